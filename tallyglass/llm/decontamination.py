"""Benchmark decontamination with a positional inverted index.

The index is cut by documents: each task turns its documents into segments of
about ``SEGMENT_WORDS`` words, one stored row each, with the sorted positions of
every term. So a term that fills a third of all text is spread over all
segments, and nothing is shuffled. Test windows are looked up in every segment:
starting from the rarest of its terms there, position lists shifted by the
term's offset in the window are intersected until none is left.

The test set goes to the executors in blocks of at most ``BLOCK_BYTES`` of text,
each of which is matched against all segments. With one block, terms that no
test item has are left out of the index, since nothing asks for them.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters.
Windows are ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window. Matches never cross documents.

Cases: null or empty texts have no words, no hit and no item; items without
words match nothing; items that repeat an id are one item, and an item without
an id marks words but is not listed; documents with equal or null ids each get
their own row. Without documents the result is empty, without items nothing is
hit. Only ids and texts are read. A document is never cut, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import landed, numbered_rows

WINDOW = 13
SEGMENT_WORDS = 1_000_000
BLOCK_BYTES = 16 * 1024 * 1024
ROWS_OUT = 10_000

# Bytes of words as they are, capitals lower-cased, everything else a space.
_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)

INDEX = (
    "segment bigint, doc_ids array<bigint>, starts binary, n_words binary, "
    "terms binary, offsets binary, positions binary"
)
MATCHES = (
    "segment bigint, doc_no int, doc_id bigint, n_words bigint, "
    "spans array<struct<first:int,after:int>>, items array<string>"
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


# ---------------------------------------------------------------------- index


def _segment(number: int, doc_ids: list, parts: list[np.ndarray], terms: Sequence[bytes]) -> pa.RecordBatch:
    """``parts``: term numbers of every document, -1 where not indexed."""
    lengths = np.array([len(p) for p in parts], dtype=np.int32)
    # One free position after each document keeps phrases from crossing it.
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int32)
    numbers = np.concatenate(parts)
    places = np.arange(len(numbers), dtype=np.int32) + np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    indexed = numbers >= 0
    numbers, places = numbers[indexed], places[indexed]
    order = np.argsort(numbers, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(numbers, minlength=len(terms)))]).astype(np.int32)
    row = [number, doc_ids, starts.tobytes(), lengths.tobytes(), b" ".join(terms), offsets.tobytes()]
    row.append(places[order].tobytes())
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
    names = ["segment", "doc_ids", "starts", "n_words", "terms", "offsets", "positions"]
    return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names)


def build_index(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    terms: Sequence[bytes] | None = None,
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """Index table, one row per segment. ``terms`` limits it to those words."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if terms is None else {t: i for i, t in enumerate(terms)}
        number = TaskContext.get().partitionId() << 32
        doc_ids, parts, held, seen = [], [], 0, {}
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                words = words_of(texts[i].as_py())
                if wanted is None:
                    found = [seen.setdefault(w, len(seen)) for w in words]
                else:
                    found = list(map(wanted.get, words, repeat(-1)))
                doc_ids.append(ids[i].as_py())
                parts.append(np.array(found, dtype=np.int32))
                held += len(words)
                if held >= segment_words:
                    yield _segment(number, doc_ids, parts, terms if terms is not None else list(seen))
                    number += 1
                    doc_ids, parts, held, seen = [], [], 0, {}
        if doc_ids:
            yield _segment(number, doc_ids, parts, terms if terms is not None else list(seen))

    rows = docs.select(
        field(id_column).cast("bigint").alias("doc_id"), field(text_column).cast("string").alias("text")
    )
    return rows.mapInArrow(segments, INDEX)


class _Segment:
    """One stored row, ready for look-ups."""

    def __init__(self, row: dict, wanted: Sequence[bytes]):
        self.number, self.doc_ids = row["segment"], row["doc_ids"]
        self.starts, self.n_words, offsets, self.positions = (
            np.frombuffer(row[c], dtype=np.int32) for c in ("starts", "n_words", "offsets", "positions")
        )
        place = {t: i for i, t in enumerate(row["terms"].split())}
        local = np.array([place.get(t, -1) for t in wanted], dtype=np.int64)
        ends = np.append(offsets[1:], 0)[local] if len(place) else np.zeros(len(local), np.int64)
        begins = np.append(offsets[:-1], 0)[local] if len(place) else np.zeros(len(local), np.int64)
        known = local >= 0
        self.begins, self.ends = np.where(known, begins, 0), np.where(known, ends, 0)
        self.counts = self.ends - self.begins

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.begins[term] : self.ends[term]]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        # An empty document shares no position, the last start at or before it is right.
        return np.searchsorted(self.starts, places, side="right") - 1

    def phrase(self, phrase: np.ndarray) -> np.ndarray:
        """Places where the terms follow one another."""
        offsets = np.argsort(self.counts[phrase], kind="stable")
        found = self.postings(phrase[offsets[0]]) - np.int32(offsets[0])
        for offset in offsets[1:]:
            if not len(found):
                break
            listed = self.postings(phrase[offset])
            at = np.searchsorted(listed, found + np.int32(offset))
            at[at == len(listed)] = 0
            found = found[listed[at] == found + np.int32(offset)]
        return found

    def together(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Places of the rarest term from which all terms lie in ``within``
        consecutive words of one document, in any order."""
        terms = np.unique(terms)
        by_count = terms[np.argsort(self.counts[terms], kind="stable")]
        rare = self.postings(by_count[0])
        for term in by_count[1:]:
            listed = self.postings(term)
            low = np.searchsorted(listed, rare - within + 1)
            high = np.searchsorted(listed, rare + within - 1, side="right")
            rare = rare[high > low]
        sure = []
        for place in rare.tolist():
            doc = self.doc_of(np.array([place]))[0]
            first, after = self.starts[doc], self.starts[doc] + self.n_words[doc]
            for begin in range(max(first, place - within + 1), place + 1):
                end = min(begin + within, after)
                if all(
                    np.searchsorted(p, begin) < np.searchsorted(p, end) for p in map(self.postings, by_count)
                ):
                    sure.append(place)
                    break
        return np.array(sure, dtype=np.int32)


# ------------------------------------------------------------------- test set


@dataclass(frozen=True)
class _Tests:
    """A block of items: its words, and windows as numbers of these."""

    words: list[bytes]
    windows: list[np.ndarray]
    items: list[str | None]  # of each window


def _tests(rows: Sequence, window: int) -> _Tests:
    numbers: dict[bytes, int] = {}
    windows: dict[tuple, None] = {}
    for row in rows:
        item = None if row["item_id"] is None else str(row["item_id"])
        found = [numbers.setdefault(w, len(numbers)) for w in words_of((row["text"] or "").encode())]
        for start in range(max(1, len(found) - window + 1) if found else 0):
            windows[(item, tuple(found[start : start + window]))] = None
    return _Tests(list(numbers), [np.array(w) for _, w in windows], [i for i, _ in windows])


def _blocks(tests: DataFrame, item_column: str, text_column: str, block_bytes: int) -> Iterator[list]:
    """Items in blocks of about ``block_bytes`` of text; the driver holds one."""
    items = tests.select(
        field(item_column).cast("string").alias("item_id"), field(text_column).cast("string").alias("text")
    )
    size = items.selectExpr("coalesce(sum(octet_length(text)), 0)").first()[0]
    count = max(1, math.ceil(size / block_bytes))
    yield count
    for block in range(count):
        yield items.filter(f"pmod(xxhash64(item_id, text), {count}) = {block}").collect()


def _runs(begins: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Overlapping and touching spans merged; ``begins`` sorted."""
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    last = np.concatenate([np.nonzero(new)[0][1:] - 1, [len(begins) - 1]])
    return [{"first": int(b), "after": int(e)} for b, e in zip(begins[new], reach[last])]


def _match(segment: _Segment, tests: _Tests) -> pa.Table:
    counts = segment.counts
    begins, ends, windows = [], [], []
    for i, window in enumerate(tests.windows):
        if counts[window].min():
            found = segment.phrase(window)
            if len(found):
                begins.append(found)
                ends.append(found + len(window))
                windows.append(np.full(len(found), i))
    n = len(segment.doc_ids)
    spans, items = [[]] * n, [[]] * n
    if begins:
        begin, end, window = map(np.concatenate, (begins, ends, windows))
        order = np.argsort(begin, kind="stable")
        begin, end, window = begin[order], end[order], window[order]
        docs = segment.doc_of(begin)
        cuts = np.concatenate([[0], np.nonzero(np.diff(docs))[0] + 1, [len(docs)]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            doc = docs[low]
            start = segment.starts[doc]
            spans[doc] = _runs(begin[low:high] - start, end[low:high] - start)
            listed = {tests.items[w] for w in window[low:high]}
            items[doc] = sorted(listed - {None})
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    values = [[segment.number] * n, range(n), segment.doc_ids, segment.n_words]
    arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
    arrays.append(pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))))
    arrays.append(pa.array(items, pa.list_(pa.string())))
    return pa.table(arrays, ["segment", "doc_no", "doc_id", "n_words", "spans", "items"])


def _lookup(spark: SparkSession, index: DataFrame, tests: _Tests) -> DataFrame:
    sent = spark.sparkContext.broadcast(tests)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                matched = _match(_Segment(row, sent.value.words), sent.value)
                yield from matched.to_batches(max_chunksize=ROWS_OUT)

    return index.mapInArrow(look, MATCHES)


_MERGED = """
aggregate(array_sort(flatten(collect_list(spans))),
  CAST(array() AS array<struct<first:int,after:int>>),
  (done, s) -> CASE WHEN size(done) > 0 AND s.first <= element_at(done, -1).after
    THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
      'first', element_at(done, -1).first, 'after', greatest(element_at(done, -1).after, s.after))))
    ELSE concat(done, array(s)) END)
"""


def exact_matches(
    docs: DataFrame,
    tests: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, spans of words inside windows that
    occur (merged, end exclusive) and the items these belong to. Runs jobs."""
    spark = docs.sparkSession
    blocks = _blocks(tests, item_column, text_column, block_bytes)
    several = next(blocks) > 1
    index = found = None
    for rows in blocks:
        block = _tests(rows, window)
        if index is None:
            terms = None if several else block.words
            index = landed(build_index(docs, id_column, text_column, terms, segment_words))
        part = _lookup(spark, index, block)
        found = part if found is None else found.union(part)
    if several:
        found = found.groupBy("segment", "doc_no").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.expr(_MERGED).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return found.select(F.col("doc_id").alias(id_column), "n_words", "spans", "items")


def proximity_matches(
    index: DataFrame, phrases: Sequence[str], within: int
) -> DataFrame:
    """Rows (doc_id, phrase): all words of the phrase, in any order, inside
    ``within`` consecutive words of the document. ``index`` must hold them."""
    rows = [{"item_id": p, "text": p} for p in phrases]
    tests = _tests(rows, window=1 << 30)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = _Segment(batch.slice(i, 1).to_pylist()[0], tests.words)
                for item, terms in zip(tests.items, tests.windows):
                    if segment.counts[terms].min():
                        docs = np.unique(segment.doc_of(segment.together(terms, within)))
                        ids = [segment.doc_ids[d] for d in docs]
                        yield pa.record_batch(
                            [pa.array(ids, pa.int64()), pa.array([item] * len(ids), pa.string())],
                            ["doc_id", "phrase"],
                        )

    return index.mapInArrow(look, "doc_id bigint, phrase string")


def contamination(
    docs: DataFrame, tests: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``exact_matches`` with n_hit, n_items and contaminated: some word is hit,
    and at least one in twenty."""
    found = exact_matches(docs, tests, id_column, text_column, **options)
    n_hit = "aggregate(spans, 0L, (n, s) -> n + s.after - s.first)"
    return found.selectExpr("*", f"{n_hit} AS n_hit", "CAST(size(items) AS BIGINT) AS n_items").withColumn(
        "contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words")
    )


def without_contaminated(
    docs: DataFrame, tests: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each decided by its own
    text, whatever its id. Runs jobs."""
    rows, number = numbered_rows(docs)
    found = contamination(rows, tests, number, text_column)
    bad = landed(found.filter("contaminated").select(number))
    return rows.join(bad, number, "left_anti").select(*map(field, docs.columns))
