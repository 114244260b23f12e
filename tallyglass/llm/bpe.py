"""Byte-level BPE: words looked up in a transducer, unseen words merged exactly.

The lexicon holds the most frequent words of the corpus, counted over all
documents. It is a minimal acyclic automaton (equal suffixes are shared) whose
edges carry the number of words before them; a word's number points at its ids.
The driver compiles it into one file of bounded size, Spark ships the file to
every executor, and workers map it into memory, so its pages are shared. All
distinct words of a batch walk the automaton together, one array step a byte.
Words it does not have are merged together too: per step, every word merges its
pair of lowest rank, the leftmost first. Results are those of merging in rank
order and do not depend on what is in the lexicon.

Cases: null texts are empty and have no token; the special tokens of the vocabulary
file inside a text become their ids; decoding replaces bytes that are no
UTF-8. Texts are never cut; a word of any length is merged with a heap. Null and
repeated ids and other columns pass through; an empty table gives an empty
result and an empty lexicon.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions.columns import field, quoted
from tallyglass.llm.common import by_bytes, landed, without
from tallyglass.llm.pieces import PieceCache

LEXICON_WORDS = 50_000
# Words a counting task holds before it hands counts on.
COUNTED_AT_ONCE = 300_000
LONGEST_TOGETHER = 48
ROWS_TOGETHER = 1 << 14

# Pre-tokenisation of this kind of vocabulary. Fixed value.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = np.iinfo(np.int32).max


def _byte_of_character() -> dict[str, int]:
    """Vocabulary files write bytes that do not print as characters from 256 on."""
    printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in printing}
    for i, b in enumerate(b for b in range(256) if b not in set(printing)):
        table[chr(256 + i)] = b
    return table


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model, to_byte = content["model"], _byte_of_character()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        raw = lambda t: bytes(map(to_byte.__getitem__, t))
        of_token = {t: i for t, i in model["vocab"].items()}
        size = max([*of_token.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in of_token.items():
            self.bytes_of[i] = token.encode() if token in self.special else raw(token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.of_byte = np.array([of_token[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([of_token[m[k]] for m in merges], dtype=np.int64) for k in (0, 1))
        self.size = size
        self.result = np.array([of_token[a + b] for a, b in merges], dtype=np.int32)
        keys = left * size + right
        order = np.argsort(keys)
        self._keys, self._rank = keys[order], order.astype(np.int32)
        self._rank_of = None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        return np.where(self._keys[at] == keys, self._rank[at], NEVER)

    def merge_long(self, word: bytes) -> np.ndarray:
        """One word of any length, with a heap of pairs."""
        if self._rank_of is None:
            self._rank_of = dict(zip(self._keys.tolist(), self._rank.tolist()))
        rank_of, size = self._rank_of, self.size
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := rank_of.get(ids[i] * size + ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.result[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def merge_together(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of many words, as bytes of 32-bit integers."""
        found: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        for start in range(0, len(order), ROWS_TOGETHER):
            rows = order[start : start + ROWS_TOGETHER]
            short = rows[lengths[rows] <= LONGEST_TOGETHER]
            if len(short):
                for i, ids in zip(short.tolist(), self._merge_rows([words[i] for i in short], lengths[short])):
                    found[i] = ids
            for i in rows[len(short) :].tolist():
                found[i] = self.merge_long(words[i]).tobytes()
        return found

    def _merge_rows(self, words: list[bytes], lengths: np.ndarray) -> list[bytes]:
        width = int(lengths.max())
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.of_byte[flat.reshape(-1, width)].astype(np.int32)
        lengths = lengths.copy()
        inside = np.arange(width - 1)[None, :] < lengths[:, None] - 1
        ranks = np.full((len(words), width), NEVER, dtype=np.int32)  # of the pair that starts here
        ranks[:, : width - 1][inside] = self.ranks(ids[:, :-1][inside], ids[:, 1:][inside])
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = np.arange(len(words))
        columns = np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            open_ = best < NEVER
            if not open_.all():
                done.append((rows[~open_], ids[~open_], lengths[~open_]))
                rows, ids, ranks, lengths = rows[open_], ids[open_], ranks[open_], lengths[open_]
                at, best = at[open_], best[open_]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, at] = self.result[best]
            # What follows the right half moves one place to the left.
            source = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, source, axis=1), np.take_along_axis(ranks, source, axis=1)
            ranks[:, -1] = NEVER
            lengths = lengths - 1
            last = at + 1 >= lengths
            following = self.ranks(ids[each, at], ids[each, np.minimum(at + 1, width - 1)])
            ranks[each, at] = np.where(last, NEVER, following)
            inner = at > 0
            i, p = each[inner], at[inner]
            ranks[i, p - 1] = self.ranks(ids[i, p - 1], ids[i, p])
        found: list[bytes] = [b""] * len(words)
        for which, values, counts in done:
            for i, row, n in zip(which.tolist(), values, counts.tolist()):
                found[i] = row[:n].tobytes()
        return found


# -------------------------------------------------------------------- lexicon


class Lexicon:
    """Look-ups in a compiled automaton that is mapped into memory."""

    FIELDS = ("edge_keys", "edge_targets", "edge_skips", "final", "id_starts", "ids")

    def __init__(self, path: str):
        with open(path, "rb") as f:
            sizes = np.frombuffer(f.read(8 * len(self.FIELDS)), dtype=np.int64)
        offset = 8 * len(self.FIELDS)
        for name, size in zip(self.FIELDS, sizes.tolist()):
            shape = (size,)
            array = np.memmap(path, np.int64, "r", offset, shape) if size else np.zeros(0, np.int64)
            setattr(self, name, array)
            offset += 8 * size

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """Number of every word, -1 for words that are not in the lexicon."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.edge_keys) or not len(words):
            return found
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        rows = np.nonzero(lengths > 0)[0]
        states, numbers = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        position = 0
        while len(rows):
            keys = states * 256 + flat[starts[rows] + position]
            at = np.searchsorted(self.edge_keys, keys)
            at[at == len(self.edge_keys)] = 0
            walks = self.edge_keys[at] == keys
            rows, at = rows[walks], at[walks]
            states = self.edge_targets[at]
            numbers = numbers[walks] + self.edge_skips[at]
            position += 1
            ends = (lengths[rows] == position)
            hit = ends & (self.final[states] == 1)
            found[rows[hit]] = numbers[hit]
            rows, states, numbers = rows[~ends], states[~ends], numbers[~ends]
        return found

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.id_starts[number] : self.id_starts[number + 1]].astype(np.int32).tobytes()


def compile_lexicon(words: Sequence[bytes], ids: Sequence[Sequence[int]], path: str) -> None:
    """Write the minimal automaton of ``words`` with the ids of each."""
    order = sorted(range(len(words)), key=words.__getitem__)
    # States under construction along the current word: [final, edges].
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple]] = []
    path_states: list[list] = [[False, []]]
    previous = b""

    def freeze(down_to: int) -> None:
        while len(path_states) > down_to + 1:
            final, edges = path_states.pop()
            key = (final, tuple(edges))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
            path_states[-1][1][-1] = (path_states[-1][1][-1][0], register[key])

    for i in order:
        word = words[i]
        shared = len(os.path.commonprefix([previous, word]))
        freeze(shared)
        for byte in word[shared:]:
            path_states[-1][1].append((byte, -1))
            path_states.append([False, []])
        path_states[-1][0] = True
        previous = word
    freeze(0)
    frozen.append((path_states[0][0], tuple(path_states[0][1])))
    # The root comes first; targets are frozen before their sources.
    number = {old: new for new, old in enumerate(reversed(range(len(frozen))))}
    below = [0] * len(frozen)  # words that end in or below a state
    for old, (final, edges) in enumerate(frozen):
        below[old] = int(final) + sum(below[t] for _, t in edges)
    keys, targets, skips = [], [], []
    for old in reversed(range(len(frozen))):
        final, edges = frozen[old]
        skipped = int(final)
        for byte, target in edges:
            keys.append(number[old] * 256 + byte)
            targets.append(number[target])
            skips.append(skipped)
            skipped += below[target]
    sorted_ids = [ids[i] for i in order]
    arrays = (
        keys,
        targets,
        skips,
        [int(f) for f, _ in reversed(frozen)],
        np.concatenate([[0], np.cumsum([len(x) for x in sorted_ids])]) if sorted_ids else [0],
        [x for row in sorted_ids for x in row],
    )
    with open(path, "wb") as f:
        np.array([len(a) for a in arrays], dtype=np.int64).tofile(f)
        for a in arrays:
            np.asarray(a, dtype=np.int64).tofile(f)


# ------------------------------------------------------------------- encoding


class Encoder:
    """Ids of whole texts, as bytes of 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self._vocabulary, self._lexicon = vocabulary, lexicon
        self._words = regex.compile(WORD).findall
        self._cache = PieceCache(
            lambda pieces: self._encode([" " + p for p in pieces]), self._encode
        )
        escaped = map(re.escape, sorted(vocabulary.special, key=len, reverse=True))
        self._special = re.compile(f"({'|'.join(escaped)})") if vocabulary.special else None

    def _encode(self, pieces: list[str]) -> list[bytes]:
        # A piece of letters only is one word.
        words = [[p] if p[1:].isalpha() and p[0] == " " else self._words(p) for p in pieces]
        distinct = list(dict.fromkeys(chain.from_iterable(words)))
        ids_of = dict(zip(distinct, self._encode_words([w.encode() for w in distinct])))
        return [ids_of[w[0]] if len(w) == 1 else b"".join([ids_of[x] for x in w]) for w in words]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        if self._lexicon is None:
            return self._vocabulary.merge_together(words)
        places = self._lexicon.numbers(words)
        unseen = np.nonzero(places < 0)[0]
        merged = self._vocabulary.merge_together([words[i] for i in unseen])
        found: list[bytes] = [b""] * len(words)
        for i, ids in zip(unseen.tolist(), merged):
            found[i] = ids
        for i in np.nonzero(places >= 0)[0].tolist():
            found[i] = self._lexicon.ids_of(int(places[i]))
        return found

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        sections: list[str] = []
        layout: list[list] = []  # per text: section numbers, and ids of special tokens as bytes
        for text in texts:
            whole = self._special is None or not any(s in text for s in self._vocabulary.special)
            row = []
            for k, part in enumerate([text] if whole else self._special.split(text)):
                if k % 2:
                    row.append(np.int32(self._vocabulary.special[part]).tobytes())
                elif part:
                    row.append(len(sections))
                    sections.append(part)
            layout.append(row)
        encoded = self._cache.joined(sections, b"".join)
        return [
            encoded[row[0]] if len(row) == 1 and isinstance(row[0], int)
            else b"".join(encoded[x] if isinstance(x, int) else x for x in row)
            for row in layout
        ]


def _ships(spark: SparkSession, path: str) -> str:
    """Give a file to every executor; returns the name they know it by."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, count) of everything between single spaces, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in by_bytes(batch, "text"):
                for text in part.column("text").to_pylist():
                    if text:
                        counts.update(text.split(" "))
                if len(counts) > COUNTED_AT_ONCE:
                    yield _counted(counts)
                    counts = Counter()
        if counts:
            yield _counted(counts)

    rows = docs.select(field(text_column).cast("string").alias("text"))
    partial = rows.mapInArrow(count, "word string, count bigint")
    return partial.groupBy("word").agg(F.sum("count").alias("count"))


def _counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
    return pa.record_batch(columns, ["word", "count"])


def build_lexicon(
    docs: DataFrame, vocabulary_path: str, text_column: str = "text", words: int = LEXICON_WORDS
) -> str:
    """Compile the most frequent words, ``words`` at most, and ship the file;
    returns its name. Runs jobs.

    A first look at how many words have which magnitude of count gives the least
    count that few enough words reach, so the driver receives those words only
    and no task sends words that others outdo."""
    counted = landed(word_counts(docs, text_column).filter("count > 1"))
    magnitude = F.floor(F.log2("count") * 16).alias("magnitude")
    sizes = counted.groupBy(magnitude).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("magnitude"))
    room, least = words, None
    for row in sizes.collect():  # 16 magnitudes for every doubling of the count
        room -= row.words
        if room < 0:
            break
        least = row.magnitude
    most = [] if least is None else counted.filter(magnitude >= least).collect()
    split = regex.compile(WORD).findall
    tokens = {w.encode() for row in most for w in split(" " + row.word)}
    listed = sorted(tokens)
    ids = vocabulary(vocabulary_path).merge_together(listed)
    # Spark refuses two files of one name.
    path = os.path.join(_driver_folder(), f"lexicon-{uuid.uuid4().hex}")
    compile_lexicon(listed, [np.frombuffer(x, np.int32).tolist() for x in ids], path)
    return _ships(docs.sparkSession, path)


@cache
def _driver_folder() -> str:
    """Where the driver keeps files that Spark ships from it."""
    return tempfile.mkdtemp(prefix="lexicon-")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_encoders: dict[tuple, Encoder] = {}


def _encoder(vocabulary_path: str, lexicon: str | None) -> Encoder:
    """One per worker process, so that its cache outlives a task."""
    key = (vocabulary_path, lexicon)
    if key not in _encoders:
        _encoders.clear()
        mapped = Lexicon(SparkFiles.get(lexicon)) if lexicon else None
        _encoders[key] = Encoder(vocabulary(vocabulary_path), mapped)
    return _encoders[key]


def _encoded(texts: list[str | None], encoder: Encoder) -> tuple[pa.Array, pa.Array]:
    """Counts and lists of ids."""
    found = encoder.encode([t or "" for t in texts])
    counts = np.array([len(x) // 4 for x in found], dtype=np.int64)
    values = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values)


class _Decoder:
    """Bytes of many tokens by one look-up."""

    def __init__(self, pieces: Sequence[bytes]):
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def texts(self, rows: pa.ListArray) -> pa.Array:
        texts: list[str | None] = []
        for row in rows:
            if not row.is_valid:
                texts.append(None)
                continue
            ids = row.values.to_numpy(zero_copy_only=False)
            lengths = self.sizes[ids]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ids) else 0
            place = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
            texts.append(self.flat[place].tobytes().decode("utf-8", "replace"))
        return pa.array(texts, pa.string())


@lru_cache(maxsize=2)
def _decoder(vocabulary_path: str) -> _Decoder:
    return _Decoder(vocabulary(vocabulary_path).bytes_of)


def _added(df: DataFrame, **columns: str):
    """``df`` less columns of these names, and its schema with them."""
    df = without(df, *columns)
    kept = [quoted(c) for c in df.columns]
    return df, df.selectExpr(*kept, *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in columns.items()]).schema


def encode(
    docs: DataFrame, vocabulary_path: str, lexicon: str | None = None, text_column: str = "text"
) -> DataFrame:
    """``docs`` and the columns n_tokens and ids, which replace any of that name. The
    vocabulary file is read at that path by every executor; ``lexicon`` is a name
    from ``build_lexicon``."""
    docs, schema = _added(docs, n_tokens="bigint", ids="array<int>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_path, lexicon)
        for batch in batches:
            for part in by_bytes(batch, text_column):
                added = _encoded(part.column(text_column).to_pylist(), encoder)
                yield pa.record_batch([*part.columns, *added], schema.names)

    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, vocabulary_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` and the column decoded: the text of the ids. Null ids give null."""
    encoded, schema = _added(encoded, decoded="string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _decoder(vocabulary_path).texts(batch.column(ids_column))
            yield pa.record_batch([*batch.columns, texts], schema.names)

    return encoded.mapInArrow(work, schema)


def round_trip(
    docs: DataFrame, vocabulary_path: str, lexicon: str | None = None, text_column: str = "text"
) -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that ids go to the JVM once and a task
    has one Python worker."""
    docs, schema = _added(docs, n_tokens="bigint", ids="array<int>", decoded="string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(vocabulary_path, lexicon), _decoder(vocabulary_path)
        for batch in batches:
            for part in by_bytes(batch, text_column):
                counts, ids = _encoded(part.column(text_column).to_pylist(), encoder)
                added = counts, ids, decoder.texts(ids)
                yield pa.record_batch([*part.columns, *added], schema.names)

    return docs.mapInArrow(work, schema)
