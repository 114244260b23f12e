"""How far the sources of a language differ in their words, and by which words.

A term is a run of letters and other characters beyond ASCII, with ASCII capitals
lower-cased. Each language keeps the terms that enough of its documents have. A
group (the documents of one language and source) gives every kept term the share
p = 1 + floor(scale (count + 2) / (N + 2 V)), with N the group's count over all V
kept terms; so does the whole language. The divergence of two groups is the sum of
floor((p - q)^2 / (p + q)) over all kept terms, also those that neither group has.

Kept terms are dealt into blocks of some thousand by a hash, frequent ones first
inside a block. In each block the groups' counts are leaves of segment trees whose
nodes are hash-consed: nodes with equal children are one node, across all groups,
so stretches without occurrences or with like small counts are stored once. Two
groups are compared by walking both trees at once. Pairs of nodes that were met
before are not walked again but counted, level by level, so every different pair
of leaves of two groups is priced once, times the number of its places.

Scale: one scan counts terms per task and group; only sums are shuffled, and terms
that few documents have go before anything is joined. A block holds the counts of
at most two tiles of sources, whatever the number of sources, so a task's memory is
bounded; sums over blocks are added by Spark. A hot term or group sends one row a
task. All numbers are exact integers (below 2^53 words in a language).

Cases: null text, language and source count as empty; every row is a document, also
one with a repeated or null id; groups without a term take part; a language without
a kept term has divergence 0 everywhere; ties go by the item's bytes. Texts are read
whole, long ones in parts. An empty table gives an empty result; only the three
columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes, landed

LEAST_DOCS = 10
MOST_TERMS = 10
SCALE_STEPS = 3  # the scale is 1000 to this power
BLOCK_TERMS = 8192
TILE_SOURCES = 64
# Terms a counting task holds before it hands counts on; bytes of a text split at once.
COUNTED_AT_ONCE = 300_000
SPLIT_AT_ONCE = 4 * 1024 * 1024
# Places of two trees that are walked together.
WALKED_AT_ONCE = 1 << 19

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)
)


# ------------------------------------------------------------------- counting


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, of a long one in several lists."""
    start = 0
    while start < len(text):
        stop = start + SPLIT_AT_ONCE
        part = text[start:stop].translate(_LETTERS)
        if stop < len(text):
            cut = part.rfind(b" ")
            while cut < 0 and stop < len(text):  # one term so far
                part += text[stop : stop + SPLIT_AT_ONCE].translate(_LETTERS)
                stop += SPLIT_AT_ONCE
                cut = part.rfind(b" ")
            if stop < len(text):
                part = part[: cut + 1]
        start += len(part)
        yield part.split()


_COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _counted(groups: dict[tuple, tuple[Counter, Counter]]) -> pa.RecordBatch:
    """A row per group and term, and one without a term for every group."""
    columns: list[list] = [[], [], [], [], []]
    for (lang, source), (counts, docs) in groups.items():
        own = len(counts) + 1
        for column, values in zip(
            columns,
            (
                [lang] * own,
                [source] * own,
                [None, *counts],
                [0, *counts.values()],
                [0, *map(docs.__getitem__, counts)],
            ),
        ):
            column += values
    kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    arrays[2] = arrays[2].cast(pa.string())
    return pa.record_batch(arrays, ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        for part in by_bytes(batch, "text"):
            keys = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            for key, text in zip(keys, part.column("text").cast(pa.binary()).to_pylist()):
                counts, docs = groups.setdefault(key, (Counter(), Counter()))
                seen: set[bytes] = set()
                for found in terms(text):
                    counts.update(found)
                    seen.update(found)
                docs.update(seen)
            if sum(len(counts) for counts, _ in groups.values()) > COUNTED_AT_ONCE:
                yield _counted(groups)
                groups = {}
    if groups:
        yield _counted(groups)


def kept_counts(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """lang, source, term, n and in_lang (the term's count in the language) for every kept
    term of a group; with a null term one row for every group. Lazy."""
    named = {"lang": lang_column, "source": source_column, "text": text_column}
    rows = docs.select(*[F.coalesce(field(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    sums = (
        rows.mapInArrow(_count, _COUNTS)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    same = Window.partitionBy("lang", "term")
    whole = sums.select(
        "lang", "source", "term", "n", F.sum("docs").over(same).alias("docs"), F.sum("n").over(same).alias("in_lang")
    )
    return whole.filter(f"term IS NULL OR docs >= {least_docs}").drop("docs")


# ------------------------------------------------------------- trees of a block


def share(count: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """1 + floor(scale (count + 2) / (total + 2 kept)), by long division in steps of 1000."""
    whole, rest = np.divmod(count + 2, total + 2 * kept)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * 1000, total + 2 * kept)
        whole = whole * 1000 + digits
    return 1 + whole


class Trees:
    """Segment trees over the rows of ``counts``; equal nodes of a level are one node.
    ``below[i]`` holds the left and right child of every node of level i, the root's
    level first; ``leaves`` are the different counts, -1 where no term is."""

    def __init__(self, counts: np.ndarray):
        groups, places = counts.shape
        width = 1 << max(0, places - 1).bit_length()
        padded = np.full((groups, width), -1, dtype=np.int64)
        padded[:, :places] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(groups, width)
        self.below: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            size = int(nodes.max()) + 1
            keys, nodes = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
            nodes = nodes.reshape(groups, -1)
            self.below.insert(0, (keys // size, keys % size))
        self.roots = nodes[:, 0]

    def different_leaves(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """For pairs of trees: the number of a pair, two counts, and at how many places
        they meet. Every pair of nodes is walked once, with its number of places."""
        pair = np.arange(len(first))
        a, b, places = self.roots[first], self.roots[second], np.ones(len(first), dtype=np.int64)
        for left, right in self.below:
            pair, places = np.tile(pair, 2), np.tile(places, 2)
            a, b = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
            size = int(max(a.max(), b.max())) + 1
            keys = (pair * size + a) * size + b
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
            places = np.add.reduceat(places[order], starts)
            keys = keys[starts]
            pair, a, b = keys // size // size, keys // size % size, keys % size
        return pair, self.leaves[a], self.leaves[b], places


def block_divergences(
    counts: np.ndarray, totals: np.ndarray, kept: int, first: np.ndarray, second: np.ndarray
) -> np.ndarray:
    """What the terms of a block add to the divergence of the groups ``first`` and ``second``."""
    found = np.zeros(len(first), dtype=np.int64)
    if not counts.shape[1]:
        return found
    trees = Trees(counts)
    step = max(1, WALKED_AT_ONCE // counts.shape[1])
    for start in range(0, len(first), step):
        one, two = first[start : start + step], second[start : start + step]
        pair, a, b, places = trees.different_leaves(one, two)
        real = a >= 0
        pair, a, b, places = pair[real], a[real], b[real], places[real]
        p, q = share(a, totals[one[pair]], kept), share(b, totals[two[pair]], kept)
        np.add.at(found, start + pair, (p - q) ** 2 // (p + q) * places)
    return found


def _compare_block(rows: pa.Table) -> pa.Table:
    """Rows of one block and two tiles. A group's own row has place -1, its N as n and
    the number of terms in the block and the language."""
    place, n, tile = (rows.column(c).to_numpy() for c in ("place", "n", "tile"))
    sources = rows.column("source").to_pylist()
    heads = sorted(np.nonzero(place < 0)[0].tolist(), key=lambda i: sources[i].encode())
    number = {sources[i]: k for k, i in enumerate(heads)}
    terms_here, kept = (int(rows.column(c)[heads[0]].as_py()) for c in ("terms", "kept"))
    counts = np.zeros((len(heads), terms_here), dtype=np.int64)
    own = np.nonzero(place >= 0)[0]
    counts[[number[sources[i]] for i in own.tolist()], place[own]] = n[own]
    first, second = np.triu_indices(len(heads), 1)
    tiles = tile[heads]
    low, high = int(rows.column("low")[0].as_py()), int(rows.column("high")[0].as_py())
    # Two groups of one tile are compared where the tile meets itself.
    meet = (np.minimum(tiles[first], tiles[second]) == low) & (np.maximum(tiles[first], tiles[second]) == high)
    first, second = first[meet], second[meet]
    found = block_divergences(counts, n[heads], kept, first, second)
    names = [sources[i] for i in heads]
    return pa.table(
        {
            "lang": pa.array([rows.column("lang")[0].as_py()] * len(first), pa.string()),
            "a": pa.array([names[i] for i in first.tolist()], pa.string()),
            "b": pa.array([names[i] for i in second.tolist()], pa.string()),
            "value": pa.array(found),
        }
    )


# -------------------------------------------------------------------- on Spark


def _share(count: str, total: str, kept: str) -> str:
    """As ``share``, in SQL."""
    size, rest = f"({total} + 2 * {kept})", f"({count} + 2)"
    whole = f"({rest} div {size})"
    for _ in range(SCALE_STEPS):
        rest = f"(({rest} % {size}) * 1000)"
        whole = f"({whole} * 1000 + {rest} div {size})"
    return f"(1 + {whole})"


class Audit:
    """The tables that both parts of a report start from. Runs jobs."""

    def __init__(self, counts: DataFrame):
        counts = landed(counts)
        self.groups = landed(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")))
        of_lang = counts.groupBy("lang", "term").agg(F.max("in_lang").alias("n")).groupBy("lang")
        langs = of_lang.agg(F.count("term").alias("kept"), F.sum(F.when(F.col("term").isNotNull(), F.col("n"))).alias("total"))
        sources = self.groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        self.langs = landed(
            langs.join(sources, "lang").select(
                "lang",
                "kept",
                F.coalesce("total", F.lit(0)).alias("total"),
                F.expr(f"greatest(1L, CAST(ceil(kept / {BLOCK_TERMS}D) AS BIGINT))").alias("blocks"),
                F.expr(f"CAST(ceil(sources / {TILE_SOURCES}D) AS BIGINT)").alias("tiles"),
            )
        )
        blocks = counts.filter("term IS NOT NULL").join(self.langs.select("lang", "blocks"), "lang")
        blocks = blocks.withColumn("block", F.expr("pmod(xxhash64(term), blocks)"))
        inside = Window.partitionBy("lang", "block")
        place = F.dense_rank().over(inside.orderBy(F.desc("in_lang"), "term")) - 1
        self.entries = landed(blocks.select("lang", "source", "term", "n", "in_lang", "block", place.alias("place")))

    def _tiled(self, rows: DataFrame) -> DataFrame:
        """Every row once for each tile that its own tile meets."""
        own = F.expr("CAST(pmod(xxhash64(source), tiles) AS BIGINT)")
        rows = rows.withColumn("tile", own).withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
        return rows.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})

    def pairs(self) -> DataFrame:
        """(lang, source, item, value) for every two sources of a language, both ways."""
        sizes = self.entries.groupBy("lang", "block").agg((F.max("place") + 1).cast("bigint").alias("terms"))
        blocks = self.langs.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        blocks = blocks.drop("total").join(sizes, ["lang", "block"], "left")
        heads = self._tiled(self.groups.join(blocks, "lang")).select(
            "lang", "block", "low", "high", "tile", "source",
            F.lit(-1).alias("place"), F.col("total").alias("n"), F.coalesce("terms", F.lit(0)).alias("terms"), "kept",
        )
        counts = self._tiled(self.entries.join(self.langs.select("lang", "tiles"), "lang")).select(
            "lang", "block", "low", "high", "tile", "source",
            "place", "n", F.lit(0).cast("bigint").alias("terms"), F.lit(0).cast("bigint").alias("kept"),
        )
        partial = (
            heads.unionByName(counts)
            .groupBy("lang", "block", "low", "high")
            .applyInArrow(_compare_block, "lang string, a string, b string, value bigint")
        )
        summed = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = F.explode(
            F.array(
                F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
            )
        )
        return summed.select("lang", both.alias("side"), "value").select("lang", "side.*", "value")

    def terms(self) -> DataFrame:
        """(lang, source, item, value) for the terms that a group has more often than its
        language."""
        groups = self.groups.withColumnRenamed("total", "own")
        langs = self.langs.select("lang", "kept", "total")
        rows = self.entries.filter("n > 0").join(groups, ["lang", "source"]).join(langs, "lang")
        rows = rows.select(
            "lang",
            "source",
            F.col("term").alias("item"),
            F.expr(_share("n", "own", "kept")).alias("p"),
            F.expr(_share("in_lang", "total", "kept")).alias("q"),
        )
        return rows.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """Rows (lang, source, item, value) with their rank, the ``most`` first of a group."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    numbered = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        numbered = numbered.filter(F.col("rank") <= most)
    return numbered.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, most_terms: int = MOST_TERMS, **columns) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` ranks all other sources of the
    language, part ``term`` the terms that set a group apart. ``columns`` are those of
    ``kept_counts``. Runs jobs."""
    tables = Audit(kept_counts(docs, **columns))
    pairs = ranked(tables.pairs(), "pair")
    return pairs.unionByName(ranked(tables.terms(), "term", most_terms))
