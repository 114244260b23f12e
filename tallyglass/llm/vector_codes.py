"""Vector codes: product quantisation in exact integers, nearest entries by LAESA.

Every component x becomes the integer floor(scale * x); a vector is cut into
equal consecutive parts, and each part position has a codebook of its own. The
codebook starts as that part of the vectors with the smallest ids, and a round
assigns every part to its nearest entry and moves each entry to the floor of the
mean of its parts. All distances and sums are exact integers, so the result does
not depend on how Spark deals out the rows.

Search: a few entries of the first codebooks, chosen far from each other, are the
pivots and stay fixed. The distance of every part to every pivot is computed once
and landed beside the vector. In each round the distances from pivots to entries
bound those from parts to entries from below (the triangle inequality); entries
are taken in the order of that bound, evaluated exactly some at a time, and a
part is done as soon as the next bound exceeds the best distance found.

Rounds pass sums on: one row per entry and component from a task, summed by
Spark. The driver holds codebooks only, whose size depends on the dimension.

Cases: vectors that are null or hold a null, NaN or infinite component are
dropped, and so are those whose squared distances could leave 64 bits and those
of another dimension than the most frequent one (among multiples of the number
of parts; of two, the larger). With fewer vectors than entries a codebook has
that many entries. Equal entries: the lower index wins. Null ids come last,
repeated ids go by their components; every row gets a code of its own. An empty
table gives an empty result. Only id, vector and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.columns import field, quoted
from tallyglass.llm.common import landed

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
# Squared distances of whole vectors stay below 2^62.
SQUARED_LIMIT = 2.0**60
# Parts assigned together, and entries evaluated exactly at a time.
ROWS_AT_ONCE = 1024
ENTRIES_AT_ONCE = 32


@dataclass(frozen=True)
class Codebooks:
    """``entries`` has the shape (parts, entries, components of a part)."""

    entries: np.ndarray
    pivots: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vector: str, scale: int = SCALE) -> str:
    return f"transform({vector}, x -> CAST(floor(CAST(x AS DOUBLE) * {scale}D) AS INT))"


def usable(vector: str, scale: int = SCALE) -> str:
    """Neither null nor without an exact code; NaN is above every limit."""
    limit = f"sqrt({SQUARED_LIMIT:.1f}D / size({vector})) - 1"
    fits = f"forall({vector}, x -> x IS NOT NULL AND abs(CAST(x AS DOUBLE)) * {scale}D < {limit})"
    return f"CASE WHEN size({vector}) > 0 THEN {fits} ELSE false END"


def kept_vectors(
    df: DataFrame, id_column: str, vector_column: str, label_column: str | None, parts: int, scale: int
) -> DataFrame:
    """id, label and the integer components of the vectors that get a code. Runs a job."""
    vector = quoted(vector_column)
    rows = df.select(
        field(id_column).alias("id"),
        (F.lit(None).cast("int") if label_column is None else field(label_column)).alias("label"),
        F.expr(f"CASE WHEN {usable(vector, scale)} THEN {integers(vector, scale)} END").alias("v"),
    ).filter(f"v IS NOT NULL AND size(v) % {parts} = 0")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    most = sizes.first()
    return rows.filter(F.size("v") == (most.n if most else 0))


# ------------------------------------------------------------------ one batch


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every point to every entry."""
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def chosen_pivots(entries: np.ndarray, pivots: int) -> np.ndarray:
    """Entries far from each other, for every part position: the first one, then
    always the one farthest from those chosen."""
    chosen = []
    for own in entries:
        places = [0] if len(own) else []
        nearest = distances(own, own[:1])[:, 0] if len(own) else None
        while len(places) < min(pivots, len(own)):
            places.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(own, own[places[-1:]])[:, 0])
        chosen.append(own[places])
    return np.stack(chosen)


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(distances(points, pivots)).astype(np.float32)


def nearest(
    points: np.ndarray, entries: np.ndarray, point_pivots: np.ndarray, entry_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry, the lowest of several.
    ``point_pivots`` and ``entry_pivots`` hold distances, a row a point or entry."""
    n, k = len(points), len(entries)
    bound, gap = np.zeros((n, k), dtype=np.float32), np.empty((n, k), dtype=np.float32)
    for p in range(point_pivots.shape[1]):
        np.subtract(point_pivots[:, p, None], entry_pivots[None, :, p], out=gap)
        np.maximum(bound, np.abs(gap, out=gap), out=bound)
    # Less by what the roots may be rounded.
    bound -= (point_pivots.max(axis=1)[:, None] + entry_pivots.max(axis=1)[None, :]) * np.float32(2.0**-21)
    np.maximum(bound, 0, out=bound)
    order = np.argsort(bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1).astype(np.float64) ** 2
    best = np.full(n, np.iinfo(np.int64).max)
    at = np.full(n, k)
    open_ = np.arange(n)
    for start in range(0, k, ENTRIES_AT_ONCE):
        open_ = open_[bound[open_, start] <= best[open_]]
        if not len(open_):
            break
        which = order[open_, start : start + ENTRIES_AT_ONCE]
        gaps = points[open_][:, None, :] - entries[which]
        found = np.einsum("ijk,ijk->ij", gaps, gaps)
        least = found.min(axis=1)
        index = np.where(found == least[:, None], which, k).min(axis=1)
        better = (least < best[open_]) | ((least == best[open_]) & (index < at[open_]))
        rows = open_[better]
        best[rows], at[rows] = least[better], index[better]
    return at, best


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _assigned(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch with, per part position, its points, indexes and distances."""
    parts, _, width = books.entries.shape
    entry_pivots = [to_pivots(e, p) for e, p in zip(books.entries, books.pivots)]
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        piece = batch.slice(start, ROWS_AT_ONCE)
        points = _matrix(piece.column("v"), piece.num_rows).astype(np.int64).reshape(-1, parts, width)
        known = _matrix(piece.column("d"), piece.num_rows).reshape(piece.num_rows, parts, -1)
        yield piece, [
            (points[:, i], *nearest(points[:, i], books.entries[i], known[:, i], entry_pivots[i]))
            for i in range(parts)
        ]


# -------------------------------------------------------------------- on Spark


def _with_pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Column d: the distances of all parts to their pivots, part after part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count, width = pivots.shape
        for batch in batches:
            points = _matrix(batch.column("v"), batch.num_rows).astype(np.int64).reshape(-1, parts, width)
            known = np.concatenate([to_pivots(points[:, i], pivots[i]) for i in range(parts)], axis=1)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (parts * count))
            lists = pa.ListArray.from_arrays(ends, pa.array(known.ravel()))
            yield pa.record_batch([*batch.columns, lists], [*batch.schema.names, "d"])

    return rows.mapInArrow(work, rows.withColumn("d", F.expr("CAST(array() AS array<float>)")).schema)


def _moved(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries after one round. A cell is an entry's number of parts, then its sums."""
    shipped = rows.sparkSession.sparkContext.broadcast(books)
    parts, entries, width = books.entries.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            for _, found in _assigned(batch, shipped.value):
                for i, (points, at, _) in enumerate(found):
                    sums[i, :, 0] += np.bincount(at, minlength=entries)
                    for j in range(width):
                        # A slice's sums are small enough to be exact as doubles.
                        own = np.bincount(at, weights=points[:, j], minlength=entries)
                        sums[i, :, j + 1] += own.astype(np.int64)
        cells = np.nonzero(sums.ravel())[0]
        yield pa.record_batch([pa.array(cells), pa.array(sums.ravel()[cells])], ["cell", "total"])

    partial = rows.select("v", "d").mapInArrow(work, "cell bigint, total bigint")
    totals = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    for row in partial.groupBy("cell").agg(F.sum("total").alias("total")).collect():
        totals[row.cell] = row.total
    totals = totals.reshape(books.entries.shape[:2] + (width + 1,))
    counts = totals[:, :, :1]
    shipped.unpersist()
    return np.where(counts > 0, totals[:, :, 1:] // np.maximum(counts, 1), books.entries)


def compress(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """One row per vector that gets a code: the id column, label, codes (an index a
    part) and error, its squared distance; and the codebooks. Runs jobs."""
    kept = kept_vectors(df, id_column, vector_column, label_column, parts, scale)
    first = kept.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    width = len(first[0].v) // parts if first else 0
    begun = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), parts, width)
    begun = begun.transpose(1, 0, 2)
    fixed = chosen_pivots(begun, pivots)
    books = Codebooks(begun, fixed)
    rows = landed(_with_pivot_distances(kept, fixed), compression="zstd")
    for _ in range(rounds if first else 0):
        books = Codebooks(_moved(rows, books), fixed)
    return _coded(rows, books).withColumnRenamed("id", id_column), books


def _coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    shipped = rows.sparkSession.sparkContext.broadcast(books)
    parts = len(books.entries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, found in _assigned(batch, shipped.value):
                codes = np.stack([at for _, at, _ in found], axis=1).astype(np.int32)
                ends = pa.array(np.arange(piece.num_rows + 1, dtype=np.int32) * parts)
                lists = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
                error = pa.array(sum(d for _, _, d in found))
                columns = [piece.column("id"), piece.column("label"), lists, error]
                yield pa.record_batch(columns, ["id", "label", "codes", "error"])

    kinds = rows.selectExpr("id", "label", "CAST(array() AS array<int>) AS codes", "0L AS error").schema
    return rows.mapInArrow(work, kinds)


def restored(coded: DataFrame, books: Codebooks, scale: int = SCALE, codes_column: str = "codes") -> DataFrame:
    """``coded`` and the column restored: the vector that the codes stand for."""
    coded = coded.drop("restored")
    shipped = coded.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shipped.value.entries
        for batch in batches:
            codes = _matrix(batch.column(codes_column), batch.num_rows)
            values = np.concatenate([own[codes[:, i]] for i, own in enumerate(entries)], axis=1) / scale
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * values.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
            yield pa.record_batch([*batch.columns, lists], [*batch.schema.names, "restored"])

    return coded.mapInArrow(work, coded.withColumn("restored", F.expr("CAST(array() AS array<double>)")).schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` and label_error, the error summed over the rows of equal label; null
    labels are equal; null if it leaves 64 bits. Both sides of the join come from files, so that a hot label can
    be cut by the skew join. Runs jobs."""
    rows = landed(coded)
    sums = landed(rows.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error")))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
