"""Exact duplicates by 128-bit content hash, with bytes compared inside groups.

Texts are equal when identical after every run of ASCII white space became one
space; a null text counts as empty. One scan lands a slim table of ids and
hashes. Groups come from that table alone: partial aggregation leaves one row
per hash and task, so a group that holds a third of all rows is harmless.
Bytes are compared by grouping all texts by (hash, text), again collapsed per
task; a hash that two texts share is then split by text. That shuffles every
different text once whatever the number of copies: looking up first which hashes
repeat would need the list of these in every task, and no bound holds for it.

Cases: nulls in any other column are ignored; a null id sorts after every other
and is ``keep_id`` only of a group without any id. Rows that repeat id and text
are one group like any copies, and exactly one of them is kept. An empty table
gives an empty result. Only the id and text columns are read, so other columns
may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.columns import field, unused
from tallyglass.llm.common import landed

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> F.Column:
    return F.regexp_replace(F.coalesce(field(text).cast("string"), F.lit("")), WHITE_SPACE, " ")


def content_hash(norm: F.Column) -> F.Column:
    """128 bits."""
    return F.unhex(F.md5(norm))


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", hashed=content_hash
) -> DataFrame:
    """One row per input row: the id column, keep_id, group_size, kept,
    text_sha256. Runs jobs. ``hashed`` makes the group hash of a text."""
    texts = docs.select(field(id_column).alias("doc_id"), normalised(text_column).alias("norm"))
    texts = texts.withColumn("content", hashed(F.col("norm")))
    slim = landed(_slim(texts, F.col("content")))
    repeated = landed(_repeated(slim))
    different = texts.select("content", "norm").distinct()
    shared = landed(different.groupBy("content").count().filter("count > 1").select("content"))
    if not shared.isEmpty():
        # Texts of shared hashes go by their own bytes; every other row has null there.
        split = texts.join(shared.withColumn("split", F.lit(True)), "content", "left")
        own_bytes = F.struct("content", F.when(F.col("split"), F.col("norm")))
        slim = landed(_slim(split, own_bytes))
        repeated = landed(_repeated(slim))
    # Both sides come from files, so a hot group can be cut by the skew join.
    return slim.join(repeated, "content", "left").select(
        F.col("doc_id").alias(id_column),
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("first_row.doc_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("row_number") == F.col("first_row.row_number"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def _slim(texts: DataFrame, content: F.Column) -> DataFrame:
    number = F.monotonically_increasing_id().alias("row_number")
    return texts.select("doc_id", number, content.alias("content"), F.sha2("norm", 256).alias("text_sha256"))


def _repeated(slim: DataFrame) -> DataFrame:
    """Groups of at least two rows with their first row."""
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_number"))
    groups = slim.groupBy("content").agg(
        F.min(first).alias("first_row"), F.count(F.lit(1)).alias("group_size")
    )
    return groups.filter("group_size > 1")


def without_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, whole, one per group. Runs jobs."""
    rows = landed(exact_groups(docs, id_column, text_column))
    again = rows.groupBy(field(id_column), "text_sha256").count().filter("count > 1")
    digest, kept_id, kept_text = (unused(docs, n) for n in ("digest_of_row", "kept_id", "kept_text"))
    wanted = rows.filter("kept").select(
        field(id_column).alias(kept_id), F.col("text_sha256").alias(kept_text)
    )
    staying = docs.withColumn(digest, F.sha2(normalised(text_column), 256)).join(
        wanted,
        field(id_column).eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_text)),
        "left_semi",
    )
    if not again.isEmpty():  # whole rows repeat, so the join keeps each of them
        staying = staying.dropDuplicates([id_column, digest])
    return staying.drop(digest)
