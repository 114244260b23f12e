"""Near-duplicate documents by SimHash and pigeonring filtering.

Fingerprint: ASCII letters lower-cased, words between ASCII white space, four
consecutive words joined by a space are a shingle (repeats count; a shorter
text is one shingle, a text without words has fingerprint zero). A bit is set
when it is set in over half of the shingles' 64-bit hashes.

Links: 64 bits form a ring of five segments. If two fingerprints differ in at
most four bits, some segment starts a chain along which the first ``n``
segments together differ in at most ``4 n / 5`` bits, for every ``n``. Hence the
first segment is equal, the first two differ in at most one bit, three in two,
four in three. The first two segments are the join key: one side lists its own
value, the other all values within one bit of the second segment. The rest of
the chain and then the whole distance are checked on what the join returns.

Equal fingerprints collapse first, so only different ones are compared. Listing
every pair of a key would grow with the square of its group. Keys with many
members (and those next to them) therefore go another exact way: their members
are searched breadth first, which gives a spanning forest, fewer links than
members with the same components. Components come from landed links, round by
round; nothing but counts reaches the driver.

Cases: null text counts as empty; a null id sorts after all others and names a
component only if it has no other id; repeated rows share a component; an empty
table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes, landed, numbered_rows
from tallyglass.llm.components import component_of_nodes

SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
SEGMENT_BITS = (13, 13, 13, 13, 12)
# Shingles of a text whose bits are counted at once.
COUNTED_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    set_bits = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), COUNTED_AT_ONCE):
        part = hashes[start : start + COUNTED_AT_ONCE].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_bytes(batch, "text"):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            values = [fingerprint(t) if t else 0 for t in texts]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            kept = [c for c in part.schema.names if c != "text"]
            yield pa.record_batch([*map(part.column, kept), pa.array(signed)], [*kept, "fp"])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carried: F.Column | None = None
) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit integer, with the column
    ``carried`` between them if there is one."""
    others = [] if carried is None else [carried.alias("carried")]
    rows = docs.select(
        field(id_column).cast("bigint").alias("doc_id"), *others, field(text_column).cast("string").alias("text")
    )
    return rows.mapInArrow(_fingerprints, rows.drop("text").withColumn("fp", F.lit(0).cast("bigint")).schema)


def _segments() -> list[tuple[int, int]]:
    """Lowest bit and width of every segment."""
    starts = [sum(SEGMENT_BITS[:i]) for i in range(len(SEGMENT_BITS))]
    return list(zip(starts, SEGMENT_BITS))


def _ring_keys(fp: str, near: bool) -> str:
    """Array of join keys: segment number, its bits and those of the next one;
    with ``near`` the next one within one bit as well."""
    segments, keys = _segments(), []
    for i, (start, width) in enumerate(segments):
        after, after_width = segments[(i + 1) % len(segments)]
        first = f"(shiftrightunsigned({fp}, {start}) & {(1 << width) - 1}L)"
        second = f"(shiftrightunsigned({fp}, {after}) & {(1 << after_width) - 1}L)"
        flips = [0, *(1 << b for b in range(after_width))] if near else [0]
        head = f"shiftleft({i}L, 40) | shiftleft({first}, 16)"
        keys += [f"{head} | ({second} ^ {flip}L)" for flip in flips]
    return f"array({', '.join(keys)})"


def _literal(value: int) -> str:
    return f"CAST('{value}' AS BIGINT)"  # the smallest long has no plain literal


def _chain_holds(a: str, b: str, key: str) -> str:
    """The chain that starts at the key's segment stays within its budgets."""
    segments = _segments()
    cases = []
    for i in range(len(segments)):
        checks, mask = [], 0
        for length in range(1, len(segments)):
            start, width = segments[(i + length - 1) % len(segments)]
            mask |= ((1 << width) - 1) << start
            signed = mask - (1 << 64) if mask >= 1 << 63 else mask
            budget = MAX_DISTANCE * length // len(segments)
            checks.append(f"bit_count(({a} ^ {b}) & {_literal(signed)}) <= {budget}")
        cases.append(f"WHEN {i} THEN {' AND '.join(checks[2:])}")
    return f"CASE CAST(shiftright({key}, 40) AS INT) {' '.join(cases)} END"


def _forest(table: pa.Table) -> pa.Table:
    """Links that connect the members of one key as all links within reach would."""
    left = np.unique(table.column("fp").to_numpy()).view(np.uint64)
    a, b = [], []
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            node, reached = reached[0], reached[1:]
            near = np.bitwise_count(left ^ node) <= MAX_DISTANCE
            found, left = left[near], left[~near]
            a.append(np.full(len(found), node))
            b.append(found)
            reached = np.concatenate([reached, found])
    joined = [np.concatenate(x or [np.zeros(0, np.uint64)]).view(np.int64) for x in (a, b)]
    return pa.table(joined, ["a", "b"])


def links(fps: DataFrame, members_of_dense_key: int = 256) -> DataFrame:
    """Links (a, b) between different fingerprints of column ``fp`` that give the
    components of all pairs within reach. Runs a job."""
    different = fps.select("fp").distinct()
    own = different.selectExpr("fp AS a", f"explode({_ring_keys('fp', near=False)}) AS key")
    near = different.selectExpr("fp AS b", f"explode({_ring_keys('fp', near=True)}) AS key")
    many = own.groupBy("key").count().filter(f"count > {members_of_dense_key}")
    flips = ", ".join(f"{f}L" for f in (0, *(1 << bit for bit in range(max(SEGMENT_BITS)))))
    dense = landed(many.selectExpr(f"explode(transform(array({flips}), f -> key ^ f)) AS key").distinct())
    some = not dense.isEmpty()
    pairs = (own.join(dense, "key", "left_anti") if some else own).join(near, "key")
    found = pairs.filter("a < b").filter(_chain_holds("a", "b", "key"))
    found = found.filter(f"bit_count(a ^ b) <= {MAX_DISTANCE}").select("a", "b")
    if some:
        members = near.join(dense, "key").select("key", F.col("b").alias("fp"))
        found = found.union(members.groupBy("key").applyInArrow(_forest, "a bigint, b bigint"))
    return found


def _components(prints: DataFrame) -> DataFrame:
    """(fp, component_id) of all fingerprints of the landed table ``prints``. Runs jobs."""
    reps = landed(prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")))
    parts = component_of_nodes(links(reps))
    of_print = landed(
        reps.join(parts, F.col("fp") == F.col("node"), "left").select(
            "fp", "smallest", F.coalesce("component", "fp").alias("component")
        )
    )
    # From files, so that a component with very many fingerprints can be cut by the skew join.
    names = landed(of_print.groupBy("component").agg(F.min("smallest").alias("component_id")))
    return of_print.join(names, "component").select("fp", "component_id")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id column, fp and component_id. Runs jobs."""
    prints = landed(fingerprints(docs, id_column, text_column))
    named = _components(prints)
    return prints.join(named, "fp").select(F.col("doc_id").alias(id_column), "fp", "component_id")


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` per component, that of the smallest id, null last; of
    rows that share it the first. Runs jobs."""
    rows, number = numbered_rows(docs)
    prints = landed(fingerprints(rows, number, text_column, field(id_column)))
    groups = landed(prints.join(_components(prints), "fp").select("doc_id", "carried", "component_id"))
    place = F.struct(F.col("carried").isNull(), F.col("carried"), F.col("doc_id").alias("row"))
    first = groups.groupBy("component_id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows"))
    first = landed(first.filter("rows > 1").select("component_id", "first.row"))
    # Fewer rows go than stay, so the list of those is the one to look up.
    going = groups.join(first, "component_id").filter("doc_id != row").select(F.col("doc_id").alias(number))
    return rows.join(landed(going), number, "left_anti").select(*map(field, docs.columns))
