"""Exact counting and removal of identical rows.

Nulls equal nulls, not-a-number equals itself and -0.0 equals 0.0, as in any
Spark grouping. Maps are equal when their entries are, in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DataType,
    MapType,
    NullType,
    StringType,
    StructType,
)

from tallyglass.functions.columns import quoted, record, unused
from tallyglass.functions.rounding import percentage
from tallyglass.operators.cleaning import BothTables
from tallyglass.session import is_plain_scan, remove_folder, shared_folder

BINARY_COLLATION = "UTF8_BINARY"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Every different row once. Copies collapse per task before the shuffle."""
    maps = [f.name for f in df.schema if _has_map(f.dataType)]
    if not maps:
        return df.distinct()
    keys = {m: unused(df, f"{m} as entries") for m in maps}
    compared = df.withColumns({k: _without_maps(m, df) for m, k in keys.items()})
    return compared.dropDuplicates([keys.get(c, c) for c in df.columns]).drop(*keys.values())


def comparable(df: DataFrame) -> DataFrame:
    """Maps as sorted entries, because maps cannot be compared."""
    maps = [f.name for f in df.schema if _has_map(f.dataType)]
    return df.withColumns({m: _without_maps(m, df) for m in maps})


def _has_map(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return isinstance(dtype, MapType)


def _without_maps(name: str, df: DataFrame) -> F.Column:
    return F.expr(_entries(quoted(name), df.schema[name].dataType, 0))


def _entries(value: str, dtype: DataType, depth: int) -> str:
    if not _has_map(dtype):
        return value
    each = f"x{depth}"
    if isinstance(dtype, ArrayType):
        return f"transform({value}, {each} -> {_entries(each, dtype.elementType, depth + 1)})"
    if isinstance(dtype, StructType):
        parts = [
            f"'{i}', {_entries(f'{value}.{quoted(f.name)}', f.dataType, depth + 1)}"
            for i, f in enumerate(dtype)
        ]
        return f"IF({value} IS NULL, NULL, named_struct({', '.join(parts)}))"
    key = _entries(f"{each}.key", dtype.keyType, depth + 1)
    inner = _entries(f"{each}.value", dtype.valueType, depth + 1)
    return f"array_sort(transform(map_entries({value}), {each} -> named_struct('key', {key}, 'value', {inner})))"


def hashes_as_it_groups(dtype: DataType) -> bool:
    """Values that a grouping holds equal have equal hashes. Not so for text whose
    collation holds different bytes equal."""
    if isinstance(dtype, ArrayType):
        return hashes_as_it_groups(dtype.elementType)
    if isinstance(dtype, MapType):
        return hashes_as_it_groups(dtype.keyType) and hashes_as_it_groups(dtype.valueType)
    if isinstance(dtype, StructType):
        return all(hashes_as_it_groups(f.dataType) for f in dtype)
    if isinstance(dtype, StringType):
        return dtype.collation == BINARY_COLLATION
    return isinstance(dtype, (AtomicType, NullType))


def duplicate_profile(
    df: DataFrame,
    method: str = "auto",
    derived: Sequence[str] = (),
    total: int | None = None,
) -> DataFrame:
    """One row: total, unique, duplicate_count and duplicate_percentage.

    ``rows``  lazy; groups by every column, so whole rows are shuffled once
              after each task has collapsed its own copies.
    ``hash``  runs jobs; shuffles one 8-byte hash per row, then compares whole
              rows only where a hash occurs more than once. Far less shuffle
              for a table with few copies. Scans the table twice, so it should
              be a columnar file. Refused for columns that do not hash as they group.
    ``auto``  by schema and plan: ``hash`` where the table is read from files as it is
              and every column hashes as it groups, else ``rows``. A table made by
              joins or generated rows would be made twice, or written once, which
              moves as much as shuffling its rows.

    Both are exact. ``derived`` names columns computed from others of the same
    row: equal rows agree in them anyway, so they need not be hashed, compared or
    shuffled. ``total`` is the number of rows where the caller knows it.
    """
    df = df.drop(*derived)
    return _by_hash(df, total) if uses_hash(df, method) else _by_rows(df)


def uses_hash(df: DataFrame, method: str) -> bool:
    hashable = all(hashes_as_it_groups(f.dataType) for f in df.schema)
    if method not in ("auto", "rows", "hash"):
        raise ValueError(f"unknown method: {method}")
    if method == "hash" and not hashable:
        raise ValueError("some column holds values equal that have different hashes; use method='rows'")
    return method == "hash" or (method == "auto" and hashable and is_plain_scan(df))


def _counted(df: DataFrame) -> tuple[DataFrame, str]:
    copies = unused(df, "copies_of_row")
    return df.groupBy(*map(quoted, df.columns)).agg(F.count(F.lit(1)).alias(copies)), copies


def _by_rows(df: DataFrame) -> DataFrame:
    groups, copies = _counted(comparable(df))
    counted = groups.selectExpr(f"coalesce(sum({quoted(copies)}), 0) AS total", "count(1) AS different")
    return counted.selectExpr(f"inline(array({share('total', 'total - different')}))")


def with_hash(df: DataFrame, name: str) -> DataFrame:
    """``df`` with maps as entries, and an 8-byte hash of each row; equal rows have
    equal hashes."""
    rows = comparable(df)
    return rows.withColumn(name, F.xxhash64(*map(quoted, rows.columns)))


def rows_with(hashed: DataFrame, repeated: DataFrame, name: str | tuple[str, ...]) -> DataFrame:
    """Rows whose hash is listed. Spark knows the size of the written list: a short one
    goes to every task and no row is shuffled; else both sides are sorted by hash,
    and a hot hash is split by the skew join."""
    return hashed.join(repeated, list(name) if isinstance(name, tuple) else name, "left_semi")


def _by_hash(df: DataFrame, total: int | None) -> DataFrame:
    surplus = surplus_rows(df)
    total = df.count() if total is None else total
    return df.sparkSession.range(1).selectExpr(f"inline(array({share(f'{total}L', surplus)}))")


def surplus_rows(df: DataFrame) -> int:
    """How many rows repeat an earlier one, by hash. Runs jobs."""
    spark = df.sparkSession
    # First, because a cluster without a shared folder is refused here.
    folder = shared_folder(spark)
    name = unused(df, "hash_of_row")
    hashed = with_hash(df, name)

    # Written, so that the comparison below does not hash and group again.
    groups, copies = _counted(hashed.select(name))
    listing = groups.filter(f"{quoted(copies)} > 1").select(name)
    listing.write.parquet(folder)
    repeated = spark.read.schema(listing.schema).parquet(folder)

    surplus = 0
    if not repeated.isEmpty():
        # Rows that share a hash without being equal are separate groups.
        compared, copies = _counted(rows_with(hashed, repeated, name))
        surplus = compared.selectExpr(f"coalesce(sum({quoted(copies)} - 1), 0)").first()[0]
    remove_folder(spark, folder)
    return surplus


def versions(
    both: BothTables, derived: Sequence[str] = (), hashed: bool = True, whole: bool = True, carried: Sequence[str] = ()
) -> DataFrame:
    """A row for each of the two tables that has it: side (0 raw, 1 cleaned), its hash or 0,
    if ``whole`` the row itself in columns of which those of the other table are null
    (``compared_columns``), and the columns ``carried``."""
    rows, sides = comparable(both.rows), []
    for columns in (both.raw, both.cleaned):
        sides.append([quoted(new) for c, new in columns.items() if c not in derived])
    parts = []
    for i, own in enumerate(sides):
        cells = {
            f"{side}_{j}": value if k == i else "NULL"
            for k, side in enumerate(("raw", "cleaned"))
            for j, value in enumerate(sides[k])
        }
        value = f"xxhash64({', '.join(own)})" if hashed else "0L"
        parts.append(record(side=str(i), hash=value, **(cells if whole else {}), **{c: quoted(c) for c in carried}))
    return rows.selectExpr(f"inline(IF({quoted(both.survives)}, array({', '.join(parts)}), array({parts[0]})))")


def compared_columns(found: DataFrame) -> list[str]:
    """Columns of ``versions`` in which equal rows agree."""
    return [c for c in found.columns if c == "side" or c.startswith(("raw_", "cleaned_"))]


def surplus_of_both(both: BothTables, derived: Sequence[str] = (), method: str = "auto") -> DataFrame:
    """One row: how many rows of the raw and of the cleaned table repeat an earlier one
    (raw_surplus, cleaned_surplus). The methods are those of ``duplicate_profile``; either
    looks at both tables in the same scans."""
    by_hash = uses_hash(both.rows, method)
    found, folder = versions(both, derived, by_hash), None
    spark = both.rows.sparkSession
    if by_hash:
        folder = shared_folder(spark)
        hashes = versions(both, derived, whole=False)
        listing = hashes.groupBy("side", "hash").count().filter("count > 1").select("side", "hash")
        listing.write.parquet(folder)
        found = rows_with(found, spark.read.schema(listing.schema).parquet(folder), ("side", "hash"))
    groups = found.groupBy(*compared_columns(found)).count()
    surplus = [f"coalesce(sum(count - 1) FILTER (WHERE side = {i}), 0)" for i in (0, 1)]
    result = groups.selectExpr(f"{surplus[0]} AS raw_surplus", f"{surplus[1]} AS cleaned_surplus")
    if folder is None:
        return result
    known = result.first()
    remove_folder(spark, folder)
    return spark.range(1).selectExpr(f"{known[0]}L AS raw_surplus", f"{known[1]}L AS cleaned_surplus")


def share(total: str, surplus: int | str) -> str:
    """The four measures as a struct, from expressions of total and surplus."""
    surplus = f"CAST({surplus} AS BIGINT)"
    return record(
        total_records=total,
        unique_records=f"{total} - {surplus}",
        duplicate_count=surplus,
        duplicate_percentage=percentage(surplus, total),
    )
