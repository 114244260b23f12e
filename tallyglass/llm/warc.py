"""WARC archives with revisit records, and capture histories merged from runs.

Writing: one record a page, made by the JVM and written by Spark's text writer
with the record separator of the format as line separator, gzip per file, a
bounded number of records each. Payloads that repeat become revisits of the
page with the smallest id; which these are comes from digests, grouped with
partial aggregation, and only digests that repeat are joined to the pages.

Reading: each archive file gives one run, its captures sorted by URL key,
timestamp and page id. Merging: captures are dealt to ranges of (URL key,
timestamp, page id, run, offset), so that one URL may span many tasks, and each task
merges its slices of all runs with a loser tree. Tasks in order give one
global order. The records of a task are bounded by the number of ranges, which
follows the number of captures.

Cases: a null payload is empty, a null or empty URL has an empty key and no
target header; line breaks in URLs are percent-encoded. A null page id can
neither be referred to nor be a response's first choice: it sorts after all ids, and a group without
ids is all responses. Rows that repeat page id and payload are the same capture
and have the same record type. An empty table gives no archive and no
capture. Only page_id, url and html, and the column of capture times if one is
named, are read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import landed
from tallyglass.session import shared_folder

LEAST_REVISIT_BYTES = 100
RECORDS_PER_FILE = 4000
ROWS_PER_MERGE = 400_000
ROWS_OUT = 10_000
NO_TIME = "1970-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = (
    "run string, offset bigint, url_key string, captured string, page_id bigint, url string, "
    "record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"
)
_NAMES = [c.split()[0] for c in CAPTURES.split(", ")]
_KINDS = [pa.int64() if c.endswith("bigint") else pa.string() for c in CAPTURES.split(", ")]


# -------------------------------------------------------------------- writing

_RECORD = f"""
concat(
  'WARC/1.1\r\nWARC-Type: ', record_type,
  '\r\nWARC-Record-ID: <urn:capture:', coalesce(CAST(page_id AS STRING), 'none'),
  '>\r\nWARC-Date: ', captured,
  coalesce(concat('\r\nWARC-Target-URI: ', replace(replace(nullif(url, ''), '\r', '%0D'), '\n', '%0A')), ''),
  '\r\nWARC-Payload-Digest: sha256:', digest,
  IF(refers_to IS NULL, '', concat('\r\nWARC-Refers-To: <urn:capture:', refers_to,
    '>\r\nWARC-Profile: {REVISIT_PROFILE}')),
  '\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: ',
  octet_length(message), '\r\n\r\n', message)
"""
_MESSAGE = """
concat('HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ',
  octet_length(payload), '\r\n\r\n', IF(refers_to IS NULL, payload, ''))
"""


def write_archives(
    pages: DataFrame,
    folder: str,
    captured_column: str | None = None,
    least_bytes: int = LEAST_REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``."""
    captured = F.lit(None) if captured_column is None else field(captured_column).cast("string")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(captured, F.lit(NO_TIME)).alias("captured"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = rows.filter(F.octet_length("payload") >= least_bytes)
    groups = long_enough.groupBy("digest").agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies")
    )
    repeated = landed(groups.filter("copies > 1").select("digest", "first_page"))
    marked = rows.join(repeated, "digest", "left").withColumn(
        # Where no page of the group has an id there is nothing to refer to.
        "refers_to",
        F.expr("CASE WHEN first_page IS NOT NULL AND NOT first_page <=> page_id THEN first_page END"),
    )
    typed = marked.withColumn("record_type", F.expr("IF(refers_to IS NULL, 'response', 'revisit')"))
    records = typed.withColumn("message", F.expr(_MESSAGE)).select(F.expr(_RECORD).alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(folder)


# -------------------------------------------------------------------- reading


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest, so that a site's captures are neighbours."""
    rest = (url or "").partition("://")[2] or (url or "")
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, port = rest[:cut].lower().rpartition("@")[2].partition(":")[::2]
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return f"{key}){rest[cut:] or '/'}" if rest else ""


def _header(stream: io.BufferedReader) -> tuple[str, dict[str, str], int]:
    """First line, fields and number of bytes up to the empty line."""
    first = stream.readline()
    size, fields = len(first), {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        size += len(line)
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        fields[name.lower()] = value
    return first.decode().rstrip("\r\n"), fields, size + 2


def _number(urn: str | None) -> int | None:
    value = (urn or "none").strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def captures_of(run: str, archive: bytes) -> list[tuple]:
    """The captures of one archive file, sorted."""
    found, offset = [], 0
    with gzip.open(io.BytesIO(archive)) as packed, io.BufferedReader(packed, 1 << 20) as stream:
        while True:
            version, fields, size = _header(stream)
            if not version:
                break
            if version != "WARC/1.1":
                raise ValueError(f"{run}: no record at {offset}")
            length = int(fields["content-length"])
            block = stream.read(length + len(RECORD_END))
            if len(block) != length + len(RECORD_END) or not block.endswith(RECORD_END.encode()):
                raise ValueError(f"{run}: record at {offset} is cut off")
            head, _, body = block[:length].partition(b"\r\n\r\n")
            digest = fields["warc-payload-digest"].partition(":")[2]
            kind = fields["warc-type"]
            if kind == "response":
                held = len(body)
                if hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"{run}: payload at {offset} does not match its digest")
            else:
                held = int(head.rpartition(b": ")[2])
            url = fields.get("warc-target-uri")
            found.append(
                (
                    run,
                    offset,
                    url_key(url),
                    fields["warc-date"],
                    _number(fields["warc-record-id"]),
                    url,
                    kind,
                    _number(fields.get("warc-refers-to")),
                    digest,
                    held,
                )
            )
            offset += size + len(block)
    return sorted(found, key=_place)


def _place(capture: tuple) -> tuple:
    run, offset, key, captured, page_id = capture[:5]
    return key.encode(), captured, page_id is None, page_id or 0, run, offset


def _batches(rows: Iterator[tuple] | Sequence[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            yield from _batches(captures_of(path.as_py(), content.as_py()))


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Captures of all archives below ``folder``; each file is one sorted run."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(_read_runs, CAPTURES)


# -------------------------------------------------------------------- merging


class LoserTree:
    """Merges sorted sequences. Inner nodes hold the run that lost there, so
    replacing the winner takes one comparison per level."""

    def __init__(self, runs: Sequence[Sequence], key: Callable):
        self._iterators = [iter(r) for r in runs]
        self._key = key
        self._items: list = [None] * len(runs)
        self._keys: list = [None] * len(runs)  # None: the run is over
        for i in range(len(runs)):
            self._advance(i)
        size = len(runs)
        self._losers = [0] * size
        winners = [0] * size + list(range(size))
        for node in range(size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self._losers[node] = (a, b) if self._before(a, b) else (b, a)
        self._winner = winners[1] if size > 1 else 0

    def _advance(self, run: int) -> None:
        self._items[run] = item = next(self._iterators[run], None)
        self._keys[run] = None if item is None else self._key(item)

    def _before(self, a: int, b: int) -> bool:
        if self._keys[a] is None or self._keys[b] is None:
            return self._keys[b] is None
        return self._keys[a] <= self._keys[b]

    def __iter__(self) -> Iterator:
        size = len(self._items)
        while size and self._keys[self._winner] is not None:
            winner = self._winner
            yield self._items[winner]
            self._advance(winner)
            node = (winner + size) // 2
            while node:
                if self._before(self._losers[node], winner):
                    self._losers[node], winner = winner, self._losers[node]
                node //= 2
            self._winner = winner


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(row[0], []).append(row)
    for run in runs.values():
        run.sort(key=_place)  # slices of a sorted run may arrive in any order
    yield from _batches(iter(LoserTree(list(runs.values()), _place)))


def merge_runs(runs: DataFrame, rows_per_merge: int = ROWS_PER_MERGE) -> DataFrame:
    """All captures in the order of URL key, timestamp and page id. ``runs`` should
    be landed, because finding the ranges reads it once more."""
    spark = runs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(runs.count() / rows_per_merge))
    place = ("url_key", "captured", F.asc_nulls_last("page_id"), "run", "offset")
    return runs.repartitionByRange(ranges, *place).mapInArrow(_merge, CAPTURES)


def archived_captures(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write archives, read them back and merge their runs. Runs jobs."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark)
    write_archives(pages, folder, **options)
    return merge_runs(landed(read_runs(spark, folder)))
