"""Token ids of a corpus as files of range-coded blocks, and reading them back.

Documents are dealt to ranges of ids and sorted, so files in order hold the
documents in ascending id. A file row is one block: whole documents with about
``BLOCK_IDS`` ids together, their ids and lengths packed in front, the token ids
range-coded (see ``range_coder``), and a checksum. Blocks decode on their own. Spark
writes the rows, so lost tasks leave nothing behind, on any file system.

The place of a document in the whole sequence is the number of ids before its
file (one number a file), before its block and before itself.

Cases: null texts are empty and hold the end id alone; a null id comes before
all others; documents with equal ids follow one another, ordered by a hash of
the text. A text is tokenised whole, and a document longer than a block is a
block by itself. An empty table gives no block and reads back as no row. Only
id and text are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyglass.functions.columns import field
from tallyglass.llm.common import by_bytes
from tallyglass.llm.pieces import PieceCache
from tallyglass.llm.range_coder import decode_ids, encode_ids
from tallyglass.session import input_bytes, shuffle_partitions

BLOCK_IDS = 1 << 20
END_ID = 2
WORD_END = "</w>"
WORDS_A_LINE = 256
# Twice as many of each at most, at some 200 bytes each.
CACHED_PIECES = 150_000
CACHED_WORDS = 300_000
# Letters that stay one letter each whatever the tokenizer normalises, but for their case,
# then signs. The tokenizer makes one word of each.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]+)?")
PREFIX = struct.Struct("<III")  # documents, bytes of their table, its crc32

BLOCKS = "file int, block int, ids_before bigint, n_docs int, n_ids bigint, payload binary"
TOKENS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"

_tokenizers: dict[str, PieceCache] = {}


def _pieces(path: str) -> PieceCache:
    """The tokenizer drops white space and lets no token cross it, so that texts
    may be cut at every space, and a line feed is as good as one. One per worker process."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        ends_word = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        ends_word[[i for t, i in tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True

        def ids_of(texts: list[str]) -> list[bytes]:
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

        words: dict[str, bytes] = {}
        words_earlier: dict[str, bytes] = {}

        def add_words(missing: list[str]) -> None:
            """Many words go to the library as one text and are told apart by the tokens
            that end a word."""
            parts = [missing[i : i + WORDS_A_LINE] for i in range(0, len(missing), WORDS_A_LINE)]
            for part, flat in zip(parts, ids_of([" ".join(part) for part in parts])):
                ends = 4 * np.nonzero(ends_word[np.frombuffer(flat, dtype="<u4")])[0] + 4
                if len(part) != len(ends):
                    raise ValueError(f"{path}: words do not end where expected")
                cuts = ends.tolist()
                words.update(zip(part, [flat[a:b] for a, b in zip([0, *cuts], cuts)]))

        def encode(pieces: list[str]) -> list[bytes]:
            """Plain pieces are a word or a word and signs. The tokenizer lowers their case, so
            that forms of a word which differ in case or in signs are encoded once."""
            nonlocal words, words_earlier
            if len(words) > CACHED_WORDS:
                words_earlier, words = words, {}
            plain = [m and (m[1].lower(), m[2]) for m in map(_PLAIN.fullmatch, pieces)]
            wanted = dict.fromkeys(w for pair in plain if pair for w in pair if w and w not in words)
            again = [w for w in wanted if w in words_earlier]
            words.update([(w, words_earlier[w]) for w in again])
            add_words([w for w in wanted if w not in words])
            others = iter(ids_of([p for p, pair in zip(pieces, plain) if not pair]))
            return [
                next(others) if not pair else words[pair[0]] + words[pair[1]] if pair[1] else words[pair[0]]
                for pair in plain
            ]

        _tokenizers[path] = PieceCache(encode, tight=False, limit=CACHED_PIECES)
    return _tokenizers[path]


def pack(doc_ids: list[int | None], texts_ids: list[bytes], vocabulary: int) -> bytes:
    """A block of documents; ``texts_ids`` holds 32-bit little-endian ids."""
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    lengths = np.array([len(x) // 4 for x in texts_ids], dtype="<u4")
    listed = zlib.compress(known.tobytes() + np.diff(numbers, prepend=0).astype("<i8").tobytes() + lengths.tobytes(), 6)
    ids = np.frombuffer(b"".join(texts_ids), dtype="<u4")
    return PREFIX.pack(len(doc_ids), len(listed), zlib.crc32(listed)) + listed + encode_ids(ids, vocabulary)


def unpack(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths, and all token ids in order."""
    n, size, check = PREFIX.unpack_from(payload)
    listed = payload[PREFIX.size : PREFIX.size + size]
    if zlib.crc32(listed) != check:
        raise ValueError("damaged block")
    plain = zlib.decompress(listed)
    known = np.frombuffer(plain, np.uint8, n)
    numbers = np.cumsum(np.frombuffer(plain, "<i8", n, n))
    lengths = np.frombuffer(plain, "<u4", n, 9 * n)
    ids = decode_ids(payload[PREFIX.size + size :])
    return [d if k else None for d, k in zip(numbers.tolist(), known)], lengths, ids


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    vocabulary: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int | None = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write blocks below ``folder``. ``tokenizer`` is a file that every executor
    reads at that path and ``vocabulary`` a number above all of its ids."""
    ending = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, number, before = _pieces(tokenizer), 0, 0
        file = TaskContext.get().partitionId()
        doc_ids: list = []
        found: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            row = [file, number, before, len(doc_ids), held, pack(doc_ids, found, vocabulary)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for part in by_bytes(batch, "text"):
                texts = cache.joined([(t or "").replace("\n", " ") for t in part.column("text").to_pylist()], b"".join)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), texts):
                    doc_ids.append(doc_id)
                    found.append(ids + ending)
                    held += len(found[-1]) // 4
                    if held >= block_ids:
                        yield block()
                        number, before = number + 1, before + held
                        doc_ids, found, held = [], [], 0
        if doc_ids:
            yield block()

    place = F.col("doc_id"), F.xxhash64("text")
    rows = docs.select(
        field(id_column).cast("bigint").alias("doc_id"), field(text_column).cast("string").alias("text")
    )
    files = shuffle_partitions(docs.sparkSession, input_bytes(rows))
    ordered = rows.repartitionByRange(files, *place).sortWithinPartitions(*place)
    # Blocks are as small as they get.
    ordered.mapInArrow(work, BLOCKS).write.option("compression", "uncompressed").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (32-bit little-endian) of every document."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    # One row a file.
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    running = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("file", F.coalesce(running, F.lit(0)).alias("file_start"))
    placed = blocks.join(starts, "file").selectExpr("file_start + ids_before AS start", "payload")
    return placed.mapInArrow(_unpack, TOKENS)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, payload in zip(batch.column("start").to_pylist(), batch.column("payload")):
            doc_ids, lengths, ids = unpack(payload.as_py())
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            places = [pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids)]
            values = pa.Array.from_buffers(pa.binary(), len(doc_ids), [None, *places])
            columns = [
                pa.array(doc_ids, pa.int64()),
                pa.array(first + ends[:-1]),
                pa.array(lengths.astype(np.int64)),
                values,
            ]
            yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids"])
