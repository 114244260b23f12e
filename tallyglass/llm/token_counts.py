"""Token counts without tokens: Arrow functions that return lengths only.

Batches are balanced by the bytes of their texts, not by rows. For vocabularies
of the sentencepiece kind texts are split at safe boundaries: a single space
between two other characters, since no piece of such a vocabulary goes on after
a space and the library puts one before every text. Distinct pieces are encoded
together, once a batch, and their counts kept in a bounded cache of the worker.
Vocabularies of the tokenizers kind are given whole texts.

Cases: null texts are empty and have no token, so they are never over the limit;
special strings inside texts are what the library makes of them by default.
Texts are counted whole, however long. Null and repeated ids pass through; an
empty table gives an empty result; no column but the text is looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.columns import quoted
from tallyglass.llm.common import by_bytes, without
from tallyglass.llm.pieces import PieceCache

MOST_TOKENS = 4096
BATCH_BYTES = 2 * 1024 * 1024

_counters: dict[str, Callable[[Sequence[str]], list[int]]] = {}


def counter(path: str) -> Callable[[Sequence[str]], list[int]]:
    """What counts the tokens of texts by that vocabulary file; one per worker
    process."""
    if path not in _counters:
        _counters[path] = _sentencepiece(path) if path.endswith(".model") else _tokenizers(path)
    return _counters[path]


def _sentencepiece(path: str) -> Callable[[Sequence[str]], list[int]]:
    import sentencepiece

    encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    lengths = lambda pieces: list(map(len, encode(pieces, num_threads=1))) if pieces else []
    cache = PieceCache(lengths)

    def count(texts: Sequence[str]) -> list[int]:
        # An empty text has no token, though the space put before it would be one.
        found = iter(cache.joined([t for t in texts if t], sum))
        return [next(found) if t else 0 for t in texts]

    return count


def _tokenizers(path: str) -> Callable[[Sequence[str]], list[int]]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]


def count_tokens(
    docs: DataFrame, vocabulary_path: str, text_column: str = "text", most_tokens: int = MOST_TOKENS
) -> DataFrame:
    """``docs`` and the columns n_bytes, n_tokens and over_limit, which replace any
    of that name. Every executor reads the vocabulary file at that path."""
    docs = without(docs, "n_bytes", "n_tokens", "over_limit")
    columns = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary_path)
        for batch in batches:
            for part in by_bytes(batch, text_column, BATCH_BYTES):
                counts = count([t or "" for t in part.column(text_column).to_pylist()])
                yield pa.record_batch([*part.columns, pa.array(counts, pa.int64())], [*columns, "n_tokens"])

    counted = docs.mapInArrow(
        work, docs.selectExpr(*map(quoted, columns), "CAST(0 AS BIGINT) AS n_tokens").schema
    )
    size = F.expr(f"CAST(coalesce(octet_length({quoted(text_column)}), 0) AS BIGINT)")
    return counted.withColumns({"n_bytes": size, "over_limit": F.col("n_tokens") > most_tokens})
