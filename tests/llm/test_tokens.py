import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import DOCS, HARD_TEXTS, documents
from tokenizers import Tokenizer

from tallyglass.llm import bpe, queries, range_coder, token_counts, token_output

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

ODD = [t or "" for t in HARD_TEXTS] + [
    "a  b\n\n c\t d  \n",
    "\n foo  bar \n",
    "x\x1cy \x1c z \x1f a\x85b \x85 c 　 d",
    "don't we'll I'M 'sre ‘s … “q”",
    "▁a ▁ b▁ c",
    "é é ﬁ Ⅷ १२३ ²³ Σίσυφος ΣΑΣ",
    "<|startoftext|> x<|endoftext|>y",
    "ab" * 700 + " " + "é" * 500,
]
MIXED = st.text(alphabet="abc  \n'sé日😀1<|\t　.,!\x1c▁", max_size=60)

VOCABULARY = bpe.Vocabulary(BYTE_BPE)
ENCODER = bpe.Encoder(VOCABULARY)
LIBRARY = Tokenizer.from_file(BYTE_BPE)


def by_library(text, tokenizer=LIBRARY):
    return tokenizer.encode(text, add_special_tokens=False).ids


# ----------------------------------------------------------------------- BPE


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_ids_are_those_of_the_library(text):
    assert np.frombuffer(ENCODER.encode([text])[0], np.int32).tolist() == by_library(text)


def test_odd_texts():
    assert [np.frombuffer(x, np.int32).tolist() for x in ENCODER.encode(ODD)] == [by_library(t) for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=8), max_size=40, unique=True))
def test_lexicon_knows_its_words_only(words):
    path = f"/tmp/lexicon-test-{os.getpid()}"
    bpe.compile_lexicon(words, [[i, i + 1] for i in range(len(words))], path)
    lexicon = bpe.Lexicon(path)
    numbers = lexicon.numbers(words).tolist()
    assert sorted(numbers) == list(range(len(words)))
    for i, n in enumerate(numbers):
        assert np.frombuffer(lexicon.ids_of(n), np.int32).tolist() == [i, i + 1]
    others = [w for w in (*(w + b"!" for w in words), *(w[:-1] for w in words)) if w not in words]
    assert set(lexicon.numbers(others).tolist()) <= {-1}


def test_lexicon_shares_suffixes(tmp_path):
    words = [p + s for p in (b"wa", b"ta", b"li") for s in (b"lking", b"lked", b"lks")]
    bpe.compile_lexicon(words, [[1]] * len(words), str(tmp_path / "x"))
    # w, t, l, a, i, l, k, then i-n-g, e-d, s, with the end shared: the minimal automaton.
    assert len(bpe.Lexicon(str(tmp_path / "x")).edge_keys) == 14 - 1


def test_merging_does_not_depend_on_the_lexicon(tmp_path):
    words = [b" the", b"the", b" word", b"zz"]
    ids = [np.frombuffer(x, np.int32).tolist() for x in VOCABULARY.merge_together(words)]
    bpe.compile_lexicon(words, ids, str(tmp_path / "x"))
    with_lexicon = bpe.Encoder(VOCABULARY, bpe.Lexicon(str(tmp_path / "x")))
    texts = ["the word zz the", *ODD]
    assert with_lexicon.encode(texts) == ENCODER.encode(texts)


def test_encode_and_decode_tables(spark):
    docs = documents(spark, [*HARD_TEXTS, *ODD]).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit("y"))
    lexicon = bpe.build_lexicon(docs, BYTE_BPE, words=50)
    both = bpe.round_trip(docs, BYTE_BPE, lexicon)
    rows = bpe.decode(bpe.encode(docs, BYTE_BPE, lexicon), BYTE_BPE).collect()
    assert sorted(map(str, both.collect())) == sorted(map(str, rows))
    assert len(rows) == len(HARD_TEXTS) + len(ODD)
    for row in rows:
        expected = by_library(row.text or "")
        assert list(row.ids) == expected and row.n_tokens == len(expected)
        assert row.decoded == (row.text or "") == LIBRARY.decode(expected, skip_special_tokens=False)


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert bpe.encode(empty, BYTE_BPE, bpe.build_lexicon(empty, BYTE_BPE)).count() == 0
    assert token_counts.count_tokens(empty, PIECE_BPE).count() == 0


def test_damaged_utf8_is_replaced(spark):
    ids = spark.createDataFrame([([int(i) for i in VOCABULARY.of_byte[[0xC3, 0x28, 0xE2]]],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(ids, BYTE_BPE).collect()] == ["�(�", None, ""]


def test_bpe_query_against_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = by_library(texts[row.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


# -------------------------------------------------------------------- counts


@settings(max_examples=200, deadline=None)
@given(MIXED)
def test_counts_are_those_of_the_library(text):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert token_counts.counter(PIECE_BPE)([text]) == [len(processor.encode(text))]


@pytest.mark.parametrize("path", [PIECE_BPE, BYTE_BPE])
def test_counts_of_tables(spark, path):
    docs = documents(spark, [*HARD_TEXTS, *ODD]).withColumn("n_bytes", F.lit("x"))
    rows = token_counts.count_tokens(docs, path, most_tokens=10).collect()
    if path == PIECE_BPE:
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        expected = {r.doc_id: len(processor.encode(r.text or "")) for r in rows}
    else:
        expected = {r.doc_id: len(by_library(r.text or "")) for r in rows}
    for row in rows:
        assert row.n_tokens == expected[row.doc_id]
        assert row.n_bytes == len((row.text or "").encode())
        assert row.over_limit == (row.n_tokens > 10)


def test_counts_query_against_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    rows = queries.op5_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n = len(processor.encode(texts[row.doc_id]))
        assert tuple(row)[1:] == (len(texts[row.doc_id].encode()), n, n > 4096)


# ------------------------------------------------------------------ id files


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1500), st.integers(0, 5), st.integers(0, 2**31))
def test_range_coder_round_trip(n, kind, seed):
    random = np.random.default_rng(seed)
    vocabulary = [3, 49_408, 49_408, 10, 100_000, 2][kind]
    ids = [
        random.integers(0, 3, n),
        random.integers(0, vocabulary, n),
        np.minimum(vocabulary - 1, random.zipf(1.2, n)),
        np.zeros(n),
        np.full(n, vocabulary - 1),
        np.arange(n) % 2,
    ][kind].astype(np.uint32)
    assert range_coder.decode_ids(range_coder.encode_ids(ids, vocabulary)).tolist() == ids.tolist()


def test_repeats_cost_little():
    ids = np.tile(np.arange(2000, dtype=np.uint32), 40)
    assert len(range_coder.encode_ids(ids, 49_408)) < 0.2 * 2 * len(ids)


def test_damage_is_noticed():
    block = token_output.pack([1, None], [np.arange(500, dtype="<u4").tobytes()] * 2, 1000)
    token_output.unpack(block)
    for place in (1, 15, 60, len(block) // 2, len(block) - 1):
        damaged = bytearray(block)
        damaged[place] ^= 1
        with pytest.raises(Exception):
            token_output.unpack(bytes(damaged))


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_files_of_hard_rows(spark, tmp_path, block_ids):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = [*HARD_TEXTS, *ODD, "b", "a"]
    ids = [None, *range(len(texts) - 3, 0, -1), 2, None]
    docs = documents(spark, texts, ids)
    token_output.write_tokens(docs, f"{tmp_path}/t", WORD_BPE, 49_408, block_ids=block_ids)
    rows = token_output.read_tokens(spark, f"{tmp_path}/t").collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    stored = sorted((r.doc_id or 0, bytes(r.ids)) for r in rows)
    expected = sorted(
        (i or 0, np.array([*by_library(t or "", tokenizer), 2], "<u4").tobytes()) for i, t in zip(ids, texts)
    )
    assert stored == expected


def test_files_without_documents(spark, tmp_path):
    token_output.write_tokens(spark.createDataFrame([], DOCS), f"{tmp_path}/t", WORD_BPE, 49_408)
    assert token_output.read_tokens(spark, f"{tmp_path}/t").count() == 0


def test_output_query_against_the_library(spark, sf_dir):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op3_token_output(spark, sf_dir).collect()}
    start = 0
    for doc_id, text in docs:
        ids = np.array([*by_library(text, tokenizer), 2], "<u4")
        assert tuple(rows[doc_id]) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_that_share_words_are_encoded_as_the_library_does():
    """Forms in other case or with other signs, contractions, special strings, line feeds."""
    tokenizer = Tokenizer.from_file(WORD_BPE)
    stems = ["Straße", "STRASSE", "don't", "don'", "'s", "İstanbul", "ΟΔΟΣ", "naïve", "naïve", "x≠y", "<|endoftext|>", "<|ENDOFTEXT|>"]
    signs = ["", "!", "...", "'", "***", "<|", "=", "\u0338", "_", "\t", "\r"]
    texts = [f"{a}{s} {a.upper()}{s}\n{a.lower()}{s}{b}" for a in stems for s in signs for b in ("", "S", " 's", "\n")]
    texts += ["\n", "", " \n ", "a\n\nb", "A\nB!\nc"]
    cut = token_output._pieces(WORD_BPE).joined([t.replace("\n", " ") for t in texts], b"".join)
    for text, ids in zip(texts, cut):
        assert np.frombuffer(ids, "<u4").tolist() == by_library(text, tokenizer), text
