import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tables import DOCS, HARD_TEXTS, documents

from tallyglass.llm import queries, sentence_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [t or "" for t in HARD_TEXTS] + [
    " ",
    "▁▁a ▁",
    "▁",
    "a  b\n\n c\t d  \n",
    "ﬁﬁﬁ Ａ　Ｂ ½ が が \x00 ​",
    "日本語" * 200,
    "<s> </s> <unk> <0x41>",
    "ab" * 700 + " " + "é" * 500,
    "x\n" * 300 + "   " * 50,
]
MIXED = st.text(alphabet="abthe  \n'é日😀ﬁＡ　▁½\t\x00", max_size=60)
# Character map, removal of extra white space, added space.
VARIANTS = [(None, False, True), ("nmt_nfkc", True, True), ("nfkc_cf", False, True), (None, True, True), ("nfkc", False, False)]


@pytest.fixture(scope="module", params=VARIANTS, ids=str)
def model(request, tmp_path_factory):
    """The public model with another normalisation; its pieces stay as they are."""
    rule, tidy, prefix = request.param
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    if rule:
        other = sentencepiece_model_pb2.ModelProto()
        other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = tidy
    proto.normalizer_spec.add_dummy_prefix = prefix
    path = tmp_path_factory.mktemp("model") / "variant.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def by_library(processor, text):
    """ids, first and last bytes."""
    pieces = processor.encode(text, return_type="proto").pieces if text else []
    return [p.id for p in pieces], [p.begin for p in pieces], [p.end for p in pieces]


def check(path, texts):
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder, decoder = sentence_pieces.encoder(path), sentence_pieces.decoder(path)
    for text, found in zip(texts, encoder.encode(texts)):
        assert tuple(x.tolist() for x in found) == by_library(processor, text), text
        assert decoder.text(found[0]) == processor.decode(found[0].tolist())


def test_odd_texts(model):
    check(model, ODD)


def test_random_texts(model):
    @settings(max_examples=150, deadline=None)
    @given(st.lists(MIXED, max_size=5))
    def run(texts):
        check(model, texts)

    run()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400) | st.integers(0, 31_999), max_size=20))
def test_any_ids_are_decoded_as_the_library_does(ids):
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sentence_pieces.decoder(MODEL).text(np.array(ids, dtype=np.int64)) == processor.decode(ids)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abthein ▁er", min_size=1, max_size=40))
def test_heap_and_arrays_merge_alike(text):
    model = sentence_pieces.encoder(MODEL).model
    symbols = sentence_pieces.encoder(MODEL)._symbols(text.replace(" ", "▁"))
    (_, together, _), = model.merge_together(symbols.copy(), np.array([len(symbols)]))
    assert together.tolist() == model.merge_long(symbols.tolist())


def test_compiled_map_prefers_the_longest_prefix():
    proto = sentencepiece_model_pb2.ModelProto()
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    proto.ParseFromString(normalizer.serialized_model_proto())
    compiled = sentence_pieces.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    text = "\u304b\u309a\u304b\u3099\ufb00x"
    assert compiled.longest("\u304b\u3099".encode(), 0) == (6, "\u304c".encode())
    joined = [(text.encode()[a:b].decode(), r.decode()) for a, b, r in compiled.replacements(text)]
    assert joined[-2:] == [("\u304b\u3099", "\u304c"), ("\ufb00", "ff")]


def test_spans_cover_the_text():
    text = "The naïve café ☕ is 日本語 \U00013000 ok"
    ids, first, last = sentence_pieces.encoder(MODEL).encode([text])[0]
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(first, last)) == raw
    assert first[0] == 0 and last[-1] == len(raw)


def test_tables(spark):
    names = ("ids", "first_bytes", "last_bytes", "decoded", "n_tokens")
    docs = documents(spark, [*HARD_TEXTS, *ODD], [None, *range(1, len(HARD_TEXTS) + len(ODD))])
    docs = docs.withColumns({n: F.lit("x") for n in names})
    both = sentence_pieces.round_trip(docs, MODEL)
    apart = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL)
    rows = both.collect()
    assert sorted(map(str, rows)) == sorted(map(str, apart.collect()))
    assert len(rows) == len(HARD_TEXTS) + len(ODD)
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for row in rows:
        text = row.text or ""
        assert (row.ids, row.first_bytes, row.last_bytes) == by_library(processor, text)
        assert row.n_tokens == len(row.ids) and row.decoded == processor.decode(row.ids)


def test_null_ids_and_no_rows(spark):
    ids = spark.createDataFrame([(None,), ([],), ([1, 295, 2],)], "ids array<int>")
    assert [r.decoded for r in sentence_pieces.decode(ids, MODEL).collect()] == [None, "", "h"]
    assert sentence_pieces.round_trip(spark.createDataFrame([], DOCS), MODEL).count() == 0


def test_other_models_are_refused(tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    (tmp_path / "x.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="no plain model"):
        sentence_pieces.PieceModel(str(tmp_path / "x.model"))


def test_query_against_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = queries.op12_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = processor.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()
