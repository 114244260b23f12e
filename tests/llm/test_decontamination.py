import re

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tables import DOCS, HARD_TEXTS, documents, oracle, rows_of

from tallyglass.llm import decontamination as d
from tallyglass.llm import queries

ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])
WORDS = [f"w{i}" for i in range(40)]


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(doc, items):
    w, hit, listed = words(doc), set(), set()
    for item_id, text in items:
        v = words(text)
        n = min(13, len(v))
        for s in range(len(v) - n + 1 if v else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[s : s + n]:
                    hit |= set(range(i, i + n))
                    listed |= {str(item_id)} if item_id is not None else set()
    return len(w), len(hit), sorted(listed)


CORPUS = [
    *HARD_TEXTS[:11],
    " ".join(WORDS),
    "Start. " + " ".join(WORDS[5:20]).upper() + ", end " * 3 + " ".join(WORDS[5:18]),
    "go " + " ".join(WORDS[:12]),
    "short one; short ONE short",
    " ".join(["the"] * 30),
]
TESTS = [
    (1, " ".join(WORDS[3:25])),
    (1, " ".join(WORDS[3:25])),
    (2, "short one"),
    (3, ""),
    (4, None),
    (None, " ".join(WORDS[6:19])),
    (10, " ".join(["the"] * 14)),
    (11, "日本語 テスト"),
]


@pytest.mark.parametrize("options", [{}, {"segment_words": 3}, {"block_bytes": 60}, {"block_bytes": 60, "segment_words": 20}])
def test_against_all_places(spark, options):
    docs, tests = documents(spark, CORPUS), spark.createDataFrame(TESTS, ITEMS)
    found = d.contamination(docs, tests, **options).collect()
    assert len(found) == len(CORPUS)
    for row in found:
        n_words, n_hit, listed = plain(CORPUS[row.doc_id], TESTS)
        assert (row.n_words, row.n_hit, list(row["items"]), row.n_items) == (n_words, n_hit, listed, len(listed))
        assert row.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)


def test_nothing_on_one_side(spark):
    docs, tests = documents(spark), spark.createDataFrame(TESTS, ITEMS)
    assert d.contamination(spark.createDataFrame([], DOCS), tests).count() == 0
    untouched = d.contamination(docs, spark.createDataFrame([], ITEMS))
    assert untouched.filter("n_hit = 0 AND NOT contaminated").count() == len(HARD_TEXTS)


def test_stage_keeps_the_rest(spark):
    docs = documents(spark, CORPUS).withColumnRenamed("source", "bad_id")
    kept = d.without_contaminated(docs, spark.createDataFrame(TESTS, ITEMS))
    bad = {i for i, t in enumerate(CORPUS) if (p := plain(t, TESTS))[1] and 20 * p[1] >= p[0]}
    assert bad and kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(CORPUS))) - bad


def test_query_agrees_with_sql(spark, sf_dir):
    columns, expected = oracle(sf_dir, queries.OP8_SQL)
    assert rows_of(queries.op8_decontamination(spark, sf_dir), columns) == expected


@pytest.mark.parametrize("segment_words", [5, 1000])
def test_proximity(spark, segment_words):
    texts = ["alpha x beta y gamma", "gamma alpha beta", "alpha x x x x beta gamma", "alpha beta", "beta gamma\nalpha"]
    index = d.build_index(documents(spark, texts), segment_words=segment_words)
    phrases = ["alpha beta gamma", "beta alpha"]
    found = {(r.doc_id, r.phrase) for r in d.proximity_matches(index, phrases, within=5).collect()}
    expected = set()
    for i, text in enumerate(texts):
        w = text.split()
        for p in phrases:
            if any(set(p.split()) <= set(w[s : s + 5]) for s in range(len(w))):
                expected.add((i, p))
    assert found == expected
