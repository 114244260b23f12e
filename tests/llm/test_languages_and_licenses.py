import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import DOCS, HARD_TEXTS, documents

from tallyglass.llm import language_id, license_scan, queries
from tallyglass.llm.decontamination import words_of


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op4_language_id(spark, sf).collect()
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in set(labels.values()) | {"und"} for r in rows)
    judged = [r for r in rows if r.held_out and labels[r.doc_id] and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in judged]) >= 0.97


def bilingual(spark, n=60):
    texts = ["der und die nicht das ist ein haus" if i % 2 else "the and of not that is a house" for i in range(n)]
    rows = [(i, t, "de" if i % 2 else "en", None, None) for i, t in enumerate(texts)]
    hard = [(None if i % 3 == 0 else 1000 + i, t, None, None, None) for i, t in enumerate(HARD_TEXTS)]
    return spark.createDataFrame(rows + hard, DOCS).withColumn("score", F.lit("x"))


def test_hard_rows(spark):
    docs = bilingual(spark)
    rows = language_id.with_language(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        letters = row.text is not None and any(c.isalpha() for c in row.text)
        assert (row.lang_pred == "und") == (not letters)
        assert row.score == 0 if not letters else 0 < row.score <= 1
    known = [r for r in rows if r.lang]
    assert np.mean([r.lang_pred == r.lang for r in known]) == 1
    kept = language_id.identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {r.doc_id for r in known}


def test_whole_texts_are_read(spark):
    """The end of a long text decides as well as its start."""
    windows, labels = language_id.training_sample(bilingual(spark))
    net = language_id.train(windows, labels)
    german, english = "der und die nicht das ist ein haus " * 40, "the and of not that is a house " * 400
    (found, other), _ = language_id.predict([german + english, english[:1200] + german * 9], net, net.pair_tables())
    assert (found, other) == ("en", "de")


def test_nothing_to_learn_from(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.with_language(docs).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert language_id.with_language(empty).count() == language_id.identified(empty).count() == 0


def test_sample_is_bounded_and_skips_held_out(spark):
    docs = bilingual(spark, 400)
    windows, labels = language_id.training_sample(docs, docs_per_language=20)
    assert len(windows) == len(labels) and labels.count("en") <= 20 * language_id.WINDOWS_PER_DOC
    shown = docs.filter(~language_id.held_out("doc_id") & F.col("lang").isNotNull())
    poisoned = docs.withColumn("lang", F.when(language_id.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    assert "xx" not in language_id.training_sample(poisoned)[1] and shown.count()


def test_table_sums_are_convolutions():
    net = language_id.train(language_id.windows_of(b"some text to train on, and more " * 40), ["a", "b"] * 2 + ["a"], epochs=1)
    windows = language_id.windows_of("Ein Text für den Test.".encode() * 30)
    pooled, _ = net._pooled(windows, net.pair_tables())
    plain = []
    for w in net.filters:
        sums = [
            sum(w[k][windows[:, p + k]] for k in range(len(w))) for p in range(language_id.WINDOW - len(w) + 1)
        ]
        plain.append(np.max(sums, axis=0))
    assert np.allclose(pooled, np.maximum(np.concatenate(plain, axis=1) + net.bias, 0), atol=1e-4)


# ------------------------------------------------------------------ licences


def plain_score(template, words):
    """Score of the best alignment of the whole template with a part of the words,
    over the full matrix."""
    above = [0] * (len(words) + 1)
    for i, t in enumerate(template):
        row = [license_scan.GAP * (i + 1)]
        for j, w in enumerate(words):
            step = license_scan.MATCH if t == w else license_scan.MISMATCH
            row.append(max(above[j] + step, above[j + 1] + license_scan.GAP, row[-1] + license_scan.GAP))
        above = row
    return max(above)


@pytest.mark.parametrize("seed", range(12))
def test_banded_alignment_against_the_full_matrix(seed):
    random = np.random.default_rng(seed)
    template = random.integers(0, 30, 40)
    copy = [w for w in template.tolist() for w in ([] if random.random() < 0.08 else [w, 99] if random.random() < 0.08 else [w])]
    before = random.integers(40, 60, 25).tolist()
    words = np.array(before + copy + random.integers(40, 60, 25).tolist())
    found = license_scan.align(template, words, 25, 25, 16)
    span = words[found.first : found.after]
    assert plain_score(template.tolist(), words.tolist()) == plain_score(template.tolist(), span.tolist())
    assert 0.75 * len(template) <= found.matched <= len(template)
    assert found.first >= 24 and found.after <= 25 + len(copy) + 1


def test_matches_and_spans(spark):
    mit = license_scan.TEMPLATES["mit"]
    texts = [
        *HARD_TEXTS,
        "Intro. Released under the MIT License. More. released UNDER the mit license",
        "a b " + mit.replace("free of charge, ", "") + " tail",
        "the software is free of any license under the law",
        " ".join(mit.split()[:60]),
        "Licensed under CC BY-NC 3.0.",
    ]
    n = len(HARD_TEXTS)
    rows = license_scan.scan_licenses(documents(spark, texts)).collect()
    found = {(r.doc_id, r.license, r.first_word, r.after_word) for r in rows}
    assert found == {
        (n, "mit-notice", 1, 6),
        (n, "mit-notice", 7, 12),
        (n + 1, "mit", 2, 2 + len(words_of(mit.encode())) - 3),
        (n + 4, "cc-by-nc-notice", 0, 7),
    }
    assert all(r.coverage == r.matched_words / r.template_words >= license_scan.COVERAGE for r in rows)


def fewest_edits(template, words):
    """Fewest words changed, left out and inserted that make the template a part of the
    words, by the full matrix, a row at a time."""
    places = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, dtype=np.int64)
    for i, t in enumerate(template):
        best = np.append(i + 1, np.minimum(row[:-1] + np.array([w != t for w in words], dtype=np.int64), row[1:] + 1))
        row = np.minimum.accumulate(best - places) + places
    return int(row.min())


def edited(random, words, edits):
    words = list(words)
    for _ in range(edits):
        place = int(random.integers(0, len(words)))
        kind = random.integers(0, 3)
        words[place : place + (kind != 2)] = [] if kind == 1 and len(words) > 1 else [b"other%d" % random.integers(0, 9)]
    return words


def test_license_query_against_the_full_matrix(spark, sf_dir):
    """Every document with a copy of at most the promised edits is reported, for every template,
    and what is reported has the words it says."""
    docs = {r.doc_id: words_of(r.text.encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op6_license_scan(spark, sf_dir).collect()
    found = {(r.doc_id, r.license) for r in rows}
    assert rows
    for name, text in license_scan.TEMPLATES.items():
        template = words_of(text.encode())
        allowed = license_scan.Plan(len(template)).edits
        for doc, words in docs.items():
            shared = set(template) & set(words)
            if sum(t in shared for t in template) >= len(template) - allowed and fewest_edits(template, words) <= allowed:
                assert (doc, name) in found
    for r in rows:
        template, span = words_of(license_scan.TEMPLATES[r.license].encode()), docs[r.doc_id][r.first_word : r.after_word]
        assert fewest_edits(template, span) >= r.template_words - r.matched_words
        assert r.matched_words <= len(span) and r.coverage >= license_scan.COVERAGE


@pytest.mark.parametrize("seed", range(8))
def test_every_edited_copy_is_found(seed):
    """Recall is whole up to the promised edits, also among other copies."""
    random, index = np.random.default_rng(seed), license_scan.Index(license_scan.TEMPLATES)
    noise = [w for t in license_scan.TEMPLATES.values() for w in words_of(t.encode())] + [b"filler%d" % i for i in range(400)]
    for name, text in license_scan.TEMPLATES.items():
        template = words_of(text.encode())
        words = edited(random, template, int(random.integers(0, license_scan.Plan(len(template)).edits + 1)))
        before, behind = ([noise[i] for i in random.integers(0, len(noise), 60)] for _ in range(2))
        found = index.scan(b" ".join(before + words + behind))
        near = [f for f in found if f[0] == name and f[4] < 60 + len(words) and f[5] > 60]
        assert near, (name, words)


def test_edited_notices():
    index = license_scan.Index(license_scan.TEMPLATES)
    for text, name in (
        ("Released under an MIT License.", "mit-notice"),
        ("Released under MIT License.", "mit-notice"),
        ("Licensed under the Apache Licence, Version 2.0.", "apache-2.0-notice"),
    ):
        assert [f[0] for f in index.scan(text.encode())] == [name]


def test_templates_of_few_words():
    index = license_scan.Index({"one": "copyleft", "two": "all rights", "three": "all rights reserved"})
    assert [(f[0], f[4], f[5]) for f in index.scan(b"copyleft is not all rights reserved, all wrongs")] == [
        ("one", 0, 1), ("three", 3, 6), ("two", 3, 5),
    ]


def test_many_repeats_take_linear_time():
    index = license_scan.Index(license_scan.TEMPLATES)
    index.scan(b"warm")
    taken = []
    for n in (10_000, 100_000):
        start = time.perf_counter()
        found = index.scan(b"Released under the MIT License. " * n)
        taken.append(time.perf_counter() - start)
        assert [(f[4], f[5]) for f in found if f[0] == "mit-notice"] == [(5 * i, 5 * i + 5) for i in range(n)]
    assert taken[1] < 30 * max(taken[0], 0.1)


def test_templates_are_bounded_and_may_be_empty(spark):
    assert license_scan.scan_licenses(documents(spark), {"none": "", "dots": "..."}).count() == 0
    assert license_scan.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        license_scan.Index({"big": "x" * (license_scan.MOST_TEMPLATE_BYTES + 1)})


def test_every_label_is_learned(spark):
    rows = [(3 * i, f"wörd{i % 300} text of its own", f"l{i % 300}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").filter("crc32(CAST(doc_id AS STRING)) % 3 != 1")
    labels = {r.lang for r in docs.select("lang").distinct().collect()}
    windows, found = language_id.training_sample(docs, most_docs=600)
    assert set(found) == labels and len(labels) > 250
    assert len(windows) <= 2 * len(labels) * language_id.WINDOWS_PER_DOC
