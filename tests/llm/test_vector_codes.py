import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import oracle, rows_of

from tallyglass.llm import queries, vector_codes


def table_of(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, label int")


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """Loops over rows (vec_id, vector, label): codes and error by place, codebooks."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[int(np.floor(float(np.float32(x)) * 1024)) for x in v] for _, v, _ in rows]
    width = len(vectors[0]) // parts
    cut = [[v[k * width : (k + 1) * width] for k in range(parts)] for v in vectors]
    books = [[v[k] for v in cut[:entries]] for k in range(parts)]

    def closest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            own = [[] for _ in books[k]]
            for v in cut:
                own[closest(v[k], books[k])[1]].append(v[k])
            books[k] = [
                [sum(c) // len(c) for c in zip(*ps)] if ps else e for ps, e in zip(own, books[k])
            ]
    found = [[closest(v[k], books[k]) for k in range(parts)] for v in cut]
    return [([i for _, i in f], sum(d for d, _ in f)) for f in found], books


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 20), st.integers(1, 5), st.sampled_from([2, 60, 2**27]), st.integers(0, 99))
def test_search_finds_the_first_of_the_nearest(n, k, width, size, seed):
    random = np.random.default_rng(seed)
    points, entries = (random.integers(-size, size, (m, width)) for m in (n, k))
    pivots = vector_codes.chosen_pivots(entries[None], 3)[0]
    at, best = vector_codes.nearest(
        points, entries, vector_codes.to_pivots(points, pivots), vector_codes.to_pivots(entries, pivots)
    )
    every = vector_codes.distances(points, entries)
    assert at.tolist() == every.argmin(axis=1).tolist()
    assert best.tolist() == every.min(axis=1).tolist()


def test_pruning_skips_entries(monkeypatch):
    # Clusters far from each other: bounds leave little to evaluate.
    random = np.random.default_rng(1)
    centres = random.integers(-(10**6), 10**6, (64, 8))
    points = centres[random.integers(0, 64, 500)] + random.integers(-9, 9, (500, 8))
    pivots = vector_codes.chosen_pivots(centres[None], 8)[0]
    known = vector_codes.to_pivots(points, pivots), vector_codes.to_pivots(centres, pivots)
    seen = []
    plain = np.einsum
    monkeypatch.setattr(vector_codes, "ENTRIES_AT_ONCE", 2)
    monkeypatch.setattr(np, "einsum", lambda *a: seen.append(len(a[1]) * a[1].shape[1]) or plain(*a))
    vector_codes.nearest(points, centres, *known)
    assert sum(seen) < 0.1 * 500 * 64


@pytest.mark.parametrize("entries,rounds", [(3, 4), (256, 2), (1, 1)])
def test_against_plain_loops(spark, entries, rounds):
    random = np.random.default_rng(entries)
    rows = [(i, random.normal(size=8).astype(np.float32).tolist(), i % 3) for i in range(60)]
    rows += [(7, rows[7][1], None), (None, rows[3][1], 1), (8, rows[9][1], 0)]  # repeats and ties
    coded, books = vector_codes.compress(table_of(spark, rows), entries=entries, rounds=rounds)
    expected, expected_books = plain_codes(rows, entries=entries, rounds=rounds)
    assert books.entries.tolist() == expected_books
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted((repr(r[0]), repr(r[2]), c, e) for r, (c, e) in zip(ordered, expected))
    assert sorted((repr(r.vec_id), repr(r.label), r.codes, r.error) for r in coded.collect()) == want


def test_unusable_vectors_are_dropped(spark):
    good = [0.5, -0.25, 1.0, 2.0]
    rows = [
        (1, good, 1),
        (2, None, 1),
        (3, [0.5, None, 1.0, 2.0], 1),
        (4, [0.5, float("nan"), 1.0, 2.0], None),
        (5, [0.5, float("inf"), 1.0, 2.0], 1),
        (6, [0.5, -float("inf"), 1.0, 2.0], 1),
        (7, [3e38, 0.0, 0.0, 0.0], 1),
        (8, [], 1),
        (9, [1.0] * 8, 1),
        (10, [1.0] * 3, 1),
        (11, [1.0] * 4, None),
        (12, [-0.0001] * 4, None),
    ]
    coded, books = vector_codes.compress(table_of(spark, rows))
    found = {r.vec_id: r for r in vector_codes.with_label_error(coded).collect()}
    assert sorted(found) == [1, 11, 12]
    assert books.entries[:, :, 0].tolist() == [[512, 1024, -1], [-256, 1024, -1], [1024, 1024, -1], [2048, 1024, -1]]
    assert [r.error for r in found.values()] == [0, 0, 0]


def test_label_error_sums_equal_labels_and_nulls(spark):
    rows = [(i, [float(i % 5), 0.1 * i, 1.0, 0.0], [1, 1, None][i % 3]) for i in range(30)]
    coded, _ = vector_codes.compress(table_of(spark, rows), entries=2)
    summed = vector_codes.with_label_error(coded).collect()
    for label in (1, None):
        own = [r for r in summed if r.label == label]
        assert {r.label_error for r in own} == {sum(r.error for r in own)} and len(own) == (20 if label else 10)


def test_restored_vectors_and_other_columns(spark):
    rows = [(i, [i / 8, -i / 4, 1.0, 0.0], 0) for i in range(20)]
    df = table_of(spark, rows, "array<double>").withColumns({"codes": F.lit("x"), "error": F.lit(1), "v": F.lit(2)})
    coded, books = vector_codes.compress(df, label_column=None)
    for row in vector_codes.restored(coded.withColumn("restored", F.lit(0)), books).collect():
        assert row.label is None and row.restored == [row.vec_id / 8, -row.vec_id / 4, 1.0, 0.0]


def test_no_vectors(spark):
    coded, books = vector_codes.compress(table_of(spark, []))
    assert vector_codes.with_label_error(coded).count() == 0
    assert books.digest() == hashlib.sha256(b"").hexdigest()


def test_query_against_sql(spark, sf_dir):
    columns, expected = oracle(sf_dir, queries.OP11_SQL)
    assert rows_of(queries.op11_vector_codes(spark, sf_dir), columns) == expected
