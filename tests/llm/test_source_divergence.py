import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import DOCS, HARD_TEXTS, oracle, rows_of

from tallyglass.llm import queries, source_divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def table_of(spark, rows):
    """Rows (text, lang, source); ids repeat and may be null."""
    return spark.createDataFrame([(i % 7 or None, t, l, s, None) for i, (t, l, s) in enumerate(rows)], DOCS)


def plain_terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_audit(rows, least=10, most=10):
    """Dense loops over every group and term."""
    rows = [(plain_terms(t), l or "", s or "") for t, l, s in rows]
    docs = Counter((l, w) for ws, l, _ in rows for w in set(ws))
    counts, found = defaultdict(Counter), []
    for ws, l, s in rows:
        counts[l, s].update(w for w in ws if docs[l, w] >= least)
    for lang in {l for l, _ in counts}:
        kept = sorted(w for (l, w), n in docs.items() if l == lang and n >= least)
        whole = sum((c for (l, _), c in counts.items() if l == lang), Counter())
        p = lambda c, w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        own = {s: c for (l, s), c in counts.items() if l == lang}
        for s, c in own.items():
            pairs = [(o, sum(gap(p(c, w), p(d, w)) for w in kept)) for o, d in own.items() if o != s]
            apart = [(w, gap(p(c, w), p(whole, w))) for w in kept if c[w] and p(c, w) > p(whole, w)]
            for part, items in (("pair", pairs), ("term", apart)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [
                    (lang, s, part, item, value, rank)
                    for rank, (item, value) in enumerate(items, 1)
                    if part == "pair" or rank <= most
                ]
    return sorted(found, key=repr)


def some_rows(n, langs, sources, words, seed):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        source = int(random.integers(sources))
        chosen = random.zipf(1.4, int(random.integers(0, 30))) % words + source % 3
        rows.append((" ".join(f"W{'é' * (k % 2)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in chosen), f"l{random.integers(langs)}", f"s{source}"))
    return rows


@pytest.mark.parametrize("block_terms,tile_sources", [(8192, 64), (4, 64), (8192, 2), (3, 3)])
def test_against_plain_loops(spark, monkeypatch, block_terms, tile_sources):
    monkeypatch.setattr(source_divergence, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(source_divergence, "TILE_SOURCES", tile_sources)
    rows = some_rows(400, 2, 7, 60, block_terms + tile_sources)
    rows += [(None, "l0", "empty"), ("", None, None), ("x", "l0", None), ("alone", "other", "s1"), ("1 2", "other", "s2")]
    found = source_divergence.audit(table_of(spark, rows))
    assert rows_of(found, COLUMNS) == plain_audit(rows)


def test_hard_texts_ties_and_other_columns(spark):
    rows = [(t, "en", f"s{i % 3}") for i, t in enumerate(HARD_TEXTS * 4)] + [(t, None, "Z") for t in HARD_TEXTS * 10]
    docs = table_of(spark, rows).withColumns({c: F.lit("x") for c in ("term", "n", "place", "value", "rank")})
    assert rows_of(source_divergence.audit(docs), COLUMNS) == plain_audit(rows)


def test_no_documents(spark):
    assert source_divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(source_divergence, "SPLIT_AT_ONCE", 8)
    for text in ("abc " * 50, "x" * 100 + " y", "naïve Ünïcödé 123 " * 9, "  ", "", "x" * 33):
        found = [w.decode() for part in source_divergence.terms(text.encode()) for w in part]
        assert found == plain_terms(text)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 6), st.integers(1, 40), st.integers(1, 4), st.integers(0, 999))
def test_trees_price_what_dense_rows_do(groups, places, most, seed):
    random = np.random.default_rng(seed)
    counts = random.integers(0, most, (groups, places)) * random.integers(0, 2, (groups, places))
    totals, kept = counts.sum(axis=1), places + int(random.integers(0, 9))
    first, second = np.triu_indices(groups, 1)
    shares = source_divergence.share(counts, totals[:, None], kept)
    p, q = shares[first], shares[second]
    expected = ((p - q) ** 2 // (p + q)).sum(axis=1)
    found = source_divergence.block_divergences(counts, totals, kept, first, second)
    assert found.tolist() == expected.tolist()


def test_equal_stretches_are_one_node_and_priced_once():
    counts = np.zeros((10, 4096), dtype=np.int64)
    counts[np.arange(10), np.arange(10)] = 7
    trees = source_divergence.Trees(counts)
    assert sum(len(left) for left, _ in trees.below) < 130  # of 40,950
    first, second = np.triu_indices(10, 1)
    pair, a, b, places = trees.different_leaves(first, second)
    assert len(pair) == 3 * len(first)
    assert places.tolist() == [4094, 1, 1] * len(first)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**50), st.integers(0, 2**20), st.integers(1, 2**40))
def test_shares_are_exact(count, more, kept):
    found = source_divergence.share(np.array([count]), np.array([count + more]), np.array([kept]))
    assert found.tolist() == [1 + 10**9 * (count + 2) // (count + more + 2 * kept)]


def test_shares_in_sql(spark):
    cases = [(0, 0, 1), (5, 9, 3), (2**50, 2**51, 12345), (10**12, 3 * 10**12, 10**6)]
    rows = spark.createDataFrame(cases, "n bigint, total bigint, kept bigint")
    found = rows.selectExpr("n", "total", "kept", source_divergence._share("n", "total", "kept")).collect()
    assert all(r[3] == 1 + 10**9 * (r[0] + 2) // (r[1] + 2 * r[2]) for r in found)


def test_query_against_sql(spark, sf_dir):
    columns, expected = oracle(sf_dir, queries.OP13_SQL)
    assert rows_of(queries.op13_source_divergence(spark, sf_dir), columns) == expected
