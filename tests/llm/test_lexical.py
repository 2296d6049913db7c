"""Ranked lexical search against scores of all pairs."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_helpers import documents
from railpulse.llm import lexical


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=20):
    own = [(doc_id, Counter(terms(t)), len(terms(t))) for doc_id, t in docs if terms(t)]
    n_docs, total = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item_id, text in items:
        q, ranked = Counter(terms(text)), []
        for doc_id, tf, n in own:
            m = 75 + 25 * n * n_docs // total
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t, c in q.items() if t in tf)
            if score > 0:
                ranked.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i, r[3], -r[0]) for i, r in enumerate(sorted(ranked, key=lambda r: r[:3])[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted((tuple(r) for r in lexical.search(docs, items, **options).collect()), key=str)


def corpus(seed, n_docs=400, n_items=30):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(500)] + ["Über", "ß1", "中文", "x_y", "A1b"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 80))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[i % 5][1]) for i in range(60)] + [(None, docs[1][1]), (None, None), (3, docs[2][1]), (-7, "")]
    items = [(i, text(rng.randrange(0, 40))) for i in range(n_items)]
    items += [(5, items[4][1]), (None, items[3][1]), (99, None), (98, "none of these"), (97, " ".join([docs[7][1]] * 3))]
    return docs, items


def frames(spark, docs, items):
    return documents(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"item_terms": 60}])
def test_against_all_pairs(spark, options):
    docs, items = corpus(1 + len(options))
    assert found(*frames(spark, docs, items), **options) == brute(docs, items, options.get("k", 20))


@given(st.lists(st.dictionaries(st.integers(0, 12), st.integers(1, 9), max_size=6), min_size=1, max_size=80),
       st.lists(st.dictionaries(st.integers(0, 12), st.integers(1, 9), max_size=6), min_size=1, max_size=30), st.integers(1, 5), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_tree_prunes_no_member(docs, items, k, block):
    def csr(rows):
        return (np.array([len(r) for r in rows]), np.array([t for r in rows for t in r], dtype=np.int64),
                np.array([v for r in rows for v in r.values()], dtype=np.int64))

    weights = np.arange(1, 14, dtype=np.int64)
    queries = lexical.Hierarchy(*csr(items), weights, 2)
    tree = lexical.DualTree(queries, k)
    for at in range(0, len(docs), block):
        own = docs[at:at + block]
        tree.search(lexical.Hierarchy(*csr(own), weights, 3), np.arange(at, at + len(own)), np.zeros(len(own), bool))
    for row, item in enumerate(queries.order.tolist()):
        scores = [(-sum(v * d.get(t, 0) for t, v in items[item].items()), i) for i, d in enumerate(docs)]
        best = [(i, -s) for s, i in sorted(scores)[:k] if s]
        assert [(i, s) for i, s in zip(tree.best.id[row].tolist(), tree.best.score[row].tolist()) if s] == best


def test_hierarchy_holds_maxima():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 9, 300)
    rows = [rng.choice(40, n, replace=False) for n in sizes]
    terms_, values = np.concatenate(rows), rng.integers(1, 50, sizes.sum())
    h = lexical.Hierarchy(sizes, terms_, values, np.ones(40, np.int64), 16)
    assert sorted(h.order.tolist()) == list(range(300))
    for first, (starts, t, v) in zip(h.first_row, h.maxima):
        for i in range(len(first) - 1):
            a, b = h.starts[first[i]], h.starts[first[i + 1]]
            expected = {}
            for x, y in zip(h.terms[a:b].tolist(), h.values[a:b].tolist()):
                expected[x] = max(expected.get(x, 0), y)
            assert dict(zip(t[starts[i]:starts[i + 1]].tolist(), v[starts[i]:starts[i + 1]].tolist())) == expected
    assert len(h.first_row[-1]) == 2


def test_whole_branches_are_pruned():
    """Items in one language never meet the documents of the other, and the best
    documents close part of the rest."""
    rng = np.random.default_rng(4)
    rows = [np.append(rng.choice(50, 10, replace=False) + 50 * (i % 2), 100 + i % 2) for i in range(4000)]
    values = rng.integers(1, 1000, 44_000)
    weights = np.ones(102, np.int64)
    docs = lexical.Hierarchy(np.full(4000, 11), np.concatenate(rows), values, weights, lexical.DOCUMENT_LEAF)
    chosen = [np.append(rng.choice(50, 3, replace=False), 100) for _ in range(40)]
    tree = lexical.DualTree(lexical.Hierarchy(np.full(40, 4), np.concatenate(chosen), np.ones(160, np.int64), weights, lexical.ITEM_LEAF), 5)
    tree.search(docs, np.arange(4000), np.zeros(4000, bool))
    assert tree.scored < 4000 * 40 / 3


@given(st.text(max_size=200), st.integers(1, 20))
@settings(max_examples=150, deadline=None)
def test_terms_of_parts(text, part):
    old, lexical.PART = lexical.PART, part
    try:
        n, counts = lexical.term_counts(text)
    finally:
        lexical.PART = old
    assert (n, {t.decode(): c for t, c in counts.items()}) == (len(terms(text)), dict(Counter(terms(text))))


def test_tables_with_odd_rows(spark, tricky, nothing):
    items = spark.createDataFrame([(1, "one id W5"), (2, None), (None, "text")], "item_id long, text string") \
        .select("*", *[F.lit(7).alias(c) for c in ("rank", "score", "n", "terms", "block")])
    got = lexical.search(tricky, items).collect()
    assert {r["item_id"] for r in got} == {1, None} and lexical.search(tricky, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(tricky, items.where("false")).count() == 0
