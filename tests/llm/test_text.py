"""Winnowing, SentencePiece, exact top-k and mixing against brute force."""
import hashlib
import os
import random

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from llm_helpers import documents
from railpulse.llm import mixing, sentencepiece_viterbi as sp, topk, winnowing
from railpulse.llm.queries import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, cur.fetchall())


# -- winnowing -----------------------------------------------------------------------

def brute_winnow(text, k, window):
    if not text:
        return []
    if len(text) < k:
        return [(xxhash.xxh32_intdigest(text.encode(), 0), 0)]
    hashes = []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i:i + k]:
            h = (h * winnowing.BASE + ord(c) + 1) % (1 << 64)
        hashes.append(((h ^ h >> 29) * 0xBF58476D1CE4E5B9) % (1 << 64) >> 32)
    out = []
    for i in range(max(1, len(hashes) - window + 1)):
        own = hashes[i:i + window]
        j = i + max(x for x, v in enumerate(own) if v == min(own))
        if not out or out[-1][1] != j:
            out.append((hashes[j], j))
    return out


@given(st.lists(st.text(alphabet="ab é€\U0001F600", max_size=60), max_size=6), st.sampled_from([(16, 16), (5, 4), (7, 3), (1, 1), (3, 9)]))
@settings(max_examples=150, deadline=None)
def test_winnowing(texts, params):
    got = winnowing.winnow(texts, *params)
    for i, t in enumerate(texts):
        own = got.owner == i
        assert list(zip(got.hashes[own].tolist(), got.positions[own].tolist())) == brute_winnow(t, *params)


def test_shared_text_shares_a_fingerprint():
    rnd = random.Random(1)
    noise = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    n = winnowing.K + winnowing.WINDOW - 1
    for _ in range(50):
        common = noise(n)
        texts = [noise(rnd.randrange(80)) + common + noise(rnd.randrange(80)) for _ in range(2)]
        got = winnowing.winnow(texts)
        assert set(got.hashes[got.owner == 0].tolist()) & set(got.hashes[got.owner == 1].tolist())


def test_compared_with_the_next_document(spark):
    rnd = random.Random(3)
    rows = [(i * 7 % 101, "".join(rnd.choice("abcde é") for _ in range(rnd.randrange(120)))) for i in range(101)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, None)]
    got = {r["doc_id"]: r for r in winnowing.compare_with_next(documents(spark, rows)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        changed = text[:len(text) - len(text) // 4] + following[:len(text) // 4]
        sets = [{h for h, _ in brute_winnow(t, winnowing.K, winnowing.WINDOW)} for t in (text, changed, following)]
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(r["near_edited"] - near(sets[0], sets[1])) < 1e-12 and abs(r["near_next"] - near(sets[0], sets[2])) < 1e-12
    assert got[500]["fingerprint"] == got[501]["fingerprint"] == got[rows[3][0]]["fingerprint"]
    assert got[500]["near_next"] == 1.0


# -- SentencePiece ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return sp.load()


def piece_scores(v):
    names, out = [""], {}
    for before, last, ids, scores in zip(v.before, v.last, v.ids, v.scores):
        names = [names[b] + chr(c) for b, c in zip(before, last)]
        out |= {p: (int(i), float(s)) for p, i, s in zip(names, ids, scores) if i >= 0}
    return out


def brute_best(text, pieces, v):
    """Best total score of the whole text by dynamic programming."""
    shown = ("▁" + text.replace("▁", "").replace(" ", "▁")) if text else ""
    best = [0.0] + [-np.inf] * len(shown)
    for end in range(1, len(shown) + 1):
        best[end] = best[end - 1] + v.byte_score if shown[end - 1] not in pieces else -np.inf
        for start in range(max(0, end - 16), end):
            if shown[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[shown[start:end]][1])
    return best[-1]


def test_viterbi_is_the_best_segmentation(vocabulary):
    pieces = piece_scores(vocabulary)
    score = {i: s for i, s in pieces.values()}
    texts = ["", "Hello world", "  two  spaces   ", "internationalization of tokenizers", "aaaaaaaaaaaaaaaaaaaaaaaa", "été à l'école", "x"]
    ids, counts = sp.Encoder(vocabulary).encode(texts)
    for t, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert abs(sum(score.get(i, vocabulary.byte_score) for i in own.tolist()) - brute_best(t, pieces, vocabulary)) < 1e-9


@given(st.lists(st.text(max_size=40), max_size=5))
@settings(max_examples=200, deadline=None)
def test_round_trip(vocabulary, texts):
    ids, counts = sp.Encoder(vocabulary, memory=20).encode(texts)
    assert sp.decode(ids, counts, vocabulary) == texts


def test_round_trip_of_real_rows(spark):
    rows = QUERIES["op10_sentencepiece"](spark, SF).collect()
    assert rows and all(r["round_trip"] and r["n_tokens"] == len(r["tokens"]) for r in rows)


def test_long_words_and_memory(vocabulary):
    texts = ["x" * 5000, "ab" * 3000 + " c", "▁" * 30, "\x00\x01 �"]
    for memory in (0, 1000):
        encoder = sp.Encoder(vocabulary, memory=memory)
        for _ in range(2):
            ids, counts = encoder.encode(texts)
            assert sp.decode(ids, counts, vocabulary) == texts


# -- exact top-k -----------------------------------------------------------------------

def test_top_k_with_ties_and_bad_vectors(spark):
    rnd = np.random.default_rng(5)
    vectors = rnd.normal(size=(600, 12)).round(1)
    vectors[100:200] = vectors[7]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 12), (1060, [float("inf")] * 12), (None, [1.0] * 12), (40, [0.5] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(df, k=9, query_block=7, vector_block=90).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows[:600]] + [(40, np.full(12, 32))]
    for q in range(0, 600, 20):
        if q == 40:
            continue  # the id stands twice
        own = whole[q][1]
        want = sorted((-int(own @ v), i) for n, (i, v) in enumerate(whole) if n != q)[:9]
        assert [(i, s) for _, i, s in sorted(got[q])] == [(i, -s) for s, i in want]
    assert set(got) == set(range(0, 600, 20)) and len(got[40]) == 18


def test_possible_members_hold_the_best():
    rnd = np.random.default_rng(1)
    vectors = rnd.integers(-30, 30, size=(500, 16))
    queries = rnd.integers(-30, 30, size=(40, 16)) * (rnd.random((40, 16)) < 0.6)
    for largest in (30, 1 << 30):  # single and double precision
        index = topk.ImpactIndex(vectors, largest)
        for q, members in zip(queries, index.possible(queries, 10)):
            score = vectors @ q
            assert set(np.flatnonzero(score > np.sort(score)[-10]).tolist()) <= set(members.tolist())
    assert len(index.possible(np.zeros((1, 16), dtype=int), 10)[0]) == 500


# -- mixing ----------------------------------------------------------------------------

def test_targets_share_out_the_excess(spark):
    rnd = random.Random(8)
    for _ in range(3):
        sizes = [(f"s{i:02d}", rnd.choice([0, 1, 10, 100, 5000])) for i in range(9)] + [(None, 40)]
        got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        weight = {s: (3, 1, 2)[i % 3] for i, (s, _) in enumerate(sizes)}
        total, free, want = 1.5 * sum(n for _, n in sizes), dict(sizes), {}
        while free:
            level = (total - sum(want.values())) / sum(weight[s] for s in free)
            over = [s for s, n in free.items() if weight[s] * level > 2 * n]
            if not over:
                want |= {s: weight[s] * level for s in free}
                break
            for s in over:
                want[s] = 2 * free.pop(s)
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_taken_words_come_near_the_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix_sources(docs)
    rows = mixed.collect()
    assert max(r["copies"] for r in rows) <= 2
    by_source = {}
    for r in rows:
        own = by_source.setdefault(r["source"], [0, r["target"], 0])
        own[0] += r["size"] * r["copies"]
        own[2] = max(own[2], r["size"])
    assert all(abs(taken - target) <= longest for taken, target, longest in by_source.values())
    again = mixing.mix_sources(docs.repartition(13)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.emit_copies(mixed, ["doc_id"]).count() == sum(r["copies"] for r in rows)


def test_mixing_is_native(spark):
    plan = mixing.mix_sources(documents(spark, [(1, "a b", "en", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_top_k_beyond_the_precision_of_doubles(spark):
    rng = np.random.default_rng(6)
    whole = rng.integers(-(1 << 22), 1 << 22, (300, 8))
    whole[100:200] = whole[:100] + rng.integers(0, 2, (100, 8))  # scores that differ in the last digits
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(whole.tolist())]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    big = whole.astype(object) * 64
    want = []
    for q in range(0, 300, 20):
        best = sorted((-int(big[q] @ big[i]), i) for i in range(300) if i != q)[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want and max(s for *_, s in want) > 1 << 53
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e12]), (20, [1e12])], "vec_id long, embedding array<double>")).collect()
