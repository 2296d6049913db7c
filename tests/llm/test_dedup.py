"""SimHash, components and substring dedup against brute force."""
import random

import numpy as np
import xxhash

from llm_helpers import documents
from railpulse.llm import components, simhash, substring


def closure(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] \
        + [(500, 500 + i) for i in range(1, 60)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = closure({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = ["", "One", "one TWO", "a b c", "a b c d a b c d a b c", "É é   x", "tab\tnew\nline\x0bfeed\x0c x"]
    got = simhash.fingerprints_of(texts).view(np.uint64).tolist()
    assert got == [brute_fingerprint(t) for t in texts]


def test_links_match_all_pairs(spark):
    """Small cells, so that crowded blocks are dealt out."""
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    prints = {0}
    for c in centres:
        for _ in range(40):
            x = c
            for b in rnd.sample(range(64), rnd.randrange(5)):
                x ^= 1 << b
            prints.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    links = simhash.close_links(spark.createDataFrame([(x,) for x in signed], "fp long"), cell=8).collect()
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3]
    assert {frozenset((r["u"], r["v"])) for r in links} <= {frozenset(p) for p in pairs}
    assert closure(signed, [(r["u"], r["v"]) for r in links]) == closure(signed, pairs)


def test_component_ids_and_kept_documents(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(30, base), (10, base), (20, base + " tail"), (40, "something else entirely here"), (50, None), (51, ""), (None, base)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == {30: 10, 10: 10, 20: 10, 40: 40, 50: 50, 51: 50, None: 10}
    assert sorted(r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()) == [10, 40, 50]


def test_chain_score_is_the_best():
    """The Fenwick chain against the quadratic recurrence."""
    rnd = random.Random(1)
    for _ in range(50):
        runs = np.array(sorted({(rnd.randrange(60), rnd.randrange(60), 5) for _ in range(rnd.randrange(2, 25))}))
        k, cost = 5, 0.05
        score = []
        for i, (f, p, size) in enumerate(runs):
            best = 0.0
            for j in range(len(runs)):
                fj, pj, sj = runs[j]
                if fj + sj - k + 1 <= f and pj + sj - k + 1 <= p and j < i:
                    best = max(best, score[j] - cost * (f - fj - sj + p - pj - sj))
            score.append(size + best)
        chain = substring.chains(runs, gap=1000)[0]
        got = sum(r[2] for r in chain) - cost * sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(chain, chain[1:]))
        assert abs(got - max(score)) < 1e-9


def test_common_words():
    rnd = random.Random(2)
    for _ in range(60):
        x, y = ([rnd.randrange(4) for _ in range(rnd.randrange(9))] for _ in range(2))
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        assert substring.common_words(np.array(x), np.array(y)) == table[-1][-1]


def planted():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    passage = prose(70)
    fuzzy = list(passage)
    for i in (15, 30, 45, 60):
        fuzzy[i] = word()
    gapped = passage[:35] + prose(2) + passage[36:]
    docs = {1: prose(50) + passage + prose(40), 2: prose(80) + passage + prose(10), 3: prose(20) + fuzzy + prose(60),
            4: prose(30) + gapped + prose(30), 5: prose(200), 6: prose(40) + passage[:20] + prose(40), 7: passage + prose(5)}
    cycle = (prose(12) * 12)
    docs[8], docs[9] = prose(10) + cycle, cycle + prose(30)
    return docs, passage


def test_planted_passages(spark):
    docs, passage = planted()
    got = {r["doc_id"]: r for r in substring.repeated(documents(spark, [(i, " ".join(w)) for i, w in docs.items()])).collect()}
    assert {i for i, r in got.items() if r["passages"]} == {2, 3, 4, 7, 9}
    assert {i: r["class_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 1, 8: 8, 9: 8}
    assert (got[2]["passages"][0]["start"], got[2]["passages"][0]["end"]) == (80, 150)
    assert (got[7]["passages"][0]["start"], got[7]["passages"][0]["end"]) == (0, 70)
    assert got[1]["n_links"] == 4 and got[5]["n_links"] == 0
    for i in (3, 4):
        p = got[i]["passages"][0]
        assert p["end"] - p["start"] >= 68


def test_repeats_are_cut(spark):
    docs, _ = planted()
    texts = {i: "Head  line\n" + " ".join(w) + "\n" for i, w in docs.items()}
    kept = {r["doc_id"]: r for r in substring.cut_repeats(documents(spark, list(texts.items()))).collect()}
    assert kept[1]["text"] == texts[1] and kept[5]["text"] == texts[5] and kept[6]["text"] == texts[6]
    assert kept[2]["text"].split() == ["Head", "line"] + docs[2][:80] + docs[2][150:]
    assert all(r["n_chars"] == len(r["text"]) for r in kept.values())


def test_every_exact_repeat_is_found(spark):
    """All runs of 50 words that stand in an earlier document too, on real rows."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {r["doc_id"]: r["passages"] for r in substring.repeated(documents(spark, rows)).collect()}
    first, missed, total = {}, 0, 0
    for i, text in sorted(rows):
        words = text.encode().lower().split()
        covered = {x for p in got[i] for x in range(p["start"], p["end"])}
        for j in range(len(words) - 49):
            h = hash(tuple(words[j:j + 50]))
            if first.setdefault(h, i) != i:
                total += 1
                missed += not covered.issuperset(range(j, j + 50))
    assert total > 1000 and not missed
