"""Phrase collocations against a brute-force count."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from llm_helpers import documents
from railpulse.llm import collocations as co


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(rows, longest):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    return f, n


def brute(rows, shortest=2, longest=3, least=10, keep=2000, cover=50):
    f, n = counts(rows, longest)
    candidates = {p: a for p, a in f.items() if shortest <= len(p[1]) and a >= least}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        covered = any(x == lang and len(q) > len(p) and 100 * b >= cover * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                      for (x, q), b in candidates.items())
        if not covered:
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, own in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(own)[:keep], 1))


def mined(df, **options):
    return sorted(tuple(r)[:8] for r in co.collocations(df, **options).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "é", "New", "york", "z\x0bz", "\U0001F600", "of", "the", "x" * 300, "y-1"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", " ; "]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(60)))
        out.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return [*out, (None, "en"), ("", None), (" . \t", "fr"), *[("new york city hall", "es")] * 15]


@pytest.mark.parametrize("options", [{}, {"longest": 5, "least": 4, "keep": 50}, {"shortest": 3, "longest": 4, "least": 3, "cover": 90}, {"longest": 2}])
def test_against_brute_force(spark, options):
    rows = corpus(len(options))
    df = documents(spark, [(i, t, x) for i, (t, x) in enumerate(rows)])
    assert mined(df, **options) == brute(rows, **options)


def test_first_document_and_null_ids(spark):
    df = documents(spark, [(None if i == 3 else i, "red fox." if i > 2 else "none", "en") for i in range(20)])
    assert [(r["phrase"], r["a"], r["first_doc_id"]) for r in co.collocations(df).collect()] == [("red fox", 17, 4)]


def test_colliding_fingerprints_keep_their_counts(spark, monkeypatch):
    """Fingerprints of two bits and a full bit set: only the texts tell phrases apart."""
    rows = corpus(7, 60)
    df = documents(spark, [(i, t, x) for i, (t, x) in enumerate(rows)])
    expected = brute(rows)
    made = co.Words.fingerprints
    words = co.Words.of([t.encode() for t, _ in rows if t], co.Powers())
    at = words.grams(2)
    fps = made(words, at, 2, np.zeros(len(rows), np.uint64)) & np.uint64(3)
    spelled = [words.data[words.start[i]:words.end[i + 1]].tobytes() for i in at]
    seen = Counter()
    for first, group in co.groups(words, fps, words.start[at], words.end[at + 1] - words.start[at], np.zeros(len(at), np.int64)):
        for i, g in enumerate(group.tolist()):
            if g >= 0:
                assert spelled[first[g]] == spelled[i]
                seen[spelled[i]] += 1
    assert seen == Counter(spelled)
    monkeypatch.setattr(co, "bit_set", lambda fps: np.full(4096, 255, np.uint8))  # lets everything through
    assert mined(df) == expected


def test_bit_set(spark):
    fps = [(x,) for x in (0, 1, 7, 8, 32_767, 32_768, -1, -2, 1 << 40, 999_999)]
    bits = co.bit_set(spark.createDataFrame(fps, "fp long"))
    assert co.hit(bits, np.array([x for x, in fps], dtype=np.int64).view(np.uint64)).all()
    assert co.hit(bits, np.arange(1 << 15, dtype=np.uint64)).sum() <= len(fps)
    assert not co.hit(co.bit_set(spark.createDataFrame([], "fp long")), np.arange(99, dtype=np.uint64)).any()


@given(st.lists(st.sampled_from(["a", "bb", "c" * 40, " ", " ", ".", "\n"]), max_size=60), st.integers(1, 30), st.integers(2, 4))
@settings(max_examples=200, deadline=None)
def test_parts_of_a_long_text_count_once(pieces, step, longest):
    text = "".join(pieces)
    expected, _ = counts([(text, "en")], longest)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "lang": ["en"], "text": [text]})
    got, old = Counter(), co.STEP
    co.STEP = step
    try:
        for words, langs, _ in co.buffers([batch], longest):
            for n in range(1, longest + 1):
                got.update(tuple(words.data[words.start[i]:words.end[i + n - 1]].tobytes().decode().split(" ")) for i in words.grams(n))
    finally:
        co.STEP = old
    assert got == Counter({p: c for (_, p), c in expected.items()})


def test_tables_without_phrases(tricky, nothing):
    assert co.collocations(nothing).count() == 0
    got = co.collocations(tricky, least=2).collect()
    assert {r["lang"] for r in got} >= {"en", "und"}
    assert co.collocations(tricky.where("text is null")).count() == 0
