"""Toxicity by maximum-scoring segments with extreme-value calibration.

Method. Words and their first bytes (``STEMS``) get log-odds between toxic and
clean labelled texts under an informative Dirichlet prior (the corpus
distribution), shrunk by their standard error. A token scores as the strongest
of its word and stems, less a constant drift, so that clean text scores negative
on average and inflected forms of a toxic stem count. A linear-time scan
(Ruzzo and Tompa) finds all maximal-scoring segments of a text. By extreme-value
theory the best segment of n clean tokens reaches S with probability
1 - exp(-K n exp(-lambda S)): lambda solves the moment equation of the clean
token scores, K is its maximum-likelihood value on clean training texts.
Segments with an E-value below ``SIGNIFICANT`` are reported; a logistic link
over the normalised best score and the sum of significant excesses gives the
probability.

Scale. Tokens are hashed into ``BUCKETS`` counts, so the model has a fixed
size; counting, calibration and scoring are projections with one small
grouped sum. The fit uses at most about ``SAMPLE`` labelled rows (chosen by a
hash of doc_id over all labels), which bounds what is broadcast.

Inputs of a score are the text alone. Defined cases: null and empty texts score
like a text without evidence; labels that are null or contradict each other
are not learned from; without labelled training rows every score is 0;
repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import fold, steps, texts
from railpulse.llm.logistic import fit_logistic, predict_logistic

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
BUCKETS = 1 << 19
STEMS = (4, 5, 6)  # bytes
SAMPLE = 200_000
PRIOR = 50.0  # weight of the corpus distribution in the Dirichlet prior, in counts
FLOOR = 0.5  # and a constant part per token
CONFIDENCE = 1.5
DRIFT = 1.25
SIGNIFICANT = 0.05
FOLDS = 5
REMEMBERED = 400_000
BINS = np.linspace(-12, 12, 481)  # of token scores


def buckets(token: bytes) -> list[int]:
    """Of the word and of each stem."""
    digest = xxhash.xxh64_intdigest
    return [digest(token, 1) & (BUCKETS - 1)] + [digest(token[:n], 1 + n) & (BUCKETS - 1) for n in STEMS]


def tokens_of(text: str) -> list[bytes]:
    return TOKEN.findall(text.encode().lower())


@dataclass
class Model:
    odds: np.ndarray  # per bucket
    lam: float
    k: float
    weights: np.ndarray | None  # of the logistic link; None: no labelled rows


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Per-bucket log-odds, shrunk towards 0 by their standard error."""
    total = toxic + clean
    prior = FLOOR + PRIOR * (total + 0.01) / (total.sum() + 0.01 * len(total))
    t, c = toxic + prior, clean + prior
    delta = np.log(t / (t.sum() - t)) - np.log(c / (c.sum() - c))
    error = np.sqrt(1 / t + 1 / c)
    return np.sign(delta) * np.maximum(0, np.abs(delta) - CONFIDENCE * error)


def extreme_rate(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    p = weight / max(weight.sum(), 1)
    if not (p[scores > 0] > 0).any() or (p * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    def moment(x: float) -> float:
        return float((p * np.exp(np.minimum(x * scores, 700))).sum())
    while moment(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 1 else (low, mid)
    return max(high, 0.05)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), ends exclusive, in
    linear time: only positive tokens open a segment."""
    cum = np.cumsum(scores)
    stack: list[list] = []  # start, end, sum before, sum at end, link to the last lower segment
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(cum[i] - scores[i]), float(cum[i])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append([start, end, left, right, j])
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, r - l) for s, e, l, r, _ in stack]


class Scanner:
    """Token scores of texts, remembering up to ``REMEMBERED`` tokens."""

    def __init__(self, odds: np.ndarray):
        self.odds, self.known = odds, {}

    def token_scores(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        words = tokens_of(text)
        new = list(set(words).difference(known))
        if new:
            odds = self.odds[np.array([buckets(w) for w in new])]
            strongest = odds[np.arange(len(new)), np.abs(odds).argmax(axis=1)] - DRIFT
            known.update(zip(new, strongest.tolist()))
        return np.array([known[w] for w in words])


def evidence(best: np.ndarray, excess: np.ndarray, n: np.ndarray, lam: float, k: float) -> np.ndarray:
    """Features of the logistic link."""
    return np.stack([np.clip(lam * best - np.log(k * np.maximum(n, 1)), -20, 60), np.log1p(excess)], axis=1)


def excess_of(segments: list[tuple[int, int, float]], n: int, lam: float, k: float) -> list[tuple[int, int, float, float]]:
    """The significant segments, each with its E-value."""
    rated = [(s, e, x, k * n * float(np.exp(-min(lam * x, 700)))) for s, e, x in segments]
    return [r for r in rated if r[3] <= SIGNIFICANT]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE, folds: int = FOLDS) -> DataFrame:
    """(text, y): labelled rows outside the held-out fold, at most about
    ``sample`` of them."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)") \
        .where(fold("doc_id", folds) != 0).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z")
    n = known.count()
    # xxhash64 as 31-bit fraction: the expected number kept is at most ``sample``.
    kept = known.where((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)) < min(1.0, sample / max(n, 1)))
    return docs.select("doc_id", "text").join(F.broadcast(kept.select("doc_id", "y")), "doc_id").select("text", "y")


def count_tokens(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, in how many toxic and clean rows its tokens stand: a word that
    one text repeats counts once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        for part in steps(batches, "text"):
            words: tuple[Counter, Counter] = (Counter(), Counter())
            for text, y in zip(texts(part.column("text")), part.column("y").to_pylist()):
                words[y].update(set(tokens_of(text)))
            for y in (0, 1):
                if words[y]:
                    at = np.array([buckets(w) for w in words[y]])
                    times = np.fromiter(words[y].values(), dtype=np.int64, count=len(words[y]))
                    np.add.at(counts[y], at.ravel(), np.repeat(times, at.shape[1]))
        at = np.flatnonzero(counts.any(axis=0))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[1, at]), pa.array(counts[0, at])],
                                             ["bucket", "toxic", "clean"])

    sums = (rows.mapInArrow(run, "bucket long, toxic long, clean long")
            .groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    got = sums.toArrow()  # at most BUCKETS rows
    toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS)
    toxic[got["bucket"].to_numpy()] = got["toxic"].to_numpy()
    clean[got["bucket"].to_numpy()] = got["clean"].to_numpy()
    return toxic, clean


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    rows = training_rows(docs, labels, label, sample)
    toxic, clean = count_tokens(rows)
    odds = log_odds(toxic, clean)
    shipped = spark.sparkContext.broadcast(odds)

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, seen = Scanner(shipped.value), np.zeros(len(BINS) - 1)
        types = [pa.int32(), pa.int64(), pa.list_(pa.float64())]

        def out(*columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["y", "n", "sums"])

        for part in steps(batches, "text"):
            own = [scanner.token_scores(t) for t in texts(part.column("text"))]
            y = part.column("y").to_pylist()
            for s, toxic_one in zip(own, y):
                if not toxic_one:
                    seen += np.histogram(s, BINS)[0]
            yield out(y, [len(s) for s in own], [[x for _, _, x in maximal_segments(s)] for s in own])
        yield out([-1], [0], [seen.tolist()])  # the clean token scores of this task, binned

    # About ``sample`` rows at most, and a row per task.
    got = rows.mapInArrow(best_of, "y int, n long, sums array<double>").toArrow().to_pylist()
    seen = sum((np.array(r["sums"]) for r in got if r["y"] < 0), np.zeros(len(BINS) - 1))
    lam = extreme_rate((BINS[1:] + BINS[:-1]) / 2, seen)
    got = [r for r in got if r["y"] >= 0]
    if not got:
        return Model(odds, lam, 1.0, None)
    y = np.array([r["y"] for r in got])
    n = np.array([max(r["n"], 1) for r in got])
    best = np.array([max(r["sums"], default=0.0) for r in got])
    background = y == 0
    tail = (n[background] * np.exp(-np.minimum(lam * best[background], 700))).sum()
    k = float(np.clip(background.sum() / tail, 1e-6, 10.0)) if tail > 0 else 1.0
    excess = np.array([sum(lam * x[2] - np.log(k * m) for x in excess_of([(0, 0, v) for v in r["sums"]], m, lam, k))
                       for r, m in zip(got, n)])
    return Model(odds, lam, k, fit_logistic(evidence(best, excess, n, lam, k), y))


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of every row with ``score`` (probability of being
    toxic), n_tokens and ``passages``: the significant segments as (start, end,
    score, e_value), in tokens."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*carry, F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        scanner = Scanner(m.odds)
        for part in steps(batches, "_text"):
            own = [scanner.token_scores(t) for t in texts(part.column("_text"))]
            n = np.array([max(len(s), 1) for s in own])
            found = [maximal_segments(s) for s in own]
            best = np.array([max((x for _, _, x in f), default=0.0) for f in found])
            rated = [excess_of(f, c, m.lam, m.k) for f, c in zip(found, n)]
            excess = np.array([sum(m.lam * r[2] - np.log(m.k * c) for r in f) for f, c in zip(rated, n)])
            p = np.zeros(len(own)) if m.weights is None else predict_logistic(evidence(best, excess, n, m.lam, m.k), m.weights)
            passages = [[{"start": s, "end": e, "score": x, "e_value": v} for s, e, x, v in f] for f in rated]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in carry] + [pa.array([len(s) for s in own], pa.int64()), pa.array(p, pa.float64()),
                 pa.array(passages, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])))],
                [*carry, "n_tokens", "score", "passages"])

    types = dict(docs.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in carry)
    return kept.mapInArrow(run, f"{schema}, n_tokens long, score double, "
                                "passages array<struct<start:long,end:long,score:double,e_value:double>>")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    model = fit(docs, labels)
    return score(docs, model, tuple(docs.columns)).where("score < 0.5").select(*docs.columns)
