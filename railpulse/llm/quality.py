"""Quality classifier with hierarchical empirical Bayes over sites.

Method. A logistic classifier over text statistics gives each document's own
evidence. Sites are two levels, host and path below it. The posterior of a host
is the mean of its documents' labels (training fold) or classifier
probabilities, shrunk to the global rate by a prior whose strength is
estimated from the spread between hosts (method of moments); a path shrinks to
its host in the same way. A document leaves its own part out of both sums. Its
final log-odds are its own evidence plus its path's log-odds minus the global
ones, as for text and site that are independent given the quality.

Scale. One pass computes the statistics; the rest works on narrow rows: two
grouped sums with map-side combining (a site with a third of all rows is one
small row per task) and joins with one row per site. The classifier is fitted
on at most about ``SAMPLE`` labelled rows, a parameter.

Defined cases: null and empty texts have all-zero statistics; a null host or
path is a site of its own; without labelled training rows the score is 0.5
before and after the site step; repeated rows get a row each; extra columns are
ignored.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from railpulse.llm.common import fold, materialise, steps, texts
from railpulse.llm.logistic import fit_logistic, predict_logistic

SAMPLE = 50_000
FOLDS = 5
UPPER, LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
DIGITS, MARKS = string.digits.encode(), string.punctuation.encode()
SPACES = b" \t\n\r\x0b\x0c"


def statistics(text: str) -> list[float]:
    b = text.encode()
    words = b.split()
    if not words:
        return [0.0] * 12
    n, w = len(b), len(words)
    share = lambda chars: (n - len(b.translate(None, chars))) / n
    counts = Counter(words)
    lines = [x for x in b.split(b"\n") if x.strip()]
    ends = sum(x[-1:] in b".,;:!?" for x in words) / w
    return [np.log1p(w), len(counts) / w, max(counts.values()) / w, len(set(zip(words, words[1:]))) / max(w - 1, 1),
            share(UPPER), share(DIGITS), share(MARKS), share(SPACES), (n - w) / w, ends,
            len(set(lines)) / len(lines), np.log1p(n / len(lines))]


def host_of(source: Column) -> Column:
    """The part of a source before its first slash."""
    return F.substring_index(source, "/", 1)


def document_statistics(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            x = [statistics(t) for t in texts(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("host"), part.column("path"),
                                              pa.array(x, pa.list_(pa.float64()))], ["doc_id", "host", "path", "x"])

    narrow = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    return narrow.mapInArrow(run, "doc_id long, host string, path string, x array<double>")


def _strength(groups: DataFrame, rate: float) -> float:
    """Pseudo-count of the Beta prior from the spread of group means (columns
    s, n), by the method of moments; between 1 and 10,000."""
    r = groups.agg(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - rate, 2)).alias("between"),
                   F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.pow(F.col("n").cast("double"), 2)).alias("n2")).first()
    if not r["k"] or r["k"] < 2:
        return 10.0
    noise = rate * (1 - rate)
    spread = (r["between"] - (r["k"] - 1) * noise) / max(r["n"] - r["n2"] / r["n"], 1e-9)
    return float(np.clip(noise / spread - 1 if spread > 0 else 10_000, 1, 10_000))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", host: Column | None = None,
             path: Column | None = None, sample: int = SAMPLE, folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, host, path, doc_score (its text
    alone), host_rate and path_rate (posterior means without the document),
    score."""
    host = host_of(F.col("source")) if host is None else host
    path = F.concat_ws("/", F.col("source"), F.col("lang")) if path is None else path
    rows = materialise(document_statistics(docs, host, path), "quality_statistics")
    known = (labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
             .where(fold("doc_id", folds) != 0).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
             .where("y = z").select("doc_id", "y"))
    rows = materialise(rows.join(known, "doc_id", "left"), "quality_rows")
    n = rows.where("y is not null").count()
    chosen = rows.where("y is not null").where(
        (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)) < min(1.0, sample / max(n, 1)))
    got = chosen.select("x", "y").toArrow()  # about ``sample`` rows at most
    if got.num_rows:
        x = np.array(got["x"].to_pylist())
        weights = fit_logistic(x, got["y"].to_numpy().astype(float))
    else:
        weights = np.zeros(13)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array(b.column("x").to_pylist())
                p = np.clip(predict_logistic(x, weights), 1e-4, 1 - 1e-4)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("host"), b.column("path"), b.column("y"),
                                                  pa.array(p)], ["doc_id", "host", "path", "y", "p"])

    scored = rows.select("doc_id", "host", "path", "y", "x").mapInArrow(
        run, "doc_id long, host string, path string, y int, p double")
    scored = materialise(scored.withColumn("part", F.coalesce(F.col("y").cast("double"), F.col("p"))), "quality_scored")
    paths = materialise(scored.groupBy("host", "path").agg(F.sum("part").alias("s"), F.count(F.lit(1)).alias("n")), "quality_paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    rate = float(np.clip((whole["s"] or 0) / (whole["n"] or 1), 1e-3, 1 - 1e-3)) if whole["n"] else 0.5
    of_host, of_path = _strength(hosts, rate), _strength(paths, rate)
    sites = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select(
        F.col("p.host").alias("s_host"), F.col("p.path").alias("s_path"), F.col("p.s").alias("path_s"),
        F.col("p.n").alias("path_n"), F.col("h.s").alias("host_s"), F.col("h.n").alias("host_n"))
    sites = materialise(sites, "quality_sites")
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    host_rate = (F.col("host_s") - F.col("part") + of_host * rate) / (F.col("host_n") - 1 + of_host)
    path_rate = (F.col("path_s") - F.col("part") + of_path * F.col("host_rate")) / (F.col("path_n") - 1 + of_path)
    logit = lambda c: F.log(c / (1 - c))
    bounded = lambda c: F.least(F.greatest(c, F.lit(1e-4)), F.lit(1 - 1e-4))
    out = joined.withColumn("host_rate", bounded(host_rate)).withColumn("path_rate", bounded(path_rate))
    odds = logit(F.col("p")) + logit(F.col("path_rate")) - F.lit(float(np.log(rate / (1 - rate))))
    return out.select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "host", "path", F.col("p").alias("doc_score"),
                      "host_rate", "path_rate", (1 / (1 + F.exp(-odds))).alias("score"))
