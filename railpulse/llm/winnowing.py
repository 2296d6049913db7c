"""Document fingerprints by winnowing.

Method. Every run of ``K`` characters gets a rolling hash; of every window of
``WINDOW`` consecutive hashes the minimum is selected, the rightmost of equal
ones, and its position kept. Two texts that share ``K + WINDOW - 1`` characters
share a selected hash at the matching positions. The likeness of two
fingerprints is the share of their distinct hashes that both have.

Scale. Fingerprints are a projection over the texts, in vectorised steps of
bounded size. Comparing each document with its successor in id order moves every
text once: rows are range-partitioned by id at boundaries taken from the ids
alone, and only the first row of each partition is sent to two partitions.

Defined cases: a null text is empty; an empty text has no hashes, and two such
fingerprints have likeness 1, with any other 0; a text shorter than ``K`` has
one hash of the whole text; documents of equal id follow each other in order
of their text; a null id comes first; a single document follows itself; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import steps

K = 16
WINDOW = 16
BASE = 0x9E3779B97F4A7C15
STEP_CHARS = 1 << 20


@dataclass
class Prints:
    """Selected hashes of a list of texts, one after another."""
    hashes: np.ndarray  # uint32
    positions: np.ndarray  # in characters, within the text
    owner: np.ndarray  # index of the text


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams: a polynomial over 2**64 built by joining
    runs of doubling length, then mixed."""
    out, have, power = None, 0, 1
    run, size, factor = codes.astype(np.uint64) + np.uint64(1), 1, BASE
    while True:
        if k & size:
            if out is None:
                out, have = run, size
            else:  # append this run after what is there
                n = len(codes) - have - size + 1
                out = out[:n] * np.uint64(factor) + run[have:have + n]
                have += size
        if size * 2 > k:
            break
        n = len(codes) - 2 * size + 1
        run = run[:n] * np.uint64(factor) + run[size:size + n]
        size, factor = size * 2, factor * factor % (1 << 64)
    out = out ^ (out >> np.uint64(29))
    return ((out * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)


def rightmost_minima(hashes: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the window minima, the rightmost of equal ones, of 32-bit
    hashes that belong to owners one after another (``counts`` each, none
    empty), and the owner of each; fewer hashes than a window are one window."""
    owner, first = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
    # Hash above, reversed place below: the minimum of a window is its smallest
    # hash, the rightmost of equal ones.
    packed = (hashes.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    least, have = packed, 1
    while have < window:
        shift = min(have, window - have)
        least = np.minimum(least[:len(least) - shift], least[shift:]) if len(least) > shift else least[:0]
        have += shift
    of = owner[:len(least)]
    inside = np.arange(len(least)) - first[of] <= counts[of] - window
    chosen, of = least[inside], of[inside]
    few = np.flatnonzero(counts < window)
    if len(few):
        extra = np.array([packed[first[i]:first[i] + counts[i]].min() for i in few], dtype=np.uint64)
        chosen, of = np.concatenate((chosen, extra)), np.concatenate((of, few))
        at = np.argsort(of, kind="stable")
        chosen, of = chosen[at], of[at]
    if len(chosen):
        new = np.concatenate(([True], chosen[1:] != chosen[:-1]))
        chosen, of = chosen[new], of[new]
    return (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64), of


def winnow(batch: list[str], k: int = K, window: int = WINDOW) -> Prints:
    lengths = np.array([len(t) for t in batch], dtype=np.int64)
    hashes, positions, owner = [], [], []
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    if len(short):
        hashes.append(np.array([xxhash.xxh32_intdigest(batch[i].encode(), 0) for i in short], dtype=np.uint32))
        positions.append(np.zeros(len(short), dtype=np.int64))
        owner.append(short)
    long = np.flatnonzero(lengths >= k)
    if len(long):
        codes = np.frombuffer("".join([batch[i] for i in long]).encode("utf-32-le"), dtype=np.uint32)
        grams = gram_hashes(codes, k)
        sizes = lengths[long]
        starts = np.cumsum(sizes) - sizes
        # Keep the grams inside one text; a text of n characters has n - k + 1.
        text = np.repeat(np.arange(len(long)), sizes)[:len(grams)]
        inside = np.arange(len(grams)) - starts[text] <= sizes[text] - k
        grams, text = grams[inside], text[inside]
        counts = sizes - k + 1
        first = np.cumsum(counts) - counts
        chosen, chosen_text = rightmost_minima(grams, counts, window)
        hashes.append(grams[chosen])
        positions.append(chosen - first[chosen_text])
        owner.append(long[chosen_text])
    if not hashes:
        return Prints(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    h, p, o = np.concatenate(hashes), np.concatenate(positions), np.concatenate(owner)
    at = np.argsort(o, kind="stable")
    return Prints(h[at], p[at], o[at])


def distinct_keys(prints: Prints) -> np.ndarray:
    """Sorted distinct (owner, hash) keys."""
    return np.unique((prints.owner.astype(np.uint64) << np.uint64(32)) | prints.hashes)


def likeness(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Jaccard likeness per owner of two sets of ``distinct_keys``."""
    owner = lambda keys: (keys >> np.uint64(32)).astype(np.int64)
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    both = a[b[at] == a] if len(b) else a[:0]
    common = np.bincount(owner(both), minlength=n)
    union = np.bincount(owner(a), minlength=n) + np.bincount(owner(b), minlength=n) - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def digests(prints: Prints, n: int) -> list[str]:
    """128-bit digest of each text's hashes and positions."""
    ends = np.searchsorted(prints.owner, np.arange(n), side="right")
    starts = np.concatenate(([0], ends[:-1]))
    pairs = np.stack([prints.hashes.astype(np.int64), prints.positions], axis=1)
    return [xxhash.xxh3_128_hexdigest(pairs[a:b].tobytes()) for a, b in zip(starts, ends)]


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hashes array<long>, positions array<long>: the selected hashes of
    every text in order of position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text", STEP_CHARS):
            got = winnow([t or "" for t in part.column("text").to_pylist()], k, window)
            offsets = pa.array(np.concatenate(([0], np.searchsorted(got.owner, np.arange(part.num_rows), side="right"))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(got.hashes.astype(np.int64))),
                 pa.ListArray.from_arrays(offsets, pa.array(got.positions))], ["doc_id", "hashes", "positions"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the start of the next text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_step(batch: list[str], k: int, window: int) -> tuple:
    """The columns of all but the last text of ``batch``, which only follows."""
    own, n = batch[:-1], len(batch) - 1
    changed = [edited(a, b) for a, b in zip(own, batch[1:])]
    prints, new = winnow(batch, k, window), winnow(changed, k, window)
    keys, new_keys = distinct_keys(prints), distinct_keys(new)
    mine = keys[keys < np.uint64(n) << np.uint64(32)]
    shift = np.uint64(1) << np.uint64(32)
    following = keys[keys >= shift] - shift
    return ([len(t) for t in own], [hashlib.sha256(t.encode()).hexdigest() for t in changed], digests(prints, n + 1)[:n],
            digests(new, n), likeness(mine, new_keys, n), likeness(mine, following, n))


def compare_with_next(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document with its edited text and its successor in id order:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), dtype=np.int64)  # fewer than partitions

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy().astype(np.int64), side="left")
        return pd.Series(out)

    placed = rows.select("doc_id", "text", F.xxhash64("text").alias("mark"), place("doc_id").alias("part"))
    heads = placed.groupBy("part").agg(F.min(F.struct("doc_id", "mark")).alias("head")).collect()  # a row per partition
    first = {r["part"]: (r["head"]["doc_id"], r["head"]["mark"]) for r in heads}
    order = sorted(first)
    # The first row of a partition also follows the last row of the one before;
    # the very first one follows the very last.
    @F.pandas_udf("int")
    def leads_into(part: pd.Series, ids: pd.Series, marks: pd.Series) -> pd.Series:
        out = [before.get((p, None if pd.isna(i) else int(i), m), -1) for p, i, m in zip(part, ids, marks)]
        return pd.Series(out, dtype="int32")

    before = {(p, *first[p]): order[i - 1] for i, p in enumerate(order)}
    lead = leads_into("part", "doc_id", "mark")
    sent = placed.withColumn("lead", lead).select("doc_id", "text", "mark", F.explode(F.when(
        F.col("lead") >= 0, F.array(F.struct(F.col("part").alias("to"), F.lit(0).alias("follows")),
                                    F.struct(F.col("lead").alias("to"), F.lit(1).alias("follows"))))
        .otherwise(F.array(F.struct(F.col("part").alias("to"), F.lit(0).alias("follows"))))).alias("p"))
    sent = sent.select("doc_id", "text", "mark", "p.to", "p.follows")
    dealt = sent.repartitionById(parts, "to").sortWithinPartitions("to", "follows", "doc_id", "mark", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # (doc_id, text) waiting for their successor
        size = 0

        def flush(keep: bool):
            nonlocal held, size
            ids, batch = [h[0] for h in held], [h[1] for h in held]
            if len(batch) > 1:
                columns = compare_step(batch, k, window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[:-1], pa.int64()), pa.array(columns[0], pa.int64())] + [pa.array(c, pa.string()) for c in columns[1:4]]
                    + [pa.array(c, pa.float64()) for c in columns[4:]],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            held, size = (held[-1:], len(batch[-1])) if keep else ([], 0)

        group, closed = None, False
        for b in steps(batches, "text"):
            for to, follows, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("to", "follows", "doc_id", "text"))):
                if to != group:
                    held, size, group, closed = [], 0, to, False
                if closed:  # further copies of the row that follows
                    continue
                held.append((doc_id, text))
                size += len(text)
                if follows:
                    yield from flush(False)
                    closed = True
                elif size >= STEP_CHARS and len(held) > 1:
                    yield from flush(True)

    return dealt.select("doc_id", "text", "to", "follows").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
