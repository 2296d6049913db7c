"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Method. Components are quantised to floor(64 x); the impact of a posting is the
magnitude of its component. A block of vectors is indexed by impact level: the
segments of a level hold, per dimension, the rows whose component has an
impact between two thresholds. The segments are processed level by level, by
descending impact, for a batch of queries at a time. After a level a row's score
is known up to the threshold times the sum of the query's magnitudes, which
bounds all postings left. The scan of a query stops only when that bound proves
all but a few rows out, and the possible members are then scored exactly.

Scale. Queries and vectors are dealt into blocks of bounded size by a hash, and
every pair of a query block and a vector block is one task group (a stated query
set against all rows, in blocks); each returns its k best per query, which a
window per query merges.

Defined cases: vectors that are null or hold null or non-finite components take
no part; of vectors of different length the shorter is filled with zeros; a
query's own row is no candidate, another row with the same id is; equal scores
go to the smaller vec_id; components so large that a score may not fit 64 bits fail the
query; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from railpulse.llm.common import materialise

K = 20
QUERY_EVERY = 20
FACTOR = 64
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192
QUERY_STEP = 128  # queries whose scores are held at a time
FIRST_LEVEL = 8  # the first threshold's share of the largest impact


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    at = 0
    for chunk in column.chunks:
        sizes = np.diff(chunk.offsets.to_numpy())
        rows = np.repeat(np.arange(len(sizes)), sizes)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[at + rows, places] = chunk.flatten().to_numpy(zero_copy_only=False)
        at += len(sizes)
    return out


class ImpactIndex:
    """Posting segments of a block of vectors, by impact level."""

    def __init__(self, vectors: np.ndarray, largest_query: int):
        impact = np.abs(vectors)
        most = int(impact.max(initial=0))
        # Whole numbers: exact in floating point below its precision. Beyond it the bounds
        # allow for rounding; scores are exact in any case.
        largest = vectors.shape[1] * most * max(largest_query, 1)
        if largest >= 1 << 63:
            raise OverflowError("inner products beyond 64 bits")
        self.rounding = 0.0 if largest < 1 << 53 else 4.0 * largest * (vectors.shape[1] + 2) * 2.0 ** -53
        self.whole = vectors
        self.vectors = vectors.astype(np.float32 if largest < 1 << 24 else np.float64)
        self.levels: list[tuple[int, np.ndarray]] = []  # threshold, components above it and not above the last one
        above, threshold = most + 1, most // FIRST_LEVEL
        while True:
            segment = np.where((impact > threshold) & (impact < above), self.vectors, 0)
            self.levels.append((threshold, np.ascontiguousarray(segment.T)))
            if threshold == 0:
                break
            above, threshold = threshold + 1, threshold // 2

    def possible(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query the rows that can be among the k best: all but those
        proven out."""
        n = len(self.vectors)
        out = [np.arange(n)] * len(queries)
        if n <= 4 * k:
            return out
        few = max(4 * k, n // 8)
        queries = queries.astype(self.vectors.dtype)
        mass = np.abs(queries).sum(axis=1)
        score, active = np.zeros((len(queries), n), dtype=self.vectors.dtype), np.arange(len(queries))
        for threshold, segment in self.levels:
            score += queries[active] @ segment
            kth = np.partition(score, n - k, axis=1)[:, n - k]
            # A row's score is within threshold * mass of what it has.
            within = score >= (kth - 2 * threshold * mass[active] - self.rounding)[:, None]
            done = (within.sum(axis=1) <= few) | (threshold == 0)
            for i in np.flatnonzero(done):
                out[active[i]] = np.flatnonzero(within[i])
            score, active = score[~done], active[~done]
            if not len(active):
                break
        return out


def best(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(query index, vec_id, score) of each query's k best rows."""
    index = ImpactIndex(vectors, int(np.abs(queries).max(initial=0)))
    out_q, out_id, out_score = [], [], []
    for start in range(0, len(queries), QUERY_STEP):
        batch = queries[start:start + QUERY_STEP]
        for i, members in enumerate(index.possible(batch, k + 1), start):  # its own row may be among them
            members = members[rows[members] != query_rows[i]]
            score = index.whole[members] @ queries[i]
            at = np.lexsort((ids[members], -score))[:k]
            out_q.append(np.full(len(at), i))
            out_id.append(ids[members][at])
            out_score.append(score[at])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score)


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, factor: int = FACTOR,
          query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose vec_id is divisible by
    ``every``."""
    v = F.col("embedding")
    sound = F.coalesce(F.forall(v, lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False))), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(factor * x.cast("double")).cast("long")).alias("q"), F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows, "topk_rows")
    asked = rows.where(F.col("vec_id") % every == 0)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    n_queries = asked.count()
    vector_blocks, query_blocks = max(1, -(-n // vector_block)), max(1, -(-n_queries // query_block))
    width = max(width or 0, 1)

    def block(blocks: int):
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def each(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = asked.select("vec_id", "row", "q", block(query_blocks).alias("qb"), each(vector_blocks).alias("vb"))
    # Columns of their own: both sides come from one table, and a column that they share
    # would be pruned on one side.
    right = rows.select(F.col("vec_id").alias("c_id"), F.col("row").alias("c_row"), F.col("q").alias("c_q"),
                        block(vector_blocks).alias("vb"), each(query_blocks).alias("qb"))

    def run(queries: pa.Table, block_rows: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "vec_id", "score"]
        if not queries.num_rows or not block_rows.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        ids = queries["vec_id"].to_numpy()
        own = queries["row"].to_numpy()
        at, found, score = best(matrix(queries["q"], width), own, matrix(block_rows["c_q"], width),
                                block_rows["c_row"].to_numpy(), block_rows["c_id"].to_numpy(), k)
        return pa.table(dict(zip(names, (own[at], ids[at], found, score))))

    cells = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(
        run, "query_row long, query_id long, vec_id long, score long")
    ranked = cells.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
