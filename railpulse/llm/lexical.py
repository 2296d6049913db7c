"""Ranked lexical search: exact top documents of every item by a dual-tree search.

Method. A document is a vector of term impacts, an item one of term weights; a score is
their inner product, in whole numbers. A block of documents and a block of items each get
a hierarchy: rows are split again and again by the term that divides a part most evenly for
its weight, and neighbours in that order share a node, level by level. A node holds the
coordinate maxima of its rows. The inner product of two nodes' maxima bounds every score
between their rows, so where it is below the weakest kth score of the node's items, all
pairs are pruned at once. Both sides descend together, the document node with the highest
bounds first, and scores are exact where two leaves meet. Equal scores are not pruned, as
the smaller id may come later.

Scale. Two passes over the texts' terms: document vectors over the items' terms only are written
once, then statistics and the search read those. A task searches its documents block by block
with the kth scores it has reached and returns k rows per item; a window per item merges the tasks'
rows, of which Spark keeps k per task before the shuffle. Items go in blocks of at most
``ITEM_TERMS`` terms (or one item), so what is shipped to tasks is bounded and does not grow
with the documents.

Defined cases: null and empty texts have no terms, such documents do not count and are never
found, such items find nothing; rows that repeat are ranked each, and repeated item rows have
results each; a null doc_id comes after all others of the same score; a very long text is
counted in parts; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from railpulse.llm.common import materialise, ragged_ranges, steps, texts
from railpulse.operators.ordering import global_running_sum

K = 20
ITEM_TERMS = 1 << 18  # distinct terms of the items that are searched for at a time
BLOCK_ROWS = 8192  # documents in one hierarchy
BLOCK_TERMS = 1 << 21  # and their terms
PART = 1 << 20  # bytes whose terms are counted at a time
FAN = 4  # nodes below a node
DOCUMENT_LEAF = 4
ITEM_LEAF = 1
DENSE = 1 << 23
# Terms: runs of digits, letters and everything beyond ASCII, A-Z lower-cased.
TABLE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(text: str) -> tuple[int, Counter]:
    """(number of terms, how often each occurs)."""
    data, at, n, counts = text.encode().translate(TABLE), 0, 0, Counter()
    while at < len(data):
        cut = data.find(b" ", at + PART)
        terms = data[at:cut if cut >= 0 else len(data)].split()
        n += len(terms)
        counts.update(terms)
        at = cut if cut >= 0 else len(data)
    return n, counts


class Hierarchy:
    """Rows of sparse vectors in an order that puts like ones together, and levels of
    nodes over neighbours with their coordinate maxima. ``bounds[0]`` are the
    leaves' rows, the last level is one node."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray, leaf: int):
        self.width = len(weights)
        starts = np.cumsum(sizes) - sizes
        self.order = self._order(sizes, terms, weights, leaf)
        entries = ragged_ranges(starts[self.order], sizes[self.order])
        self.sizes, self.terms, self.values = sizes[self.order], terms[entries], values[entries]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.first_row: list[np.ndarray] = []  # of each node, with the end
        self.maxima: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # start of each node, terms, largest values
        n, per, t, v = len(sizes), leaf, self.terms, self.values
        node = np.repeat(np.arange(n) // leaf, self.sizes)
        while True:
            count = -(-n // per)
            key = node * self.width + t
            at = np.argsort(key, kind="stable")
            new = np.flatnonzero(np.diff(key[at], prepend=-1))
            t, node = t[at][new], node[at][new]
            v = np.maximum.reduceat(v[at], new) if len(new) else v
            self.first_row.append(np.minimum(np.arange(count + 1) * per, n))
            self.maxima.append((np.searchsorted(node, np.arange(count + 1)), t, v))
            if count == 1:
                break
            node, per = node // FAN, per * FAN

    def _order(self, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, leaf: int) -> np.ndarray:
        n, width = len(sizes), self.width
        part, row = np.zeros(n, dtype=np.int64), np.repeat(np.arange(n), sizes)
        for _ in range(max(0, math.ceil(math.log2(max(1, n / leaf))))):
            of, size = np.unique(part, return_inverse=True, return_counts=True)[1:]
            key = of[row] * width + terms
            if len(size) * width <= DENSE:
                count = np.bincount(key, minlength=len(size) * width)
                key = np.flatnonzero(count)
                count = count[key]
            else:
                key, count = np.unique(key, return_counts=True)
            owner, term = key // width, key % width
            gain = weights[term] * count * (size[owner] - count)
            best = np.lexsort((term, -gain, owner))
            best = best[np.flatnonzero(np.diff(owner[best], prepend=-1))]
            chosen = np.full(len(size), -1)
            chosen[owner[best]] = np.where(gain[best] > 0, term[best], -1)
            has = np.zeros(n, dtype=bool)
            has[row[terms == chosen[of[row]]]] = True
            part = 2 * of + ~has
        return np.argsort(part, kind="stable")

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FAN, min((node + 1) * FAN, len(self.first_row[level - 1]) - 1))


class Best:
    """The ``k`` best documents of every item so far, best first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.zeros((n, k), dtype=np.int64)
        self.id = np.zeros((n, k), dtype=np.int64)
        self.unnamed = np.ones((n, k), dtype=bool)

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        better = ((scores >= self.score[items, -1][:, None]) & (scores > 0)).any(axis=1)
        items, scores = items[better], scores[better]
        if not len(items):
            return
        score = np.concatenate((self.score[items], scores), axis=1)
        own_id = np.concatenate((self.id[items], np.broadcast_to(ids, scores.shape)), axis=1)
        own_unnamed = np.concatenate((self.unnamed[items], np.broadcast_to(unnamed, scores.shape)), axis=1)
        at = np.lexsort((own_id, own_unnamed, -score), axis=1)[:, :self.k]
        rows = np.arange(len(items))[:, None]
        self.score[items], self.id[items], self.unnamed[items] = score[rows, at], own_id[rows, at], own_unnamed[rows, at]


class DualTree:
    """Searches one hierarchy of documents after the other for all items."""

    def __init__(self, items: Hierarchy, k: int):
        self.items, self.best = items, Best(len(items.sizes), k)
        self.impact = np.zeros(items.width, dtype=np.int64)  # of the document node at hand, by term
        self.place = np.zeros(items.width, dtype=np.int64)  # row of a term in the leaf at hand
        self.scored = 0  # pairs scored exactly

    def search(self, docs: Hierarchy, ids: np.ndarray, unnamed: np.ndarray) -> None:
        self.docs, self.ids, self.unnamed = docs, ids[docs.order], unnamed[docs.order]
        top = len(self.items.maxima) - 1
        self._visit(len(docs.maxima) - 1, 0, top, np.zeros(1, dtype=np.int64))

    def _bounds(self, level: int, node: int, item_level: int, nodes: np.ndarray) -> np.ndarray:
        starts, terms, largest = self.docs.maxima[level]
        a, b = starts[node], starts[node + 1]
        self.impact[terms[a:b]] = largest[a:b]
        starts, item_terms, weights = self.items.maxima[item_level]
        out = self._sums(starts[nodes], starts[nodes + 1] - starts[nodes], lambda at: self.impact[item_terms[at]] * weights[at])
        self.impact[terms[a:b]] = 0
        return out

    @staticmethod
    def _sums(starts: np.ndarray, sizes: np.ndarray, of) -> np.ndarray:
        value = of(ragged_ranges(starts, sizes))
        total = np.concatenate((np.zeros((1, *value.shape[1:]), np.int64), np.cumsum(value, axis=0)))
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def _open(self, bounds: np.ndarray, item_level: int, nodes: np.ndarray) -> np.ndarray:
        """Whether a pair of nodes may hold one of its items' k best documents."""
        first = self.items.first_row[item_level]
        weakest = np.minimum.reduceat(self.best.score[:, -1], first[:-1])[nodes]
        return (bounds > 0) & (bounds >= weakest)

    def _visit(self, level: int, node: int, item_level: int, nodes: np.ndarray) -> None:
        if level == 0:
            while True:
                nodes = nodes[self._open(self._bounds(0, node, item_level, nodes), item_level, nodes)]
                if not item_level or not len(nodes):
                    break
                nodes, item_level = self._below(item_level, nodes), item_level - 1
            if len(nodes):
                self._score(node, nodes)
            return
        if item_level:
            nodes, item_level = self._below(item_level, nodes), item_level - 1
        below = self.docs.children(level, node)
        bounds = np.stack([self._bounds(level - 1, c, item_level, nodes) for c in below.tolist()])
        for i in np.argsort(-bounds.sum(axis=1), kind="stable").tolist():
            left = self._open(bounds[i], item_level, nodes)
            if left.any():
                self._visit(level - 1, int(below[i]), item_level, nodes[left])

    def _below(self, item_level: int, nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.items.children(item_level, i) for i in nodes.tolist()])

    def _score(self, node: int, nodes: np.ndarray) -> None:
        docs, rows = self.docs, self.docs.first_row[0][node:node + 2]
        a, b = docs.starts[rows[0]], docs.starts[rows[1]]
        starts, terms, _ = docs.maxima[0]
        own = terms[starts[node]:starts[node + 1]]
        self.place[own] = np.arange(1, len(own) + 1)
        impacts = np.zeros((len(own) + 1, rows[1] - rows[0]), dtype=np.int64)
        impacts[self.place[docs.terms[a:b]], np.repeat(np.arange(rows[1] - rows[0]), docs.sizes[rows[0]:rows[1]])] = docs.values[a:b]
        first, q = self.items.first_row[0], self.items
        wanted = ragged_ranges(first[nodes], first[nodes + 1] - first[nodes])
        scores = self._sums(q.starts[wanted], q.sizes[wanted], lambda at: q.values[at][:, None] * impacts[self.place[q.terms[at]]])
        self.place[own] = 0
        self.scored += scores.size
        self.best.add(wanted, scores, self.ids[rows[0]:rows[1]], self.unnamed[rows[0]:rows[1]])


class Items:
    """A block of items over their own vocabulary."""

    def __init__(self, ids: list, counts: list[dict[bytes, int]]):
        self.ids = ids
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for own in counts for t in own}))}
        self.sizes = np.array([len(own) for own in counts], dtype=np.int64)
        self.terms = np.array([self.vocabulary[t] for own in counts for t in own], dtype=np.int64)
        self.counts = np.array([n for own in counts for n in own.values()], dtype=np.int64)

    def hierarchy(self, weights: np.ndarray) -> Hierarchy:
        return Hierarchy(self.sizes, self.terms, self.counts * weights[self.terms], weights, ITEM_LEAF)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with terms: its length, and the
    items' terms in it with their numbers."""
    shipped = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for part in steps(batches, "text"):
            kept, n, sizes, terms, tfs = [], [], [], [], []
            for i, text in enumerate(texts(part.column("text"))):
                size, counts = term_counts(text)
                if not size:
                    continue
                own = counts.keys() & known.keys() if len(known) < len(counts) else [t for t in counts if t in known]
                kept.append(i), n.append(size), sizes.append(len(own))
                terms += [known[t] for t in own]
                tfs += [counts[t] for t in own]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS, terms: int = BLOCK_TERMS) -> Iterator[pa.Table]:
    """Documents in blocks of at most that many rows, and terms unless one has more."""
    waiting, n, size = [], 0, 0
    for batch in batches:
        at = 0
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = min(at + rows - n, int(np.searchsorted(ends, before + terms - size, side="right")))
            if stop <= at and n:
                yield pa.Table.from_batches(waiting)
                waiting, n, size = [], 0, 0
                continue
            stop = max(stop, at + 1)
            waiting.append(batch.slice(at, stop - at))
            n, size, at = n + stop - at, size + int(ends[stop - 1] - before), stop
    if n:
        yield pa.Table.from_batches(waiting)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).astype(np.int64)


def impacts(tfs: np.ndarray, sizes: np.ndarray, n: list[int], n_docs: int, total: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m) of every term, m from its document's length."""
    m = np.array([100 - 25 + 25 * own * n_docs // total for own in n], dtype=np.int64)  # whole numbers of any size inside
    return 1_000_000_000 * tfs // (1000 * tfs + 12 * np.repeat(m, sizes))


def search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best documents per item and task."""
    found = materialise(vectors(docs, items), "lexical_vectors")
    n_docs, total = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(items.vocabulary), dtype=np.int64)
    for term, n in df.collect():  # at most the items' vocabulary
        weights[term] = weight(n_docs, n)
    shipped = docs.sparkSession.sparkContext.broadcast((items.ids, items.hierarchy(weights), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hierarchy, weights = shipped.value
        tree = DualTree(hierarchy, k)
        for block in blocks(batches):
            sizes = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in block["terms"].chunks]).astype(np.int64)
            terms, tfs = flat(block["terms"]), flat(block["tfs"])
            values = impacts(tfs, sizes, block["n"].to_pylist(), n_docs, total)
            names = block["doc_id"].combine_chunks()
            tree.search(Hierarchy(sizes, terms, values, weights, DOCUMENT_LEAF), names.fill_null(0).to_numpy(zero_copy_only=False),
                        names.is_null().to_numpy(zero_copy_only=False))
        best = tree.best
        row, place = np.nonzero(best.score > 0)
        item = hierarchy.order[row]
        yield pa.RecordBatch.from_arrays([
            pa.array(item, pa.int64()), pa.array([ids[i] for i in item.tolist()], pa.int64()),
            pa.array(best.id[row, place], mask=best.unnamed[row, place]), pa.array(best.score[row, place])], ["item", "item_id", "doc_id", "score"])

    return found.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, item_terms: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest score above
    0 for every row of ``items`` (item_id, text)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            own = [term_counts(t)[1] for t in texts(part.column("text"))]
            yield pa.RecordBatch.from_arrays([
                part.column("item_id"), pa.array([sorted(c) for c in own], pa.list_(pa.binary())),
                pa.array([[c[t] for t in sorted(c)] for c in own], pa.list_(pa.int64())), pa.array([len(c) for c in own], pa.int64())],
                ["item_id", "terms", "counts", "n"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        counted, "item_id long, terms array<binary>, counts array<long>, n long").where("n > 0")
    rows = global_running_sum(rows, ["item_id", "terms"], weight=F.col("n"), out="upto")
    rows = materialise(rows.select("item_id", "terms", "counts", F.expr(f"(upto - 1) div {item_terms}").alias("block")), "lexical_items")
    found = None
    for block in range((rows.agg(F.max("block")).first()[0] or 0) + 1):
        own = rows.where(F.col("block") == block).orderBy("item_id").select("item_id", "terms", "counts").collect()  # bounded by item_terms
        if not own:
            continue
        part = search_block(docs, Items([r["item_id"] for r in own], [dict(zip(map(bytes, r["terms"]), r["counts"])) for r in own]), k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        part = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
