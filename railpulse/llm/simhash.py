"""SimHash near-duplicates: pigeonhole blocks, then the exact bit distance.

Method. A fingerprint has a bit set where over half of the document's shingle
hashes (repeats included) have it. 64 bits are split into ``distance + 2``
blocks; two fingerprints at most ``distance`` bits apart agree on at least two
blocks, so they meet under some pair of blocks (with one agreeing block only,
16-bit keys would pair up unrelated documents of a large corpus). Members of a
block are compared exactly and linked; components of the links are the groups.

Scale. Texts are read once; everything after works on distinct fingerprints,
so copies collapse before any join. A block key that more than ``CELL``
fingerprints share is dealt into cells of about ``CELL``: every pair of cells
is compared in a task of its own, so no key ends in one task and no pair is
lost. A cell returns the spanning forest of its links, not all pairs.

Defined cases: a null or empty text has the fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; repeated rows get
a row each; an empty table gives an empty result; extra columns are ignored. A
component whose documents all lack an id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import checkpointed, materialise, steps, texts
from railpulse.llm.components import connected_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
CELL = 4096


def shingle_hashes(text: str, width: int = SHINGLE) -> list[int]:
    words = text.encode().lower().split()  # bytes: ASCII case and white space only
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())]


def fingerprints_of(batch_texts: list[str], width: int = SHINGLE) -> np.ndarray:
    """Signed 64-bit fingerprints."""
    hashes: list[int] = []
    counts = np.zeros(len(batch_texts), dtype=np.int64)
    for i, t in enumerate(batch_texts):
        own = shingle_hashes(t, width)
        counts[i] = len(own)
        hashes += own
    out = np.zeros((len(batch_texts), 8), dtype=np.uint8)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = (np.cumsum(counts) - counts)[full]
        votes = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * votes > counts[full, None], axis=1)
    return out.view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp): mark identifies the text, fp is the signed fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            fp = pa.array(fingerprints_of(texts(part.column("text")), width), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), fp], ["doc_id", "mark", "fp"])

    narrow = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return narrow.mapInArrow(run, "doc_id long, mark long, fp long")


def block_masks(distance: int = DISTANCE) -> list[int]:
    """Signed masks of every pair of the ``distance + 2`` blocks."""
    cuts = np.linspace(0, 64, distance + 3).round().astype(int).tolist()
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if (m := x | y) >> 63 else m for x, y in combinations(blocks, 2)]


def close_forest(fp: np.ndarray, side: np.ndarray, cross: bool, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the close pairs of one cell; ``cross``: only pairs
    from different sides."""
    root = np.arange(len(fp))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out, bits = [], fp.view(np.uint64)  # bits of signed numbers would be counted without the sign
    step = max(1, (1 << 20) // max(1, len(fp)))
    for a in range(0, len(fp), step):
        near = np.bitwise_count(bits[a:a + step, None] ^ bits[None, a:]) <= distance
        if cross:
            near &= side[a:a + step, None] != side[None, a:]
        for i, j in zip(*np.nonzero(np.triu(near, 1))):
            x, y = find(a + i), find(a + j)
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(fp[a + i]), int(fp[a + j])))
    return out


def close_links(prints: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``prints`` (fp) that
    connect exactly the pairs at most ``distance`` bits apart."""
    masks = block_masks(distance)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.block", "k.key")
    crowded = checkpointed(keyed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell))
    cells = F.coalesce(F.ceil(F.col("n") / cell), F.lit(1)).cast("int")
    dealt = (keyed.join(crowded, ["block", "key"], "left")
             .select("fp", "block", "key", cells.alias("cells"), F.pmod(F.xxhash64("fp"), cells).cast("int").alias("side"))
             .select("fp", "block", "key", "side", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other"))
             .select("fp", "block", "key", "side", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b")))
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["block", "key", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            if batch is not None:
                got = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ["fp", "side", *group]}
                rest = got if rest is None else {c: np.concatenate((rest[c], got[c])) for c in got}
            if rest is None:
                return
            size = len(rest["fp"])
            new = np.zeros(size, dtype=bool)
            new[:1] = True
            for c in group:
                new[1:] |= rest[c][1:] != rest[c][:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], size)
            whole = len(starts) if batch is None else len(starts) - 1  # the last group may go on
            links = []
            for g in np.flatnonzero(ends[:whole] - starts[:whole] > 1):
                s, e = starts[g], ends[g]
                links += close_forest(rest["fp"][s:e], rest["side"][s:e], rest["a"][s] != rest["b"][s], distance)
            if links:
                u, v = zip(*links)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
            rest = {c: x[starts[-1]:] for c, x in rest.items()}

    return (dealt.repartition(n, *group).sortWithinPartitions(*group)
            .select("fp", "side", *group).mapInArrow(run, "u long, v long"))


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for b in batches:
        if b.num_rows:
            yield b
    yield None


def near_duplicates(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """One row per document: doc_id, mark, fp, ``class`` (the smallest signed
    fingerprint of its component) and component_id (its smallest doc_id)."""
    rows = materialise(fingerprints(docs, width), "simhash_rows")
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash_prints")
    roots = connected_components(close_links(prints.select("fp"), distance, cell))
    of = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("class"))
    of = materialise(of, "simhash_classes")
    least = materialise(of.groupBy("class").agg(F.min("least").alias("component_id")), "simhash_least")
    of = materialise(of.join(least, "class").select("fp", "class", "component_id"), "simhash_of")
    return rows.join(of, "fp").select("doc_id", "mark", "fp", "class", "component_id")


def keep_one_of_each(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` without near-duplicates: of each component the document with
    the smallest id stays (of equal ids, and where ids are null, the one with
    the smallest text mark)."""
    rows = near_duplicates(docs, width, distance)
    first = rows.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("k"))
    # Plain equal keys on both sides of the join and of the last step, so that texts
    # are dealt out once.
    keys = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("mark").alias("_mark")]
    first = materialise(first.select("k.doc_id", "k.mark").select(*keys), "simhash_first")
    kept = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(0)), "_none": F.col("doc_id").isNull(), "_mark": F.xxhash64("text")})
    names = ["_id", "_none", "_mark"]
    return kept.join(first, names, "left_semi").dropDuplicates(names).select(*docs.columns)
