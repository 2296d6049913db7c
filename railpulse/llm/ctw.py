"""Language-model scores by context-tree weighting over bytes.

Method. A byte is eight binary decisions; the context of a decision is the bits
of the byte so far and up to ``DEPTH`` bytes before it. Every node of the tree
holds a Krichevsky-Trofimov estimator of its decisions in the training texts;
a node's weighted probability is the mean of its own block probability and the
product of its children's. Block probabilities depend on counts only, so the
tree follows from counts of (DEPTH + 1)-grams of bytes, bottom up, and the
probability of a new decision mixes the estimates of all depths along its
context with the weights the counts give. Texts are lower-cased (A-Z), start in
an empty context and end with an end symbol.

Scale. Grams and tokens are counted per task and summed by key over all training
texts. The tree is built in parts: a part holds all contexts that share their
last three bytes; the levels above are sums over the parts. No context is dropped
at any size: the grams of all texts, held out or not, are dealt to the parts, and
each part gives the probabilities of its own grams from its whole nodes and the
few levels above. The probabilities of the ``MODEL_GRAMS`` most frequent grams
are shipped, all others are joined by gram. Scoring is one pass over the texts. The base
model's counts of the ``FREQUENT`` most frequent tokens are shipped, all others are
joined by token.

Defined cases: a null text is empty and consists of its end; without training
texts every decision has probability 1/2; a row with a null id is held out;
repeated rows get a row each; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import fold, materialise, ragged_ranges, steps, texts

DEPTH = 5
TOP = 3  # latest bytes of context that a part of the tree shares
END = 0xFF  # never a byte of UTF-8
MODEL_GRAMS = 800_000  # the head that is shipped; the rest is joined
FREQUENT = 1 << 17
FREQUENT_BYTES = 64
FOLDS = 10
HELD = 1 << 21  # entries that a counting task holds before it hands them on
LEAST_WEIGHT = 1e-6
SMOOTHING = 0.1


def grams_of(batch: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(grams, counts): one gram per byte and end of all texts, one text after
    another. A gram holds the byte in its lowest place, above it the context
    with the latest byte in the highest place."""
    pad = bytes([END]) * depth
    stream = np.frombuffer(pad + b"".join([t + pad for t in batch]), dtype=np.uint8)
    n = len(stream) - depth
    grams = stream[depth:].astype(np.int64)
    for back in range(1, depth + 1):
        grams |= stream[depth - back:depth - back + n].astype(np.int64) << (8 * (depth + 1 - back))
    sizes = np.array([len(t) for t in batch], dtype=np.int64)
    starts = np.cumsum(sizes + depth) - (sizes + depth)
    return grams[ragged_ranges(starts, sizes + 1)], sizes + 1


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums the counts of equal keys."""
    if not len(keys):
        return keys, counts
    at = np.argsort(keys, kind="stable")
    keys, counts = keys[at], counts[at]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def count_grams(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n, total): occurrences in the rows not ``held_out`` and in all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {h: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for h in (False, True)}

        def out(h: bool) -> pa.RecordBatch:
            keys, counts = held[h]
            held[h] = keys[:0], counts[:0]
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts * (not h)), pa.array(counts)], ["gram", "n", "total"])

        for part in steps(batches, "text"):
            which = part.column("held_out").to_pylist()
            lowered = [t.encode().lower() for t in texts(part.column("text"))]
            for h in held:
                grams = np.sort(grams_of([t for t, w in zip(lowered, which) if w == h], depth)[0])
                if not len(grams):
                    continue
                first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
                held[h] = merge(np.concatenate((held[h][0], grams[first])),
                                np.concatenate((held[h][1], np.diff(np.append(first, len(grams))))))
                if len(held[h][0]) > HELD // 2:
                    yield out(h)
        yield from (out(h) for h in held)

    counted = docs.select("text", "held_out").mapInArrow(run, "gram long, n long, total long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def count_tokens(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()),
                                               pa.array(list(held.values()), pa.int64())], ["token", "n"])

        for part in steps(batches, "text"):
            for t in texts(part.column("text")):
                held.update(t.encode().lower().split())
            if len(held) > HELD // 8:
                yield out()
                held.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, carried down."""
    down = np.ones_like(x)
    for i in range(8):
        down = down * (x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(down)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log block probability of the Krichevsky-Trofimov estimator."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def decisions(contexts: np.ndarray, byte: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, zeros, ones) of the binary nodes: a key is context << 8 | bits so
    far with a leading one."""
    keys, ones = [], []
    for bit in range(8):
        keys.append((contexts << 8) | (1 << bit) | (byte >> (8 - bit)))
        ones.append(np.where((byte >> (7 - bit)) & 1, n, 0))
    key, one, total = np.concatenate(keys), np.concatenate(ones), np.tile(n, 8)
    at = np.argsort(key, kind="stable")
    key, one, total = key[at], one[at], total[at]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    one, total = np.add.reduceat(one, first), np.add.reduceat(total, first)
    return key[first], (total - one).astype(np.float64), one.astype(np.float64)


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the node's own estimate, log weighted probability), given the
    summed log weighted probability of the children."""
    own = log_kt(zeros, ones)
    return 1 / (1 + np.exp(np.clip(below - own, -700, 700))), np.logaddexp(own, below) - math.log(2)


def parents(key: np.ndarray) -> np.ndarray:
    """Keys of the same decisions one byte of context shorter."""
    return ((key >> 16) << 8) | (key & 255)


def part_nodes(grams: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, ...]]:
    """Nodes of one or more whole parts of the tree, from sorted grams: per level
    from ``depth`` up to TOP - 1 (key, zeros, ones, weight); level TOP - 1 has, for
    the sum over the parts, the log probability of the children as its weight."""
    rows, below_key, log_p = [], None, None
    for level in range(depth, TOP - 2, -1):
        key, zeros, ones = decisions(grams >> (8 * (depth - level + 1)), grams & 255, n)
        below = None if below_key is None else np.bincount(np.searchsorted(key, parents(below_key)), weights=log_p, minlength=len(key))
        if level == depth:
            weight, log_p = np.ones(len(key)), log_kt(zeros, ones)
        elif level >= TOP:
            weight, log_p = weigh(zeros, ones, below)
        else:
            weight = below
        below_key = key
        rows.append((key, zeros, ones, weight))
    return rows


@dataclass
class Tree:
    """By level: sorted node keys, the log-odds of a one and of the node's own weight."""
    keys: list[np.ndarray]
    ones: list[np.ndarray]
    weights: list[np.ndarray]

    def add(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weight: np.ndarray) -> None:
        self.keys.append(key)
        self.ones.append(np.log((ones + 0.5) / (zeros + 0.5)))
        w = np.clip(weight, LEAST_WEIGHT, 1 - LEAST_WEIGHT)
        self.weights.append(np.log(w / (1 - w)))

    def log10_probability(self, grams: np.ndarray) -> np.ndarray:
        """Of the byte of each gram after its context; sorted grams are faster."""
        depth = len(self.keys) - 1
        context, byte = grams >> 8, grams & 255
        out = np.zeros(len(grams))
        for bit in range(8):
            node, one = (1 << bit) | (byte >> (8 - bit)), ((byte >> (7 - bit)) & 1).astype(bool)
            p, longer = np.full(len(grams), 0.5), np.zeros(len(grams), dtype=bool)
            for level in range(depth, -1, -1):
                keys = self.keys[level]
                if not len(keys):
                    continue
                key = ((context >> (8 * (depth - level))) << 8) | node
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                own = 1 / (1 + np.exp(np.where(one, -1.0, 1.0) * self.ones[level][at]))
                w = np.where(longer, 1 / (1 + np.exp(-self.weights[level][at])), 1.0)
                found = keys[at] == key
                p = np.where(found, w * own + (1 - w) * p, p)
                longer |= found
            out += np.log10(p)
        return out


def in_parts(grams: DataFrame, columns: list[str], run, schema: str, depth: int = DEPTH) -> DataFrame:
    """``run`` on sorted arrays of whole parts of the tree, a bounded number of
    grams at a time unless a single part has more."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in columns]
        for b in batches:
            held = [np.concatenate((h, b.column(c).to_numpy())) for h, c in zip(held, columns)]
            parts = held[0] >> (8 * (depth - TOP + 1))
            cut = int(np.searchsorted(parts, parts[-1])) if len(parts) else 0  # the last part may go on
            if cut > HELD // 8:
                yield run(*[h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield run(*held)

    n = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (grams.select(*columns).repartition(n, F.shiftright("gram", 8 * (depth - TOP + 1))).sortWithinPartitions("gram")
            .mapInArrow(whole, schema))


def top_levels(grams: DataFrame, depth: int = DEPTH) -> Tree:
    """Levels 0 to TOP - 1: a bounded number of short contexts."""
    if depth < TOP:
        raise ValueError(f"depth is at least {TOP}")

    def run(gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in part_nodes(gram, n, depth)[-1]], ["key", "zeros", "ones", "weight"])

    nodes = in_parts(grams.where("n > 0"), ["gram", "n"], run, "key long, zeros double, ones double, weight double", depth)
    got = nodes.groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weight").alias("below")) \
        .orderBy("key").toArrow()
    key, zeros, one, below = (got[c].to_numpy() for c in ("key", "zeros", "ones", "below"))
    above = []
    for _ in range(TOP):
        weight, log_p = weigh(zeros, one, below)
        above.append((key, zeros, one, weight))
        key, at = np.unique(parents(key), return_inverse=True)
        zeros, one, below = (np.bincount(at, x, len(key)) for x in (zeros, one, log_p))
    tree = Tree([], [], [])
    for level in reversed(above):
        tree.add(*level)
    return tree


def with_levels(top: Tree, gram: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> Tree:
    """The tree of ``top`` and of the nodes of the parts that the grams make up."""
    tree = Tree(list(top.keys), list(top.ones), list(top.weights))
    seen = n > 0
    if seen.any():
        for level in reversed(part_nodes(gram[seen], n[seen], depth)[:-1]):
            tree.add(*level)
    else:
        for _ in range(TOP, depth + 1):
            tree.add(np.zeros(0, np.int64), *[np.zeros(0)] * 3)
    return tree


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, total, value): log10 probability of every gram's byte after its context."""
    top = grams.sparkSession.sparkContext.broadcast(top_levels(grams, depth))

    def run(gram: np.ndarray, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        tree = with_levels(top.value, gram, n, depth)
        value = np.concatenate([tree.log10_probability(gram[i:i + HELD // 8]) for i in range(0, len(gram), HELD // 8)])
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(total), pa.array(value)], ["gram", "total", "value"])

    return in_parts(grams, ["gram", "n", "total"], run, "gram long, total long, value double", depth)


def fit_tree(train: DataFrame, depth: int = DEPTH) -> Tree:
    """The whole tree in one object, for training texts of a size that allows it;
    ``gram_scores`` has no such bound."""
    grams = materialise(count_grams(train.withColumn("held_out", F.lit(False)), depth), "ctw_grams")
    got = grams.orderBy("gram").toArrow()
    return with_levels(top_levels(grams, depth), got["gram"].to_numpy(), got["n"].to_numpy(), depth)


def head_scores(batch: list[bytes], head: np.ndarray, values: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, pa.Array]:
    """Per text the summed values of the shipped grams, and its other grams
    (gram, n)."""
    grams, counts = grams_of(batch, depth)
    new, at = np.unique(grams, return_inverse=True)
    place = np.minimum(np.searchsorted(head, new), max(0, len(head) - 1))
    found = head[place] == new if len(head) else np.zeros(len(new), dtype=bool)
    value = np.where(found, values[place], 0.0) if len(head) else np.zeros(len(new))
    owner = np.repeat(np.arange(len(counts)), counts)
    rest = np.flatnonzero(~found[at])
    pairs, times = np.unique(owner[rest] * len(new) + at[rest], return_counts=True)
    ends = np.concatenate(([0], np.cumsum(np.bincount(pairs // len(new), minlength=len(counts)))))
    others = pa.StructArray.from_arrays([pa.array(new[pairs % len(new)], pa.int64()), pa.array(times.astype(np.int64))], ["gram", "n"])
    return np.add.reduceat(value[at], np.cumsum(counts) - counts), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), others)


def score_documents(docs: DataFrame, depth: int = DEPTH, folds: int = FOLDS, model_grams: int = MODEL_GRAMS,
                    frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte (code length of the text and its end over
    its bytes and one)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", (fold("doc_id", folds) == 0).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    grams = materialise(count_grams(rows, depth), "ctw_grams")
    values = materialise(gram_scores(grams, depth), "ctw_values")
    head = values.orderBy(F.desc("total"), "gram").limit(model_grams).select("gram", "value").toArrow()
    by_gram = np.argsort(head["gram"].to_numpy(), kind="stable")
    head = spark.sparkContext.broadcast((head["gram"].to_numpy()[by_gram], head["value"].to_numpy()[by_gram]))
    tokens = materialise(count_tokens(train), "ctw_tokens")
    ends = train.count()
    words, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, vocabulary = words + ends, distinct + (1 if ends else 0)
    denominator = math.log10(train_tokens + SMOOTHING * (vocabulary + 1))
    most = (tokens.where(F.octet_length("token") <= FREQUENT_BYTES).orderBy(F.desc("n"), "token").limit(frequent).toArrow())
    shipped = spark.sparkContext.broadcast({t.encode(): math.log10(c + SMOOTHING) - denominator
                                            for t, c in zip(most["token"].to_pylist(), most["n"].to_pylist())})
    end_score = math.log10(ends + SMOOTHING) - denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (head_grams, head_values), known = head.value, shipped.value
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                            ("n_bytes", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                            ("rare", pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))),
                            ("rare_grams", pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))])
        for part in steps(batches, "text"):
            lowered = [t.encode().lower() for t in texts(part.column("text"))]
            score, rare_grams = head_scores(lowered, head_grams, head_values, depth)
            n, n_known, base, rare = [], [], [], []
            for t in lowered:
                own = t.split()
                scores = [known.get(w) for w in own]
                found = [s for s in scores if s is not None]
                n.append(len(own) + 1)
                n_known.append(len(found) + (1 if ends else 0))
                base.append(math.fsum(found) + end_score)
                others = Counter(w for w, s in zip(own, scores) if s is None) if len(found) < len(own) else {}
                rare.append([{"token": w.decode(), "n": c} for w, c in others.items()])
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(n, pa.int64()),
                 pa.array([len(t) for t in lowered], pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(score, pa.float64()), pa.array(rare, schema.field("rare").type), rare_grams], schema=schema)

    scored = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base_score double, "
             "score double, rare array<struct<token:string,n:long>>, rare_grams array<struct<gram:long,n:long>>")
    scored = materialise(scored, "ctw_scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", F.col("r.n").alias("times"))
    rare = (rare.join(tokens, "token", "left")
            .select("row", F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"),
                    (F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING) - denominator)).alias("base"))
            .groupBy("row").agg(F.sum("known").alias("known"), F.sum("base").alias("base")))
    rare_grams = scored.select("row", F.explode("rare_grams").alias("r")).select("row", "r.gram", F.col("r.n").alias("times"))
    rare_grams = rare_grams.join(values.select("gram", "value"), "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("tail"))
    score = F.col("score") + F.coalesce("tail", F.lit(0.0))
    return scored.drop("rare", "rare_grams").join(rare, "row", "left").join(rare_grams, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        score.alias("score"), (-score * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
