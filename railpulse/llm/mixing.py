"""Mixing sources to target weights by systematic sampling (DataFrame only).

Method. A document's expected copies are its source's target words over the
source's words. Within a source the documents stand in order of size (ties in
a seeded order), their expected copies are prefix-summed, one random offset is
added, and a document is emitted once for each integer the sum crosses.
Ordering by size makes every size class give its share, so the taken words
stay within about one long document of the target.

Scale. Documents are range-partitioned by (source, size, ...), so a source
that holds a third of all rows spreads over many tasks; the place of a row in
its source comes from its place in its partition plus the counts of earlier
partitions (one small row per partition and source). No row is moved twice.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; repeated rows are sampled one by one; an empty table gives an
empty result; extra columns are ignored unless named in ``carry``. A document
of size 0 in a source with words is copied like any other of its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.llm.common import materialise, word_count
from railpulse.operators.ordering import dense_row_ids, global_running_sum

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CEILING = 2


def uniform(text: Column) -> Column:
    """A number in [0, 1) fixed by ``text``: 48 bits of its md5."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   ceiling: int = CEILING) -> DataFrame:
    """Targets per source from (source, source_size): weights repeat in code
    point order of the sources, ``share`` of all words is dealt by weight, and
    a target stops at ``ceiling`` times its source.

    Sources in order of size over weight reach their ceiling first, so the
    water level after capping the first i is
    (share * total - ceiling * their sizes) / (weight of the rest); it rises
    while the next source is still above its ceiling and falls after, so the
    final level is its maximum."""
    ordered = dense_row_ids(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_place")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    dealt = ordered.select("source", "source_size", "_place", cycle.cast("long").alias("weight")) \
        .withColumn("_ratio", F.col("source_size") / F.col("weight"))
    dealt = global_running_sum(dealt, ["_ratio", "_place"], F.col("weight"), "_weights")
    dealt = global_running_sum(dealt, ["_ratio", "_place"], F.col("source_size"), "_sizes")
    total, weight = dealt.agg(F.sum("source_size")).scalar(), dealt.agg(F.sum("weight")).scalar()
    level = (F.lit(share) * total - ceiling * (F.col("_sizes") - F.col("source_size"))) \
        / (weight - F.col("_weights") + F.col("weight"))
    dealt = dealt.withColumn("_level", level)
    water = dealt.agg(F.max("_level")).scalar()
    target = F.least(ceiling * F.col("source_size").cast("double"), F.col("weight") * water)
    return dealt.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), seed: int = 7,
                weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with size, source_size,
    target and ``copies``, the times it is taken; ``carry`` names the columns
    of ``docs`` that come along."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = word_count(F.col("text"))
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    kept = F.struct(*[F.col(c) for c in carry])
    rows = (docs.select(kept.alias("row"), F.col("source").alias("source"), size.alias("size"), tie.alias("tie"),
                        F.xxhash64("text").alias("mark"))
            .repartitionByRange(n, "source", "size", "tie", "mark")
            .sortWithinPartitions("source", "size", "tie", "mark")
            .select("row", "source", "size", F.monotonically_increasing_id().alias("at")))
    rows = materialise(rows, "mix_rows").select(
        "row", "source", "size", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at"))
    parts = rows.groupBy("part", "source").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.sum("size").alias("words"))
    parts = materialise(parts, "mix_parts")  # a row per partition and source
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", "source", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, ceiling)
    s, t = starts.alias("s"), targets.alias("t")
    layout = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.part").alias("l_part"), F.col("s.source").alias("l_source"), "start", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("expected"),
        uniform(F.concat(F.lit(f"offset {seed}:"), F.coalesce(F.col("s.source"), F.lit("\0")))).alias("offset"))
    # A row per partition and source, stored so that its size is known when the join
    # is planned: the rows stay where they are as long as it can be sent to them.
    layout = materialise(layout, "mix_layout")
    place = F.col("start") + F.col("at")  # documents of the source before this one
    crossed = F.floor((place + 1) * F.col("expected") + F.col("offset")) - F.floor(place * F.col("expected") + F.col("offset"))
    return rows.join(layout, (F.col("part") == F.col("l_part")) & F.col("source").eqNullSafe(F.col("l_source"))).select(
        *[F.col(f"row.{c}").alias(c) for c in carry], *([] if "source" in carry else ["source"]), "size",
        F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"), F.coalesce("target", F.lit(0.0)).alias("target"),
        crossed.cast("long").alias("copies"))


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per taken copy."""
    return (mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*columns))
