"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Targets share out a total by weight. A source whose share is above ``max_epochs`` times its size is
clamped there and the excess goes to the other sources by weight, round by round until none is above.
Each round is an aggregate over the source table, of which two sums reach the driver.

A source repeated ``r`` times takes each document ``floor(r)`` times and, for the fraction, a prefix of
its documents in the order of a seeded digest, as near the wanted words as whole documents come. The
prefix is found without sorting a source in one place: sizes are summed per digest bucket, whole buckets
are taken by their running sum, and only the one bucket that the boundary cuts is ordered by document.
A bucket holds about 1/65,536 of a source.

Missing texts have size 0, a missing source is a source of its own and ranks last, a missing id counts as
an empty one. Rows that share an id are ordered by size and are otherwise interchangeable. A source of
size 0 has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import settle

WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SEED = "mix-1"
MAX_EPOCHS = 3.0
BUCKET_DIGITS = 4


def cycle_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds ``weight`` by the place of ``source`` in code point order, null last.

    Places are counted per range of the sorted sources, so no task holds them all.
    """
    ranged = settle(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()),
        "mix-ranges",
    )
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = parts.select(
        F.col("part"),
        (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return (
        ranged.withColumn("place", place)
        .join(before, "part")
        .withColumn("rank", F.col("place") + F.coalesce(F.col("before"), F.lit(0)) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .drop("part", "place", "before", "rank")
    )


def water_fill(sources: DataFrame, share: float = 1.0, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows (source, source_size, weight); ends as each round clamps a source."""
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = None  # words per unit of weight
    while True:
        held = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        fixed, weight, clamped = sources.agg(
            F.coalesce(F.sum(F.when(held, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(held, 1)),
        ).first()
        if weight == 0:
            break
        higher = max(0.0, total - fixed) / weight
        if level is not None and clamped == last:
            break
        level, last = higher, clamped
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.round(F.least(F.col("weight") * F.lit(level), cap), 3))


def digest(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix_sizes(docs: DataFrame, seed: str) -> DataFrame:
    return settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            size_of(F.col("text")).alias("size"),
        ).withColumn("digest", digest(seed)),
        "mix-sizes",
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.0,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies and taken (words, repeats counted)."""
    sized = mix_sizes(docs, seed)
    plan = mix_plan(sized, weights, share, max_epochs)
    return mix_copies(sized, plan)


def mix_plan(sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(settle(cycle_weights(sources, weights), "mix-sources"), share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(epochs).cast("long")
    return settle(
        filled.withColumn("whole", whole).withColumn(
            "quota", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))
        ),
        "mix-plan",
    )


def mix_cuts(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan, a row per source, with the bucket that the boundary cuts (none: "g") and what is taken before it."""
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    joined = sums.join(plan, sums["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    before = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")
    # One row per source: the first bucket that is not taken whole, and what is taken before it.
    cut = settle(
        joined.withColumn("before", before)
        .where(F.col("before") + F.col("bucket_size") > F.col("quota"))
        .groupBy("source", "whole", "quota", "target", "source_size")
        .agg(F.min("bucket").alias("cut"), F.min("before").alias("before")),
        "mix-cuts",
    )
    rest = plan.join(cut.select(F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")), "left_anti")
    return cut.unionByName(rest.select(
        "source", "whole", "quota", "target", "source_size", F.lit("g").alias("cut"), F.lit(0).cast("long").alias("before")
    ))


def with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    return rows.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")


def copies_of() -> Column:
    return F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(F.lit(0))


def cut_buckets(at: DataFrame) -> DataFrame:
    """Rows of the buckets that boundaries cut, each with the repetition it has beside the whole ones."""
    running = F.sum("size").over(
        Window.partitionBy("source").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    return at.where(F.col("bucket") == F.col("cut")).withColumn(
        "extra",
        (F.col("before") + F.coalesce(running, F.lit(0)) + F.col("size") / 2 <= F.col("quota")).cast("long"),
    )


def mix_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    sized = sized.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    at = with_cuts(sized, mix_cuts(sized, plan))
    others = at.where(F.col("bucket") != F.col("cut")).withColumn(
        "extra", (F.col("bucket") < F.col("cut")).cast("long")
    )
    return others.unionByName(cut_buckets(at)).select(
        "doc_id", "size", "source_size", "target", copies_of().alias("copies"), (copies_of() * F.col("size")).alias("taken"),
    )


def repeat_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.0,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns.

    A document's copies follow from its source's row of the plan, so texts stay where they are; only those of
    the buckets that boundaries cut are joined by source, id and size. Rows equal in these are
    interchangeable; documents of size 0 are taken as often as their source is taken whole.
    """
    sized = mix_sizes(docs, seed).withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))
    cuts = settle(mix_cuts(sized, mix_plan(sized, weights, share, max_epochs)), "mix-quotas")
    names = docs.columns
    keyed = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
    ).withColumn("bucket", F.substring(digest(seed), 1, BUCKET_DIGITS))
    at = with_cuts(keyed, cuts.select("source", "whole", "cut"))
    taken_too = (F.col("bucket") < F.col("cut")) & F.coalesce(F.col("row.text").rlike(WORD_PATTERN), F.lit(False))
    others = at.where(F.col("bucket") != F.col("cut")).select("row", (F.col("whole") + taken_too.cast("long")).alias("copies"))

    rows = at.where(F.col("bucket") == F.col("cut")).withColumn("size", size_of(F.col("row.text")))
    order = Window.partitionBy("source", "doc_id", "size").orderBy(F.xxhash64("row"))
    rows = rows.select("row", "source", "doc_id", "size", F.row_number().over(order).alias("nth"))
    taken = (
        cut_buckets(with_cuts(sized, cuts)).withColumn("copies", copies_of())
        .groupBy("source", "doc_id", "size", "copies").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("upto", F.sum("rows").over(Window.partitionBy("source", "doc_id", "size").orderBy(F.desc("copies"))))
        .select(F.col("source").alias("t_source"), F.col("doc_id").alias("t_id"), F.col("size").alias("t_size"), "copies", "rows", "upto")
    )
    boundary = rows.join(
        taken, F.col("source").eqNullSafe(F.col("t_source")) & F.col("doc_id").eqNullSafe(F.col("t_id"))
        & (F.col("size") == F.col("t_size")) & (F.col("nth") <= F.col("upto")) & (F.col("nth") > F.col("upto") - F.col("rows"))
    ).select("row", "copies")
    return (
        others.unionByName(boundary).where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*[F.col("row")[name].alias(name) for name in names])
    )
