"""Exact order statistics per group that stay exact and spread out under skew.

A group may hold a third of all rows, so no group is sorted or collected in one task.
The first pass counts rows per (group, bucket), where a bucket is a narrow slice of the
value range; partial aggregation shrinks this before the shuffle to a few thousand rows
per group. The counts are written once, so what follows from them is planned with a known
size. Running counts over the buckets tell which bucket holds each wanted rank.
The second pass reads only the rows of those buckets, counts them per distinct value and
finds the value at the rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.session import pinned

# slices per unit of ln(1 + |x|): prices from 50 to a billion give under 70,000 slices
_SLICES = 4096


def _slice(v: Column) -> Column:
    """A bucket number that never decreases as ``v`` grows."""
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(float(_SLICES))).cast("bigint")


def _wanted(total: Column, percentiles: tuple[float, ...]) -> Column:
    """The wanted ranks, counted from one, by name."""
    ranks = [
        F.struct(F.lit("lo").alias("name"), F.floor((total + 1) / 2).cast("bigint").alias("rank")),
        F.struct(F.lit("hi").alias("name"), (F.floor(total / 2) + 1).cast("bigint").alias("rank")),
    ]
    for p in percentiles:
        at = F.least(total - 1, F.floor(F.lit(p / 100.0) * total)) + 1
        ranks.append(F.struct(F.lit(f"p{p:g}").alias("name"), at.cast("bigint").alias("rank")))
    return F.explode(F.array(*ranks))


def _slice_counts(rows: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their slice, and the written counts per (group, slice)."""
    src = rows.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    src = src.withColumn("_slice", _slice(F.col("_v")))
    counts = src.groupBy(*keys, "_slice").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    return src, pinned(counts, "slices")


def _locate(counts: DataFrame, keys: list[str], percentiles: tuple[float, ...]) -> DataFrame:
    """The slice of each wanted rank, and the rank inside that slice."""
    group = Window.partitionBy(*keys)
    running = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("n", F.sum("_n").over(group))
        .withColumn("min_price", F.min("_lo").over(group))
        .withColumn("max_price", F.max("_hi").over(group))
        .withColumn("_want", _wanted(F.col("n"), percentiles))
        .where((F.col("_want.rank") > F.col("_upto") - F.col("_n")) & (F.col("_want.rank") <= F.col("_upto")))
        .select(
            *keys,
            "_slice",
            "n",
            "min_price",
            "max_price",
            F.col("_want.name").alias("_name"),
            (F.col("_want.rank") - (F.col("_upto") - F.col("_n"))).alias("_rank"),
        )
    )


def _matches(keys: list[str]) -> list[Column]:
    return [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]


def _read_ranks(located: DataFrame, inside: DataFrame, keys: list[str], percentiles: tuple[float, ...]) -> DataFrame:
    """The value at each wanted rank, one row per group."""
    by_value = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = inside.withColumn("_to", F.sum("_m").over(by_value))
    picked = (
        located.alias("t")
        .join(upto.alias("s"), _matches([*keys, "_slice"]), "inner")
        .where((F.col("_rank") > F.col("_to") - F.col("_m")) & (F.col("_rank") <= F.col("_to")))
        .select(*[F.col(f"t.{k}").alias(k) for k in keys], "n", "min_price", "max_price", "_name", "_v")
    )
    at = lambda name: F.max(F.when(F.col("_name") == name, F.col("_v")))
    out = picked.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("min_price").alias("min_price"),
        at("lo").alias("_m1"),
        at("hi").alias("_m2"),
        F.max("max_price").alias("max_price"),
        *[at(f"p{p:g}").alias(f"p{p:g}") for p in percentiles],
    )
    median = F.when(F.col("n") % 2 == 1, F.col("_m1")).otherwise(
        F.floor((F.col("_m1") + F.col("_m2")) / 2 + F.lit(0.5)).cast("double")
    )
    return out.select(
        *keys, "n", "min_price", median.alias("median_price"), "max_price", *[f"p{p:g}" for p in percentiles]
    )


def _inside(src: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per distinct value, for the wanted slices only."""
    return (
        src.alias("s")
        .join(slices.alias("t"), _matches([*keys, "_slice"]), "left_semi")
        .groupBy(*keys, "_slice", "_v")
        .agg(F.count("*").alias("_m"))
    )


def price_stats(
    rows: DataFrame, keys: list[str], value: str, percentiles: tuple[float, ...] = ()
) -> DataFrame:
    """Count, min, median, max and floor-rank percentiles of ``value`` per group.

    The median of an even count is the rounded mean of the two middle values. A percentile
    is the sorted value at ``floor(p / 100 * n)``, never interpolated. Null values are left out.
    Columns: the keys, ``n``, ``min_price``, ``median_price``, ``max_price``, ``p5`` and so on.
    """
    if not keys:
        one = rows.withColumn("_all", F.lit(1))
        return price_stats(one, ["_all"], value, percentiles).drop("_all")
    src, counts = _slice_counts(rows, keys, value)
    located = _locate(counts, keys, percentiles)
    inside = _inside(src, located.select(*keys, "_slice"), keys)
    return _read_ranks(located, inside, keys, percentiles)


def price_stats_and_overall(
    rows: DataFrame,
    keys: list[str],
    value: str,
    percentiles: tuple[float, ...],
    overall_percentiles: tuple[float, ...],
) -> tuple[DataFrame, DataFrame]:
    """The statistics per group and those of all rows, from the same two passes.

    The counts per slice of all rows are sums of the counts per group, and the rows of the
    slices wanted for all rows are read together with those wanted for the groups.
    """
    src, counts = _slice_counts(rows, keys, value)
    located = _locate(counts, keys, percentiles)
    together = counts.groupBy(F.lit(1).alias("_all"), "_slice").agg(
        F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    # at most two slices for the median and one for each percentile
    everywhere = _locate(together, ["_all"], overall_percentiles)
    wanted = (
        counts.join(everywhere.select("_slice").distinct(), "_slice", "left_semi")
        .select(*keys, "_slice")
        .unionByName(located.select(*keys, "_slice"))
    )
    inside = pinned(_inside(src, wanted, keys), "values")
    by_group = _read_ranks(located, inside, keys, percentiles)
    across = (
        inside.join(everywhere.select("_slice").distinct(), "_slice", "left_semi")
        .groupBy(F.lit(1).alias("_all"), "_slice", "_v")
        .agg(F.sum("_m").alias("_m"))
    )
    return by_group, _read_ranks(everywhere, across, ["_all"], overall_percentiles).drop("_all")
