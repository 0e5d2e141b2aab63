"""What each source delivered, and look-ups used while ingesting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.text import blank_to_null


def union_batches(*batches: DataFrame) -> DataFrame:
    """One batch from the outputs of several extraction jobs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def first_k(rows: DataFrame, group: str, order: list, value: str, k: int) -> DataFrame:
    """The first ``k`` values of each group as one text, separated by ``; ``.

    The rank filter sits directly on the window, so each task passes on at most ``k`` rows
    of a group, however large the group is.
    """
    ranked = rows.select(group, value, *order).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))
    )
    few = ranked.where(F.col("_rn") <= k).groupBy(group).agg(
        F.sort_array(F.collect_list(F.struct("_rn", value))).alias("_s")
    )
    return few.select(group, F.array_join(F.transform("_s", lambda s: s[value]), "; ").alias("sample"))


def ingest_summary(rows: DataFrame, errors: DataFrame | None = None, alarm: float = fixed.MATCH_RATE_ALARM,
                   samples: int = fixed.SAMPLE_NAMES) -> DataFrame:
    """Per source: rows seen, matched and added, the match rate and, if it is suspicious, sample names.

    ``rows`` holds source, matched, added, piece_name and pos. ``errors`` (source, error) lists
    sources that failed; they are reported beside the others.
    """
    counts = rows.groupBy("source").agg(
        F.count("*").alias("seen"),
        F.count_if("matched").alias("matched"),
        F.count_if("added").alias("added"),
    )
    counts = counts.withColumn("match_rate", F.col("matched") / F.col("seen")).withColumn(
        "suspicious", (F.col("seen") > 0) & (F.col("match_rate") > alarm)
    )
    names = first_k(rows.where("matched"), "source", ["pos"], "piece_name", samples)
    out = counts.join(names, "source", "left").withColumn("sample", F.when(F.col("suspicious"), F.col("sample")))
    if errors is not None:
        out = out.unionByName(errors.select("source", "error"), allowMissingColumns=True)
    return out


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The value of the last occurrence of each key."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def with_default_name(rows: DataFrame, registry: DataFrame, key: str, name: str) -> DataFrame:
    """The registered name of a key, or the key itself."""
    known = registry.select(F.col("key").alias(key), F.col("name").alias("_name"))
    return rows.join(known, key, "left").withColumn(name, F.coalesce(blank_to_null("_name"), F.col(key))).drop("_name")


def first_hit(probes: DataFrame) -> DataFrame:
    """Per domain the first probe that found products. ``probes``: domain, platform, probe_order, found, brand."""
    hit = F.col("found") > 0
    at = F.when(hit, F.col("probe_order"))
    return probes.groupBy("domain").agg(
        F.min_by("platform", at).alias("platform"),
        F.min_by("found", at).alias("found"),
        F.min_by("brand", at).alias("brand"),
        F.count_if(hit).alias("hits"),
    )


def pointer_hop(rows: DataFrame, records: DataFrame, ref: str, fields: dict[str, str]) -> DataFrame:
    """Follow a pointer column into the record table (page_id, key, and record columns)."""
    target = records.select(
        F.col("page_id").alias("_pid"), F.col("key").alias("_key"), *[F.col(c).alias(n) for c, n in fields.items()]
    )
    on = (F.col("page_id") == F.col("_pid")) & (F.col(ref) == F.col("_key"))
    return rows.join(target, on, "left").drop("_pid", "_key")
