"""The intake job: extracted rows of all sources into the next version of the store of listings, and a report of the run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions.text import brand_match
from gavelkit.operators import ingest, store
from gavelkit.params import Params
from gavelkit.sources.extract.base import Source


def wanted(sources: Iterable[Source], brand: str) -> Column:
    """Whether a row is kept: its text names the brand, or its source is asked by a maker field; its url is one of its source's items.

    A source that isn't registered is filtered by brand. A missing url fails the test of a source that has one.
    """
    sources = list(sources)
    asked = [s.name for s in sources if not s.needs_brand]
    keep = brand_match(brand, F.col("piece_name"), F.col("notes"))
    if asked:
        keep = keep | F.coalesce(F.col("source").isin(asked), F.lit(False))
    for s in sources:
        if s.item_url:
            keep = keep & (~F.col("source").eqNullSafe(F.lit(s.name)) | F.coalesce(F.col("listing_url").rlike(s.item_url), F.lit(False)))
    return F.coalesce(keep, F.lit(False))


def ingest_listings(prev: DataFrame, batch: DataFrame, sources: list[Source], outcome: list[dict], params: Params, blocked: DataFrame,
                    truncated: DataFrame | None = None, rules=None) -> tuple[DataFrame, DataFrame]:
    """The next store and the report of the run.

    ``batch`` holds the rows of a listing with source and pos; ``outcome`` is what ``run_sources`` reported. Rows that aren't
    wanted or are on the blocklist stay outside. Listings of sources that delivered and weren't seen become inactive; those of a
    source that failed or was skipped stay as they are. The report has, for each source that brought rows: seen, matched (wanted), added (ids
    that the store didn't have, counted for the first source that brought them), match rate, whether it is suspicious and then
    sample names, whether paging was cut short (``truncated``: source, truncated); failed sources have their error alone, and
    one that delivered without a row isn't listed. Without an outcome for a source it counts as not run.
    """
    rows = store.with_listing_key(batch.drop("id")).withColumn("matched", wanted(sources, params.brand_pattern))
    kept = store.without_blocked(rows.where("matched"), blocked)
    delivered = [o["source"] for o in outcome if o["status"] == "done"]
    merged = store.merge_listings(prev, kept, params.run_date, ["pos"], rules)
    out = store.mark_missing(merged, params.run_date, delivered)

    first = kept.groupBy("id").agg(F.min_by("source", "pos").alias("source")).join(prev.select("id"), "id", "left_anti")
    added = first.groupBy("source").agg(F.count("*").alias("added"))
    report = ingest.ingest_summary(rows.withColumn("added", F.lit(False))).drop("added").join(added, "source", "left")
    if truncated is not None:
        report = report.join(truncated.groupBy("source").agg(F.bool_or("truncated").alias("truncated")), "source", "left")
    else:
        report = report.withColumn("truncated", F.lit(None).cast("boolean"))
    report = report.withColumn("error", F.lit(None).cast("string"))
    # one row a registered source, so a handful
    failed = prev.sparkSession.createDataFrame([(o["source"], o["error"]) for o in outcome if o["status"] == "failed"], "source string, error string")
    every = report.unionByName(failed, allowMissingColumns=True)
    ran = lambda c, default: F.when(F.col("error").isNull(), F.coalesce(c, F.lit(default))).alias(c)
    filled = {"added": 0, "truncated": False}
    return out, every.select(*[ran(c, filled[c]) if c in filled else c for c in every.columns])
