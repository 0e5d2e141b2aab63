"""Rules over landed result pages: fresh items, stalled pages, where to stop.

A crawl reads at most a hundred pages of a shop, so windows over the pages of one shop are
small. Items are counted per page before any window sees them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_counts(items: DataFrame) -> DataFrame:
    """Per (shop, page): items, items not on an earlier page, and the first item id.

    ``items`` holds shop, page, pos and item_id.
    """
    per_page = items.groupBy("shop", "item_id", "page").agg(
        F.count("*").alias("_n"), F.min("pos").alias("_pos")
    )
    # one row per page of an item, so at most the page cap of a crawl
    earliest = F.min("page").over(Window.partitionBy("shop", "item_id"))
    return (
        per_page.withColumn("_first", F.col("page") == earliest)
        .groupBy("shop", "page")
        .agg(
            F.sum("_n").alias("items"),
            F.coalesce(F.sum(F.when(F.col("_first"), F.col("_n"))), F.lit(0)).cast("bigint").alias("fresh"),
            F.min_by("item_id", "_pos").alias("first_id"),
        )
    )


def first_sightings(items: DataFrame) -> DataFrame:
    """The first appearance of each item of a shop."""
    cols = [c for c in items.columns if c not in ("shop", "item_id")]
    best = F.min(F.struct("page", "pos", *[c for c in cols if c not in ("page", "pos")])).alias("_b")
    return items.groupBy("shop", "item_id").agg(best).select("shop", "item_id", "_b.*")


def stalled_pages(pages: DataFrame) -> DataFrame:
    """Pages kept and dropped where a shop serves the same page again.

    A page that opens with the first item of the page before it stalls; it and all later
    pages of the shop are dropped.
    """
    order = Window.partitionBy("shop").orderBy("page")
    stalled = F.coalesce(F.col("first_id") == F.lag("first_id").over(order), F.lit(False))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return pages.withColumn("stalled", stalled).withColumn("dropped", F.max("stalled").over(upto))


def stop_pages(pages: DataFrame, page_limit: int | None = None, stop_on_overlap: bool = False,
               max_pages: int = 100) -> DataFrame:
    """Which pages a crawl reads, and whether it was cut at the cap.

    A crawl ends after a page that is short (with ``page_limit``) or has no fresh item, and, with
    ``stop_on_overlap``, after one that partly repeats. A page without fresh items is not kept.
    """
    order = Window.partitionBy("shop").orderBy("page")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stop = F.col("fresh") == 0
    if page_limit is not None:
        stop = stop | (F.col("items") < page_limit)
    if stop_on_overlap:
        stop = stop | (F.col("fresh") < F.col("items"))
    return (
        pages.withColumn("stop", stop)
        .withColumn("_ended", F.coalesce(F.max("stop").over(before), F.lit(False)))
        .withColumn("kept", ~F.col("_ended") & (F.col("fresh") > 0) & (F.col("page") <= max_pages))
        .withColumn("truncated", ~F.col("_ended") & ~F.col("stop") & (F.col("page") == max_pages))
        .drop("_ended")
    )
