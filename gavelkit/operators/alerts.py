"""New listings worth a message today."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import money, positive
from gavelkit.functions.text import text_or
from gavelkit.operators.stats import is_active
from gavelkit.session import pinned


def backfilling_dealers(listings: DataFrame, run_date: str, more_than: int = fixed.BACKFILL_COUNT) -> DataFrame:
    """Dealers with many active listings that were all first seen today."""
    active = listings.where(is_active(F.col("status")))
    per_dealer = active.groupBy("dealer").agg(
        F.count("*").alias("_n"), F.count_if(F.col("first_seen") == run_date).alias("_today")
    )
    return per_dealer.where((F.col("_n") > more_than) & (F.col("_n") == F.col("_today"))).select("dealer")


def new_today(
    listings: DataFrame,
    run_date: str,
    threshold: float = fixed.ALERT_THRESHOLD,
    more_than: int = fixed.BACKFILL_COUNT,
) -> DataFrame:
    """Active listings first seen today at or above the threshold, without first imports.

    Dealers are counted with a partial aggregation, not a window, so that one dealer with a
    large share of all rows is not brought together in a task.
    """
    price = F.coalesce(positive(F.col("asking_price_usd")), positive(F.col("asking_price")), F.lit(0.0))
    fresh = listings.where(is_active(F.col("status")) & (F.col("first_seen") == run_date))
    fresh = fresh.withColumn("alert_price", price).where(F.col("alert_price") >= threshold)
    filling = pinned(backfilling_dealers(listings, run_date, more_than), "backfill")
    return fresh.alias("l").join(
        filling.alias("b"), F.col("l.dealer").eqNullSafe(F.col("b.dealer")), "left_anti"
    )


def alert_lines(alerts: DataFrame, run_date: str, threshold: float, k: int = fixed.ALERT_LONG) -> DataFrame:
    """The first ``k`` alerts as text, most expensive first, with the total and the overflow."""
    total = alerts.agg(F.count("*").alias("n")).select("n").scalar()
    line = F.concat(
        text_or(F.col("piece_name"), "(untitled)"),
        F.lit(" — "),
        money(F.col("alert_price")),
        F.lit(" via "),
        text_or(F.col("dealer"), "unknown dealer"),
    )
    top = alerts.orderBy(F.col("alert_price").desc(), "id").limit(k)
    return top.select(
        "id",
        "alert_price",
        line.alias("line"),
        total.cast("bigint").alias("total"),
        F.greatest(total - F.lit(k), F.lit(0)).cast("bigint").alias("overflow"),
    )
