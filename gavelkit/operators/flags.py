"""Prices that are implausibly low."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import money, native_note, plausible
from gavelkit.functions.text import text_or
from gavelkit.operators.ranks import price_stats_and_overall
from gavelkit.operators.stats import is_not_delisted
from gavelkit.session import pinned


def price_flags(
    rows: DataFrame,
    price: str,
    source: str,
    kind: str,
    min_sample: int = fixed.MIN_CATEGORY_SAMPLE,
    ratio: float = fixed.CATEGORY_RATIO,
) -> DataFrame:
    """Flag prices far below their category, or at the bottom of all prices of this kind.

    The category test needs a minimum sample and has priority. Thresholds are computed once
    per category and once overall, then attached to the rows; the category table is written
    first so that its true size decides between broadcast and shuffle.
    """
    cat_p, all_p = fixed.CATEGORY_PERCENTILE, fixed.GLOBAL_PERCENTILE
    priced = rows.withColumn("_cat", text_or(F.col("category"), "other")).withColumn(
        "_price", plausible(F.col(price))
    )
    priced = priced.where(F.col("_price").isNotNull())
    by_cat, everything = price_stats_and_overall(priced, ["_cat"], "_price", (cat_p,), (all_p,))
    by_cat = by_cat.select(
        "_cat", F.col("n").alias("_n"), F.col("median_price").alias("_median"), F.col(f"p{cat_p}").alias("_floor")
    )
    overall = everything.select(f"p{all_p}").scalar()

    low_in_category = (
        (F.col("_n") >= min_sample)
        & (F.col("_price") <= F.col("_floor"))
        & (F.col("_price") < F.col("_median") * F.lit(ratio))
    )
    category_reason = F.concat(
        money(F.col("_price")),
        F.lit(' is well below the typical range for "'),
        F.col("_cat"),
        F.lit('" ('),
        F.col("_n").cast("string"),
        F.lit(f" comparable {kind} records, median "),
        money(F.col("_median")),
        F.lit(")"),
    )
    overall_reason = F.concat(
        money(F.col("_price")),
        F.lit(f" is in the bottom {all_p}% of all {kind} prices on file, regardless of category"),
    )
    reason = F.when(low_in_category, category_reason).when(F.col("_price") <= overall, overall_reason)
    native = (
        native_note(F.coalesce(*[F.col(c) for c in ("sold_price", "asking_price") if c in rows.columns]), F.col("currency_note"))
        if "currency_note" in rows.columns
        else F.lit("")
    )
    return (
        priced.join(pinned(by_cat, "category-floor"), "_cat", "left")
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(
            "id",
            F.lit(kind).alias("type"),
            F.coalesce(F.col("piece_name"), F.lit("")).alias("piece_name"),
            F.col("_cat").alias("category"),
            F.col("_price").alias("price"),
            F.coalesce(F.col(source), F.lit("")).alias("source"),
            F.coalesce(F.col("listing_url"), F.lit("")).alias("url"),
            native.alias("native"),
            F.lit("price_anomaly").alias("flag"),
            "reason",
        )
    )


def market_flags(auctions: DataFrame, listings: DataFrame) -> DataFrame:
    """Flags of sold auction records and of listings that are not delisted."""
    sold = price_flags(auctions, "sold_price_usd", "auction_house", "auction")
    asked = price_flags(
        listings.where(is_not_delisted(F.col("status"))), "asking_price_usd", "dealer", "dealer"
    )
    return sold.unionByName(asked)


def cheapest_flags(flags: DataFrame, k: int = fixed.TOP_FLAGS) -> DataFrame:
    return flags.orderBy(F.coalesce(F.col("price"), F.lit(0.0)).asc(), "type", "id").limit(k)
