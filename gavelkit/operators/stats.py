"""Market statistics over the two stores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.dates import days_before, since
from gavelkit.functions.numbers import plausible
from gavelkit.functions.text import text_or
from gavelkit.operators.ranks import price_stats
from gavelkit.session import pinned


def _priced(rows: DataFrame, price: str) -> DataFrame:
    return rows.withColumn("_price", plausible(F.col(price))).where(F.col("_price").isNotNull())


def stats_by_category(rows: DataFrame, price: str, default: str = "Uncategorized") -> DataFrame:
    src = _priced(rows, price).select(text_or(F.col("category"), default).alias("category"), "_price")
    return price_stats(src, ["category"], "_price")


def stats_by_tag(rows: DataFrame, price: str, min_count: int = fixed.MIN_TAG_COUNT) -> DataFrame:
    """One row to many tags; thin tags are left out."""
    src = _priced(rows, price).select(F.explode("tags").alias("tag"), "_price").where(F.col("tag") != "")
    return price_stats(src, ["tag"], "_price").where(F.col("n") >= min_count)


def stats_by_dealer(rows: DataFrame, price: str, default: str = "Unknown") -> DataFrame:
    src = _priced(rows, price).select(text_or(F.col("dealer"), default).alias("dealer"), "_price")
    return price_stats(src, ["dealer"], "_price").select("dealer", "n", "median_price")


def top_dealers_with_other(rows: DataFrame, price: str, top: int = fixed.TOP_DEALERS) -> DataFrame:
    """The biggest dealers by count; all others in one row with their own exact median."""
    src = _priced(rows, price).select(text_or(F.col("dealer"), "Unknown").alias("dealer"), "_price")
    sizes = src.groupBy("dealer").agg(F.count("*").alias("_size"))
    # at most ``top`` rows, so the written table is broadcast by its size
    best = pinned(
        sizes.orderBy(F.col("_size").desc(), "dealer").limit(top).select("dealer", F.lit(1).alias("_top")), "top"
    )
    keyed = src.join(best, "dealer", "left").select(
        F.when(F.col("_top").isNotNull(), F.col("dealer")).alias("dealer"), "_price"
    )
    stats = price_stats(keyed, ["dealer"], "_price")
    others = F.when(F.col("dealer").isNull(), F.lit(1)).otherwise(F.lit(0))
    total = sizes.agg(F.count("*").alias("dealers")).select("dealers").scalar()
    label = F.concat(F.lit("Other ("), (total - F.lit(top)).cast("string"), F.lit(" additional dealers)"))
    return stats.select(
        others.alias("is_other"), F.coalesce(F.col("dealer"), label).alias("dealer"), "n", "median_price"
    )


def price_histogram(rows: DataFrame, price: str) -> DataFrame:
    """Rows per price band; empty bands are kept."""
    p = plausible(F.col(price))
    counts = rows.agg(
        *[
            F.count_if((p >= F.lit(float(low))) & (p < F.lit(high)) if high != float("inf") else p >= float(low)).alias(
                f"b{i}"
            )
            for i, (_, low, high) in enumerate(fixed.PRICE_BANDS)
        ]
    )
    bands = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("ord"), F.lit(label).alias("label"), F.col(f"b{i}").alias("n"))
            for i, (label, _, _) in enumerate(fixed.PRICE_BANDS)
        ]
    )
    return counts.select(F.explode(bands).alias("b")).select("b.ord", "b.label", "b.n")


def one_row(*parts: DataFrame) -> DataFrame:
    """One row from several one-row tables with different columns."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def is_active(status: Column) -> Column:
    return F.coalesce(status == "active", F.lit(False))


def is_not_delisted(status: Column) -> Column:
    """A missing status counts as listed."""
    return ~status.eqNullSafe(F.lit("inactive"))


def baseline_flag(auctions: DataFrame, run_date: str) -> DataFrame:
    """Whether every record on file was first captured inside the capture window."""
    first = days_before(run_date, fixed.CAPTURED_DAYS)
    return auctions.agg(
        F.count("*").alias("records"),
        F.count_if(since(F.col("first_captured"), first)).alias("new_records"),
    ).select(
        "records",
        "new_records",
        ((F.col("records") > 0) & (F.col("records") == F.col("new_records"))).alias("is_baseline"),
    )


def window_counts(auctions: DataFrame, listings: DataFrame, run_date: str) -> DataFrame:
    """Rows inside each look-back window."""
    d = lambda n: days_before(run_date, n)
    a = auctions.agg(
        F.count_if(since(F.col("first_captured"), d(fixed.CAPTURED_DAYS))).alias("captured_4wk"),
        F.count_if(since(F.col("sale_date"), d(fixed.SALES_DAYS))).alias("sold_60d"),
    )
    b = listings.agg(
        F.count_if(since(F.col("first_seen"), d(fixed.NEW_DAYS))).alias("new_1wk"),
        F.count_if(
            (F.col("status") == "inactive") & since(F.col("last_seen"), d(fixed.CLOSED_DAYS))
        ).alias("closed_4wk"),
    )
    return one_row(a, b)


def market_totals(auctions: DataFrame, listings: DataFrame) -> DataFrame:
    active = listings.where(is_active(F.col("status")))
    price = plausible(F.col("asking_price_usd"))
    median = price_stats(active.select(price.alias("p")), [], "p").select(
        F.col("median_price").alias("asking_median")
    )
    counts = auctions.agg(F.count("*").alias("auction_records"))
    dealer = listings.agg(
        F.count("*").alias("dealer_records"),
        F.count_if(is_active(F.col("status"))).alias("active_listings"),
        F.sum(F.when(is_active(F.col("status")), F.coalesce(price, F.lit(0.0)))).alias("asking_total"),
    )
    return one_row(counts, dealer, median)


def recent_sales(auctions: DataFrame, run_date: str, days: int = fixed.SALES_DAYS) -> DataFrame:
    """Sales of the last days, priced, newest first."""
    sold = auctions.withColumn("price", plausible(F.col("sold_price_usd")))
    return sold.where(F.col("price").isNotNull() & since(F.col("sale_date"), days_before(run_date, days)))


def recent_sales_summary(auctions: DataFrame, run_date: str, days: int = fixed.SALES_DAYS) -> DataFrame:
    recent = recent_sales(auctions, run_date, days)
    stats = price_stats(recent, [], "price").select(F.col("median_price").alias("sale_median"))
    return one_row(recent.agg(F.count("*").alias("sales")), stats)


def top_sales(auctions: DataFrame, k: int = fixed.TOP_SALES) -> DataFrame:
    sold = auctions.withColumn("price", plausible(F.col("sold_price_usd"))).where(F.col("price").isNotNull())
    return sold.orderBy(F.col("price").desc(), "id").limit(k)


def new_listings(listings: DataFrame, run_date: str, days: int = fixed.NEW_DAYS) -> DataFrame:
    """Listings first seen in the window, any status."""
    fresh = listings.where(since(F.col("first_seen"), days_before(run_date, days)))
    return fresh.withColumn("price", plausible(F.col("asking_price_usd")))


def new_listings_top(listings: DataFrame, run_date: str, k: int = fixed.TOP_NEW) -> DataFrame:
    """The most expensive new listings, with the number of those not shown."""
    fresh = new_listings(listings, run_date)
    total = fresh.agg(F.count("*").alias("n")).select("n").scalar()
    top = fresh.orderBy(F.coalesce(F.col("price"), F.lit(0.0)).desc(), "id").limit(k)
    return top.withColumn("overflow", F.greatest(total - F.lit(k), F.lit(0)).cast("bigint"))


def closed_listings(listings: DataFrame, run_date: str, days: int = fixed.CLOSED_DAYS) -> DataFrame:
    """Listings delisted in the window."""
    gone = listings.where((F.col("status") == "inactive") & since(F.col("last_seen"), days_before(run_date, days)))
    return gone.withColumn("price", plausible(F.col("asking_price_usd")))


def stats_row(auctions: DataFrame, listings: DataFrame, run_date: str) -> DataFrame:
    """The row that a run adds to the statistics series."""
    totals = market_totals(auctions, listings)
    recent = recent_sales_summary(auctions, run_date)
    windows = window_counts(auctions, listings, run_date)
    one = one_row(totals, recent, windows)
    return one.select(
        F.lit(run_date).alias("date"),
        F.col("auction_records").alias("auctionRecords"),
        F.col("dealer_records").alias("dealerRecords"),
        F.col("active_listings").alias("activeDealerListings"),
        F.col("new_1wk").alias("newDealerListings1wk"),
        F.col("closed_4wk").alias("closedDealerListings4wk"),
        F.col("asking_median").alias("dealerAskingMedian"),
        F.col("sale_median").alias("recentSalesMedian"),
    )


def upsert_series(series: DataFrame, row: DataFrame, keep: int = fixed.STATS_KEEP) -> DataFrame:
    """Replace the row of the same date, keep the last runs."""
    old = series.join(row.select("date"), "date", "left_anti")
    return old.unionByName(row, allowMissingColumns=True).orderBy(F.col("date").desc()).limit(keep).orderBy("date")


def series_delta(series: DataFrame, measures: list[str]) -> DataFrame:
    """The change of each measure since the previous run. The series has one row per run."""
    runs = Window.orderBy("date")
    return series.select(
        "date",
        *measures,
        *[(F.col(m) - F.lag(m).over(runs)).alias(f"{m}_delta") for m in measures],
    )


def ask_vs_sold(auctions: DataFrame, listings: DataFrame, min_count: int = fixed.MIN_TAG_COUNT) -> DataFrame:
    """Median asking and median sold price of each tag, side by side."""
    sold = stats_by_tag(auctions, "sold_price_usd", min_count).select(
        "tag", F.col("n").alias("sold_n"), F.col("median_price").alias("sold_median")
    )
    asked = stats_by_tag(listings.where(is_active(F.col("status"))), "asking_price_usd", min_count).select(
        "tag", F.col("n").alias("ask_n"), F.col("median_price").alias("ask_median")
    )
    both = sold.join(asked, "tag", "full_outer")
    return both.withColumn("spread", F.col("ask_median") - F.col("sold_median"))


def scan_trend(sightings: DataFrame) -> DataFrame:
    """Pieces, priced pieces, median and maximum per scan date."""
    price = F.when(F.col("price") > 0, F.col("price"))
    rows = sightings.select("date", price.alias("price"))
    counts = rows.groupBy("date").agg(F.count("*").alias("pieces"))
    stats = price_stats(rows, ["date"], "price").select(
        "date", F.col("n").alias("priced"), "median_price", "max_price"
    )
    return counts.join(stats, "date", "left").withColumn("priced", F.coalesce("priced", F.lit(0).cast("bigint")))


def price_type_mix(rows: DataFrame) -> DataFrame:
    return rows.groupBy(text_or(F.col("price_type"), "unknown").alias("price_type")).agg(
        F.count("*").alias("n"), F.count_if(plausible(F.col("price")).isNotNull()).alias("priced")
    )
