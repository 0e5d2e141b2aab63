"""The periodic digest as rows: section number, section, part, rank, tie and line.

Long tables are ordered by the rank and tie columns when they are written, so no row number
over a whole table is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import axis_ceiling, money, native_suffix, plausible
from gavelkit.functions.text import capital, link_text, text_or
from gavelkit.operators import stats
from gavelkit.operators.flags import cheapest_flags
from gavelkit.sources.stores import union_all

SECTIONS = ["available", "trends", "new", "closed", "recent", "notable", "flags", "caveats"]
_CAVEATS = [
    "Hammer prices do not include the premium that buyers pay on top.",
    "Asking prices are offers, not confirmed sales.",
    "A closed listing was usually sold, but may also have been relisted or dropped out of a feed.",
    "Available means dealer stock; auction records are finished sales.",
    "A piece may be listed on several sites, so totals count listings, not pieces.",
    "Foreign prices are converted with yearly average rates; the original amount is shown beside them.",
]


def _lines(rows: DataFrame, section: str, part: int, rank: Column, tie: Column, line: Column) -> DataFrame:
    return rows.select(
        F.lit(SECTIONS.index(section) + 1).alias("section_no"),
        F.lit(section).alias("section"),
        F.lit(part).alias("part"),
        rank.cast("double").alias("rank"),
        tie.cast("string").alias("tie"),
        line.alias("line"),
    )


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _newest_first(day: Column) -> Column:
    """A number that falls as the text date grows; partial dates sort below full ones."""
    return -F.rpad(F.regexp_replace(F.coalesce(day, F.lit("")), "[^0-9]", ""), 8, "0").try_cast("double")


def _count(n: Column) -> Column:
    return F.format_number(n, 0)


def available(listings: DataFrame) -> DataFrame:
    """Headline, price bands, categories and dealers of the active listings."""
    active = listings.where(stats.is_active(F.col("status")))
    price = "asking_price_usd"
    zero, none = F.lit(0), F.lit("")
    total = active.agg(F.count("*").alias("n"), F.sum(F.coalesce(plausible(F.col(price)), F.lit(0.0))).alias("total"))
    head = F.concat(
        _count(F.col("n")), F.lit(" active listings with a combined asking total of "), money(F.coalesce("total", F.lit(0.0)))
    )
    bands = stats.price_histogram(active, price)
    top = bands.agg(axis_ceiling(F.greatest(F.max("n"), F.lit(1)), 50).alias("top"))
    cats = stats.stats_by_category(active, price)
    dealers = stats.top_dealers_with_other(active, price)
    n = -F.col("n")
    return union_all(
        [
            _lines(total, "available", 0, zero, none, head),
            _lines(top, "available", 1, zero, none, F.concat(F.lit("By price, axis to "), F.col("top").cast("bigint").cast("string"))),
            _lines(bands, "available", 2, F.col("ord"), none, _row(F.col("label"), F.col("n").cast("string"))),
            _lines(
                cats, "available", 3, n, F.col("category"),
                _row(capital(F.col("category")), F.col("n").cast("string"), money(F.col("min_price")), money(F.col("median_price")), money(F.col("max_price"))),
            ),
            _lines(
                dealers, "available", 4, F.col("is_other") * 1e15 - F.col("n"), F.col("dealer"),
                _row(F.col("dealer"), F.col("n").cast("string"), money(F.col("median_price"))),
            ),
        ]
    )


def trends(auctions: DataFrame, listings: DataFrame) -> DataFrame:
    """The most frequent tags of sales and of active listings; no lines without tags."""
    active = listings.where(stats.is_active(F.col("status")))
    parts = []
    for part, rows in ((1, stats.stats_by_tag(auctions, "sold_price_usd")), (2, stats.stats_by_tag(active, "asking_price_usd"))):
        top = rows.orderBy(F.col("n").desc(), "tag").limit(fixed.TOP_TAGS)
        cells = [F.col("tag"), F.col("n").cast("string"), money(F.col("min_price")), money(F.col("median_price")), money(F.col("max_price"))]
        parts.append(_lines(top, "trends", part, -F.col("n"), F.col("tag"), _row(*cells)))
    return union_all(parts)


def _listing_line() -> Column:
    day = F.coalesce(F.nullif("first_seen", F.lit("")), F.col("last_seen"), F.lit(""))
    price = F.concat(money(F.col("price")), native_suffix(F.col("asking_price"), F.col("currency_note")))
    return _row(
        link_text(F.col("piece_name"), F.col("listing_url")), capital(text_or(F.col("category"), "other")),
        F.coalesce("dealer", F.lit("")), price, day,
    )


def _none(rows: DataFrame, section: str) -> DataFrame:
    """The line that stands for an empty table."""
    empty = rows.agg(F.count("*").alias("n")).where(F.col("n") == 0)
    return _lines(empty, section, 1, F.lit(0), F.lit(""), F.lit("None."))


def new_section(listings: DataFrame, run_date: str) -> DataFrame:
    top = stats.new_listings_top(listings, run_date)
    total = stats.new_listings(listings, run_date).agg(F.count("*").alias("n"))
    head = F.concat(_count(F.col("n")), F.lit(f" listings first seen in the last {fixed.NEW_DAYS} days"))
    more = total.where(F.col("n") > fixed.TOP_NEW)
    return union_all(
        [
            _lines(total, "new", 0, F.lit(0), F.lit(""), head),
            _none(top, "new"),
            _lines(top, "new", 1, -F.coalesce("price", F.lit(0.0)), F.col("id"), _listing_line()),
            _lines(more, "new", 2, F.lit(0), F.lit(""), F.concat(F.lit("and "), _count(F.col("n") - fixed.TOP_NEW), F.lit(" more"))),
        ]
    )


def closed_section(listings: DataFrame, run_date: str) -> DataFrame:
    rows = stats.closed_listings(listings, run_date)
    head = F.concat(_count(F.col("n")), F.lit(f" listings delisted in the last {fixed.CLOSED_DAYS} days"))
    return union_all(
        [
            _lines(rows.agg(F.count("*").alias("n")), "closed", 0, F.lit(0), F.lit(""), head),
            _none(rows, "closed"),
            _lines(rows, "closed", 1, _newest_first(F.col("last_seen")), F.col("id"), _listing_line()),
        ]
    )


def _sale_line() -> Column:
    price = F.concat(money(F.col("price")), native_suffix(F.col("sold_price"), F.col("currency_note")))
    return _row(
        link_text(F.col("piece_name"), F.col("listing_url")), F.coalesce("auction_house", F.lit("")),
        F.coalesce("sale_date", F.lit("")), price,
    )


def recent_section(auctions: DataFrame, run_date: str) -> DataFrame:
    rows = stats.recent_sales(auctions, run_date)
    summary = stats.recent_sales_summary(auctions, run_date)
    median = F.coalesce(F.concat(F.lit(", median "), F.when(F.col("sale_median").isNotNull(), money(F.col("sale_median")))), F.lit(""))
    head = F.concat(_count(F.col("sales")), F.lit(f" sales in the last {fixed.SALES_DAYS} days"), median)
    return union_all(
        [
            _lines(summary, "recent", 0, F.lit(0), F.lit(""), head),
            _none(rows, "recent"),
            _lines(rows, "recent", 1, _newest_first(F.col("sale_date")), F.col("id"), _sale_line()),
        ]
    )


def notable_section(auctions: DataFrame) -> DataFrame:
    return _lines(stats.top_sales(auctions), "notable", 1, -F.col("price"), F.col("id"), _sale_line())


def flag_section(flags: DataFrame) -> DataFrame:
    """The cheapest flags and their total; no lines without flags."""
    head = F.concat(_count(F.col("n")), F.lit(" listings priced implausibly low"))
    name = F.concat(text_or(F.col("piece_name"), "(untitled)"), F.when(F.col("url") == "", " — no link on file").otherwise(""))
    linked = F.when(F.col("url") != "", link_text(F.col("piece_name"), F.col("url"))).otherwise(name)
    line = F.concat(
        F.lit("- "), linked, F.lit(" — "), money(F.col("price")), F.col("native"), F.lit(" via "),
        text_or(F.col("source"), "unknown"), F.lit(". "), F.col("reason"), F.lit("."),
    )
    return union_all(
        [
            _lines(flags.agg(F.count("*").alias("n")).where("n > 0"), "flags", 0, F.lit(0), F.lit(""), head),
            _lines(cheapest_flags(flags), "flags", 1, F.col("price"), F.concat("type", "id"), line),
        ]
    )


def caveats(spark) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(_CAVEATS)), "at int, line string")
    return _lines(rows, "caveats", 1, F.col("at"), F.lit(""), F.concat(F.lit("- "), F.col("line")))


def digest(auctions: DataFrame, listings: DataFrame, flags: DataFrame, run_date: str) -> DataFrame:
    """All sections in order; a section without lines does not appear."""
    return union_all(
        [
            available(listings), trends(auctions, listings), new_section(listings, run_date), closed_section(listings, run_date),
            recent_section(auctions, run_date), notable_section(auctions), flag_section(flags), caveats(auctions.sparkSession),
        ]
    )


def headline(auctions: DataFrame, listings: DataFrame, flags: DataFrame, run_date: str) -> DataFrame:
    """The figures of a run in one row, and a short text made of them."""
    row = stats.stats_row(auctions, listings, run_date)
    recent = stats.recent_sales_summary(auctions, run_date).select(F.col("sales").alias("recent_sales"))
    flagged = flags.agg(F.count("*").alias("flags"))
    one = stats.one_row(row, recent, flagged)
    text = F.concat(
        F.col("date"), F.lit(": "), _count(F.col("activeDealerListings")), F.lit(" active listings, "),
        _count(F.col("newDealerListings1wk")), F.lit(" new / "), _count(F.col("closedDealerListings4wk")), F.lit(" closed, "),
        _count(F.col("recent_sales")), F.lit(" sales in 60 days (median "), money(F.col("recentSalesMedian")), F.lit(")"),
    )
    return one.select(
        "date", "auctionRecords", "activeDealerListings", "recent_sales", "recentSalesMedian", "newDealerListings1wk",
        "closedDealerListings4wk", "flags", text.alias("text"),
    )


def context(auctions: DataFrame, listings: DataFrame, run_date: str, k: int = 5) -> DataFrame:
    """The compact facts behind a summary: counts and the top new listings and recent sales."""
    fresh = stats.new_listings(listings, run_date).orderBy(F.coalesce("price", F.lit(0.0)).desc(), "id").limit(k)
    sold = stats.recent_sales(auctions, run_date).orderBy(F.col("price").desc(), "id").limit(k)
    # at most k rows each
    top_new = fresh.agg(F.to_json(F.sort_array(F.collect_list(F.struct((-F.coalesce("price", F.lit(0.0))).alias("order"), "id", "piece_name", "dealer")))).alias("top_new"))
    top_sold = sold.agg(F.to_json(F.sort_array(F.collect_list(F.struct((-F.col("price")).alias("order"), "id", "piece_name", "auction_house")))).alias("top_sold"))
    return stats.one_row(
        stats.stats_row(auctions, listings, run_date), stats.baseline_flag(auctions, run_date).select(F.col("is_baseline").alias("isBaselineRun")),
        top_new, top_sold,
    )
