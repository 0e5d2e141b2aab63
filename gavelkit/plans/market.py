"""Registered queries: prices, statistics, flags and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit.functions import fixed, numbers, text
from gavelkit.functions.dates import days_before
from gavelkit.operators import alerts, flags, stats
from gavelkit.operators.ranks import price_stats
from gavelkit.plans.adapters import (
    LISTINGS_SQL, RUN_DATE, SALES_SQL, SIGHTINGS_SQL, listings, median_sql, sales, sightings, stored, table, with_views,
)
from gavelkit.plans.registry import Registry

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _group_sql(view: str, key: str, price: str, default: str, where: str = "TRUE") -> str:
    return f"""
SELECT coalesce(nullif({key}, ''), '{default}') AS {key}, count(*) AS n, min({price}) AS min_price,
       {median_sql(price)} AS median_price, max({price}) AS max_price
FROM {view} WHERE {price} >= 50 AND {where} GROUP BY 1"""


@query(with_views(_group_sql("sales", "category", "sold_price_usd", "Uncategorized"), SALES_SQL))
def stats_by_category(spark, sf_dir):
    return stats.stats_by_category(sales(spark, sf_dir), "sold_price_usd")


@query(
    with_views(
        f"""
SELECT tag, count(*) AS n, min(asking_price_usd) AS min_price, {median_sql('asking_price_usd')} AS median_price,
       max(asking_price_usd) AS max_price
FROM (SELECT unnest(tags) AS tag, asking_price_usd FROM listings WHERE status = 'active' AND asking_price_usd >= 50)
GROUP BY tag HAVING count(*) >= 5""",
        LISTINGS_SQL,
    )
)
def stats_by_tag(spark, sf_dir):
    active = listings(spark, sf_dir).where(stats.is_active(F.col("status")))
    return stats.stats_by_tag(active, "asking_price_usd")


@query(
    with_views(
        f"""
SELECT coalesce(nullif(dealer, ''), 'Unknown') AS dealer, count(*) AS n, {median_sql('asking_price_usd')} AS median_price
FROM listings WHERE status = 'active' AND asking_price_usd >= 50 GROUP BY 1""",
        LISTINGS_SQL,
    )
)
def stats_by_dealer(spark, sf_dir):
    active = listings(spark, sf_dir).where(stats.is_active(F.col("status")))
    return stats.stats_by_dealer(active, "asking_price_usd")


_TOP_SQL = with_views(
    f"""
, priced AS (SELECT coalesce(nullif(dealer, ''), 'Unknown') AS dealer, asking_price_usd AS p
             FROM listings WHERE status = 'active' AND asking_price_usd >= 50),
ranked AS (SELECT dealer, row_number() OVER (ORDER BY count(*) DESC, dealer) AS r FROM priced GROUP BY dealer),
keyed AS (SELECT CASE WHEN r <= 20 THEN dealer
                      ELSE 'Other (' || ((SELECT count(*) FROM ranked) - 20) || ' additional dealers)' END AS dealer,
                 CASE WHEN r <= 20 THEN 0 ELSE 1 END AS is_other, p FROM priced JOIN ranked USING (dealer))
SELECT CAST(is_other AS BIGINT) AS is_other, dealer, count(*) AS n, {median_sql('p')} AS median_price
FROM keyed GROUP BY 1, 2""".lstrip(),
    LISTINGS_SQL,
)


@query(_TOP_SQL)
def top_n_with_other(spark, sf_dir):
    active = listings(spark, sf_dir).where(stats.is_active(F.col("status")))
    out = stats.top_dealers_with_other(active, "asking_price_usd")
    return out.withColumn("is_other", F.col("is_other").cast("bigint"))


_HIST = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS ord, '{label}' AS label, count(*) FILTER (sold_price_usd >= 50 AND sold_price_usd >= {low}"
    + (f" AND sold_price_usd < {high}" if high != float("inf") else "")
    + ") AS n FROM sales"
    for i, (label, low, high) in enumerate(fixed.PRICE_BANDS)
)


@query(with_views(_HIST, SALES_SQL))
def price_histogram(spark, sf_dir):
    return stats.price_histogram(sales(spark, sf_dir), "sold_price_usd")


@query(
    with_views(
        f"""
SELECT (SELECT count(*) FROM sales) AS auction_records, count(*) AS dealer_records,
       count(*) FILTER (status = 'active') AS active_listings,
       sum(CASE WHEN status = 'active' AND asking_price_usd >= 50 THEN asking_price_usd ELSE 0 END) AS asking_total,
       (SELECT {median_sql('asking_price_usd')} FROM listings WHERE status = 'active' AND asking_price_usd >= 50)
         AS asking_median
FROM listings""",
        SALES_SQL,
        LISTINGS_SQL,
    )
)
def market_totals(spark, sf_dir):
    return stats.market_totals(sales(spark, sf_dir), listings(spark, sf_dir))


@query(
    with_views(
        f"""
SELECT count(*) AS sales, {median_sql('sold_price_usd')} AS sale_median FROM sales
WHERE sold_price_usd >= 50 AND sale_date >= '{days_before(RUN_DATE, 60)}'""",
        SALES_SQL,
    )
)
def recent_sales(spark, sf_dir):
    return stats.recent_sales_summary(sales(spark, sf_dir), RUN_DATE)


@query(
    with_views(
        f"""
SELECT count(*) AS records, count(*) FILTER (first_captured >= '{days_before(RUN_DATE, 28)}') AS new_records,
       count(*) > 0 AND count(*) = count(*) FILTER (first_captured >= '{days_before(RUN_DATE, 28)}') AS is_baseline
FROM sales""",
        SALES_SQL,
    )
)
def baseline_flag(spark, sf_dir):
    return stats.baseline_flag(sales(spark, sf_dir), RUN_DATE)


@query(
    with_views(
        f"""
SELECT (SELECT count(*) FROM sales WHERE first_captured >= '{days_before(RUN_DATE, 28)}') AS captured_4wk,
       (SELECT count(*) FROM sales WHERE sale_date >= '{days_before(RUN_DATE, 60)}') AS sold_60d,
       count(*) FILTER (first_seen >= '{days_before(RUN_DATE, 7)}') AS new_1wk,
       count(*) FILTER (status = 'inactive' AND last_seen >= '{days_before(RUN_DATE, 28)}') AS closed_4wk
FROM listings""",
        SALES_SQL,
        LISTINGS_SQL,
    )
)
def recent_window_filters(spark, sf_dir):
    return stats.window_counts(sales(spark, sf_dir), listings(spark, sf_dir), RUN_DATE)


@query(
    with_views(
        """
SELECT id, piece_name, category, auction_house, sale_date, sold_price_usd AS price FROM sales
WHERE sold_price_usd >= 50 ORDER BY sold_price_usd DESC, id LIMIT 5""",
        SALES_SQL,
    )
)
def top_sales(spark, sf_dir):
    out = stats.top_sales(sales(spark, sf_dir))
    return out.select("id", "piece_name", "category", "auction_house", "sale_date", "price")


@query(
    with_views(
        f"""
, fresh AS (SELECT * FROM listings WHERE first_seen >= '{days_before(RUN_DATE, 7)}')
SELECT id, dealer, first_seen, CASE WHEN asking_price_usd >= 50 THEN asking_price_usd END AS price,
       greatest((SELECT count(*) FROM fresh) - 20, 0) AS overflow
FROM fresh ORDER BY coalesce(CASE WHEN asking_price_usd >= 50 THEN asking_price_usd END, 0) DESC, id LIMIT 20""",
        LISTINGS_SQL,
    )
)
def new_listings_top(spark, sf_dir):
    return stats.new_listings_top(listings(spark, sf_dir), RUN_DATE).select(
        "id", "dealer", "first_seen", "price", "overflow"
    )


@query(
    with_views(
        f"""
SELECT id, dealer, first_seen, last_seen, CASE WHEN asking_price_usd >= 50 THEN asking_price_usd END AS price
FROM listings WHERE status = 'inactive' AND last_seen >= '{days_before(RUN_DATE, 28)}'""",
        LISTINGS_SQL,
    )
)
def closed_listings(spark, sf_dir):
    out = stats.closed_listings(listings(spark, sf_dir), RUN_DATE)
    return out.select("id", "dealer", "first_seen", "last_seen", "price").orderBy(F.col("last_seen").desc(), "id")


def _series(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    month = F.substring(F.col("o_orderdate").cast("date").cast("string"), 1, 7)
    return orders.groupBy(month.alias("date")).agg(
        F.count("*").alias("auctionRecords"),
        F.countDistinct("o_custkey").alias("dealerRecords"),
        F.max("o_totalprice").alias("recentSalesMedian"),
    )


_SERIES_SQL = """
series AS (SELECT strftime(o_orderdate, '%Y-%m') AS date, count(*) AS auctionRecords,
                  count(DISTINCT o_custkey) AS dealerRecords, max(o_totalprice) AS recentSalesMedian
           FROM orders GROUP BY 1)"""


@query(
    with_views(
        """
, merged AS (SELECT * FROM series WHERE date <> '2001-07'
             UNION ALL SELECT '2001-07', 1, 2, 3.0::DOUBLE)
SELECT date, auctionRecords, dealerRecords, recentSalesMedian FROM merged ORDER BY date DESC LIMIT 26""",
        _SERIES_SQL,
    )
)
def stats_series_keep_last(spark, sf_dir):
    series = _series(spark, sf_dir)
    row = series.where(F.col("date") == "2001-07").select(
        "date",
        F.lit(1).cast("bigint").alias("auctionRecords"),
        F.lit(2).cast("bigint").alias("dealerRecords"),
        F.lit(3.0).alias("recentSalesMedian"),
    )
    return stats.upsert_series(series, row)


@query(
    with_views(
        """
SELECT date, auctionRecords, recentSalesMedian,
       auctionRecords - lag(auctionRecords) OVER (ORDER BY date) AS auctionRecords_delta,
       recentSalesMedian - lag(recentSalesMedian) OVER (ORDER BY date) AS recentSalesMedian_delta
FROM series""",
        _SERIES_SQL,
    )
)
def stats_delta(spark, sf_dir):
    return stats.series_delta(_series(spark, sf_dir), ["auctionRecords", "recentSalesMedian"])


@query(
    with_views(
        f"""
, a AS (SELECT tag, count(*) AS sold_n, {median_sql('p')} AS sold_median
        FROM (SELECT unnest(tags) AS tag, sold_price_usd AS p FROM sales WHERE sold_price_usd >= 50)
        GROUP BY tag HAVING count(*) >= 5),
b AS (SELECT tag, count(*) AS ask_n, {median_sql('p')} AS ask_median
      FROM (SELECT unnest(tags) AS tag, asking_price_usd AS p FROM listings
            WHERE asking_price_usd >= 50 AND status = 'active') GROUP BY tag HAVING count(*) >= 5)
SELECT coalesce(a.tag, b.tag) AS tag, sold_n, sold_median, ask_n, ask_median, ask_median - sold_median AS spread
FROM a FULL JOIN b ON a.tag = b.tag""",
        SALES_SQL,
        LISTINGS_SQL,
    )
)
def ask_vs_sold_spread(spark, sf_dir):
    return stats.ask_vs_sold(sales(spark, sf_dir), listings(spark, sf_dir))


@query(
    with_views(
        f"""
SELECT date, count(*) AS pieces, count(price) FILTER (price > 0) AS priced,
       CASE WHEN count(price) > 0 THEN {median_sql('price')} END AS median_price, max(price) AS max_price
FROM sightings GROUP BY date""",
        SIGHTINGS_SQL,
    )
)
def scan_trend(spark, sf_dir):
    return stats.scan_trend(sightings(spark, sf_dir))


@query(
    with_views(
        "SELECT price_type, count(*) AS n, count(*) FILTER (price >= 50) AS priced FROM sightings GROUP BY 1",
        SIGHTINGS_SQL,
    )
)
def price_type_mix(spark, sf_dir):
    return stats.price_type_mix(sightings(spark, sf_dir))


def _pct_sql(p: int) -> str:
    return f"least(n - 1, CAST(floor(({p} / 100.0)::DOUBLE * n) AS BIGINT)) + 1"


@query(
    with_views(
        f"""
, r AS (SELECT category, sold_price_usd AS p, count(*) OVER (PARTITION BY category) AS n,
               row_number() OVER (PARTITION BY category ORDER BY sold_price_usd) AS rn
        FROM sales WHERE sold_price_usd >= 50)
SELECT category, max(n) AS n, max(p) FILTER (rn = {_pct_sql(5)}) AS p5, max(p) FILTER (rn = {_pct_sql(15)}) AS p15,
       max(p) FILTER (rn = {_pct_sql(90)}) AS p90
FROM r GROUP BY category""",
        SALES_SQL,
    )
)
def percentile_floor_rank(spark, sf_dir):
    rows = sales(spark, sf_dir).withColumn("p", numbers.plausible(F.col("sold_price_usd")))
    return price_stats(rows, ["category"], "p", (5, 15, 90)).select("category", "n", "p5", "p15", "p90")


def _flag_sql(view: str, price: str, source: str, kind: str, native: str, where: str, tag: str) -> str:
    return f"""
{tag}p AS (SELECT *, coalesce(nullif(category, ''), 'other') AS cat, {price} AS px FROM {view} WHERE {price} >= 50 AND {where}),
{tag}r AS (SELECT cat, px, count(*) OVER (PARTITION BY cat) AS n, row_number() OVER (PARTITION BY cat ORDER BY px) AS rn FROM {tag}p),
{tag}c AS (SELECT cat, max(n) AS n, {median_sql('px')} AS med, max(px) FILTER (rn = {_pct_sql(15)}) AS fl FROM {tag}r GROUP BY cat),
{tag}g AS (SELECT max(px) AS gf FROM (SELECT px, count(*) OVER () AS n, row_number() OVER (ORDER BY px) AS rn FROM {tag}p)
           WHERE rn = {_pct_sql(5)}),
{tag}f AS (
  SELECT id, '{kind}' AS type, piece_name, cat AS category, px AS price, coalesce({source}, '') AS source,
         listing_url AS url, {native} AS native, 'price_anomaly' AS flag,
         CASE WHEN n >= 12 AND px <= fl AND px < med * 0.25::DOUBLE
              THEN '$' || format('{{:,}}', CAST(px AS BIGINT)) || ' is well below the typical range for "' || cat || '" ('
                   || n || ' comparable {kind} records, median $' || format('{{:,}}', CAST(med AS BIGINT)) || ')'
              WHEN px <= gf
              THEN '$' || format('{{:,}}', CAST(px AS BIGINT)) || ' is in the bottom 5% of all {kind} prices on file, regardless of category'
         END AS reason
  FROM {tag}p JOIN {tag}c USING (cat) CROSS JOIN {tag}g)"""


_SALE_NATIVE = (
    "CASE WHEN currency_note <> 'USD' THEN ' (' || currency_note || ' ' || "
    "format('{:,}', CAST(floor(sold_price + 0.5::DOUBLE) AS BIGINT)) || ')' ELSE '' END"
)
FLAGS_SQL = (
    _flag_sql("sales", "sold_price_usd", "auction_house", "auction", _SALE_NATIVE, "TRUE", "a"),
    _flag_sql("listings", "asking_price_usd", "dealer", "dealer", "''", "status IS DISTINCT FROM 'inactive'", "d"),
    "flags AS (SELECT * FROM af WHERE reason IS NOT NULL UNION ALL SELECT * FROM df WHERE reason IS NOT NULL)",
)


@query(with_views("SELECT * FROM flags", SALES_SQL, LISTINGS_SQL, *FLAGS_SQL))
def price_anomaly_flags(spark, sf_dir):
    return flags.market_flags(*stored(spark, sf_dir))


@query(
    with_views(
        "SELECT id, type, price, source, reason FROM flags ORDER BY price, type, id LIMIT 10",
        SALES_SQL, LISTINGS_SQL, *FLAGS_SQL,
    )
)
def cheapest_flags(spark, sf_dir):
    found = flags.market_flags(*stored(spark, sf_dir))
    return flags.cheapest_flags(found).select("id", "type", "price", "source", "reason")


_ALERT_DAY = "2001-03-05"


def _alert_rows(spark, sf_dir):
    # dealers whose key ends in 3 are given one common first day, as a first import would
    rows = listings(spark, sf_dir)
    return rows.withColumn("first_seen", F.when(F.col("source").endswith("3"), _ALERT_DAY).otherwise(F.col("first_seen")))


@query(
    with_views(
        f"""
, x AS (SELECT * REPLACE (CASE WHEN source LIKE '%3' THEN '{_ALERT_DAY}' ELSE first_seen END AS first_seen)
        FROM listings WHERE status = 'active'),
w AS (SELECT *, count(*) OVER (PARTITION BY dealer) AS n, min(first_seen) OVER (PARTITION BY dealer) AS lo,
             max(first_seen) OVER (PARTITION BY dealer) AS hi FROM x)
SELECT id, piece_name, dealer, asking_price_usd AS alert_price FROM w
WHERE first_seen = '{_ALERT_DAY}' AND asking_price_usd >= 5000
  AND NOT (n > 10 AND lo = '{_ALERT_DAY}' AND hi = '{_ALERT_DAY}')""",
        LISTINGS_SQL,
    )
)
def new_listing_alert(spark, sf_dir):
    out = alerts.new_today(_alert_rows(spark, sf_dir), _ALERT_DAY)
    return out.select("id", "piece_name", "dealer", "alert_price")


@query(
    with_views(
        f"""
, hit AS (SELECT * FROM listings WHERE status = 'active' AND first_seen = '{_ALERT_DAY}' AND asking_price_usd >= 5000)
SELECT id, asking_price_usd AS alert_price,
       piece_name || ' — $' || format('{{:,}}', CAST(asking_price_usd AS BIGINT)) || ' via '
         || coalesce(nullif(dealer, ''), 'unknown dealer') AS line,
       (SELECT count(*) FROM hit) AS total, greatest((SELECT count(*) FROM hit) - 15, 0) AS overflow
FROM hit ORDER BY asking_price_usd DESC, id LIMIT 15""",
        LISTINGS_SQL,
    )
)
def alert_lines(spark, sf_dir):
    hits = alerts.new_today(listings(spark, sf_dir), _ALERT_DAY)
    return alerts.alert_lines(hits, _ALERT_DAY, fixed.ALERT_THRESHOLD)


@query(
    with_views(
        """
SELECT id, currency_note, sold_price, sold_price_usd FROM sales WHERE sold_price IS NOT NULL""", SALES_SQL)
)
def fx_to_usd(spark, sf_dir):
    rows = sales(spark, sf_dir).where(F.col("sold_price").isNotNull())
    return rows.select("id", "currency_note", "sold_price", "sold_price_usd")
