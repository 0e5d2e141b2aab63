"""Registered queries: the digest and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit.functions.dates import days_before
from gavelkit.operators import digest, flags, stats
from gavelkit.plans.adapters import LISTINGS_SQL, RUN_DATE, SALES_SQL, listings, median_sql, sales, stored, with_views
from gavelkit.plans.market import FLAGS_SQL
from gavelkit.plans.registry import Registry
from gavelkit.plans.texts import comma_sql

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


_FIGURES = f"""
figures AS (
  SELECT (SELECT count(*) FROM sales) AS auctionRecords, count(*) AS dealerRecords,
         count(*) FILTER (status = 'active') AS activeDealerListings,
         count(*) FILTER (first_seen >= '{days_before(RUN_DATE, 7)}') AS newDealerListings1wk,
         count(*) FILTER (status = 'inactive' AND last_seen >= '{days_before(RUN_DATE, 28)}') AS closedDealerListings4wk,
         (SELECT {median_sql('asking_price_usd')} FROM listings WHERE status = 'active' AND asking_price_usd >= 50) AS dealerAskingMedian,
         (SELECT {median_sql('sold_price_usd')} FROM sales WHERE sold_price_usd >= 50 AND sale_date >= '{days_before(RUN_DATE, 60)}') AS recentSalesMedian,
         (SELECT count(*) FROM sales WHERE sold_price_usd >= 50 AND sale_date >= '{days_before(RUN_DATE, 60)}') AS recent_sales
  FROM listings)"""


@query(with_views(f"SELECT '{RUN_DATE}' AS date, * EXCLUDE (recent_sales) FROM figures", SALES_SQL, LISTINGS_SQL, _FIGURES))
def stats_row(spark, sf_dir):
    return stats.stats_row(*stored(spark, sf_dir), RUN_DATE)


_N = lambda c: f"format('{{:,}}', {c})"


@query(
    with_views(
        f"""
SELECT '{RUN_DATE}' AS date, auctionRecords, activeDealerListings, recent_sales, recentSalesMedian, newDealerListings1wk,
       closedDealerListings4wk, (SELECT count(*) FROM flags) AS flags,
       '{RUN_DATE}: ' || {_N('activeDealerListings')} || ' active listings, ' || {_N('newDealerListings1wk')} || ' new / '
         || {_N('closedDealerListings4wk')} || ' closed, ' || {_N('recent_sales')} || ' sales in 60 days (median $'
         || {comma_sql('recentSalesMedian')} || ')' AS text
FROM figures""",
        SALES_SQL, LISTINGS_SQL, *FLAGS_SQL, _FIGURES,
    )
)
def digest_headline(spark, sf_dir):
    a, d = stored(spark, sf_dir)
    return digest.headline(a, d, flags.market_flags(a, d), RUN_DATE)


@query()
def digest_lines(spark, sf_dir):
    a, d = stored(spark, sf_dir)
    out = digest.digest(a, d, flags.market_flags(a, d), RUN_DATE)
    return out.orderBy("section_no", "part", "rank", "tie")


@query()
def digest_context(spark, sf_dir):
    return digest.context(*stored(spark, sf_dir), RUN_DATE)


def _money_row(*cells: str) -> str:
    return "'| ' || " + " || ' | ' || ".join(cells) + " || ' |'"


def _dollars(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'n/a' ELSE '$' || {comma_sql(x)} END"


@query(
    with_views(
        f"""
, r AS (SELECT *, CASE WHEN asking_price_usd >= 50 THEN asking_price_usd END AS price FROM listings
        WHERE status = 'inactive' AND last_seen >= '{days_before(RUN_DATE, 28)}')
SELECT 0 AS part, format('{{:,}}', count(*)) || ' listings delisted in the last 28 days' AS line FROM r
UNION ALL SELECT 1, {_money_row("'[' || piece_name || '](' || listing_url || ')'",
                                "upper(substr(coalesce(nullif(category, ''), 'other'), 1, 1)) || substr(coalesce(nullif(category, ''), 'other'), 2)",
                                "dealer", _dollars('price'), "first_seen")} FROM r""",
        LISTINGS_SQL,
    )
)
def digest_closed(spark, sf_dir):
    return digest.closed_section(listings(spark, sf_dir), RUN_DATE).select("part", "line")


@query(
    with_views(
        f"""
, r AS (SELECT * FROM sales WHERE sold_price_usd >= 50 AND sale_date >= '{days_before(RUN_DATE, 60)}'),
s AS (SELECT count(*) AS n, {median_sql('sold_price_usd')} AS m FROM r)
SELECT 0 AS part, format('{{:,}}', n) || ' sales in the last 60 days, median $' || {comma_sql('m')} AS line FROM s
UNION ALL SELECT 1, {_money_row("'[' || piece_name || '](' || listing_url || ')'", "auction_house", "sale_date",
      "'$' || " + comma_sql('sold_price_usd') + " || CASE WHEN currency_note <> 'USD' THEN ' (orig. ' || currency_note || ' ' || " + comma_sql('sold_price') + " || ')' ELSE '' END")} FROM r""",
        SALES_SQL,
    )
)
def digest_recent(spark, sf_dir):
    return digest.recent_section(sales(spark, sf_dir), RUN_DATE).select("part", "line")


@query(
    with_views(
        f"""
, a AS (SELECT 1 AS part, tag, sold_price_usd AS p FROM (SELECT unnest(tags) AS tag, sold_price_usd FROM sales WHERE sold_price_usd >= 50)
        UNION ALL SELECT 2, tag, asking_price_usd FROM (SELECT unnest(tags) AS tag, asking_price_usd FROM listings
                                                        WHERE status = 'active' AND asking_price_usd >= 50)),
t AS (SELECT part, tag, count(*) AS n, min(p) AS lo, {median_sql('p')} AS med, max(p) AS hi FROM a GROUP BY 1, 2 HAVING count(*) >= 5),
k AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY n DESC, tag) AS rn FROM t)
SELECT part, {_money_row('tag', 'CAST(n AS VARCHAR)', _dollars('lo'), _dollars('med'), _dollars('hi'))} AS line FROM k WHERE rn <= 15""",
        SALES_SQL,
        LISTINGS_SQL,
    )
)
def digest_trends(spark, sf_dir):
    return digest.trends(*stored(spark, sf_dir)).select("part", "line")
