"""Market views over the benchmark tables, as DataFrames and as SQL.

``sales`` (orders, customer, nation) plays the table of completed sales, ``listings``
(lineitem, part, supplier) the table of current listings, ``sightings`` (events) the log of
dated scans. The SQL text states the same views for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.dates import day_text
from gavelkit.functions.fx import usd_price
from gavelkit.functions.text import rule_tags, tags_of, with_decade
from gavelkit.session import pinned, spread

RUN_DATE = "2001-08-01"
RUN_YEAR = 2001
SCAN_DATE = "2024-01-30"
CURRENCIES = ["USD", "GBP", "CHF", "EUR", "HKD"]

# tag rules in the words of the benchmark tables
DEMO_TAGS = [
    ("Motion", r"gear|bolt|\brod\b"),
    ("Forge", r"plate|anvil"),
    ("Jewel", r"\bring\b|gizmo"),
    ("Cold", r"\bcold\b"),
    ("Home", r"household|furniture|\blarge\b"),
    ("Works", r"machinery|building|\bnew\b"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, rows: int | None = None, by: str | None = None) -> DataFrame:
    """A table for costly work per row: parsing, patterns, long texts; ``rows`` bounds what one task gets."""
    return spread(table(spark, sf_dir, name), rows, by)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread_table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    raw = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    currency = F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), F.col("n_regionkey") + 1)
    day = day_text(F.col("o_orderdate"))
    sold = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    name = F.concat(F.lower("c_mktsegment"), F.lit(" lot "), F.col("o_orderkey").cast("string"))
    era = F.substring(day, 1, 4)
    return raw.select(
        F.col("o_orderkey").cast("string").alias("id"),
        name.alias("piece_name"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).otherwise("").alias("category"),
        era.alias("era_or_year"),
        F.lit(None).cast("string").alias("materials_gemstones"),
        F.when(sold.isNotNull(), "hammer").otherwise("estimate").alias("price_type"),
        sold.alias("sold_price"),
        F.when(F.col("o_orderkey") % 3 != 0, F.floor(F.col("o_totalprice") * 0.8).cast("double")).alias("estimate_low"),
        F.when(F.col("o_orderkey") % 4 != 0, F.floor(F.col("o_totalprice") * 1.2).cast("double")).alias("estimate_high"),
        currency.alias("currency_note"),
        day.alias("sale_date"),
        F.col("c_mktsegment").alias("auction_house"),
        F.concat(F.lit("Sale "), era).alias("sale_name"),
        F.col("o_custkey").cast("string").alias("lot_number"),
        F.concat(F.lit("https://www.sales.example.com/lot/"), F.col("o_orderkey").cast("string")).alias("listing_url"),
        F.col("c_name").alias("notes"),
        tags_of(name, era, DEMO_TAGS).alias("tags"),
        usd_price(sold, currency, day, RUN_YEAR).alias("sold_price_usd"),
        F.col("c_mktsegment").alias("source"),
        day.alias("first_captured"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spread_table(spark, sf_dir, "lineitem")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    # a part has many lines, so the rules are tried once a part
    part = part.withColumn("name_tags", rule_tags(F.col("p_name"), DEMO_TAGS))
    raw = line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    seen = F.col("l_shipdate").cast("date")
    price = F.when(F.col("l_quantity") == 1, F.lit(1.0)).otherwise(F.col("l_extendedprice"))
    era = F.substring(seen.cast("string"), 1, 4)
    site = F.concat(F.lit("https://www.dealer"), F.col("l_suppkey").cast("string"), F.lit(".example.com/item/"), key)
    return raw.select(
        key.alias("id"),
        F.col("p_name").alias("piece_name"),
        F.when(F.col("l_linenumber") != 7, F.col("p_type")).otherwise("").alias("category"),
        era.alias("era_or_year"),
        F.lit(None).cast("string").alias("materials_gemstones"),
        F.lit("asking").alias("price_type"),
        price.alias("asking_price"),
        F.lit("USD").alias("currency_note"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("s_name")).otherwise("").alias("dealer"),
        site.alias("listing_url"),
        F.concat(site, F.lit(".jpg")).alias("image_url"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("p_brand").alias("notes"),
        with_decade(F.col("name_tags"), era).alias("tags"),
        usd_price(price, F.lit("USD"), seen.cast("string"), RUN_YEAR).alias("asking_price_usd"),
        F.col("s_name").alias("source"),
        seen.cast("string").alias("first_seen"),
        F.date_add(seen, F.col("l_quantity").cast("int")).cast("string").alias("last_seen"),
        F.lit(1).alias("times_seen"),
        F.when(F.col("l_linestatus") == "O", "active").otherwise("inactive").alias("status"),
    )


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both stores written out once, for jobs that read them many times."""
    return pinned(sales(spark, sf_dir), "sales"), pinned(listings(spark, sf_dir), "listings")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("id"),
        day_text(F.col("ts")).alias("date"),
        F.col("event_id").alias("pos"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("price"),
        F.concat(F.lit("piece "), F.col("user_id").cast("string")).alias("piece_name"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("category"),
        F.lit(None).cast("string").alias("era_or_year"),
        F.lit(None).cast("string").alias("materials_gemstones"),
        F.when(F.col("event_id") % 2 == 0, "asking").otherwise("hammer").alias("price_type"),
        F.col("event_type").alias("source_site"),
        F.lit(None).cast("string").alias("listing_url"),
        F.when(F.col("event_id") % 3 == 0, F.col("props")).alias("notes"),
    )


# --- the same views in SQL ----------------------------------------------------
_FX_ROWS = ", ".join(f"('{c}', {y}, {r}::DOUBLE)" for c, t in fixed.FX_RATES.items() for y, r in t.items())


def demo_tags_sql(text: str, era: str) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({text}, '{p}', 'i') THEN '{t}' END" for t, p in DEMO_TAGS)
    decade = (
        f"CASE WHEN regexp_matches({era}, '\\b(19[4-9]\\d)s?\\b') "
        f"THEN substr(regexp_extract({era}, '\\b(19[4-9]\\d)s?\\b', 1), 1, 3) || '0s' END"
    )
    return f"list_filter([{parts}, {decade}], lambda x: x IS NOT NULL)"


SALES_SQL = f"""
fx(currency, fx_year, rate) AS (VALUES {_FX_ROWS}),
sales_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         lower(c_mktsegment) || ' lot ' || CAST(o_orderkey AS VARCHAR) AS piece_name,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority ELSE '' END AS category,
         strftime(o_orderdate, '%Y') AS era_or_year,
         CASE WHEN o_orderstatus <> 'P' THEN 'hammer' ELSE 'estimate' END AS price_type,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS sold_price,
         CASE WHEN o_orderkey % 3 <> 0 THEN floor(o_totalprice * 0.8::DOUBLE) END AS estimate_low,
         CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice * 1.2::DOUBLE) END AS estimate_high,
         ['USD', 'GBP', 'CHF', 'EUR', 'HKD'][n_regionkey + 1] AS currency_note,
         strftime(o_orderdate, '%Y-%m-%d') AS sale_date,
         CAST(year(o_orderdate) AS INTEGER) AS sale_year,
         c_mktsegment AS auction_house,
         'Sale ' || strftime(o_orderdate, '%Y') AS sale_name,
         CAST(o_custkey AS VARCHAR) AS lot_number,
         'https://www.sales.example.com/lot/' || CAST(o_orderkey AS VARCHAR) AS listing_url,
         c_name AS notes
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
sale_rate AS (
  SELECT currency_note, sale_year, arg_min(rate, abs(fx_year - sale_year) * 10000 + fx_year) AS rate
  FROM (SELECT DISTINCT currency_note, sale_year FROM sales_raw) JOIN fx ON currency_note = currency GROUP BY ALL),
sales AS (
  SELECT s.*, {demo_tags_sql('s.piece_name', 's.era_or_year')} AS tags,
         CASE WHEN s.currency_note = 'USD' THEN floor(sold_price + 0.5::DOUBLE)
              ELSE floor(sold_price * rate + 0.5::DOUBLE) END AS sold_price_usd,
         sale_date AS first_captured
  FROM sales_raw s LEFT JOIN sale_rate r ON s.currency_note = r.currency_note AND s.sale_year = r.sale_year)
"""

LISTINGS_SQL = f"""
listings_raw AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id,
         p_name AS piece_name,
         CASE WHEN l_linenumber <> 7 THEN p_type ELSE '' END AS category,
         strftime(l_shipdate, '%Y') AS era_or_year,
         'asking' AS price_type,
         CASE WHEN l_quantity = 1 THEN 1.0::DOUBLE ELSE l_extendedprice END AS asking_price,
         'USD' AS currency_note,
         CASE WHEN l_suppkey % 13 <> 0 THEN s_name ELSE '' END AS dealer,
         'https://www.dealer' || l_suppkey || '.example.com/item/'
           || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS listing_url,
         CAST(l_partkey AS VARCHAR) AS sku,
         p_brand AS notes,
         s_name AS source,
         strftime(l_shipdate, '%Y-%m-%d') AS first_seen,
         strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%d') AS last_seen,
         CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'inactive' END AS status
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
listings AS (
  SELECT l.*, {demo_tags_sql('l.piece_name', 'l.era_or_year')} AS tags,
         floor(asking_price + 0.5::DOUBLE) AS asking_price_usd
  FROM listings_raw l)
"""

SIGHTINGS_SQL = """
sightings AS (
  SELECT user_id || '|' || event_type AS id, strftime(ts, '%Y-%m-%d') AS date, event_id AS pos,
         CASE WHEN event_id % 7 <> 0 THEN value END AS price,
         'piece ' || user_id AS piece_name,
         CASE WHEN event_id % 5 <> 0 THEN event_type END AS category,
         CASE WHEN event_id % 2 = 0 THEN 'asking' ELSE 'hammer' END AS price_type,
         event_type AS source_site,
         CASE WHEN event_id % 3 = 0 THEN props END AS notes
  FROM events)
"""


def median_sql(x: str) -> str:
    """The exact median of even groups is the rounded mean of the middle values."""
    return f"CASE WHEN count({x}) % 2 = 1 THEN median({x}) ELSE floor(median({x}) + 0.5::DOUBLE) END"


def with_views(select: str, *views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n" + select
