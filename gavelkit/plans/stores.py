"""Registered queries: stores, lifecycle, catalog, result pages, browse view."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.operators import browse, catalog, flags, ingest, paging, store
from gavelkit.plans.adapters import (
    DEMO_TAGS, LISTINGS_SQL, SALES_SQL, SCAN_DATE, SIGHTINGS_SQL, demo_tags_sql, listings, sales, sightings, stored,
    table, with_views,
)
from gavelkit.plans.market import FLAGS_SQL
from gavelkit.plans.registry import Registry
from gavelkit.session import pinned, work_path
from gavelkit.sources import stores
from gavelkit.sources.arrays import write_arrays

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def last_sql(f: str) -> str:
    return f"arg_max({f}, date || lpad(CAST(pos AS VARCHAR), 20, '0')) FILTER ({f} IS NOT NULL)"


# --- catalog --------------------------------------------------------------------
_CATALOG_SQL = f"""
cat AS (
  SELECT id, {last_sql('piece_name')} AS piece_name, {last_sql('category')} AS category, {last_sql('price_type')} AS price_type,
         {last_sql('source_site')} AS source_site, {last_sql('notes')} AS notes,
         arg_min_null(price, date || lpad(CAST(pos AS VARCHAR), 20, '0')) AS first_price,
         {last_sql('price')} AS current_price, min(price) AS min_price, max(price) AS max_price,
         min(date) AS first_seen, max(date) AS last_seen, count(DISTINCT date) AS times_seen,
         CASE WHEN max(date) = (SELECT max(date) FROM sightings) THEN 'active' ELSE 'inactive' END AS status
  FROM sightings GROUP BY id)"""
_CATALOG_COLS = [
    "id", "piece_name", "category", "price_type", "source_site", "notes", "first_price", "current_price", "min_price",
    "max_price", "first_seen", "last_seen", "times_seen", "status",
]


@query(with_views("SELECT * FROM cat", SIGHTINGS_SQL, _CATALOG_SQL))
def catalog_fold(spark, sf_dir):
    return catalog.catalog_order(catalog.catalog(sightings(spark, sf_dir))).select(*_CATALOG_COLS)


@query(with_views("SELECT * FROM cat", SIGHTINGS_SQL, _CATALOG_SQL))
def catalog_incremental(spark, sf_dir):
    """Three lots of days, each folded on its own and merged into what was there, in an order that isn't that of time."""
    rows, part = sightings(spark, sf_dir), F.dayofmonth(F.col("date").cast("date"))
    kept = None
    for days in (part > 20, part <= 10, (part > 10) & (part <= 20)):
        new = catalog.day_fold(rows.where(days))
        kept = pinned(new if kept is None else catalog.merged_folds(kept, new), "catalog")
    return catalog.folded_catalog(kept).select(*_CATALOG_COLS)


@query(
    with_views(
        """
SELECT (SELECT count(*) FROM sightings) AS sightings, count(*) AS pieces, count(*) FILTER (status = 'active') AS active,
       count(*) FILTER (status <> 'active') AS inactive,
       count(*) FILTER (first_seen = (SELECT max(date) FROM sightings)) AS new_in_latest FROM cat""",
        SIGHTINGS_SQL,
        _CATALOG_SQL,
    )
)
def catalog_counters(spark, sf_dir):
    rows = sightings(spark, sf_dir)
    return catalog.catalog_counters(rows, catalog.catalog(rows))


@query(
    with_views(
        """
SELECT date AS date_pulled, CAST(row_number() OVER (PARTITION BY date ORDER BY pos) - 1 AS INTEGER) AS pos, piece_name, category,
       price AS asking_or_hammer_price, price_type, source_site, notes FROM sightings""",
        SIGHTINGS_SQL,
    )
)
def scan_snapshots(spark, sf_dir):
    """Sightings written as one array file a day, those of no day as one more, and read back; notes hold JSON themselves."""
    folder, undated = work_path(spark, "snapshots"), F.lit("undated")
    rows = sightings(spark, sf_dir).withColumnRenamed("price", "asking_or_hammer_price")
    write_arrays(rows.drop("id").withColumn("date", F.coalesce("date", undated)), "date", ["pos"], folder)
    back = stores.scan_snapshots(spark, folder)
    return back.select(F.nullif("date_pulled", undated).alias("date_pulled"), "pos", "piece_name", "category", "asking_or_hammer_price", "price_type", "source_site", "notes")


# --- merge and lifecycle ----------------------------------------------------------
_MID, _END = "2024-01-15", SCAN_DATE
_KEY = "date || lpad(CAST(pos AS VARCHAR), 20, '0')"
_UPSERT_SQL = f"""
, named AS (SELECT *, 'feed-' || (pos % 4) AS feed FROM sightings),
merged AS (
  SELECT id, {last_sql('piece_name')} AS piece_name, {last_sql('category')} AS category, {last_sql('notes')} AS notes,
         {last_sql('price')} AS sold_price, max(date) AS sale_date, arg_min(feed, {_KEY}) AS source,
         CASE WHEN min(date) <= '{_MID}' THEN '{_MID}' ELSE '{_END}' END AS first_captured
  FROM named GROUP BY id)
SELECT id, piece_name, category, notes, sold_price, sale_date, source, first_captured,
       CASE WHEN sold_price > 0 THEN floor(sold_price * 1.136::DOUBLE + 0.5::DOUBLE) END AS sold_price_usd,
       array_to_string({demo_tags_sql("(piece_name || ' ' || coalesce(notes, ''))", "''")}, '; ') AS tags
FROM merged"""


@query(with_views(_UPSERT_SQL, SIGHTINGS_SQL))
def store_upsert(spark, sf_dir):
    rows = sightings(spark, sf_dir)
    shaped = rows.select(
        "id", "piece_name", "category", "price_type", "notes", "pos", "date",
        F.col("price").alias("sold_price"),
        F.lit("CHF").alias("currency_note"),
        F.col("date").alias("sale_date"),
        F.col("source_site").alias("auction_house"),
        F.concat(F.lit("feed-"), (F.col("pos") % 4).cast("string")).alias("source"),
    )
    early, late = (_with_order(shaped.where(c)) for c in (F.col("date") <= _MID, F.col("date") > _MID))
    empty = spark.createDataFrame([], schemas.AUCTION)
    first = store.merge_auctions(empty, early, _MID, ["sale_date", "pos"], DEMO_TAGS)
    final = store.merge_auctions(first, late, _END, ["sale_date", "pos"], DEMO_TAGS)
    return final.select(
        "id", "piece_name", "category", "notes", "sold_price", "sale_date", "source", "first_captured",
        "sold_price_usd", F.array_join("tags", "; ").alias("tags"),
    )


def _with_order(rows):
    """Batch rows with every field of the shape and the position that orders them."""
    missing = [f for f in schemas.AUCTION.fields if f.name not in rows.columns]
    return rows.select(*rows.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


_LAST = "(SELECT max(date) FROM sightings)"


def _last_day(rows) -> str:
    """The newest scan day of the rows; of an empty table one that no row has."""
    return rows.agg(F.max("date")).first()[0] or "0000-00-00"


def _listing_rows(rows):
    """Sightings as rows of listing batches; ``date`` names the run."""
    shaped = rows.select(
        "id", "piece_name", "category", "price_type", "notes", "pos", "date",
        F.col("price").alias("asking_price"),
        F.lit("USD").alias("currency_note"),
        F.col("source_site").alias("dealer"),
        F.col("source_site").alias("source"),
    )
    missing = [f for f in schemas.LISTING.fields if f.name not in shaped.columns]
    return shaped.select(*shaped.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


@query(
    with_views(
        f"""
SELECT id, min(date) AS first_seen, max(date) AS last_seen, CAST(count(DISTINCT date) AS INTEGER) AS times_seen,
       CASE WHEN max(date) = {_LAST} THEN 'active' ELSE 'inactive' END AS status, {last_sql('price')} AS asking_price,
       {last_sql('notes')} AS notes
FROM sightings GROUP BY id""",
        SIGHTINGS_SQL,
    )
)
def listing_lifecycle(spark, sf_dir):
    rows = _listing_rows(sightings(spark, sf_dir))
    end = _last_day(rows)
    on = lambda d: rows.where(F.col("date") == d)
    # all scan days: those before the last in one merge, then the last one twice: it must not count again
    out = store.merge_listing_days(spark.createDataFrame([], schemas.LISTING), rows.where(F.col("date") < end), "date", ["pos"], DEMO_TAGS)
    for _ in range(2):
        out = store.mark_missing(store.merge_listings(out, on(end), end, ["pos"], DEMO_TAGS), end)
    return out.select("id", "first_seen", "last_seen", "times_seen", "status", "asking_price", "notes")


@query(
    with_views(
        f"""
, s AS (SELECT id, max(date) AS last_seen, min(source_site) AS source FROM sightings
        WHERE NOT (date = {_LAST} AND source_site = 'error') GROUP BY id)
SELECT id, last_seen, CASE WHEN last_seen = {_LAST} THEN 'active' ELSE 'inactive' END AS status_run,
       CASE WHEN last_seen = {_LAST} OR source = 'error' THEN 'active' ELSE 'inactive' END AS status_source
FROM s""",
        SIGHTINGS_SQL,
    )
)
def mark_inactive(spark, sf_dir):
    rows = _listing_rows(sightings(spark, sf_dir))
    end = _last_day(rows)
    first = store.merge_listing_days(spark.createDataFrame([], schemas.LISTING), rows.where(F.col("date") < end), "date", ["pos"])
    batch = rows.where((F.col("date") == end) & (F.col("source") != "error"))
    merged = store.merge_listings(first, batch, end, ["pos"])
    by_run = store.mark_missing(merged, end)
    both = store.mark_missing(
        by_run.withColumn("_by_run", F.col("status")).withColumn("status", F.lit("active")), end, batch
    )
    return both.select("id", "last_seen", F.col("_by_run").alias("status_run"), F.col("status").alias("status_source"))


_NORM_SQL = (
    "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)', 1)), '/+$', '')"
)


@query(
    f"""
WITH p AS (SELECT page_id, url, {_NORM_SQL} AS u FROM pages)
SELECT page_id, url FROM p WHERE u NOT IN (SELECT u FROM p WHERE page_id % 10 = 0)"""
)
def blocklist_anti(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    blocked = pages.where(F.col("page_id") % 10 == 0).select(
        F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("?seen=again")).alias("url")
    )
    return store.without_blocked(pages, blocked, "url")


# --- result pages -------------------------------------------------------------------
def _items(spark, sf_dir):
    """Every event type is a shop, every day a result page."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("shop"),
        F.dayofmonth("ts").cast("bigint").alias("page"),
        F.col("event_id").alias("pos"),
        F.col("user_id").alias("item_id"),
    )


_ITEMS_SQL = """
items AS (SELECT event_type AS shop, CAST(day(ts) AS BIGINT) AS page, event_id AS pos, user_id AS item_id FROM events),
firsts AS (SELECT *, min(page) OVER (PARTITION BY shop, item_id) AS p0 FROM items),
pages_ AS (SELECT shop, page, count(*) AS items, count(*) FILTER (page = p0) AS fresh, arg_min(item_id, pos) AS first_id
           FROM firsts GROUP BY shop, page)"""


@query(with_views("SELECT * FROM pages_", _ITEMS_SQL))
def fresh_items_by_page(spark, sf_dir):
    return paging.page_counts(_items(spark, sf_dir))


@query(
    with_views(
        """
SELECT shop, item_id, min(page) AS page, min(pos) AS pos FROM items GROUP BY shop, item_id""", _ITEMS_SQL)
)
def first_sighting_of_item(spark, sf_dir):
    return paging.first_sightings(_items(spark, sf_dir))


@query(
    with_views(
        """
, g AS (SELECT shop, page, items, fresh, CAST(first_id % 10 AS BIGINT) AS first_id FROM pages_),
l AS (SELECT *, coalesce(first_id = lag(first_id) OVER (PARTITION BY shop ORDER BY page), false) AS stalled FROM g)
SELECT *, bool_or(stalled) OVER (PARTITION BY shop ORDER BY page) AS dropped FROM l""",
        _ITEMS_SQL,
    )
)
def stalled_pages(spark, sf_dir):
    pages = paging.page_counts(_items(spark, sf_dir)).withColumn("first_id", F.col("first_id") % 10)
    return paging.stalled_pages(pages)


@query(
    with_views(
        """
, f AS (SELECT *, fresh = 0 OR items < 40 AS stop FROM pages_),
e AS (SELECT *, coalesce(bool_or(stop) OVER (PARTITION BY shop ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
             AS ended FROM f)
SELECT shop, page, items, fresh, first_id, stop, NOT ended AND fresh > 0 AND page <= 25 AS kept,
       NOT ended AND NOT stop AND page = 25 AS truncated FROM e""",
        _ITEMS_SQL,
    )
)
def page_stop_rule(spark, sf_dir):
    pages = paging.page_counts(_items(spark, sf_dir))
    return paging.stop_pages(pages, page_limit=40, max_pages=25)


@query(
    with_views(
        """
, r AS (SELECT source_site AS source, piece_name, pos, category IS NOT NULL AND price > 400 AS matched, pos % 2 = 0 AS added
        FROM sightings),
c AS (SELECT source, count(*) AS seen, count(*) FILTER (matched) AS matched, count(*) FILTER (added) AS added FROM r GROUP BY 1),
s AS (SELECT source, string_agg(piece_name, '; ' ORDER BY pos) AS sample FROM (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY pos) AS rn FROM r WHERE matched) WHERE rn <= 8 GROUP BY 1)
SELECT c.source, seen, matched, added, CAST(matched AS DOUBLE) / seen AS match_rate,
       CAST(matched AS DOUBLE) / seen > 0.15::DOUBLE AS suspicious,
       CASE WHEN CAST(matched AS DOUBLE) / seen > 0.15::DOUBLE THEN sample END AS sample
FROM c LEFT JOIN s USING (source)""",
        SIGHTINGS_SQL,
    )
)
def ingest_summary(spark, sf_dir):
    rows = sightings(spark, sf_dir).select(
        F.col("source_site").alias("source"), "piece_name", "pos",
        F.coalesce(F.col("category").isNotNull() & (F.col("price") > 400), F.lit(False)).alias("matched"),
        (F.col("pos") % 2 == 0).alias("added"),
    )
    return ingest.ingest_summary(rows)


@query("SELECT user_id, arg_max(props, event_id) AS props FROM events GROUP BY user_id")
def last_wins_lookup(spark, sf_dir):
    return ingest.last_wins(table(spark, sf_dir, "events"), "user_id", "props", "event_id")


@query(
    """
SELECT s_suppkey, s_name, coalesce(n_name, CAST(s_nationkey AS VARCHAR)) AS dealer
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey"""
)
def registry_join(spark, sf_dir):
    names = table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 2)
    registry = names.select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("k"))
    return ingest.with_default_name(rows, registry, "k", "dealer").select("s_suppkey", "s_name", "dealer")


@query(
    """
SELECT user_id AS domain, arg_min(event_type, o) FILTER (found > 0) AS platform, arg_min(found, o) FILTER (found > 0) AS found,
       arg_min(brand, o) FILTER (found > 0) AS brand, count(*) FILTER (found > 0) AS hits
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) - 60 AS found, value > 100 AS brand, event_id AS o FROM events)
GROUP BY user_id"""
)
def first_hit_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    probes = e.select(
        F.col("user_id").alias("domain"), F.col("event_type").alias("platform"), F.col("event_id").alias("probe_order"),
        (F.from_json("props", "k BIGINT")["k"] - 60).alias("found"), (F.col("value") > 100).alias("brand"),
    )
    return ingest.first_hit(probes)


@query(
    """
SELECT o_orderkey, c_name AS seller, n_name AS profile, r_name AS company
FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 9 <> 0
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 7 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def ref_hop_join(spark, sf_dir):
    # all records live in one page's object store; each hop follows a key like Nation:7
    orders, customer, nation, region = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    key = lambda kind, c: F.base64(F.encode(F.concat(F.lit(kind + ":"), F.col(c).cast("string")), "UTF-8"))
    one = F.lit(1).alias("page_id")
    rows = orders.select(one, "o_orderkey", key("Seller", "o_custkey").alias("seller_ref"))
    sellers = customer.where("c_custkey % 9 <> 0").select(
        one, key("Seller", "c_custkey").alias("key"), "c_name", key("Nation", "c_nationkey").alias("ref")
    )
    profiles = nation.where("n_nationkey % 7 <> 0").select(
        one, key("Nation", "n_nationkey").alias("key"), "n_name", key("Region", "n_regionkey").alias("ref")
    )
    companies = region.select(one, key("Region", "r_regionkey").alias("key"), "r_name")
    out = ingest.pointer_hop(rows, sellers, "seller_ref", {"c_name": "seller", "ref": "profile_ref"})
    out = ingest.pointer_hop(out, profiles, "profile_ref", {"n_name": "profile", "ref": "company_ref"})
    out = ingest.pointer_hop(out, companies, "company_ref", {"r_name": "company"})
    return out.select("o_orderkey", "seller", "profile", "company")


# --- browse -----------------------------------------------------------------------------
_BROWSE_SQL = """
browse AS (
  SELECT id, 'auction' AS type, sale_date AS date, piece_name, coalesce(nullif(category, ''), 'other') AS category,
         era_or_year, '' AS materials_gemstones, auction_house AS source, sale_name, lot_number, price_type,
         CASE WHEN sold_price_usd > 0 THEN sold_price_usd END AS price,
         CASE WHEN currency_note <> 'USD' THEN sold_price END AS native_amount,
         CASE WHEN currency_note <> 'USD' THEN currency_note ELSE '' END AS native_currency, estimate_low, estimate_high,
         currency_note AS currency,
         CASE WHEN sold_price > 0 THEN 'Sold' WHEN estimate_low > 0 OR estimate_high > 0 THEN 'Estimate only' ELSE 'Unknown' END AS status,
         listing_url, '' AS image_url, notes, tags FROM sales
  UNION ALL
  SELECT id, 'dealer', first_seen, piece_name, coalesce(nullif(category, ''), 'other'), era_or_year, '',
         coalesce(nullif(dealer, ''), 'Unknown dealer'), '', sku, price_type, asking_price_usd, NULL, '', NULL, NULL, 'USD',
         CASE WHEN status = 'active' THEN 'For sale' ELSE 'Delisted' END, listing_url, listing_url || '.jpg', notes, tags
  FROM listings)"""
_FLAT = "* REPLACE (array_to_string(tags, '; ') AS tags)"
_B = (SALES_SQL, LISTINGS_SQL, _BROWSE_SQL)


def _browse(spark, sf_dir):
    return browse.browse_union(sales(spark, sf_dir), listings(spark, sf_dir))


def _flat(df):
    return df.withColumn("tags", F.array_join("tags", "; "))


@query(with_views(f"SELECT {_FLAT} FROM browse", *_B))
def browse_union(spark, sf_dir):
    return _flat(_browse(spark, sf_dir))


@query(
    with_views(
        f"""
SELECT {_FLAT} FROM browse WHERE type = 'dealer' AND status = 'For sale' AND category = 'PROMO' AND list_contains(tags, 'Forge')
AND contains(lower(concat_ws(' ', piece_name, source, materials_gemstones, notes, lot_number, sale_name)), 'old')""",
        *_B,
    )
)
def browse_filter(spark, sf_dir):
    f = browse.BrowseFilter(type="dealer", status="For sale", category="PROMO", tag="Forge", text=" OLD ")
    return _flat(browse.browse_filter(browse.browse_union(sales(spark, sf_dir), listings(spark, sf_dir), f), f))


@query(with_views(f"SELECT id, type, price, date FROM browse WHERE list_contains(tags, 'Cold')", *_B))
def browse_known_filter(spark, sf_dir):
    rows = browse.known_filter(_browse(spark, sf_dir), "tags", "Cold")
    return browse.known_filter(rows, "type", "no such type").select("id", "type", "price", "date")


@query(with_views("SELECT id, type, price, estimate_low, estimate_high FROM browse", *_B))
def browse_sort(spark, sf_dir):
    rows = browse.browse_sort(_browse(spark, sf_dir), "estimate", ascending=True)
    return rows.select("id", "type", "price", "estimate_low", "estimate_high")


@query(
    with_views(
        f"""
SELECT id, type, price, date, source FROM browse ORDER BY coalesce(price, -1) DESC, type, id LIMIT 50 OFFSET 100""", *_B)
)
def browse_page(spark, sf_dir):
    return browse.browse_page(_browse(spark, sf_dir), 3, "price").select("id", "type", "price", "date", "source")


@query(
    with_views(
        f"""
, t AS (SELECT count(*) AS n FROM browse), o AS (SELECT id, type, price, date, source,
        row_number() OVER (ORDER BY date, type, id) AS rn FROM browse)
SELECT id, type, price, date, source FROM o, t WHERE rn > ((n - 1) // 50) * 50""",
        *_B,
    )
)
def browse_last_page(spark, sf_dir):
    return browse.browse_page(_browse(spark, sf_dir), 10**9, "date", ascending=True).select(
        "id", "type", "price", "date", "source"
    )


@query(
    with_views(
        """
SELECT DISTINCT 'source' AS facet, source AS value FROM browse UNION ALL SELECT DISTINCT 'category', category FROM browse
UNION ALL SELECT DISTINCT 'status', status FROM browse UNION ALL SELECT DISTINCT 'tag', unnest(tags) FROM browse""",
        *_B,
    )
)
def browse_facets(spark, sf_dir):
    return browse.browse_facets(_browse(spark, sf_dir))


@query(
    with_views(
        """
SELECT count(*) AS total, count(*) FILTER (type = 'auction') AS auction, count(*) FILTER (type = 'dealer') AS dealer,
       count(*) FILTER (status = 'Sold') AS matching, min(nullif(date, '')) AS first_date, max(nullif(date, '')) AS last_date
FROM browse""",
        *_B,
    )
)
def browse_header(spark, sf_dir):
    rows = _browse(spark, sf_dir)
    return browse.browse_header(rows, browse.browse_filter(rows, browse.BrowseFilter(status="Sold")))


@query(
    with_views(
        """
SELECT b.id, b.type, b.price, count(f.url) AS flags, coalesce(min(f.reason), '') AS reason FROM browse b
LEFT JOIN flags f ON b.listing_url = f.url GROUP BY b.id, b.type, b.price""",
        SALES_SQL, LISTINGS_SQL, _BROWSE_SQL, *FLAGS_SQL,
    )
)
def browse_with_flags(spark, sf_dir):
    a, d = stored(spark, sf_dir)
    rows = browse.with_flags(browse.browse_union(a, d), flags.market_flags(a, d))
    reason = F.array_min(F.transform("flags", lambda f: f["reason"]))
    return rows.select(
        "id", "type", "price", F.size("flags").cast("bigint").alias("flags"), F.coalesce(reason, F.lit("")).alias("reason")
    )
