"""Registered queries: the intake job from landed captures to the store and its report."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.operators import ingest, intake, paging, store
from gavelkit.params import Params
from gavelkit.plans.adapters import DEMO_TAGS, SIGHTINGS_SQL, sightings, with_views
from gavelkit.plans.registry import Registry
from gavelkit.plans.stores import _ITEMS_SQL, _LAST, _items, _last_day, last_sql
from gavelkit.session import pinned
from gavelkit.sources.extract.base import Source, listing_rows, run_sources

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

_BODY = "piece_name STRING, category STRING, price DOUBLE, price_type STRING, notes STRING, url STRING"
_BRAND = "piece [0-9]*[02468]( |$)"
_FAILED, _BY_MAKER, _WITH_URL = "error", "purchase", "click"


def _captures(spark, sf_dir):
    """Each sighting as one landed reply."""
    rows = sightings(spark, sf_dir)
    kind = F.when(F.col("pos") % 10 == 0, "gone").otherwise("item")
    url = F.concat(F.lit("https://shop.example/"), "source_site", F.lit("/"), kind, F.lit("/"), F.substring_index("id", "|", 1), F.lit("?from=list"))
    body = F.to_json(F.struct("piece_name", "category", "price", "price_type", "notes", url.alias("url")))
    return rows.select(F.col("source_site").alias("source"), F.col("date").alias("run_date"), F.lit(0).alias("page"), "pos", body.alias("body"))


def _extract(raw):
    it = lambda name: F.col(f"it.{name}")
    return listing_rows(
        raw.withColumn("it", F.from_json("body", _BODY)), piece_name=it("piece_name"), category=it("category"), price_type=it("price_type"),
        asking_price=it("price"), currency_note=F.lit("USD"), dealer=F.col("source"), listing_url=it("url"), notes=it("notes"),
    )


def _unreachable(raw):
    raise ValueError("no reply")


def _job(spark, sf_dir):
    raw = _captures(spark, sf_dir)
    end = _last_day(raw.withColumn("date", F.col("run_date")))
    names = sorted(r[0] for r in raw.select("source").distinct().collect())  # the registry of this made-up run: a handful
    registry = [
        Source(n, "listing", _unreachable if n == _FAILED else _extract, needs_brand=n != _BY_MAKER, item_url="/item/" if n == _WITH_URL else None)
        for n in names
    ]
    landed = {}
    outcome = run_sources(raw.where(F.col("run_date") == end), registry, lambda n, rows: landed.update({n: pinned(rows, "extracted")}))
    empty = spark.createDataFrame([], schemas.LISTING)
    batch = ingest.union_batches(*landed.values()) if landed else _extract(raw.where("false"))
    before = store.with_listing_key(_extract(raw.where(F.col("run_date") < end)))
    prev = pinned(store.merge_listing_days(empty, before, "run_date", ["pos"], DEMO_TAGS), "store")
    blocked = prev.where("CAST(substring_index(substring_index(listing_url, '?', 1), '/', -1) AS BIGINT) % 9 = 0").select(F.col("listing_url").alias("url"))
    pages = paging.stop_pages(paging.page_counts(_items(spark, sf_dir)), page_limit=40, max_pages=25)
    truncated = pages.select(F.col("shop").alias("source"), "truncated")
    params = Params(run_date=end, brand_pattern=_BRAND)
    return intake.ingest_listings(prev, batch, registry, outcome, params, blocked, truncated, DEMO_TAGS)


_JOB_SQL = f"""
shown AS (SELECT *, CAST(split_part(id, '|', 1) AS BIGINT) AS user_id, CASE WHEN pos % 10 = 0 THEN 'gone' ELSE 'item' END AS kind FROM sightings),
keyed AS (SELECT * REPLACE ('url:shop.example/' || source_site || '/' || kind || '/' || user_id AS id) FROM shown),
held AS (SELECT * FROM keyed WHERE date < {_LAST}),
judged AS (SELECT *, (user_id % 2 = 0 OR source_site = '{_BY_MAKER}') AND (source_site <> '{_WITH_URL}' OR kind = 'item') AS matched,
           user_id % 9 = 0 AND id IN (SELECT id FROM held) AS blocked
           FROM keyed WHERE date = {_LAST} AND source_site <> '{_FAILED}'),
taken AS (SELECT * FROM judged WHERE matched AND NOT blocked),
every AS (SELECT id, source_site, date, pos, price FROM held UNION ALL SELECT id, source_site, date, pos, price FROM taken)"""


@query(
    with_views(
        f"""
SELECT id, min(source_site) AS source, min(date) AS first_seen, max(date) AS last_seen, CAST(count(DISTINCT date) AS INTEGER) AS times_seen,
       CASE WHEN max(date) < {_LAST} AND min(source_site) IN (SELECT DISTINCT source_site FROM sightings WHERE source_site <> '{_FAILED}')
            THEN 'inactive' ELSE 'active' END AS status, {last_sql('price')} AS asking_price
FROM every GROUP BY id""",
        SIGHTINGS_SQL,
        _JOB_SQL,
    )
)
def intake_store(spark, sf_dir):
    """Landed replies through extraction, brand, url test, blocklist, merge and marking; one source fails and keeps its listings."""
    rows, _ = _job(spark, sf_dir)
    return rows.select("id", "source", "first_seen", "last_seen", "times_seen", "status", "asking_price")


@query(
    with_views(
        f"""
, c AS (SELECT source_site AS source, count(*) AS seen, count(*) FILTER (matched) AS matched,
               count(DISTINCT id) FILTER (matched AND NOT blocked AND id NOT IN (SELECT id FROM held)) AS added FROM judged GROUP BY 1),
s AS (SELECT source_site AS source, string_agg(piece_name, '; ' ORDER BY pos) AS sample FROM (
        SELECT *, row_number() OVER (PARTITION BY source_site ORDER BY pos) AS rn FROM judged WHERE matched) WHERE rn <= 8 GROUP BY 1),
f AS (SELECT *, fresh = 0 OR items < 40 AS stop FROM pages_),
e AS (SELECT *, coalesce(bool_or(stop) OVER (PARTITION BY shop ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
             AS ended FROM f),
t AS (SELECT shop AS source, bool_or(NOT ended AND NOT stop AND page = 25) AS truncated FROM e GROUP BY 1)
SELECT c.source, seen, matched, added, CAST(matched AS DOUBLE) / seen AS match_rate, CAST(matched AS DOUBLE) / seen > 0.15::DOUBLE AS suspicious,
       CASE WHEN CAST(matched AS DOUBLE) / seen > 0.15::DOUBLE THEN sample END AS sample, coalesce(truncated, false) AS truncated,
       CAST(NULL AS VARCHAR) AS error
FROM c LEFT JOIN s USING (source) LEFT JOIN t USING (source)
UNION ALL SELECT DISTINCT source_site, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no reply' FROM sightings WHERE source_site = '{_FAILED}'""",
        SIGHTINGS_SQL,
        _JOB_SQL,
        _ITEMS_SQL,
    )
)
def intake_report(spark, sf_dir):
    _, report = _job(spark, sf_dir)
    return report.select("source", "seen", "matched", "added", "match_rate", "suspicious", "sample", "truncated", "error")
