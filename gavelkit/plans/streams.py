"""Registered queries: the streaming jobs, run over the events table as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.plans.adapters import SIGHTINGS_SQL, median_sql, table, with_views
from gavelkit.plans.registry import Registry
from gavelkit.plans.stores import last_sql
from gavelkit.session import work_path
from gavelkit.sources.stores import VersionedStore
from gavelkit.streaming import jobs

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total, min(value) AS min_price, max(value) AS max_price
FROM events WHERE value >= 50 AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY 1, 2"""
)
def stream_daily_prices(spark, sf_dir):
    prices = _events(spark, sf_dir).withColumn("price", F.col("value"))
    out = jobs.daily_price_stream(prices, "event_type", "1 hour")
    rows = jobs.run_to_table(out, work_path(spark, "daily"), work_path(spark, "daily-checkpoint"))
    return rows.withColumn("total", F.round("total", 2))


_CLOSED = "<= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@query(
    f"""
WITH e AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS pause FROM events),
s AS (SELECT *, sum(pause) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS n, min(value) AS low, max(value) AS high
FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR {_CLOSED}"""
)
def stream_sessions(spark, sf_dir):
    out = jobs.session_stream(_events(spark, sf_dir).withColumn("price", F.col("value")), "user_id", "6 hours", "1 hour")
    rows = jobs.run_to_table(out, work_path(spark, "sessions"), work_path(spark, "sessions-checkpoint"))
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started", "ended")})


@query(
    f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, {median_sql('value')} AS median
FROM events WHERE value >= 50 AND date_trunc('day', ts) + INTERVAL 1 DAY {_CLOSED} GROUP BY 1, 2"""
)
def stream_daily_median(spark, sf_dir):
    counts = jobs.price_count_stream(_events(spark, sf_dir).withColumn("price", F.col("value")), "event_type", "1 hour")
    rows = jobs.run_to_table(counts, work_path(spark, "counts"), work_path(spark, "counts-checkpoint"))
    return jobs.daily_median(rows, "event_type")


@query(
    f"""
WITH d AS (SELECT CASE WHEN user_id % 3 = 0 THEN event_type ELSE event_type || '-' || user_id % 50 END AS dealer, strftime(ts, '%Y-%m-%d') AS day, user_id || '|' || event_type AS id, max(value) AS price
  FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY {_CLOSED} GROUP BY 1, 2, 3),
stock AS (SELECT dealer, day, count(*) AS n FROM d GROUP BY 1, 2),
imports AS (SELECT dealer, min(day) AS day FROM stock GROUP BY 1 HAVING arg_min(n, day) > 10),
firsts AS (SELECT dealer, id, min(day) AS day, arg_min(price, day) AS price FROM d GROUP BY 1, 2)
SELECT * FROM firsts f WHERE price >= 300 AND NOT EXISTS (SELECT 1 FROM imports i WHERE i.dealer = f.dealer AND i.day = f.day)"""
)
def stream_alerts_after_import(spark, sf_dir):
    # a few large dealers, whose first day is an import, and many small ones
    small = F.concat_ws("-", "event_type", (F.col("user_id") % 50).cast("string"))
    dealer = F.when(F.col("user_id") % 3 == 0, F.col("event_type")).otherwise(small).alias("dealer")
    rows = _events(spark, sf_dir).select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("id"), dealer, "ts", F.col("value").alias("price")
    )
    days = jobs.run_to_table(jobs.listing_day_stream(rows, "1 hour"), work_path(spark, "days"), work_path(spark, "days-checkpoint"))
    return jobs.alerts_after_import(days, 300, 10)


@query("SELECT DISTINCT user_id || '|' || event_type AS id FROM events WHERE value >= 300")
def stream_new_alert(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("id"), "ts", F.col("value").alias("price")
    )
    # one alert per piece while it is remembered: the events of a month lie within the bound
    out = jobs.alert_stream(rows, 300, "60 days")
    found = jobs.run_to_table(out, work_path(spark, "alerts"), work_path(spark, "alerts-checkpoint"))
    return found.select("id")


@query(
    with_views(
        """
SELECT id, min(date) AS first_seen, max(date) AS last_seen, CAST(count(DISTINCT date) AS INTEGER) AS times_seen,
       arg_max(price, ts) FILTER (price IS NOT NULL) AS last_price, 'active' AS status
FROM (SELECT user_id || '|' || event_type AS id, strftime(ts, '%Y-%m-%d') AS date, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS price FROM events)
GROUP BY id""".lstrip(),
        SIGHTINGS_SQL,
    )
)
def stream_lifecycle(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("id"), "ts",
        F.col("ts").cast("date").cast("string").alias("date"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("price"),
    )
    out = jobs.lifecycle_stream(rows, "60 days")
    found = jobs.run_to_table(out, work_path(spark, "life"), work_path(spark, "life-checkpoint"), "update")
    # of several updates of a piece the last one counts
    last = found.groupBy("id").agg(F.max_by(F.struct(*[c for c in found.columns if c not in ("id", "batch", "run")]), "batch").alias("r"))
    return last.select("id", "r.*")


@query(
    with_views(
        f"""
SELECT id, min(date) AS first_seen, max(date) AS last_seen, CAST(count(DISTINCT date) AS INTEGER) AS times_seen,
       CASE WHEN max(date) = (SELECT max(date) FROM sightings) THEN 'active' ELSE 'inactive' END AS status, {last_sql('price')} AS asking_price
FROM sightings GROUP BY id""",
        SIGHTINGS_SQL,
    )
)
def stream_store_upsert(spark, sf_dir):
    day = F.col("ts").cast("date").cast("string")
    rows = _events(spark, sf_dir).select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("id"), day.alias("run_date"), F.col("event_id").alias("pos"),
        F.concat(F.lit("piece "), F.col("user_id").cast("string")).alias("piece_name"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("asking_price"), F.col("event_type").alias("source"),
    )
    absent = [f for f in schemas.LISTING.fields if f.name not in rows.columns]
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    store = VersionedStore(spark, f"listings_{uuid.uuid4().hex[:12]}", work_path(spark, "store"), schemas.LISTING, buckets=8)
    jobs.upsert_stream(rows, store, work_path(spark, "upsert-checkpoint"), ["pos"]).awaitTermination()
    return store.read().select("id", "first_seen", "last_seen", "times_seen", "status", "asking_price")
