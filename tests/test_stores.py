"""Files in and out, versions, extraction edge cases and streams."""

import json
import math
from datetime import datetime

from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.operators import profiling, store
from gavelkit.sources import stores
from gavelkit.sources.extract import base, feeds, html, state, text
from gavelkit.streaming import jobs


def test_missing_or_broken_store_is_empty(spark, tmp_path):
    assert stores.scan_json_array(spark, str(tmp_path / "none.json"), schemas.STATS).count() == 0
    (tmp_path / "bad.json").write_text('[{"date": "2026')
    assert stores.scan_json_array(spark, str(tmp_path / "bad.json"), schemas.STATS).count() == 0


def test_store_scan_computes_keys(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        json.dumps([{"listing_url": "https://a.example/1", "asking_price": "12.5", "tags": "A; B", "times_seen": "3", "notes": ""}, {"id": "x"}])
    )
    r = {x["id"]: x for x in stores.scan_store(spark, str(tmp_path / "s.json"), schemas.LISTING).collect()}
    a = r["url:a.example/1"]
    assert (a["asking_price"], a["tags"], a["times_seen"], a["notes"]) == (12.5, ["A", "B"], 3, None) and "x" in r


def test_snapshots_keep_date_and_position(spark, tmp_path):
    (tmp_path / "2026-01-02.json").write_text(json.dumps([{"piece_name": "b"}, {"piece_name": "c", "asking_or_hammer_price": "7"}]))
    (tmp_path / "2026-01-01.json").write_text(json.dumps([{"piece_name": "a"}]))
    (tmp_path / "2026-01-03.json").write_text('{"no": "array"')
    rows = stores.scan_snapshots(spark, str(tmp_path)).orderBy("date_pulled", "pos").collect()
    assert [(r["date_pulled"], r["pos"], r["piece_name"]) for r in rows] == [("2026-01-01", 0, "a"), ("2026-01-02", 0, "b"), ("2026-01-02", 1, "c")]
    assert rows[2]["asking_or_hammer_price"] == 7.0


def _one_listing(spark, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return schemas.conform(df, schemas.LISTING)


def test_exports(spark, tmp_path):
    rows = _one_listing(spark, id="1", notes='a "b", c\nd', asking_price_usd=5.0).unionByName(_one_listing(spark, id="2", asking_price_usd=9.0))
    n = stores.write_store(rows, "asking_price_usd", str(tmp_path / "j"), str(tmp_path / "c"))
    assert n == 2
    back = stores.read_csv(spark, str(tmp_path / "c"), schemas.LISTING.fieldNames()).collect()
    assert [r["id"] for r in sorted(back, key=lambda r: -float(r["asking_price_usd"]))] == ["2", "1"]
    assert {r["id"]: r["notes"] for r in back}["1"] == 'a "b", c\nd'


def test_snapshot_of_a_date_is_replaced(spark, tmp_path):
    path = str(tmp_path / "snap")
    day = lambda d, p: spark.createDataFrame([(d, p)], "date_pulled string, piece_name string")
    for d, p in (("2026-01-01", "a"), ("2026-01-02", "b"), ("2026-01-02", "c")):
        stores.write_snapshot(day(d, p), path)
    assert sorted(r["piece_name"] for r in spark.read.parquet(path).collect()) == ["a", "c"]


def test_versioned_store_shuffles_only_the_batch(spark, tmp_path):
    s = stores.VersionedStore(spark, "t_store", str(tmp_path / "v"), schemas.LISTING, buckets=4)
    assert s.read().count() == 0
    s.write(_one_listing(spark, id="1", piece_name="x"), 1)
    s.write(_one_listing(spark, id="2"), 1)  # a version never changes
    assert [r["id"] for r in s.read().collect()] == ["1"]
    _one_listing(spark, id="1", piece_name="y").withColumn("pos", F.lit(1)).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = store.merge_listings(s.read(), batch, "2026-01-01", ["pos"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        # one exchange for the fold of the batch, which already fits the buckets
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
        s.write(merged, 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert s.versions() == [1, 2] and s.read().collect()[0]["piece_name"] == "y"
    assert s.read(1).collect()[0]["piece_name"] == "x"


def _raw(spark, body, source="s"):
    return spark.createDataFrame([(source, 1, 0, body)], "source string, page int, pos int, body string")


def test_feed_without_prices_and_with_junk(spark):
    body = json.dumps({"products": [{"id": 7, "title": "Brand cufflinks", "tags": ["x", "y"], "body_html": "<b>circa 1970s</b>", "variants": []}]})
    r = feeds.shop_feed(_raw(spark, body), "shop.example", "Shop", "USD", r"brand").collect()[0]
    assert (r["sku"], r["asking_price"], r["listing_url"], r["category"], r["era_or_year"]) == ("7", None, None, "cufflinks", "circa 1970s")
    assert feeds.shop_feed(_raw(spark, "<html>"), "s", "d", "USD", "b").count() == 0


def test_cards_without_link_are_skipped(spark):
    body = '<li class="search-result-item"><strong class="maker">Brand</strong></li>'
    assert html.list_cards(_raw(spark, body), "H", "brand").count() == 0


def test_state_scanner():
    assert state.balanced_object('x window.a={"s":"}\\"{",\'t\':1} tail', "window.a=") == '{"s":"}\\"{",\'t\':1}'
    assert state.balanced_object("window.a=undefined; {1}", "window.a=") is None
    assert state.balanced_object("window.a={1", "window.a=") is None


def test_balanced_arrays_in_replies(spark):
    reply = {"content": [{"type": "text", "text": "[x] then [{\"piece_name\": \"a ] b\"}] [end"}, {"type": "text", "text": "no data"}]}
    raw = spark.createDataFrame([(1, json.dumps(reply))], "k int, body string")
    assert [r["piece_name"] for r in text.reply_items(raw, ["piece_name"]).collect()] == ["a ] b"]


def test_failing_source_does_not_stop_the_others(spark):
    done = {}

    def broken(raw, **_):
        raise ValueError("markup changed")

    sources = [
        base.Source("bad", "listing", broken),
        base.Source("s", "listing", feeds.shop_feed, {"shop": "s", "dealer": "d", "currency": "USD", "brand": "b"}),
        base.Source("later", "auction", broken, status="web-search-only"),
    ]
    report = base.run_sources(_raw(spark, '{"products":[{"title":"b"}]}'), sources, lambda n, df: done.update({n: df.count()}))
    assert done == {"s": 1}
    assert [(r["source"], r["status"]) for r in report] == [("bad", "failed"), ("s", "done"), ("later", "web-search-only")]


def test_shape_of_top_level_array(spark):
    df = spark.createDataFrame([(1, '[{"nbHits": 3, "a": [1, 2]}, 5]'), (2, "oops")], "k int, body string")
    r = profiling.json_shape(df, "body").collect()
    assert len(r) == 1 and r[0]["top_keys"] == "array[2]"
    assert r[0]["arrays"] == ["[nested].a:2"] and r[0]["paging"] == ["nbHits=3"]


def test_lifecycle_stream_times_out(spark, tmp_path):
    src = tmp_path / "in"
    rows = [("a", "2026-01-01 10:00:00", 5.0), ("a", "2026-01-02 10:00:00", None), ("b", "2026-01-02 10:00:00", 7.0)]
    late = [("b", "2026-02-20 10:00:00", 8.0)]
    make = lambda r: spark.createDataFrame(r, "id string, t string, price double").selectExpr("id", "cast(t AS timestamp) AS ts", "substr(t, 1, 10) AS date", "price").coalesce(1)
    make(rows).write.parquet(str(src / "p=1"))
    make(late).write.parquet(str(src / "p=2"))
    make([("b", "2026-03-20 10:00:00", 9.0)]).write.parquet(str(src / "p=3"))
    schema = make(rows).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src) + "/p=*")
    out = jobs.run_to_table(jobs.lifecycle_stream(stream, "7 days", "1 day"), str(tmp_path / "out"), str(tmp_path / "ck"), "update")
    got = {(r["id"], r["status"]): r for r in out.orderBy("batch").collect()}
    assert got[("a", "inactive")]["times_seen"] == 2 and got[("a", "inactive")]["last_price"] == 5.0
    assert got[("a", "inactive")]["last_seen"] == "2026-01-02"


def test_upsert_stream_is_repeatable(spark, tmp_path):
    src = str(tmp_path / "in")
    cols = "id string, piece_name string, asking_price double, run_date string, source string, pos int"
    absent = [f for f in schemas.LISTING.fields if f.name not in ("id", "piece_name", "asking_price", "source")]
    wide = lambda r: spark.createDataFrame(r, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    wide([("1", "x", 5.0, "2026-01-01", "s", 1), ("2", "y", 6.0, "2026-01-01", "s", 2)]).write.parquet(src, mode="append")
    kept = stores.VersionedStore(spark, "t_stream", str(tmp_path / "v"), schemas.LISTING, buckets=2)
    stream = lambda: spark.readStream.schema(wide([]).schema).parquet(src)
    run = lambda: jobs.upsert_stream(stream(), kept, str(tmp_path / "ck"), ["pos"]).awaitTermination()
    run()
    wide([("1", None, 4.0, "2026-01-02", "s", 1)]).write.parquet(src, mode="append")
    run()
    run()
    r = {x["id"]: (x["piece_name"], x["asking_price"], x["times_seen"], x["status"]) for x in kept.read().collect()}
    assert r == {"1": ("x", 4.0, 2, "active"), "2": ("y", 6.0, 1, "inactive")}


def test_a_second_checkpoint_goes_on_from_the_store(spark, tmp_path):
    cols = "id string, piece_name string, asking_price double, run_date string, source string, pos int"
    absent = [f for f in schemas.LISTING.fields if f.name not in ("id", "piece_name", "asking_price", "source")]
    wide = lambda r: spark.createDataFrame(r, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    kept = stores.VersionedStore(spark, "t_second", str(tmp_path / "v"), schemas.LISTING, buckets=2)
    for n in ("1", "2"):
        wide([(n, "x", 5.0, f"2026-01-0{n}", "s", 1)]).write.parquet(str(tmp_path / n))
        stream = spark.readStream.schema(wide([]).schema).parquet(str(tmp_path / n))
        jobs.upsert_stream(stream, kept, str(tmp_path / f"ck{n}"), ["pos"]).awaitTermination()
    assert sorted(r["id"] for r in kept.read().collect()) == ["1", "2"] and kept.versions() == [1, 2]


def test_lifecycle_stream_late_rows_and_returns(spark, tmp_path):
    make = lambda r: spark.createDataFrame(r, "id string, t string, price double").selectExpr("id", "cast(t AS timestamp) AS ts", "substr(t, 1, 10) AS date", "price").coalesce(1)
    batches = [
        [("a", "2026-01-03 10:00:00", 100.0)],
        [("a", "2026-01-02 12:00:00", 7.0)],  # late: another day, an older price
        [("b", "2026-03-01 10:00:00", 1.0)],
        [("b", "2026-03-02 10:00:00", 1.0)],
        [("a", "2026-03-03 10:00:00", None)],
    ]
    for k, rows in enumerate(batches):
        make(rows).write.parquet(str(tmp_path / "in" / f"p={k}"))
    stream = spark.readStream.schema(make(batches[0]).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in") + "/p=*")
    out = jobs.run_to_table(jobs.lifecycle_stream(stream, "7 days", "3 days"), str(tmp_path / "out"), str(tmp_path / "ck"), "update")
    got = [(r["status"], r["first_seen"], r["last_seen"], r["times_seen"], r["last_price"]) for r in out.where("id = 'a'").orderBy("batch").collect()]
    assert got[:2] == [("active", "2026-01-03", "2026-01-03", 1, 100.0), ("active", "2026-01-02", "2026-01-03", 2, 100.0)]
    assert ("inactive", "2026-01-02", "2026-01-03", 2, 100.0) in got and got[-1] == ("active", "2026-01-02", "2026-03-03", 3, 100.0)


def test_many_days_in_one_merge_equal_day_after_day(spark):
    cols = "id string, piece_name string, asking_price double, notes string, date string, source string, pos int"
    absent = [f for f in schemas.LISTING.fields if f.name not in ("id", "piece_name", "asking_price", "notes", "source")]
    wide = lambda r: spark.createDataFrame(r, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    rows = wide(
        [("1", "x", 5.0, None, "2025-12-30", "s", 1), ("1", None, 6.0, "ruby", "2025-12-30", "t", 2), ("2", "y", None, None, "2025-12-31", "s", 1)]
        + [("1", "z", None, None, "2026-01-02", "u", 1), ("3", "w", 9.0, "new", "2026-01-02", "s", 1), ("2", None, 4.0, None, "2026-01-01", "v", 3)]
    )
    days = ["2025-12-30", "2025-12-31", "2026-01-01", "2026-01-02"]
    slow = empty = spark.createDataFrame([], schemas.LISTING)
    for d in days:
        slow = store.mark_missing(store.merge_listings(slow, rows.where(F.col("date") == d), d, ["pos"]), d)
    fast = store.mark_missing(store.merge_listing_days(empty, rows, "date", ["pos"]), days[-1])
    early = store.merge_listing_days(empty, rows.where(F.col("date") <= days[1]), "date", ["pos"])
    parts = store.mark_missing(store.merge_listing_days(early, rows.where(F.col("date") >= days[1]), "date", ["pos"]), days[-1])
    want = sorted(map(str, slow.collect()))
    assert sorted(map(str, fast.collect())) == want and sorted(map(str, parts.collect())) == want


def _wide(spark, rows):
    cols = "id string, piece_name string, asking_price double, run_date string, source string, pos int"
    absent = [f for f in schemas.LISTING.fields if f.name not in ("id", "piece_name", "asking_price", "source")]
    return spark.createDataFrame(rows, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def test_a_checkpoint_begun_again_loses_no_batch(spark, tmp_path):
    kept = stores.VersionedStore(spark, "t_again", str(tmp_path / "v"), schemas.LISTING, buckets=2)
    for n in ("a", "z"):
        _wide(spark, [(n, "x", 5.0, "2026-01-01", "s", 1)]).write.parquet(str(tmp_path / n))
        stream = spark.readStream.schema(_wide(spark, []).schema).parquet(str(tmp_path / n))
        jobs.upsert_stream(stream, kept, str(tmp_path / "ck"), ["pos"]).awaitTermination()
        (tmp_path / "ck").rename(tmp_path / f"lost-{n}")
    assert sorted(r["id"] for r in kept.read().collect()) == ["a", "z"]


def test_a_late_batch_keeps_the_last_day(spark, tmp_path):
    kept = stores.VersionedStore(spark, "t_late", str(tmp_path / "v"), schemas.LISTING, buckets=2)
    for n, row in enumerate([("a", "new", 5.0, "2024-01-05", "s", 1), ("a", "old", 3.0, "2024-01-03", "s", 1)]):
        _wide(spark, [row]).write.parquet(str(tmp_path / str(n)))
        stream = spark.readStream.schema(_wide(spark, []).schema).parquet(str(tmp_path / str(n)))
        jobs.upsert_stream(stream, kept, str(tmp_path / f"ck{n}"), ["pos"]).awaitTermination()
    r = kept.read().collect()[0]
    assert (r.piece_name, r.asking_price, r.first_seen, r.last_seen, r.times_seen, r.status) == ("new", 5.0, "2024-01-03", "2024-01-05", 2, "active")


def _batches(spark, tmp_path, schema, batches):
    """A stream that reads one batch at a time, in order."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/p={k}"))
    kind = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in") + "/p=*")


def _at(text):
    return datetime.fromisoformat(f"2024-01-{text}")


def test_a_late_row_joins_two_sessions(spark, tmp_path):
    batches = [
        [("d", _at("01 00:00"), 5.0), ("d", _at("01 08:00"), 7.0), (None, _at("01 00:00"), None)],
        [("d", _at("01 04:30"), 1.0), ("d", _at("01 20:00"), 2.0)],
        [("x", _at("09 00:00"), 1.0)],
    ]
    stream = _batches(spark, tmp_path, "k string, ts timestamp, price double", batches)
    out = jobs.run_to_table(jobs.session_stream(stream, "k", "5 hours", "1 day"), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(((r.k, str(r.started), str(r.ended), r.n, r.low, r.high) for r in out.collect()), key=str)
    day = "2024-01-01 "
    assert got == sorted([(None, f"{day}00:00:00", f"{day}00:00:00", 1, None, None), ("d", f"{day}00:00:00", f"{day}08:00:00", 3, 1.0, 7.0), ("d", f"{day}20:00:00", f"{day}20:00:00", 1, 2.0, 2.0)], key=str)


def test_daily_median_of_counts_in_parts(spark):
    import random
    import statistics

    r = random.Random(6)
    rows, want = [], {}
    for day in ("a", "b", None):
        for group in ("x", None):
            prices = [r.choice([50.0, 75.5, 99.99, 100.0, r.uniform(50, 1e6)]) for _ in range(r.randint(1, 60))]
            rows += [(day, group, p, 1) for p in prices]
            m = statistics.median(prices)
            want[day, group] = (len(prices), m if len(prices) % 2 else math.floor(m + 0.5))
    out = jobs.daily_median(spark.createDataFrame(rows, "day string, g string, price double, n long"), "g").collect()
    assert {(x.day, x.g): (x.n, x.median) for x in out} == want
    assert jobs.daily_median(spark.createDataFrame([], "day string, g string, price double, n long"), "g").collect() == []


def test_first_imports_are_not_reported(spark, tmp_path):
    batches = [
        [("big", f"b{k}", _at("01 01:00"), 500.0) for k in range(4)] + [("small", "s1", _at("01 02:00"), 500.0)],
        [("big", "b0", _at("02 01:00"), 900.0), ("big", "b9", _at("02 01:00"), 900.0), ("small", "s2", _at("02 01:00"), 10.0), ("big", "late", _at("01 23:00"), 700.0)],
        [("small", "s2", _at("03 01:00"), 800.0), ("other", "o", _at("09 00:00"), 800.0)],
    ]
    stream = _batches(spark, tmp_path, "dealer string, id string, ts timestamp, price double", batches)
    days = jobs.run_to_table(jobs.listing_day_stream(stream, "1 day"), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted((r.dealer, r.day, r.id) for r in jobs.alerts_after_import(days, 300, 4).collect())
    assert got == [("big", "2024-01-02", "b9"), ("small", "2024-01-01", "s1")]
    assert ("big", "2024-01-01", "b1") in [(r.dealer, r.day, r.id) for r in jobs.alerts_after_import(days, 300, 5).collect()]


def test_lifecycle_stream_listings_of_a_bucket_time_out_one_by_one(spark, tmp_path):
    make = lambda r: spark.createDataFrame(r, "id string, t string, price double").selectExpr("id", "cast(t AS timestamp) AS ts", "substr(t, 1, 10) AS date", "price").coalesce(1)
    batches = [
        [(f"p{k}", f"2026-01-0{1 + k % 3} 10:00:00", float(k)) for k in range(30)] + [(None, "2026-01-01 09:00:00", None)],
        [(f"p{k}", "2026-01-09 10:00:00", None) for k in range(0, 30, 3)],  # of the first day's
        [("q", "2026-01-10 12:00:00", 1.0)],
        [("q", "2026-01-11 12:00:00", 1.0)],
    ]
    for k, rows in enumerate(batches):
        make(rows).write.parquet(str(tmp_path / "in" / f"p={k}"))
    stream = spark.readStream.schema(make(batches[0]).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in") + "/p=*")
    out = jobs.run_to_table(jobs.lifecycle_stream(stream, "7 days", "1 day", buckets=1), str(tmp_path / "out"), str(tmp_path / "ck"), "update")
    got = {}
    for r in out.orderBy("batch").collect():
        got.setdefault(r["id"], []).append((r["status"], r["times_seen"], r["last_price"]))
    for k in range(30):
        seen = [[("active", 1, float(k)), ("active", 2, float(k))], [("active", 1, float(k)), ("inactive", 1, float(k))], [("active", 1, float(k))]]
        assert got[f"p{k}"] == seen[k % 3] or k % 3 == 2 and got[f"p{k}"] == seen[1], (k, got[f"p{k}"])
    assert got[None] == [("active", 1, None), ("inactive", 1, None)] and [x[0] for x in got["q"]] == ["active", "active"]
