"""The intake job: which rows are taken, what is marked, what the report says."""

from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.operators import intake
from gavelkit.params import Params
from gavelkit.sources.extract.base import Source

SOURCES = [Source("a", "listing", None), Source("maker", "listing", None, needs_brand=False), Source("shop", "listing", None, item_url="/products/[^ )]+"), Source("down", "listing", None)]
DONE = [{"source": s, "status": "done", "error": None} for s in ("a", "maker", "shop")]
OUTCOME = [*DONE, {"source": "down", "status": "failed", "error": "no reply"}]


def _batch(spark, rows):
    df = spark.createDataFrame(rows, "source string, pos int, piece_name string, notes string, listing_url string")
    missing = [f for f in schemas.LISTING.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def _url(n, kind="products"):
    return f"https://x.example/{kind}/{n}"


def test_taken_marked_and_reported(spark):
    first = [("a", 1, "Forge ring", None, _url(1)), ("down", 2, "Forge pin", None, _url(2)), ("shop", 3, "FORGE cuff", None, _url(3)), ("a", 4, "forge", None, _url(4))]
    blocked = spark.createDataFrame([(_url(9) + "?x=1",)], "url string")
    empty = spark.createDataFrame([], schemas.LISTING)
    all_done = [*DONE, {"source": "down", "status": "done", "error": None}]
    prev, _ = intake.ingest_listings(empty, _batch(spark, first), SOURCES, all_done, Params("2026-01-01", "forge"), blocked)
    second = [
        ("a", 1, "Forge ring", None, _url(1)), ("a", 2, "plain", "by Forge", _url(5)), ("a", 3, "plain", None, _url(6)), ("a", 4, None, None, None),
        ("maker", 5, "plain", None, _url(7)), ("shop", 6, "Forge", None, _url(8, "help")), ("shop", 7, "Forge", None, None), ("shop", 8, "Forge", None, _url(9)),
        ("other", 9, "plain", None, _url(10)), ("other", 10, "Forge", None, _url(5)), ("other", 11, "Forge", None, _url(11)),
    ]
    cut = spark.createDataFrame([("a", False), ("a", True), ("shop", None)], "source string, truncated boolean")
    out, report = intake.ingest_listings(prev, _batch(spark, second), SOURCES, OUTCOME, Params("2026-01-02", "forge"), blocked, cut)
    got = {r["id"].rsplit("/", 1)[-1]: (r["status"], r["times_seen"], r["source"]) for r in out.collect()}
    assert got == {
        "1": ("active", 2, "a"), "2": ("active", 1, "down"), "3": ("inactive", 1, "shop"), "4": ("inactive", 1, "a"),
        "5": ("active", 1, "a"), "7": ("active", 1, "maker"), "11": ("active", 1, "other"),
    }
    rows = {r["source"]: r for r in report.collect()}
    assert {s: (r["seen"], r["matched"], r["added"], r["truncated"]) for s, r in rows.items() if s != "down"} == {
        "a": (4, 2, 1, True), "maker": (1, 1, 1, False), "shop": (3, 1, 0, False), "other": (3, 2, 1, False),
    }
    assert rows["down"]["error"] == "no reply" and rows["down"]["seen"] is None and rows["a"]["sample"] == "Forge ring; plain"


def test_a_run_twice_and_an_empty_run(spark):
    none = spark.createDataFrame([], "url string")
    batch = _batch(spark, [("a", 1, "Forge", None, _url(1)), ("a", 1, "Forge", None, _url(1))])
    prev, report = intake.ingest_listings(spark.createDataFrame([], schemas.LISTING), batch, SOURCES, DONE, Params("2026-01-01", "forge"), none)
    assert [(r["seen"], r["matched"], r["added"]) for r in report.collect()] == [(2, 2, 1)]
    again, report = intake.ingest_listings(prev, batch, SOURCES, DONE, Params("2026-01-01", "forge"), none)
    assert [r["times_seen"] for r in again.collect()] == [1] and [r["added"] for r in report.collect()] == [0]
    out, report = intake.ingest_listings(again, batch.where("false"), SOURCES, DONE, Params("2026-01-02", "forge"), none)
    assert [r["status"] for r in out.collect()] == ["inactive"] and report.count() == 0
