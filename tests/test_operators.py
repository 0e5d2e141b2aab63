"""Laws, brute-force comparisons and plans of the operators."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelkit import schemas
from gavelkit.functions.text import jaccard, title_tokens
from gavelkit.operators import alerts, browse, catalog, flags, ingest, pairs, paging, ranks, stats, store
from gavelkit.plans import adapters


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_stats_with_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot", round(rnd.uniform(50, 1e6), 2)) for _ in range(3000)] + [("same", 77.0)] * 500
    rows += [(f"g{i % 40}", float(rnd.randint(-300, 3000))) for i in range(1500)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, p double")
    got = {r["g"]: r for r in ranks.price_stats(df, ["g"], "p", (5, 15, 99)).collect()}
    groups = {}
    for g, p in rows:
        if p is not None:
            groups.setdefault(g, []).append(p)
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        s, n = sorted(values), len(values)
        mid = s[n // 2] if n % 2 else float(math.floor((s[n // 2 - 1] + s[n // 2]) / 2 + 0.5))
        r = got[g]
        assert (r["n"], r["min_price"], r["median_price"], r["max_price"]) == (n, s[0], mid, s[-1])
        for p in (5, 15, 99):
            assert r[f"p{p}"] == s[min(n - 1, int(p / 100 * n))]


def test_overall_statistics_share_the_passes(spark):
    rows = [(f"g{i % 3}", float(50 + (i * 37) % 991)) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, p double")
    by_group, everything = ranks.price_stats_and_overall(df, ["g"], "p", (15,), (5,))
    s = sorted(p for _, p in rows)
    r = everything.collect()[0]
    assert (r["n"], r["p5"]) == (1000, s[50])
    assert {x["g"]: x["n"] for x in by_group.collect()} == {"g0": 334, "g1": 333, "g2": 333}


def test_even_median_is_rounded(spark):
    df = spark.createDataFrame([(50.0,), (51.0,), (52.0,), (54.0,)], "p double")
    assert ranks.price_stats(df, [], "p").collect()[0]["median_price"] == 52.0


def test_histogram_agrees_with_categories(spark, sf_dir):
    rows = adapters.sales(spark, sf_dir)
    bands = stats.price_histogram(rows, "sold_price_usd").agg(F.sum("n")).collect()[0][0]
    cats = stats.stats_by_category(rows, "sold_price_usd").agg(F.sum("n")).collect()[0][0]
    assert bands == cats


def test_flags_skip_placeholders_and_thin_categories(spark):
    rows = [(str(i), "ring", 1000.0) for i in range(40)] + [("cheap", "ring", 60.0), ("dollar", "ring", 1.0), ("thin", "brooch", 61.0)]
    df = spark.createDataFrame(rows, "id string, category string, asking_price_usd double").selectExpr(
        "*", "id AS piece_name", "'d' AS dealer", "'' AS listing_url"
    )
    got = {r["id"]: r["reason"] for r in flags.price_flags(df, "asking_price_usd", "dealer", "dealer").collect()}
    assert set(got) == {"cheap", "thin"} | {str(i) for i in range(40)}
    assert got["cheap"] == '$60 is well below the typical range for "ring" (41 comparable dealer records, median $1,000)'


# --- alerts ------------------------------------------------------------------------
def _listing(i, dealer, seen, price=9000.0, status="active"):
    return (str(i), dealer, seen, price, status, f"piece {i}")


@pytest.mark.parametrize("n,alerted", [(10, 10), (11, 0)])
def test_first_import_is_not_alerted(spark, n, alerted):
    rows = [_listing(i, "new shop", "2026-01-02") for i in range(n)]
    rows += [_listing(100, None, "2026-01-02"), _listing(101, None, "2026-01-01"), _listing(102, None, "2026-01-02", 4999.0)]
    df = spark.createDataFrame(rows, "id string, dealer string, first_seen string, asking_price_usd double, status string, piece_name string")
    df = df.withColumn("asking_price", F.col("asking_price_usd"))
    got = alerts.new_today(df, "2026-01-02")
    assert got.where("dealer = 'new shop'").count() == alerted
    assert got.where("dealer IS NULL").count() == 1
    assert "Window" not in plan(got)


# --- store --------------------------------------------------------------------------
def _batch(spark, rows):
    df = spark.createDataFrame(rows, "listing_url string, piece_name string, asking_price double, dealer string, source string, pos int")
    absent = [f for f in schemas.LISTING.fields if f.name not in df.columns]
    return store.with_listing_key(df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]))


def _empty(spark):
    return spark.createDataFrame([], schemas.LISTING)


def test_merge_is_idempotent_within_a_day(spark):
    batch = _batch(spark, [("https://a.example/1?x=1", "Gold lion", 100.0, "A", "s", 1), ("https://a.example/1?x=2", None, 120.0, "A", "s", 2)])
    once = store.merge_listings(_empty(spark), batch, "2026-01-01", ["pos"])
    twice = store.merge_listings(once, batch, "2026-01-01", ["pos"])
    assert once.collect() == twice.collect()
    r = once.collect()[0]
    assert (r["id"], r["piece_name"], r["asking_price"], r["times_seen"], r["status"]) == ("url:a.example/1", "Gold lion", 120.0, 1, "active")
    assert r["tags"] == ["Animal/Creature"] and r["asking_price_usd"] == 120.0


def test_lifecycle_over_days(spark):
    a = [("https://a.example/1", "A", 1.0, "A", "s1", 1)]
    b = [("https://b.example/2", "B", 2.0, "B", "s2", 1)]
    s = _empty(spark)
    for day, rows in (("2026-01-01", a + b), ("2026-01-02", a), ("2026-01-03", a + b)):
        batch = _batch(spark, rows)
        s = store.merge_listings(s, batch, day, ["pos"])
        by_source = {r["id"]: r["status"] for r in store.mark_missing(s, day, batch).collect()}
        s = store.mark_missing(s, day)
        status = {r["id"]: r["status"] for r in s.collect()}
        if day == "2026-01-02":
            # the second source failed: the whole store is judged, or only the sources that came
            assert status["url:b.example/2"] == "inactive" and by_source["url:b.example/2"] == "active"
    r = {x["id"]: x for x in s.collect()}["url:b.example/2"]
    assert (r["times_seen"], r["first_seen"], r["last_seen"], r["status"]) == (2, "2026-01-01", "2026-01-03", "active")


def test_auction_merge_keeps_first_source_and_zero(spark):
    cols = "listing_url string, piece_name string, sold_price double, source string, pos int"
    absent = [f for f in schemas.AUCTION.fields if f.name not in ("listing_url", "piece_name", "sold_price", "source")]
    make = lambda rows: store.with_auction_key(
        spark.createDataFrame(rows, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    )
    s = store.merge_auctions(spark.createDataFrame([], schemas.AUCTION), make([("https://a.example/1", "X", 500.0, "first", 1)]), "2026-01-01", ["pos"])
    s = store.merge_auctions(s, make([("https://a.example/1#new", None, 0.0, "second", 1)]), "2026-01-02", ["pos"])
    r = s.collect()[0]
    assert (r["piece_name"], r["sold_price"], r["source"], r["first_captured"], r["sold_price_usd"]) == ("X", 0.0, "first", "2026-01-01", None)


def test_blocklist_ignores_queries(spark):
    rows = spark.createDataFrame([("https://x.example/a?lot=1",), ("https://x.example/b",)], "listing_url string")
    blocked = spark.createDataFrame([("http://x.example/a/",)], "url string")
    assert [r[0] for r in store.without_blocked(rows, blocked).collect()] == ["https://x.example/b"]


def test_collisions(spark):
    batch = _batch(spark, [(None, "Same", 1.0, "A", "s", 1), ("", " same ", 2.0, "A", "s", 2)])
    assert store.identity_collisions(batch).collect()[0]["rows"] == 2


def test_catalog_first_price_may_be_missing(spark):
    rows = [("k", "d1", 1, None), ("k", "d2", 1, 100.0), ("k", "d2", 2, 90.0)]
    df = spark.createDataFrame(rows, "id string, date string, pos int, price double")
    r = catalog.catalog(df).collect()[0]
    assert (r["first_price"], r["current_price"], r["min_price"], r["max_price"], r["times_seen"]) == (None, 90.0, 90.0, 100.0, 2)


def test_incremental_merge_equals_rebuild(spark, sf_dir):
    rows = adapters.sightings(spark, sf_dir).where("date <= '2024-01-03'")
    days = sorted(r[0] for r in rows.select("date").distinct().collect())
    from gavelkit.plans.stores import _listing_rows

    s, shaped = _empty(spark), _listing_rows(rows)
    for d in days:
        s = store.merge_listings(s, shaped.where(F.col("date") == d), d, ["pos"])
    got = {r["id"]: (r["times_seen"], r["asking_price"], r["first_seen"], r["last_seen"]) for r in s.collect()}
    want = {
        r["id"]: (r["times_seen"], r["current_price"], r["first_seen"], r["last_seen"]) for r in catalog.catalog(rows).collect()
    }
    assert got == want


def test_late_days_move_nothing_back(spark):
    cols = "id string, piece_name string, asking_price double, date string, source string, pos int"
    absent = [f for f in schemas.LISTING.fields if f.name not in ("id", "piece_name", "asking_price", "source")]
    wide = lambda r: spark.createDataFrame(r, cols).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    s = _empty(spark)
    for batch in ([("a", "new", 5.0, "2024-01-05", "s", 1)], [("a", "old", 3.0, "2024-01-03", "s", 1), ("b", "x", 1.0, "2024-01-03", "s", 2)], [("a", None, 6.0, "2024-01-05", "s", 1)]):
        s = store.mark_missing(store.merge_listing_days(s, wide(batch), "date", ["pos"]), "2024-01-05")
    got = {r["id"]: (r["piece_name"], r["asking_price"], r["first_seen"], r["last_seen"], r["times_seen"], r["status"]) for r in s.collect()}
    assert got == {"a": ("new", 6.0, "2024-01-03", "2024-01-05", 2, "active"), "b": ("x", 1.0, "2024-01-03", "2024-01-03", 1, "inactive")}


# --- pages -----------------------------------------------------------------------------
def test_stop_rules(spark):
    items = [("s", 1, i, i) for i in range(3)] + [("s", 2, i, i + 2) for i in range(3)] + [("s", 3, i, i + 2) for i in range(3)] + [("s", 4, 0, 9)]
    df = spark.createDataFrame(items, "shop string, page int, pos int, item_id int")
    counts = paging.page_counts(df)
    assert [(r["page"], r["items"], r["fresh"]) for r in counts.orderBy("page").collect()] == [(1, 3, 3), (2, 3, 2), (3, 3, 0), (4, 1, 1)]
    kept = lambda d: [r["page"] for r in d.where("kept").orderBy("page").collect()]
    assert kept(paging.stop_pages(counts)) == [1, 2]
    assert kept(paging.stop_pages(counts, stop_on_overlap=True)) == [1, 2]
    assert paging.stop_pages(counts, max_pages=2).where("truncated").count() == 1
    stalled = paging.stalled_pages(counts).orderBy("page").collect()
    assert [r["dropped"] for r in stalled] == [False, False, True, True]


def test_first_k_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 7 AS string)) AS g", "id AS pos", "cast(id AS string) AS name")
    out = ingest.first_k(df, "g", ["pos"], "name", 3)
    assert out.where("g = 'hot'").collect()[0]["sample"] == "0; 3; 6"
    assert "WindowGroupLimit" in plan(out)


# --- pairs -------------------------------------------------------------------------------
def _titles(spark):
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(25)]
    rows = []
    for i in range(160):
        n = rnd.randint(1, 6)
        cat = rnd.choice(["a", "b", None])
        rows.append((i, f"site{rnd.randint(0, 3)}", cat, float(rnd.choice([90, 99, 100, 110, 111, 121])), " ".join(rnd.sample(words, n))))
    # a third of all rows are copies of one listing
    rows += [(1000 + i, f"site{i % 4}", "a", 100.0, "word1 word2 word3") for i in range(80)]
    df = spark.createDataFrame(rows, "id int, site string, category string, price double, name string")
    return df.withColumn("tokens", title_tokens(F.col("name"))).cache()


def _brute_titles(df):
    a, b = df.alias("a"), df.alias("b")
    gap = F.abs(F.col("a.price") - F.col("b.price")) / F.greatest("a.price", "b.price")
    return a.join(
        b, (F.col("a.id") < F.col("b.id")) & F.col("a.category").eqNullSafe(F.col("b.category")) & (F.col("a.site") != F.col("b.site"))
    ).where((gap <= 0.1) & (jaccard(F.col("a.tokens"), F.col("b.tokens")) >= 0.3)).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))


def test_title_pairs_equal_brute_force(spark):
    df = _titles(spark)
    members = pairs.title_groups(df)
    links = pairs.title_links(members).cache()
    got = pairs.listing_pairs(members, links, [])
    want = {tuple(r) for r in _brute_titles(df).collect()}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    text = plan(pairs.title_links(members))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert pairs.pair_count(members.withColumn("dealer", F.col("site")), links).collect()[0][0] == len(want)
    share = pairs.involved_share(members, links).collect()[0]
    assert share["involved"] == len({i for p in want for i in p})


def test_title_tiles_equal_brute_force_and_no_pair_carries_words(spark):
    """Cells are cut into tiles of a few words; what is left after the comparison is links alone."""
    df = _titles(spark)
    members = pairs.title_groups(df)
    links = pairs.title_links(members, tile=20)
    got = [tuple(r) for r in pairs.listing_pairs(members, links, []).collect()]
    want = {tuple(r) for r in _brute_titles(df).collect()}
    assert len(got) == len(set(got)) and set(got) == want
    assert "array_intersect" not in plan(links) and "Join" not in plan(links)


def test_groups_are_compared_not_listings(spark):
    members = pairs.title_groups(_titles(spark).where("id >= 1000"))
    assert pairs.title_links(members).count() == 1


@pytest.mark.parametrize("bits", [0, 3, 10, 18])
def test_print_pairs_equal_brute_force(spark, bits):
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(12)]
    prints = []
    for i in range(150):
        x = rnd.choice(base)
        for b in rnd.sample(range(64), rnd.randint(0, 9)):
            x ^= 1 << b
        prints.append(x - 2**64 if x >= 2**63 else x)
    prints += [prints[0]] * 75
    df = spark.createDataFrame([(i, f"site{i % 3}", f"dealer{i % 5}", p) for i, p in enumerate(prints)], "id int, site string, dealer string, gid bigint")
    links = pairs.print_links(df.withColumnRenamed("gid", "print"), bits)
    got = {(r["id_a"], r["id_b"]): r["dist"] for r in pairs.listing_pairs(df, links, ["dist"]).collect()}
    want = {
        (i, j): d
        for i in range(len(prints)) for j in range(i + 1, len(prints))
        if i % 3 != j % 3 and (d := bin((prints[i] ^ prints[j]) % 2**64).count("1")) <= bits
    }
    assert got == want
    by_dealer = {r["dealer"]: r["involved"] for r in pairs.dealer_involvement(df, links).collect()}
    for k in range(5):
        assert by_dealer[f"dealer{k}"] == sum((i % 5 == k) + (j % 5 == k) for i, j in want)
    overlap = pairs.aggregator_overlap(df, links, ["dealer0"]).collect()[0]
    hit = {j for i, j in want if i % 5 == 0 and j % 5} | {i for i, j in want if j % 5 == 0 and i % 5}
    assert overlap["matched"] == len(hit)
    text = plan(links)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_prints_equal_in_most_bits_are_compared_once_a_pair(spark):
    """Three of four parts are equal in all prints: blocks by part would hold every pair hundreds of times."""
    rnd = np.random.default_rng(7)
    prints = np.unique(rnd.integers(0, 2**16, 3000)).astype(np.int64) << 48
    df = spark.createDataFrame([(int(p),) for p in prints], "print bigint")
    links = pairs.print_links(df, 3, tile=700)
    met = links.where("gid_a <> gid_b").toPandas()
    bits = prints.view(np.uint64)
    dist = np.bitwise_count(bits[:, None] ^ bits[None, :])
    want = {(min(a, b), max(a, b)): d for i, a in enumerate(prints.tolist()) for b, d in zip(prints[i + 1 :].tolist(), dist[i, i + 1 :].tolist(), strict=True) if d <= 3}
    assert len(met) == len(want) and {(a, b): d for a, b, d in met.itertuples(index=False)} == want
    whole = links._jdf.queryExecution().optimizedPlan().toString()
    assert "meet" not in whole and "mask" not in whole


# --- browse --------------------------------------------------------------------------------
def test_filters_reach_the_scans(spark, tmp_path):
    a = spark.createDataFrame([], schemas.AUCTION)
    d = spark.createDataFrame([], schemas.LISTING)
    a.write.parquet(str(tmp_path / "a"))
    d.write.parquet(str(tmp_path / "d"))
    f = browse.BrowseFilter(source="X", category="ring")
    rows = browse.browse_union(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "d")), f)
    text = plan(browse.browse_filter(rows, f).select("id"))
    for column in ("auction_house", "dealer"):
        assert f"EqualTo({column},X)" in text
    assert text.count("EqualTo(category,ring)") == 2 and "notes" not in text


def test_pushed_filters_keep_what_the_plain_filter_keeps(spark):
    names = ["X", " X ", "Xavier", "", None, "Unknown house", "Unknown dealer"]
    kinds = ["ring", "other", None, " ring", "rings"]
    pairs_ = [(n, k) for n in names for k in kinds]

    def store(schema, column):
        rows = [tuple({"id": f"{column}{i}", column: n, "category": k}.get(f.name) for f in schema.fields) for i, (n, k) in enumerate(pairs_)]
        return spark.createDataFrame(rows, schema)

    a, d = store(schemas.AUCTION, "auction_house"), store(schemas.LISTING, "dealer")
    for f in [browse.BrowseFilter(source=s, category=c) for s in (None, "X", "Unknown house", "Unknown dealer") for c in (None, "ring", "other")]:
        plain = browse.browse_filter(browse.browse_union(a, d), f).select("id").collect()
        assert sorted(browse.browse_filter(browse.browse_union(a, d, f), f).select("id").collect()) == sorted(plain)


def test_series_replaces_the_same_date(spark):
    series = spark.createDataFrame([("d1", 1), ("d2", 2)], "date string, n int")
    row = spark.createDataFrame([("d2", 5)], "date string, n int")
    assert [tuple(r) for r in stats.upsert_series(series, row, keep=2).collect()] == [("d1", 1), ("d2", 5)]
    assert [r["date"] for r in stats.upsert_series(series, row.withColumn("date", F.lit("d3")), keep=2).collect()] == ["d2", "d3"]
