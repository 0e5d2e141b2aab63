"""Cases that were once lost: reply order, documents of two days, deep lots."""

import json

import pytest
from pyspark.sql import functions as F

from gavelkit.functions.text import tags_of
from gavelkit.operators import profiling
from gavelkit.plans.adapters import DEMO_TAGS, listings
from gavelkit.session import spread
from gavelkit.sources.extract import hits, text


def reply(spark, *blocks):
    body = json.dumps({"content": [{"type": "text", "text": b} for b in blocks]})
    rows = spark.createDataFrame([(1, body)], "k int, body string")
    return [r.piece_name for r in text.reply_items(rows, ["piece_name"]).orderBy("item").collect()]


@pytest.mark.parametrize(
    ("blocks", "names"),
    [
        (['[{"piece_name":"OLD"}]', 'see [the list] [{"piece_name":"NEW"}] and [more'], ["NEW"]),
        (['x [a] [{"piece_name":"FIRST"}] [', '[{"piece_name":"MID"}]', "none"], ["MID"]),
        (['x [a] [{"piece_name":"FIRST"}] [', "none [at all"], ["FIRST"]),
        (['[{"piece_name":"A"}', "]"], ["A"]),
        (["```json\n[{\"piece_name\":\"F\"}]\n```"], ["F"]),
        (["nothing"], []),
    ],
)
def test_replies_are_tried_block_by_block(spark, blocks, names):
    assert reply(spark, *blocks) == names


def _found_lots(node, path="$"):
    """Plain recursion: paths of objects with a lot number and a price."""
    if isinstance(node, dict):
        low = {k.lower() for k in node}
        if "lotnumber" in low and "saleprice" in low:
            return [path]
        return [p for k, v in node.items() for p in _found_lots(v, f"{path}.{k}")]
    if isinstance(node, list):
        return [p for k, v in enumerate(node) for p in _found_lots(v, f"{path}[{k}]")]
    return []


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_lots_at_any_depth(spark, levels):
    documents = []
    for depth in (0, 1, 7, 8, 9, 17, 40):
        deep = {"lotNumber": depth, "salePrice": 5, "inner": {"lotNumber": 1, "salePrice": 2}}
        for k in range(depth):
            deep = {"a": deep, "b": {}, "c": [[], {"x": None}]} if k % 2 else [deep, 1]
        documents.append(deep)
    documents += [{"a": {"b": {}, "c": []}}, {}, [], 5]
    rows = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(documents)] + [(98, None), (99, "{broken")], "k int, body string")
    got = sorted((r.k, r.path) for r in profiling.lot_objects(rows, "body", levels=levels).collect())
    assert got == sorted((k, p) for k, d in enumerate(documents) for p in _found_lots(d))


def test_a_level_of_lots_takes_one_step(spark):
    """The whole text or schema of an open node at every level costs the rest of its depth again and again."""
    rows = spark.createDataFrame([(1, '{"a":{"lotNumber":1,"salePrice":2}}')], "_kept int, lot string").withColumn("path", F.lit("$"))
    found = profiling._lot_levels(rows, 4)
    text = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "schema_of_variant" not in text and "schemaofvariant" not in text and "json_object_keys" not in text
    assert [(r.path, r.done) for r in found.collect()] == [("$.a", True)]


def test_a_document_of_two_days_is_two_rows(spark):
    body = lambda p: json.dumps({"results": [{"hits": [{"document": {"id": "d1", "title": "Ring", "price": {"hammerPrice": p}}}]}]})
    rows = spark.createDataFrame([("s", "2024-01-01", 1, 0, body(100)), ("s", "2024-01-02", 1, 0, body(900)), ("s", "2024-01-02", 2, 1, body(700))], "source string, run_date string, page int, pos int, body string")
    out = hits.document_hits(rows, "House").select(F.col("sold_price")).collect()
    assert sorted(r.sold_price for r in out) == [100, 900]


def test_a_file_whose_rows_lie_in_one_split_is_dealt_out(spark, tmp_path):
    """Splits are cut by bytes; a file of one row group has as many, but one of them holds all rows."""
    path = str(tmp_path / "one")
    spark.range(40_000).selectExpr("id", "uuid() AS t").coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = lambda d: [len(p) for p in d.select("id").rdd.glom().collect()]
        assert max(sizes(df)) == 40_000
        assert max(sizes(spread(df))) < 10_000
        near = sizes(spread(df, rows=1_000, by="id"))
        assert sum(near) == 40_000 and max(near) < 2_500
        assert max(sizes(spread(spark.range(10_000, numPartitions=1), rows=500))) < 1_000
        assert sizes(spread(spark.range(0))) is not None
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_shape_parses_each_level_once(spark):
    rows = spark.createDataFrame([(1, '{"b":[{"nbHits":7,"page":"x"}],"a":2}'), (2, "[]"), (3, "5"), (4, None)], "k int, body string")
    out = profiling.json_shape(rows, "body")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") <= 6 * 2
    got = {r["k"]: (r["top_keys"], r["arrays"], r["paging"]) for r in out.collect()}
    assert got == {1: ("b,a", ["b:1"], ["nbHits=7"]), 2: ("array[0]", [], []), 3: (None, [], [])}


def test_tag_rules_are_tried_once_a_part(spark, sf_dir):
    """Lines share their part's name, so the rules stand below the join; the decade belongs to the line."""
    out = listings(spark, sf_dir).select("tags")
    text = out._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join")
    assert "anvil" in text[join:] and "anvil" not in text[:join]
    whole = listings(spark, sf_dir)
    again = tags_of(F.col("piece_name"), F.col("era_or_year"), DEMO_TAGS)
    assert whole.where(~F.col("tags").eqNullSafe(again)).count() == 0
