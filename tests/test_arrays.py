"""Array files: cut in parallel like one reader would, written whole or not at all."""

import json
import random

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from gavelkit.sources import arrays

SHAPE = "k BIGINT, text STRING, more STRUCT<list: ARRAY<STRUCT<z: STRING>>>"
PARTS = ["a", '"', "\\", "{", "}", "[", "]", ",", "\n", "é", "日本", '\\"', '"}', "x" * 40, " "]


def _records(n, seed):
    draw = random.Random(seed)
    text = lambda: "".join(draw.choice(PARTS) for _ in range(draw.randrange(30)))
    out = [{"k": k, "text": text(), "more": {"list": [{"z": text()} for _ in range(draw.randrange(3))]}} for k in range(n)]
    out[n // 2]["text"] = "}{" * 4000  # a record that is longer than some splits
    return out


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_same_records_as_one_reader(spark, tmp_path, small_splits):
    whole = {"a": _records(300, 1), "b": _records(40, 2)}
    (tmp_path / "a.json").write_text(json.dumps(whole["a"], ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps(whole["b"], indent=2))
    for name, text in {"none": "", "empty": " [ ]\n", "object": '{"k": 1}', "cut": '[{"k": 1}, {"k": 2', "open": '[{"k": 1}', "string": '[{"k": 1}, "]', "more": '[{"k": 1}]}\n'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = arrays.scan_arrays(spark, str(tmp_path), SHAPE, "*.json")
    assert arrays._split_states(arrays._pieces(spark, str(tmp_path / "a.json"), None)).count() > 10
    rows = got.select(F.regexp_extract("file", r"(\w+)\.json$", 1).alias("f"), "pos", F.to_json("record").alias("r")).collect()
    found = {(r["f"], r["pos"]): json.loads(r["r"]) for r in rows}
    assert len(rows) == len(found) == 340
    assert found == {(f, i): x for f, xs in whole.items() for i, x in enumerate(xs)}


def test_elements_that_are_no_objects(spark, tmp_path):
    (tmp_path / "x.json").write_text('[1, {"k": 7}, "s", null, {"k": bad}, {"k": 8}, [2]]')
    rows = arrays.scan_arrays(spark, str(tmp_path / "x.json"), SHAPE).orderBy("pos").collect()
    assert [(r["pos"], r["record"]["k"]) for r in rows] == [(0, 7), (1, None), (2, 8)]


def test_written_files(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([("d1", 2, "b"), ("d1", 1, 'q"}\n'), ("d2", 1, None)], "day string, at int, text string")
    arrays.write_arrays(rows, "day", ["at"], folder)
    arrays.write_arrays(rows.where("day = 'd2'").withColumn("text", F.lit("new")), "day", ["at"], folder)
    assert {p.name: json.loads(p.read_text()) for p in (tmp_path / "out").iterdir()} == {"d1.json": [{"text": 'q"}\n'}, {"text": "b"}], "d2.json": [{"text": "new"}]}


def test_small_records_share_writes(tmp_path, monkeypatch):
    opened = []

    class Store(fs.SubTreeFileSystem):
        def open_output_stream(self, path, **options):
            opened.append(options.get("buffer_size") or 0)
            return super().open_output_stream(path, **options)

    writer = arrays._ArrayWriter(str(tmp_path))
    monkeypatch.setattr(writer, "_at", lambda: (Store(str(tmp_path), fs.LocalFileSystem()), "out"))
    writer.commit([writer.write(iter([("d1", "{}"), ("d1", "{}"), ("d2", "{}")]))])
    assert len(opened) == 2 and min(opened) >= 1 << 16
    assert json.loads((tmp_path / "out" / "d1.json").read_text()) == [{}, {}]


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([("d1", 1, "a"), (None, 2, "b")], "day string, at int, text string")
    with pytest.raises(Exception, match="no file name"):
        arrays.write_arrays(rows, "day", ["at"], folder)
    assert not list((tmp_path / "out").glob("*")) if (tmp_path / "out").exists() else True
