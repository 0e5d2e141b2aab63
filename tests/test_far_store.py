"""A shared folder in a store that only Spark reaches, and one that is named without its file system."""

import gzip
import json
import uuid

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gavelkit import session
from gavelkit.llm import alignment, common, idfile, warc
from gavelkit.sources import arrays

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def far(spark, tmp_path, monkeypatch):
    """The address of a folder that Python can't open by that name."""
    store = uuid.uuid4().hex
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{store}.link./in", f"file://{tmp_path}")
    monkeypatch.setattr(session, "shared_folder", lambda _: f"viewfs://{store}/in")
    return f"viewfs://{store}/in"


def _documents(spark, n=60):
    texts = [None, "", "the cat and the dog", "naïve 東京", *(f"text number {k} of many " * (k % 7) for k in range(n))]
    return spark.createDataFrame([(len(texts) - k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)


def test_files_hold_the_bytes_of_rows(spark, far):
    raw = [bytes(range(256)) + b"\0", b"\0", b"\xff\n\r\n" * 1000 + b"\0\0"]
    rows = spark.createDataFrame([(x,) for x in raw], "x binary").coalesce(1)
    paths = common.write_files(rows, f"{far}/some", "bin")
    assert [spark.read.format("binaryFile").load(p).first().content for p in paths] == [bytearray(x) for x in raw]
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == sorted(r.path.rsplit("/", 1)[1] for r in spark.read.format("binaryFile").load(f"{far}/some").collect())
    assert common.write_files(rows.limit(0), f"{far}/none", "bin") == [] and common.file_contents(spark, []).collect() == []
    with pytest.raises(Exception, match="zero byte"):
        common.write_files(spark.createDataFrame([(b"x",)], "x binary"), f"{far}/bad", "bin")
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{far}/bad").collect() == []


def test_id_files_in_a_far_store(spark, far):
    docs, lib, start = _documents(spark), Tokenizer.from_file(WORDS), 0
    got = sorted(idfile.round_trip(spark, docs, WORDS).collect(), key=lambda r: r.start)
    for d, r in zip(docs.orderBy("doc_id").collect(), got, strict=True):
        ids = [*lib.encode(d.text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (d.doc_id, start, len(ids), ids)
        start += len(ids)


def test_a_task_writes_several_id_files(spark, tmp_path):
    docs = _documents(spark).withColumn("text", F.repeat(F.col("text"), 20_000))
    files = idfile.write_ids(docs, str(tmp_path / "many"), WORDS, 1, file_bytes=20_000)
    one = idfile.write_ids(docs, str(tmp_path / "one"), WORDS, 1)
    assert files.count() > one.count() and files.agg(F.sum("n_docs")).first()[0] == docs.count()
    show = lambda df: sorted((r.start, r.doc_id, r.n_tokens, r.crc) for r in df.withColumn("crc", F.crc32("ids")).collect())
    assert show(idfile.read_ids(files)) == show(idfile.read_ids(one))


def test_archives_in_a_far_store(spark, far):
    pages = spark.createDataFrame([(k, "u", "same" if k % 3 else f"page {k}") for k in range(40)], "page_id bigint, url string, html string").repartition(3)
    rows = warc.round_trip(spark, pages).select(warc.page_number(F.col("record_id")).alias("page"), warc.page_number(F.col("refers_to")).alias("to"), "payload_length").collect()
    assert sorted((r.page, r.to, r.payload_length) for r in rows) == [(k, 38 if k % 3 and k != 38 else None, 4 if k % 3 else len(f"page {k}")) for k in range(40)]
    files = warc.write_warc(pages, f"{far}/warc", file_bytes=300).collect()
    assert len(files) > 3 and sum(f.records for f in files) == 40
    some = warc.read_warc(spark, [f.path for f in files], tests=[("record_type", "=", "response")]).collect()
    assert sorted(bytes(r.payload) for r in some) == sorted([b"same", *(f"page {k}".encode() for k in range(0, 40, 3))])
    with pytest.raises(ValueError, match="no test"):
        warc.read_warc(spark, [f.path for f in files], tests=[("payload", "=", 1)])


def test_archives_are_whole_gzip_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "é" * 9_000_000)], "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "out")).collect()
    found = list((tmp_path / "out").glob("*.warc.gz"))
    assert [p.suffix for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == [".gz"] * len(found)
    assert sum(gzip.decompress(p.read_bytes()).count(b"WARC/1.1") for p in found) == 2
    assert spark.read.format("warc").load(f"file://{tmp_path}/out").count() == 2


def test_alignment_in_a_far_store(spark, far, monkeypatch, tmp_path):
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    docs = _documents(spark)
    got = [sorted(map(str, df.collect())) for df in alignment.aligned(docs, *paths, parts=3, run_links=50, fan=2)]
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "near"))
    assert got == [sorted(map(str, df.collect())) for df in alignment.aligned(docs, *paths)] and len(got[0]) == docs.count()


def test_array_files_in_a_far_store(spark, far, tmp_path):
    rows = spark.createDataFrame([(f"d{k % 5}", k, 'q"}\n' if k % 3 else None, 1) for k in range(200)], "day string, at int, text string, one int").repartition(4)
    for folder in (f"{far}/out", str(tmp_path / "near")):
        arrays.write_arrays(rows, "day", ["at"], folder)
        arrays.write_arrays(rows.where("day = 'd2' AND at > 100").withColumn("text", F.lit("new")), "day", ["at"], folder)
    shown = lambda name: {p.name: p.read_bytes() for p in (tmp_path / name).iterdir() if not p.name.startswith(".")}
    assert shown("out") == shown("near") and len(shown("out")) == 5
    assert [x["text"] for x in json.loads(shown("out")["d2.json"])] == ["new"] * 20
    with pytest.raises(Exception, match="no file name"):
        arrays.write_arrays(rows.withColumn("day", F.when(F.col("at") != 7, F.col("day"))), "day", ["at"], f"{far}/bad")
    assert not list(tmp_path.glob("bad/[!.]*"))
    names = ["a b", "x=1", "50%", "é", "#", "a.b"]
    odd = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "day string, at int").withColumn("piece_name", F.col("day"))
    arrays.write_arrays(odd, "day", ["at"], f"{far}/odd")
    arrays.write_arrays(odd.limit(0), "day", ["at"], f"{far}/odd")
    assert sorted(p.name for p in (tmp_path / "odd").iterdir() if not p.name.startswith(".")) == sorted(f"{n}.json" for n in names)


def test_scan_snapshots_in_a_far_store(spark, far, sf_dir):
    from gavelkit.plans.stores import QUERIES

    events = spark.read.parquet(f"{sf_dir}/events.parquet").limit(900)
    events.write.parquet(f"{far}/tables/events.parquet")
    got = QUERIES["scan_snapshots"](spark, f"{far}/tables")
    assert got.count() == got.select("date_pulled", "pos").distinct().count() == 900


def test_scan_snapshots_of_undated_events(spark, tmp_path):
    import duckdb

    from gavelkit.plans.stores import ORACLES, QUERIES

    days = F.when(F.col("id") % 4 != 0, F.timestamp_seconds(F.col("id") * 40_000))
    events = spark.range(200).select(F.col("id").alias("event_id"), days.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") / 2).alias("value"), F.lit('{"k": "}"}').alias("props"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want, got = con.execute(ORACLES["scan_snapshots"]), QUERIES["scan_snapshots"](spark, str(tmp_path))
    names = [d[0] for d in want.description]
    rows = sorted(str(tuple(r[n] for n in names)) for r in got.collect())
    assert rows == sorted(map(str, want.fetchall())) and sum(r.startswith("(None") for r in rows) == 50
