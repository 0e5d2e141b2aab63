"""Token id files and WARC archives: round trips, odd rows, foreign archives; the pipeline; oracles."""

import base64
import gzip
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gavelkit.llm import idfile, warc
from gavelkit.llm.queries import ORACLES, QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_packing_comes_back():
    r = random.Random(1)
    for n in [0, 1, 2, 59, 60, 61, 300] * 20:
        ids = np.array([r.getrandbits(r.choice([1, 7, 16, 40, 60, 64])) for _ in range(n)], np.uint64)
        assert np.array_equal(idfile.unpack(idfile.pack(ids)), ids) and np.array_equal(idfile.unpack(idfile.pack(ids, 100)), ids)
        cuts = np.array(sorted({0, n, n // 3}))
        blocks = idfile.pack_all(ids, cuts)
        assert all(np.array_equal(idfile.unpack(b), ids[cuts[k] : cuts[k + 1]]) for k, b in enumerate(blocks))


def test_words_equal_the_library():
    mine, lib, r = idfile.WordTokenizer(WORDS, keep=40), Tokenizer.from_file(WORDS), random.Random(2)
    parts = ["the", " ", "é", "É", "\x1c", "\x85", " ", "don't", "'LL", "😀", "한국", "<|endoftext|>", "<|", "İ", "ß", "Ⅷ", "²", "é", "\n", "1234", "#!?", "ſ", "ª", "x'sy", "Σ"]
    for text in ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(800)]:
        assert np.frombuffer(mine.batch([text])[0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_plain_words_are_merged_without_the_library():
    mine, lib = idfile.WordTokenizer(WORDS), Tokenizer.from_file(WORDS)
    ask, asked = mine.raw, []
    mine.raw = lambda texts: asked.extend(texts) or ask(texts)
    text = "Zqörvlant's unheard-of blorptastic, xx'llama 'SS !'s 12½ a.b.c don't naïveté" + " q" * 3 + " " + "ab" * 700
    assert np.frombuffer(mine.batch([text])[0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    assert asked == ["ab" * 700]  # very long words alone are the library's
    whole = [t.removesuffix("</w>") for t in lib.get_vocab() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha()]
    assert [len(r) for r in mine.batch(whole)] == [4] * len(whole)


def test_blocks_are_taken_apart_together():
    r = random.Random(7)
    parts = [np.array([r.getrandbits(r.choice([1, 9, 16, 62])) for _ in range(n)], np.uint64) for n in (0, 3, 500, 1, 0, 77)]
    blocks = [idfile.pack(x, 1 << 20) for x in parts]
    at = np.cumsum([0, *map(len, blocks)])[:-1]
    assert np.array_equal(idfile.unpack_all(b"".join(blocks), at), np.concatenate(parts))


def test_id_files_of_odd_rows(spark):
    texts = [None, "", "  ", "some words", "some words", "long " * 70_000, "😀"]
    rows = [(k * 3 % 7 - 2, t, 1, 2) for k, t in enumerate(texts)] + [(None, "no id", 1, 2), (4, "twice", 1, 2), (4, "twice", 1, 2)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, start int, ids int").repartition(3)
    out = sorted(idfile.round_trip(spark, table, WORDS).collect(), key=lambda r: r.start)
    lib = Tokenizer.from_file(WORDS)
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:])) and out[0].start == 0
    want = sorted((r[0] if r[0] is not None else -9, tuple(lib.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -9, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in out) == want
    assert idfile.round_trip(spark, table.limit(0), WORDS).collect() == []


def test_id_query(spark, sf_dir):
    lib, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: r for r in QUERIES["op9_id_files"](spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = [*lib.encode(d.text or "", add_special_tokens=False).ids, 1]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


PAGES = [(1, "http://a/x y", "<p>é</p>"), (2, None, None), (3, "u", ""), (9, "u", "<p>é</p>"), (5, "u", "<p>é</p>"), (9, "u", "<p>é</p>"), (None, "u", "<p>é</p>"), (None, "u", "lone"), (10, "u", "long " * 100_000)]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('warc')}"
    pages = spark.createDataFrame([(*p, 1, b"") for p in PAGES], "page_id bigint, url string, html string, keeper int, payload binary").repartition(2)
    return folder, [r.path for r in warc.write_warc(pages, folder, file_bytes=200).collect()]


@pytest.mark.parametrize("payload", ["full", "verify", "skip"])
def test_warc_round_trip(spark, archives, payload):
    rows = warc.read_warc(spark, archives[1], payload).select(warc.page_number(F.col("record_id")).alias("page"), "*").collect()
    assert len(rows) == len(PAGES)
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        mine = [r for r in rows if r.page == page_id and r.payload_digest == digest]
        assert mine and all(r.payload_length == len(raw) for r in mine)
        for r in mine:
            if html == "<p>é</p>" and page_id != 9 or page_id == 2:
                assert r.record_type == "revisit" and r.refers_to == f"{warc.RECORD}{3 if page_id == 2 else 9}" and r.payload is None
            else:
                assert r.record_type == "response" and r.refers_to is None and (r.payload == raw if payload == "full" else r.payload is None)


def test_warc_tests_are_applied_in_the_reader(spark, archives):
    rows = warc.read_warc(spark, archives[1])
    whole = rows.collect()
    for tests, keep in (
        ([("record_type", "=", "revisit")], lambda r: r.record_type == "revisit"),
        ([("record_type", "!=", "revisit"), ("content_length", ">=", 1000)], lambda r: r.record_type != "revisit" and r.content_length >= 1000),
        ([("header:WARC-Refers-To", "there", True), ("target_uri", "starts", "http:")], lambda r: r.refers_to is not None and (r.target_uri or "").startswith("http:")),
        ([("record_id", "in", [f"{warc.RECORD}2"])], lambda r: r.record_id == f"{warc.RECORD}2"),
    ):
        some = warc.read_warc(spark, archives[1], tests=tests).collect()
        assert sorted(map(str, some)) == sorted(str(r) for r in whole if keep(r)) and some
    # one DataFrame, two queries: neither changes the other
    assert rows.where("record_type = 'revisit'").count() == 4 and rows.count() == len(PAGES)
    with pytest.raises(ValueError, match="no test"):
        warc.WarcReader([], "full", [["payload", "=", 1]])
    assert warc.parse(b"x\r\nA: b\r\n c\r\n\r\n") == {"a": "b c"}


def test_payloads_that_nobody_wants_are_not_inflated(tmp_path):
    noise = random.Random(1).randbytes(3_000_000)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(warc.member(warc.record(k, "u", noise, None, "2020-01-01T00:00:00Z")) for k in range(3)))

    class Counted:
        def __init__(self, f):
            self.f, self.n = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            self.n += len(out := self.f.read(n))
            return out

    with open(path, "rb") as f:
        counted = Counted(f)
        heads = [h for _, h, _ in warc.Archive(counted).records()]
    assert len(heads) == 3 and counted.n < 10 * warc.CHUNK


def test_foreign_archives(spark, tmp_path):
    record = warc.record(7, "http://x/", b"body" * 50_000, None, "2020-01-01T00:00:00Z")
    (tmp_path / "a.warc").write_bytes(b"\r\n" + record * 3)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record) * 2 + gzip.compress(record + record[:0]))
    (tmp_path / "empty.warc").write_bytes(b"")
    warc.read_warc(spark, [])
    rows = spark.read.format("warc").load(f"file://{tmp_path}").collect()
    assert len(rows) == 6 and all(r.payload == b"body" * 50_000 for r in rows)
    (tmp_path / "a.warc").write_bytes(record.replace(b"bodybody", b"bodyBODY"))
    with pytest.raises(Exception, match="doesn't have its digest"):
        spark.read.format("warc").load(f"file://{tmp_path}/a.warc").collect()


def test_warc_of_an_empty_table(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want, got = con.execute(ORACLES[name]), QUERIES[name](spark, sf_dir)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r[n] for n in names)) for r in got.collect())


ODD = [(1, "The cat and the dog were in the house.", "en", "s", 5), (1, "The cat and the dog were in the house.", "en", "s", 5), (None, "The cat and the dog were in the house.", None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "12 !!", "en", "s", 3), (5, "the password: hunter22 of the cat", "en", "s", 33), (6, "le chat et les chiens dans la maison avec des hommes", "fr", "s", 9)]


def test_pipeline_of_odd_rows(spark, tmp_path):
    rows = ODD + [(100 + k, f"the cat and the dog were in the house number {k} with that man", "en", "s", 1) for k in range(40)] + [(200 + k, f"le chat et le chien sont dans la maison {k} avec les hommes", "fr", "s", 1) for k in range(40)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, gk_gone int")
    item = spark.createDataFrame([(1, "le chat et les chiens dans la maison avec des hommes")], "item_id bigint, text string")
    for name, df in (("some", table), ("none", table.limit(0))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        item.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/some")
        assert docs.columns == table.columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = {(r.doc_id, r.text, r.n_chars) for r in docs.collect()}
    ids = [x[0] for x in left]
    assert ids.count(1) == 1 and None not in ids and not {2, 3, 4, 6} & set(ids)
    assert (5, "the [secret] of the cat", 23) in left
    assert docs.count() == len(left)
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() == len(left)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
