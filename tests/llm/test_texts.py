"""Language ID, pieces, token counts, secrets: odd rows, brute force, round trips."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from gavelkit.llm import language, pieces, secret_scan, token_counts
from gavelkit.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\t", "12 34 !!", "a", "the  cat", "ÀÉ ñ", "\0x", "😀 한국 é", "▁x ▁", "word " * 40_000, "x" * 3000, "same text", "same text"]
DDL = "doc_id bigint, text string, lang string, score int, gk_language int, secrets int, pieces int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k if k != 3 else None, t, None, 1, 2, 3, 4) for k, t in enumerate(ODD)]
    return spark.createDataFrame(rows, DDL)


def model():
    texts = {"en": "the cat and the dog were in the house with that man ", "es": "el perro y la casa con los hombres que estaban en la calle "}
    return language.LanguageModel({k: (v * 20).encode() for k, v in texts.items()})


def test_language_of_odd_rows(spark, odd):
    out = language.with_language(odd, model(), out="found").collect()
    assert len(out) == len(ODD)
    for r in out:
        has = any(c.isalpha() for c in r.text or "")
        assert (r.found.lang == "und") == (not has) and 0 <= r.found.score <= 1
        assert has or r.found.rejected
    assert len({r.found for r in out if r.text == "same text"}) == 1
    kept = language.accepted(odd, model())
    assert kept.columns == odd.columns and kept.count() == sum(not r.found.rejected for r in out)


def test_language_is_told_and_ties_are_rejected():
    one = model().classifier()
    assert one("The dog and the cat were with that man.")[0] == "en" and one("LOS PERROS ESTABAN EN LA CALLE")[0] == "es"
    same = language.LanguageModel({"a": b"the cat", "b": b"the cat"}).classifier()
    assert same("the cat")[0] == "a" and same("the cat")[3]
    assert language.LanguageModel({}).classifier()("word") == ("und", 0.0, 0, True)


def test_language_fit_ignores_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([("uno dos tres", "es"), (None, "es"), ("no label", None), ("", "de"), ("11", "de")], "text string, lang string")
    assert set(language.fit(rows).dictionaries) == {"es"}
    assert language.fit(rows.limit(0)).dictionaries == {}


def test_language_fit_learns_a_language_of_few_texts_in_many_rows(spark):
    texts = spark.range(200).select(F.concat(F.lit("palabra número "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    # the draw by hash at a rate of 800 in 2,000 rows would pass over each of these
    few = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) >= 0.4 * (1 << 20)).orderBy("text").limit(5)
    rows = few.crossJoin(spark.range(400)).select("text", F.lit("es").alias("lang"))
    raw = language.fit(rows).dictionaries["es"].decode()
    assert raw.count("palabra") == 5


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op1_language_id"](spark, sf_dir)
    rows = out.join(docs, "doc_id").where("lang is not null").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and sum(r.rejected for r in rows) <= 0.03 * len(rows)


def test_pieces_equal_the_library():
    m, lib, r = pieces.PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(1)
    parts = ["the", "  ", " ", "é", "▁", "\n", "\0", "😀", "ing", " The", "don't", "##", "한", "<s>", "<0x41>", " " * 17, "aa", "́", "xxxxxxx"]
    for text in ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(1500)] + [t or "" for t in ODD]:
        want = lib.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(m.encode(text), "<u4").tolist() == want
        assert m.decode(m.encode(text)) == lib.decode(want)


def test_pieces_last_tokens_are_unique_and_caches_are_bounded():
    m = pieces.PieceModel(PIECES, cache_rows=50)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    word = "▁thunderstorms"
    last = m.table(word)
    for e in range(1, len(word) + 1):
        assert m.piece[last[e]] == m.merged(word[:e])[-1]
    text = " ".join(f"word{k}x" for k in range(500))
    assert np.frombuffer(m.encode(text), "<u4").tolist() == lib.encode(text, add_bos=True, add_eos=True)
    assert max(len(m.long), len(m.short) / 2, len(m.fits) / 3) <= 50


def test_pieces_of_odd_rows(spark, odd):
    out = pieces.with_pieces(odd.drop("pieces"), PIECES).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in out:
        assert np.frombuffer(r.pieces.ids, "<u4").tolist() == lib.encode(r.text or "", add_bos=True, add_eos=True)
    assert pieces.with_pieces(odd.drop("pieces").limit(0), PIECES).collect() == []


def test_piece_query_digests(spark, sf_dir):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op3_pieces"](spark, sf_dir).collect():
        ids = lib.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())


def best_split(word, trie):
    table = [(0.0, 0)]
    for e in range(1, len(word) + 1):
        ways = [(table[s][0] + trie.scores[word[s:e]], -table[s][1] - 1) for s in range(e) if word[s:e] in trie.scores]
        n = len(word[e - 1].encode())
        score, count = max(ways) if ways else (table[-1][0] + n * trie.unknown, -table[-1][1] - n)
        table.append((score, -count))
    return table[-1]


def test_token_counts_equal_brute_force(spark, sf_dir, odd):
    trie = token_counts.vocabulary(PIECES)
    for rows in (odd.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id % 10 = 0")):
        for r in token_counts.with_token_counts(rows, PIECES).collect():
            words = (r.text or "").split()
            split = {w: best_split("▁" + w, trie) for w in set(words)}
            assert (r.counts.n_pretokens, r.counts.n_tokens) == (len(words), sum(split[w][1] for w in words))
            assert math.isclose(r.counts.log_prob, math.fsum(split[w][0] for w in words), abs_tol=1e-6)


def test_token_counts_of_one_batch_do_not_depend_on_another():
    trie = token_counts.vocabulary(PIECES)
    fresh = token_counts.UnigramTrie(trie.scores, trie.unknown, keep=3)
    texts = ["thunder thunders thunderstorm", "storm thunder 😀", None, "thunder"]
    assert [fresh.batch([t])[0] for t in texts] == trie.batch(texts) and len(fresh.terminals) <= 3


def slow_windows(run, bits, window):
    hot = [k for k in range(len(run) - window + 1) if -sum(c / window * math.log2(c / window) for c in (run[k : k + window].count(x) for x in set(run[k : k + window]))) >= bits - 1e-9]
    covered = sorted({i for k in hot for i in range(k, k + window)})
    return [(a, b) for a, b in re_spans(covered)]


def re_spans(places):
    out = []
    for p in places:
        if out and out[-1][1] == p:
            out[-1] = (out[-1][0], p + 1)
        else:
            out.append((p, p + 1))
    return out


def test_sliding_entropy_equals_brute_force():
    r = random.Random(5)
    for _ in range(300):
        run = "".join(r.choice("0123456789abcdef"[: r.choice([2, 6, 16])]) for _ in range(r.randint(1, 80)))
        found = secret_scan.hot_windows(run, 3.0)
        assert sorted({i for a, b in found for i in range(a, b)}) == sorted({i for a, b in slow_windows(run, 3.0, 20) for i in range(a, b)})


def test_secret_kinds_and_allow_list():
    scan = secret_scan.scanner()
    kinds = lambda t: [x[2] for x in scan(t)]
    assert scan('API_KEY = "abc.def"') == [(0, 18, "assign")] and kinds("token=ab") == []
    assert kinds("ſecret=abcdefgh") == [] and kinds("secret=token:longvalue1") == []
    assert kinds("AKIA" + "A1" * 8) == ["access"] and kinds("AKIA" + "A" * 15) == []
    assert kinds("0123456789abcdef01234567") == ["hex", "entropy_hex"] and kinds("0" * 24) == ["hex"]
    assert kinds("123e4567-e89b-12d3-a456-426614174000") == [] and kinds("aB3dE5gH7jK9mN1pQ4sT6v") == ["entropy_mixed"]
    assert kinds("notsorandomtextofletters") == [] and scan(None) == scan("") == []


def test_redaction_keeps_rows(spark, odd):
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "x password: hunter22 y " + "f0" * 20)], "doc_id bigint, text string"))
    out = {r.doc_id: r.text for r in secret_scan.redacted(rows).collect()}
    assert out[99] == "x [secret] y [secret]" and out[0] is None and out[11] == ODD[11] and len(out) == len(ODD) + 1


def test_secret_query_equals_plain_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    word = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for r in QUERIES["op8_secrets"](spark, sf_dir).collect():
        t = texts[r.doc_id]
        spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(word + "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m.group(1)) > 5]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) > 19]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) > 23]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len(spans)
