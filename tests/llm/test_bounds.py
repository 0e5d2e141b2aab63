"""What workers keep, names that clash, letters, hot ids."""

import random
import re
import time

import public_tokenizers
from pyspark.sql import functions as F

from gavelkit.llm import idfile, language, pieces, sharding
from gavelkit.llm.common import BoundedCache, small_batches
from gavelkit.llm.language import letters


def test_cache_keeps_no_long_texts():
    cache = BoundedCache(10)
    assert cache.keep("x" * 65, 1) == 1 and not cache
    for k in range(50):
        cache.keep(f"w{k}", k)
    assert len(cache) <= 10 and "w49" in cache


def test_long_words_leave_worker_caches_small():
    r = random.Random(1)
    texts = ["".join(r.choice("abcdefgh") for _ in range(5_000)) + " and short words" for _ in range(40)]
    m = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    w = idfile.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    known = [m.encode(t) for t in texts]
    w.batch(texts)
    for cache in (m.short, m.long, w.words, w.parts):
        assert max(map(len, cache), default=0) <= BoundedCache.LONGEST
    assert known == [m.encode(t) for t in texts]


def test_numbers_are_no_letters():
    model = language.LanguageModel({"en": b"the cat sat on the mat", "fr": b"le chat est sur le tapis"})
    classify = model.classifier()
    for text in ("½", "²³", "①", "Ⅳ", "१२", "_", "12 34", "😀"):
        assert classify(text) == ("und", 0.0, 0, True)
    assert classify("cat ½")[0] == classify("cat")[0] == "en"


def test_score_at_the_border_of_a_block():
    """Every text's first block is compressed alike: one more letter never moves a size by more than a few bytes."""
    words = " ".join(f"word{k}" for k in range(400))
    model = language.LanguageModel({"en": words.encode(), "xx": words[::-1].encode()})
    classify = model.classifier()
    margins = [classify(words[:n])[2] for n in range(480, 560)]
    assert max(abs(a - b) for a, b in zip(margins, margins[1:], strict=False)) <= 6


def test_shards_with_clashing_names(spark):
    names = ["gk_read_at", "gk_place", "gk_part", "gk_from", "gk_to"]
    df = spark.range(50).select("id", *[(F.col("id") + k).alias(n) for k, n in enumerate(names)])
    out = sharding.shard_rows(df, ["id"], 7).collect()
    assert len(out) == 50 and all(r[n] == r.id + k for r in out for k, n in enumerate(names))
    assert sorted((r.shard, r.slot) for r in out) == sorted((k % 7, k // 7) for k in range(50))


def test_one_id_on_all_rows_fills_several_files(spark, tmp_path):
    df = spark.range(400).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("text"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        files = idfile.write_ids(df, f"file://{tmp_path}", public_tokenizers.path("word_bpe_49k.json"), 1)
        assert files.count() > 1
    finally:
        spark.conf.unset(name)
    back = idfile.read_ids(files).collect()
    assert len(back) == 400 and {r.doc_id for r in back} == {None}
    assert sorted(r.start for r in back) == [sum(x.n_tokens for x in sorted(back, key=lambda r: r.start)[:k]) for k in range(400)]


def test_small_batches_are_given_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, 7):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name) == before


def test_letters_are_found_without_trying_each_number():
    """The same letters as ``isalpha`` says, at about the price of a small set of characters."""
    some = "".join(chr(c) for c in range(0, 0x20000, 7) if not 0xD800 <= c < 0xE000)
    for text in (some, some[:5000], "Un café, ½ Ⅷ x𝔸2"):
        low = text.lower()
        assert letters(text).split(" ") == "".join(c if c.isalpha() else " " for c in low).split()
    long = "lé mot déjà vu " * 60_000

    def took(f):
        start = time.perf_counter()
        f(long)
        return time.perf_counter() - start

    small = re.compile("[^a-zéà]+")
    assert min(took(letters) for _ in range(3)) < 5 * min(took(lambda t: small.sub(" ", t.lower())) for _ in range(3))


def test_one_memo_holds_words_and_parts():
    w = idfile.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), keep=40)
    texts = ["The cat's hat, 12 hats. " + " ".join(f"w{k} Word{k}," for k in range(j, j + 30)) for j in range(5)]
    assert w.batch(texts) == w.raw(texts) == w.batch(texts)
    assert len({id(w.words), id(w.parts)}) == 1 and len(w.words) <= 40
