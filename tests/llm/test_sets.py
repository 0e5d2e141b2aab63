"""Decontamination, Jaccard join, shards, nearest neighbours against brute force and odd tables."""

import random
import re
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gavelkit.llm import ann, decontam, jaccard, sharding
from gavelkit.llm.common import batches_of, may_be_in
from gavelkit.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, row int, items string, n int, node int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], DOCS)


def words(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def phrase_hits(text, items):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        iw = words(item)
        n = min(13, len(iw))
        wins = {tuple(iw[k : k + n]) for k in range(max(1, len(iw) - 12))} if iw else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in wins:
                hit |= set(range(k, k + n))
                names.add(str(name) if name is not None else "")
    return len(w), len(hit), sorted(names)


@pytest.fixture(scope="module")
def phrases():
    r = random.Random(2)
    vocab = ["a", "b", "c", "d", "é", "x1"]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([1, 5, 12, 13, 14, 30])))) for k in range(12)] + [(3, "again same id b"), (None, "null id words"), (50, None), (51, "!!"), (52, "")]
    rows = [(None, None), (1, ""), (2, "!!! ..."), (3, items[2][1]), (3, items[2][1]), (4, "NULL ID, words")]
    for k in range(5, 60):
        text = " ".join(r.choice(vocab) for _ in range(r.randint(1, 60)))
        rows.append((k, text + " - " + (items[r.randrange(12)][1] if k % 2 else "") + " tail"))
    rows.append((60, "word " * 60_000 + items[5][1] + " word" * 10))
    return items, rows


@pytest.mark.parametrize("size", [4 << 20, 60])
def test_decontamination_equals_brute_force(spark, phrases, size):
    items, rows = phrases
    table = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontam.contamination(docs(spark, rows), table, block_bytes=size).collect()
    want = sorted(((i, *phrase_hits(t, items)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out), key=str) == want
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) and r.n_items == len(r["items"]) for r in out)


def test_decontamination_of_empty_tables(spark, phrases):
    items, rows = phrases
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontam.contamination(docs(spark, rows).limit(0), table).collect() == []
    out = decontam.contamination(docs(spark, rows), table.limit(0)).collect()
    assert len(out) == len(rows) and not any(r.n_hit or r.contaminated for r in out)


def test_proximity_equals_brute_force(spark, phrases):
    items, rows = [(k, t) for k, t in phrases[0] if t and len(words(t)) == 5 or k == 1], [x for x in phrases[1] if len(words(x[1])) < 300]
    for slop in (0, 4):
        index = decontam.build_index(docs(spark, rows), block_tokens=400)
        found = decontam.matches(index, spark.createDataFrame(items, "item_id bigint, text string"), slop=slop)
        ids = index.select("block", F.posexplode("doc_ids").alias("row", "doc_id"))
        got = {(r.doc_id, i) for r in found.join(ids, ["block", "row"]).collect() for i in r["items"]}
        want = set()
        for i, t in rows:
            w = words(t)
            for name, item in items:
                iw = words(item)
                n = min(13, len(iw))
                for k in range(max(1, len(iw) - 12)):
                    need = set(iw[k : k + n])
                    if any(need <= set(w[s : s + n + slop]) for s in range(len(w))):
                        want.add((i, str(name)))
        assert got == want


def shingle_set(text):
    w = words(text, r"[^\x20\x09-\x0D]+")
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components_by_hand(rows):
    sets, at = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                at = [at[j] if x == at[i] else x for x in at]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if at[j] == at[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=str)


def near_copies(seed, n):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    common = [r.choice(vocab) for _ in range(25)]
    rows = [(None, "a null id a b c d"), (None, "a null id a b c d"), (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (6, "one two three"), (7, "q " * 3000)]
    base = [[r.choice(vocab) for _ in range(r.randint(4, 90))] for _ in range(12)]
    for k in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.3:
            w = w + common
        if r.random() < 0.2:
            w = w[: max(1, int(len(w) * r.uniform(0.7, 1)))]
        rows.append((100 + k, " ".join(w)))
    return rows


@pytest.mark.parametrize(("seed", "hot", "group"), [(1, 16, 32), (2, 2, 2), (3, 1000, 4)])
def test_jaccard_components_equal_brute_force(spark, seed, hot, group):
    rows = near_copies(seed, 160)
    out = jaccard.similar(docs(spark, rows), hot_docs=hot, group=group).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == components_by_hand(rows)


def test_jaccard_least_shared_is_the_least_over_all_sizes_of_a_group(spark):
    for percent in (50, 75, 100):
        sizes = spark.range(1, 61).select(F.col("id").alias("n")).join(spark.range(1, 81).select(F.col("id").alias("least")))
        sizes = sizes.join(spark.range(1, 81).select(F.col("id").alias("most"))).where("least <= most")
        got = sizes.select("n", "least", "most", jaccard._least_shared(F.col("n"), F.col("least"), F.col("most"), percent).alias("s")).toArrow()
        one = {(n, m): max(1, -(-percent * (n + m) // (100 + percent)) - jaccard.need(max(n, m), percent) + 1) for n in range(1, 61) for m in range(1, 81)}
        want = {}
        for n in range(1, 61):
            for least in range(1, 81):
                low = one[n, least]
                for most in range(least, 81):
                    want[n, least, most] = low = min(low, one[n, most])
        assert {(n, a, b): s for n, a, b, s in zip(*(got.column(k).to_pylist() for k in ("n", "least", "most", "s")), strict=True)} == want


def lone_token_families(seed, count):
    """Rows whose query (13 shingles) is linked only with the 15 of a family of 13, 15 and 16, by one prefix token that ten more texts have."""
    r = random.Random(seed)
    word = lambda: f"v{r.getrandbits(40):x}"
    rows = []
    while len(rows) < 14 * count:
        w = [word() for _ in range(16)]
        common = jaccard.shingles(" ".join(w))
        at = [int(jaccard.shingles(" ".join(w[k : k + 5]))[0]) for k in range(12)].index(int(common[0]))
        if at < 2:
            continue
        for _ in range(20_000):
            # the family's own tokens come before all that it shares with the query
            a = [word() for _ in range(4)]
            if jaccard.shingles(" ".join(w[-4:] + a)).max() < common[0]:
                break
        else:
            continue
        own = next(q for q in iter(word, None) if jaccard.shingles(" ".join([*w[-4:], q]))[0] > common[0])
        family = [[*w, own], w + a[:3], w[2:] + a[:3], w + a]
        while len(family) < 14:
            x = [word(), word(), *w[at : at + 5], word(), word()]
            if common[0] in jaccard.shingles(" ".join(x))[:2]:
                family.append(x)
        rows += [(len(rows) + k, " ".join(x)) for k, x in enumerate(family)]
    return rows


def test_jaccard_size_classes_of_a_key_leave_out_no_linked_size(spark):
    rows = [(k, k, k, n, at, left) for k, (n, at, left) in enumerate((n, at, left) for n in (1, 2, 7, 31, 32, 33, 64, 110, 147, 500) for at in (0, 1, 3, 9) for left in (1, 2, 5, 40))]
    posts = spark.createDataFrame(rows, "key bigint, node bigint, comp bigint, n bigint, at int, left bigint")
    for percent in (75, 85):
        met = {(r["key"], r["class"]): r for r in jaccard._sizes_met(posts, percent).collect()}
        sizes = spark.range(1, 1000).select("id", jaccard._size_class(F.col("id")).alias("class")).collect()
        size_class = {r["id"]: r["class"] for r in sizes}
        for key, _, _, n, at, left in rows:
            for m in range(1, min(1000, 2 * n + 2)):
                overlap = -(-percent * (n + m) // (100 + percent))
                due = max(1, overlap - jaccard.need(max(n, m), percent) + 1)
                if overlap <= min(n - at, m) and due <= left and 100 * min(n, m) >= percent * max(n, m):
                    r = met[key, size_class[m]]
                    assert r["least"] <= m <= r["most"] and r["due"] <= due


def test_jaccard_links_by_one_common_token_of_many_texts(spark):
    rows = lone_token_families(5, 12)
    out = jaccard.similar(docs(spark, rows), hot_docs=1000).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == components_by_hand(rows)


def test_jaccard_bounds_never_lose_a_link():
    r = random.Random(4)
    for _ in range(3000):
        n, m = r.randint(1, 60), r.randint(0, 12)
        a = [r.getrandbits(64) for _ in range(n)]
        b = a[: max(1, n - r.randint(0, n // 3 + 1))] + [r.getrandbits(64) for _ in range(m)]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        hot = np.unique(np.array(r.sample(list(a), len(a) // 3), np.uint64))
        p, q = (jaccard.prefix(x, hot, np.arange(len(hot))) for x in (a, b))
        if jaccard.linked(a, b):
            assert set(p[0]) & set(q[0]) or set(p[1]) & set(q[1])
            assert jaccard.possible(len(a), p[0], len(b), q[0])
            least, until, union = jaccard._united([(len(b), q[0])], 75)
            assert jaccard._reaches(len(a), p[0], least, until, union.view(np.uint64), 75)


def test_jaccard_of_an_empty_table(spark):
    assert jaccard.similar(docs(spark, [(1, "x")]).limit(0)).collect() == []


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 4999), (7, 7)]
    out = {r.node: r.comp for r in jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(out[k] == 0 for k in range(61)) and all(out[1000 + k] == 1000 for k in range(200)) and out[5000] == 4999


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 500])
def test_shuffle_is_a_permutation_and_can_be_undone(spark, n):
    rows = spark.range(n).select("id", sharding.permute(F.col("id"), n, "k").alias("p"))
    rows = rows.withColumn("back", sharding.permute(F.col("p"), n, "k", back=True)).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)
    assert n < 90 or sum(abs(r.p - r.id) for r in rows) > n * n / 6


def test_shards_of_odd_rows(spark):
    rows = [(None, None), (None, None), (1, "a"), (1, "a"), (1, "b"), *((k, "x") for k in range(2, 40))]
    table = docs(spark, rows).withColumns({"shard": F.lit(9), "slot": F.lit(9)}).drop("shard", "slot")
    out = sharding.shard_rows(table, ["doc_id", "text"], 7).collect()
    sizes = [sorted(r.slot for r in out if r.shard == s) for s in range(7)]
    assert all(x == list(range(len(x))) for x in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1 and len(out) == len(rows)
    again = sharding.shard_rows(table.repartition(5), ["doc_id", "text"], 7).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert sharding.shard_rows(table.limit(0), ["doc_id"], 7).collect() == []
    spot = spark.createDataFrame([(r.shard, r.slot, r.row_number) for r in out], "s int, t bigint, n bigint")
    assert spot.where(sharding.row_at(F.col("s"), F.col("t"), len(rows), 7) != F.col("n")).count() == 0


def exact_nearest(vectors, top):
    out = {}
    for i, v in vectors:
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != i)[:top]
            out[i] = [j for _, j in near]
    return out


def test_nearest_with_odd_vectors(spark):
    r = random.Random(3)
    good = [(k, [float(r.randint(-3, 3)) or 1.0 for _ in range(4)]) for k in range(1, 200)] + [(k, [1.0, 2.0, 0.0, 0.0]) for k in range(200, 300)]
    bad = [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 1.0, 1.0]), (1060, [float("nan"), 1.0, 1.0, 1.0]), (1080, [float("inf")] * 4), (1100, []), (1120, [1.0]), (None, [1.0] * 4)]
    table = spark.createDataFrame([(i, v, 1, 0.5) for i, v in good + bad], "vec_id bigint, embedding array<double>, rank int, class double")
    out = ann.nearest(table, F.col("vec_id") % 20 == 0, leaf_rows=20, block=30, recall=1.0).collect()
    got = {}
    for x in sorted(out, key=lambda x: (x.query_id, x.rank)):
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert got == exact_nearest(good, 20)
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    few = ann.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id bigint, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert [(x.query_id, x.rank, x.vec_id, x.score) for x in few] == [(0, 1, 1, 0.5)]


def test_nearest_recall_and_walk(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, hits, total = exact_nearest(rows, 20), 0, 0
    found = {}
    for r in QUERIES["op4_nearest"](spark, sf_dir).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, near in want.items():
        hits, total = hits + len(set(near) & found[q]), total + len(near)
    assert hits >= 0.9 * total
    tree = ann.grow(np.random.default_rng(1).normal(size=(400, 6)), 20)
    assert sorted(tree.walk(np.zeros(6), tree.leaves)) == list(range(tree.leaves)) and len(tree.walk(np.zeros(6), 3)) == 3


def test_sets_of_many_texts_are_those_of_each_text():
    texts = ["", None, "a", "a b", "a b c d", "a b c d e", "a b " * 40, "A b C d e f g", " ", "x"] + [f"w{k} w{k + 1} w{k + 2} w{k % 3} w{k % 5} w{k}" for k in range(50)]
    for words in (1, 7, 50_000):
        for text, found in zip(texts, jaccard.shingles_of(texts, words=words), strict=True):
            ws = (text or "").lower().split()
            n = min(5, len(ws))
            runs = {" ".join(ws[k : k + n]) for k in range(len(ws) - n + 1)} if ws else set()
            assert len(found) == len(runs) and (found[1:] > found[:-1]).all()
            assert found.tolist() == sorted({int(jaccard.shingles(r)[0]) for r in runs})


def test_lists_of_common_tokens_go_on_over_batches(spark):
    rows = [(k, [j for j in range(1, 60) if k % j == 0] + [1000 + k]) for k in range(1, 121)]
    classes = spark.createDataFrame(rows, "node bigint, cool array<bigint>")
    for at_most in (1, 7, 1000):
        with mock.patch.object(jaccard, "batches_of", lambda s, n, at_most=at_most: batches_of(s, at_most)):
            got = sorted((tuple(r.nodes), r.c, tuple(r.places)) for r in jaccard._posted(classes).collect())
        want = {}
        for token in range(1, 60):
            found = [(k, cool.index(token)) for k, cool in rows if token in cool]
            want.setdefault(tuple(k for k, _ in found), []).append(tuple(at for _, at in found))
        assert got == sorted((nodes, len(places), min(places)) for nodes, places in want.items() if len(nodes) > 1)


def test_rows_that_no_copy_names_are_not_shuffled(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("h"))
    rows = spark.range(100_000).withColumn("h", F.xxhash64("id"))
    found = rows.where(may_be_in(hashes)("h"))
    ids = {r.id for r in found.collect()}
    assert ids >= set(range(2000)) and len(ids) < 20_000 and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows.where(may_be_in(hashes.limit(0))("h")).count() == 0
    corpus = [(k, f"text {k // 2 if k < 20 else k} of some words in a row") for k in range(60)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = corpus_pipeline.keep_one_of_similar(spark, docs(spark, corpus), "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "may_be" in plan and sorted(r.doc_id for r in out.collect()) == [*range(0, 20, 2), *range(20, 60)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jaccard_bands_lead_similar_sets_together():
    r = np.random.default_rng(5)
    pool = np.unique(r.integers(0, 1 << 64, 200_000, np.uint64))
    met = 0
    for k in range(200):
        a = np.sort(pool[k * 900 : k * 900 + 400])
        b = np.sort(np.concatenate([a[:370], pool[k * 900 + 500 : k * 900 + 520]]))
        met += len(np.intersect1d(jaccard.bands(a), jaccard.bands(b))) > 0
    assert met >= 190 and len(set(jaccard.bands(pool[:3]).tolist())) == jaccard.BANDS


def test_jaccard_stars_alone_bring_near_copies_together(spark):
    # sets without a hot token, so the three hot tokens lead nowhere; bands do, with few pairs a set
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 1 << 63, 300, np.int64).view(np.uint64))
    sets = [np.sort(np.concatenate([base[r.permutation(len(base))[: len(base) - 12]], r.integers(0, 1 << 63, 10, np.int64).view(np.uint64)])) for _ in range(40)]
    rows = [(k, [], [], jaccard.bands(s).view(np.int64).tolist()) for k, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "node bigint, cool array<bigint>, hot array<bigint>, bands array<bigint>")
    lists = spark.createDataFrame([], "key bigint, nodes array<bigint>, c bigint, places array<int>")
    pairs = [(x.a, x.b) for x in jaccard._stars(lists, classes).collect()]
    assert len({n for p in pairs for n in p}) == 40 and len(pairs) <= 40 * 2 * jaccard.BANDS and all(a > b for a, b in pairs)


def test_decontam_blocks_of_numbers_equal_blocks_of_words():
    docs = [(1, [b"a", b"b", b"a"]), (None, []), (2, [b"c", b"a"])]
    p = decontam.Postings(decontam.block_row(7, docs))
    seen = {(int(t), int(k & 0xFFFFFFFF)) for t, k in zip(p.terms[p.keys >> 32], p.keys, strict=True)}
    ids = dict(zip([b"a", b"b", b"c"], decontam.term_ids([b"a", b"b", b"c"]).tolist(), strict=True))
    assert seen == {(ids[w], int(p.starts[k]) + j) for k, (_, ws) in enumerate(docs) for j, w in enumerate(ws)}
    codes = {}
    coded = [(d, np.array([codes.setdefault(w, len(codes)) for w in ws], np.int32)) for d, ws in docs]
    assert decontam.coded_row(7, coded, codes) == decontam.block_row(7, docs) and p.n_words.tolist() == [3, 0, 2]
