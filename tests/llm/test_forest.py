"""Near duplicates by the LSH forest against all pairs, at every level of depth."""

import random
from collections import Counter

import numpy as np
import pytest

from gavelkit.llm import forest
from gavelkit.llm.queries import QUERIES

ROWS = "doc_id bigint, text string, n int, node int, prefix string, kept string, sign int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "p", "k", 3) for i, t in rows], ROWS)


def shingle_set(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        ws = ws.replace(c, " ")
    ws = [w for w in ws.split(" ") if w]
    return frozenset([tuple(ws)] if 0 < len(ws) < 5 else (tuple(ws[k : k + 5]) for k in range(len(ws) - 4)))


def brute(rows, percent=85):
    """Every document's row by comparing all distinct sets that share a shingle."""
    sets = {}
    for i, t in rows:
        sets.setdefault(shingle_set(t), []).append(i)
    keys = [s for s in sets if s]
    where = {}
    for k, s in enumerate(keys):
        for x in s:
            where.setdefault(x, []).append(k)
    both = Counter()
    for at in where.values():
        for i, a in enumerate(at):
            both.update((a, b) for b in at[i + 1 :])
    root = list(range(len(keys)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(keys[a]) + len(keys[b]) - n):
            root[find(a)] = find(b)
    names = {}
    for k, s in enumerate(keys):
        names.setdefault(find(k), []).extend(i for i in sets[s] if i is not None)
    name = {s: min(names[find(k)], default=None) for k, s in enumerate(keys)}
    out = []
    for i, t in rows:
        s = shingle_set(t)
        c = name[s] if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=str)


def family_rows(seed=5, families=40, members=14):
    """Families of texts with a few edits each, chains of edits, shared passages, and odd rows."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    passage, rows, k = [word() for _ in range(60)], [], 1000
    for f in range(families):
        base = [word() for _ in range(r.randint(3, 160))] + (passage if f % 3 == 0 else [])
        now = list(base)
        for _ in range(members):
            if f % 2:
                now = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 50))):
                now[r.randrange(len(now))] = word()
            rows.append((k, " ".join(now)))
            k += 1
    odd = [(None, None), (1, ""), (2, " \t\n"), (3, "one two"), (3, "one two"), (4, "ONE\x0btwo"), (5, "one two "), (None, "null a b c d e f"), (None, "null a b c d e f"), (6, "null A b c d e f"), (7, "x " * 50_000), (8, "x " * 49_000)]
    odd += [(100 + k, "copy of a text that stands here many times over") for k in range(300)]
    return rows + odd


@pytest.mark.parametrize(("depths", "region"), [((3, 8, 16), 2048), ((3, 8, 16), 6), ((3, 5), 2), ((2,), 4)])
def test_equals_brute_force(spark, depths, region):
    rows = family_rows()
    out = forest.similar(table(spark, rows), depths=depths, region=region).collect()
    assert sorted(map(tuple, out), key=str) == brute(rows)


def test_other_threshold(spark):
    rows = family_rows(9, 12)
    assert sorted(map(tuple, forest.similar(table(spark, rows), percent=70).collect()), key=str) == brute(rows, 70)


def test_empty(spark):
    out = forest.similar(table(spark, []))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.collect() == []
    assert [tuple(r) for r in forest.similar(table(spark, [(1, None), (None, "")])).orderBy("doc_id").collect()] == [(None, 0, None, True), (1, 0, 1, True)]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    factors = forest.multipliers(400)
    for share in (0.5, 0.85, 0.95):
        found = []
        for _ in range(20):
            common, x, y = (r.integers(0, 1 << 64, n, dtype=np.uint64) for n in (int(600 * share), *[(600 - int(600 * share)) // 2] * 2))
            a, b = (forest.signature(np.unique(np.concatenate([common, z])), factors) for z in (x, y))
            found.append((a == b).mean())
        assert abs(np.mean(found) - share) < 0.02 and min(found) > share - 0.11


def test_levels_keep_the_miss():
    for percent in (70, 85, 95):
        for trees, p in forest.levels(percent):
            s = (percent / 100) ** p
            assert (1 - s) ** trees <= forest.MISS < (1 - s) ** (trees - 1)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = QUERIES["op11_near_dedup"](spark, sf_dir).collect()
    want = brute(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=str) == [(i, n, c, i == c) for i, n, c, _ in want]
