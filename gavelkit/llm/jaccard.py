"""Similarity join on word shingles by a token-group matrix.

Texts with equal sets fall together first. Then similar sets are put in groups: sets that share a token are compared with
one leader of that token, and what is linked is one component. The components are cut into groups of bounded size, and
each group's token union is stored. A set whose tokens also occur in another component is a query to that component's
groups: if the query can't reach the threshold against the union (|Q and U| < t|Q|), no member can, and the group stays
closed; only qualifying groups are opened and compared member by member.

Which tokens must be looked at: two sets with a Jaccard similarity of t share a token among the first n - ceil(t n) + 1 of
each, in any order common to all. The order here is by hash, with frequent tokens last, so a passage that very many texts
share seldom is what brings two texts together. The order only saves work; no link depends on it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.llm.common import batches_of, marked, release, small_batches
from gavelkit.session import pinned

WIDTH, PERCENT = 5, 75
HOT_DOCS, HOT_LIMIT, GROUP, EARLIER = 16, 500_000, 32, 2
BANDS, BINS = 8, 4
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _Q
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words; fewer words are one run, none give none.

    Words are what ASCII white space parts, with A-Z lowered.
    """
    return next(shingles_of([text], width))


def shingles_of(texts: Iterable[str | None], width: int = WIDTH, words: int = 50_000) -> Iterator[np.ndarray]:
    """``shingles`` of each text. Runs are hashed for several texts at once, up to about ``words`` words or one text."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode().lower().split())
        size += len(held[-1])
        if size >= words:
            yield from _shingled(held, width)
            held, size = [], 0
    yield from _shingled(held, width)


def _run_hashes(one: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbours."""
    acc = np.full(max(0, len(one) - n + 1), n, np.uint64)
    for k in range(n):
        acc = _mixed(acc + one[k : len(acc) + k] * _P)
    return acc


def _shingled(texts: list[list[bytes]], width: int) -> Iterator[np.ndarray]:
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, sum(map(len, texts)))
    runs, at = _run_hashes(one, width), 0
    for ws in texts:
        n = len(ws)
        # a run that goes on into the next text is passed over
        s = np.sort(runs[at : at + n - width + 1] if n >= width else _run_hashes(one[at : at + n], n) if n else one[:0])
        at += n
        new = np.ones(len(s), bool)
        np.not_equal(s[1:], s[:-1], out=new[1:])
        yield s if new.all() else s[new]


def need(n: int, percent: int = PERCENT) -> int:
    """Least overlap with a set of ``n`` that a link takes."""
    return -(-percent * n // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def prefix(tokens: np.ndarray, hot: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The tokens by which a set must be found: those that aren't hot, in order of hash, then hot ones, rarest first."""
    p = len(tokens) - need(len(tokens), percent) + 1
    if not len(hot) or not len(tokens):
        return tokens[:p], tokens[:0]
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    is_hot = hot[at] == tokens
    cool = tokens[~is_hot][:p]
    warm = tokens[is_hot]
    return cool, warm[np.argsort(rank[at[is_hot]], kind="stable")][: p - len(cool)]


def bands(tokens: np.ndarray) -> np.ndarray:
    """Keys that sets which are much alike have in common, most likely: each is made of the least hashes of ``BINS`` bins."""
    h = np.sort(_mixed(tokens ^ _P))
    edges = np.arange(BANDS * BINS, dtype=np.uint64) << np.uint64(64 - (BANDS * BINS - 1).bit_length())
    least = h[np.minimum(np.searchsorted(h, edges), len(h) - 1)].reshape(BANDS, BINS)
    acc = np.arange(BANDS, dtype=np.uint64)
    for k in range(BINS):
        acc = _mixed(acc + least[:, k] * _P)
    return acc


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str | None]]:
    for i, t in zip(batch.column(0), batch.column(1), strict=True):
        yield i.as_py(), t.as_py()


def _key(text: str | None) -> int:
    """A hash of a whole text, much cheaper than its set."""
    return xxhash.xxh3_64_intdigest((text or "").encode()) >> 1


def _sets(rows: DataFrame) -> DataFrame:
    """One table with a row for each document (n, digest of its set), and rows of tokens that several texts of a batch share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("tag", pa.int64()), ("token", pa.int64()), ("docs", pa.int64())])
        seen, size = {}, 0

        def shared():
            token, docs = np.unique(np.concatenate([*seen.values(), np.zeros(0, np.uint64)]), return_counts=True)
            token, docs = token[docs > 1], docs[docs > 1]
            n = len(token)
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array(token.view(np.int64)), pa.array(docs)], schema=schema)

        for batch in batches:
            out = []
            ids = batch.column(0).to_pylist()
            for i, s in zip(ids, shingles_of(t.as_py() for t in batch.column(1)), strict=True):
                digest = xxhash.xxh3_128_digest(s.tobytes())
                out.append((i, len(s), digest))
                if digest not in seen:
                    seen[digest] = s
                    size += len(s)
                if size >= 1_000_000:
                    yield shared()
                    seen, size = {}, 0
                    release()
            ids, n, digest = zip(*out, strict=True) if out else ((), (), ())
            k = len(out)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), batch.column(2), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=schema)
        if seen:
            yield shared()
        del seen
        release()

    return pinned(rows.mapInArrow(run, "doc_id bigint, n bigint, digest binary, tag bigint, token bigint, docs bigint"), "sets")


def _hot_tokens(sets: DataFrame, docs: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of at least ``docs`` texts and how many; of more than ``limit`` such tokens the most frequent ones."""
    counts = sets.where("token is not null").groupBy("token").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= docs)
    sizes = counts.agg(*[F.sum((F.col("docs") >= docs << k).cast("bigint")).alias(f"n{k}") for k in range(34)]).first()
    least = next(docs << k for k in range(34) if (sizes[k] or 0) <= limit)
    found = counts.where(F.col("docs") >= least).toArrow()
    token = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], found.column("docs").to_numpy()[order]


def _classes(rows: DataFrame, hot: np.ndarray, rank: np.ndarray, percent: int) -> DataFrame:
    """A row for each distinct set: node, digest, n, first (smallest doc_id), key of a text, cool and hot tokens to find it by, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            out = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, s in enumerate(shingles_of(t.as_py() for t in texts)):
                if len(s):
                    cool, warm = prefix(s, hot, rank, percent)
                    out.append((xxhash.xxh3_128_digest(s.tobytes()), ids[k], _key(texts[k].as_py()), len(s), cool.view(np.int64), warm.view(np.int64), bands(s).view(np.int64)))
            if out:
                digest, ids, key, n, *lists = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), *(pa.array(x, pa.int64()) for x in (ids, key, n)), *(pa.array(x, kind) for x in lists)], ["digest", "doc_id", "key", "n", "cool", "hot", "bands"])

    # the order of Arrow batches doesn't matter, as one row a set is left
    found = rows.mapInArrow(run, "digest binary, doc_id bigint, key bigint, n bigint, cool array<bigint>, hot array<bigint>, bands array<bigint>")
    one = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("n").alias("n"), F.first("cool").alias("cool"), F.first("hot").alias("hot"), F.first("bands").alias("bands"))
    return pinned(one.withColumn("node", F.monotonically_increasing_id()), "classes")


def _only(classes: DataFrame, nodes: DataFrame, bits: int = 22) -> DataFrame:
    """node, n, cool of the classes whose node may be among ``nodes`` (all that are, and few others), without a shuffle.

    A join against these rows moves little of the table; beyond some millions of nodes the bitmap fills up and only saves less.
    """
    size = 1 << bits
    node = F.col("node")
    bitmap = marked(nodes.select(((F.shiftright(node, 33) * 1_000_003 + node.bitwiseAND(F.lit((1 << 33) - 1))) % size).alias("spot")), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column("node").to_numpy()
            at = ((k >> 33) * 1_000_003 + (k & ((1 << 33) - 1))) % size
            yield batch.filter(pa.array((bitmap[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)))

    return classes.select("node", "n", "cool").mapInArrow(run, "node bigint, n bigint, cool array<bigint>")


def _fetch(rows: DataFrame, classes: DataFrame, nodes: DataFrame, bits: int = 22) -> DataFrame:
    """node and token set of the wanted nodes, made again from the texts.

    A bitmap of fixed size over the keys of texts tells tasks which texts may be wanted, so that sets are made of few
    others; the join then settles it.
    """
    wanted = pinned(nodes.join(classes.select("node", "digest", "key"), "node"), "wanted")
    bitmap = marked(wanted.select((F.col("key") % (1 << bits)).alias("spot")), bits)

    made = lambda out: pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], ["digest", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = {}, 0
            for _, text in _texts(batch):
                at = _key(text) % (1 << bits)
                if int(bitmap[at >> 5]) >> (at & 31) & 1:
                    raw = shingles(text).tobytes()
                    out[xxhash.xxh3_128_digest(raw)] = raw
                    size += len(raw)
                if size > 4 << 20:
                    yield made(out)
                    out, size = {}, 0
            if out:
                yield made(out)
        release()

    sets = rows.mapInArrow(run, "digest binary, tokens binary").groupBy("digest").agg(F.first("tokens").alias("tokens"))
    return pinned(sets.join(wanted.select("node", "digest"), "digest").select("node", "tokens"), "tokens")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked. Rows with their two sets pass one by one; no group is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(k) for k in ("a", "b", "x", "y"))
            ok = [linked(np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64), percent) for p, q in zip(x, y, strict=True)]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node and comp (smallest node of its component) of all nodes in ``edges`` (a, b).

    Alternating large and small stars; each pass is written to the shared folder. A node with very many edges is an
    ordinary row of its star: minima are counted first, written, and joined back.
    """
    edges = pinned(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = pinned(ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "low")
        large = pinned(ways.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        low = pinned(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = pinned(edges, "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return pinned(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots.select("node", F.col("node").alias("comp"))), "components")


def _posted(classes: DataFrame) -> DataFrame:
    """key, nodes, c, places: the lists of nodes that c cool tokens have in common, of two nodes or more.

    Places tell where the first of these tokens stands in each node's list; the first is the same one for all. Most tokens
    are in one list only, so rows are sorted by token and only those with an equal neighbour are gathered.
    """

    def gathered(token: np.ndarray, node: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        size = np.diff(np.append(starts, len(token)))
        several = size > 1
        rows, ends = np.repeat(several, size), np.concatenate(([0], np.cumsum(size[several]))).astype(np.int32)
        nodes, places = (pa.ListArray.from_arrays(pa.array(ends), pa.array(x[rows])) for x in (node, at))
        return pa.RecordBatch.from_arrays([nodes, places], ["nodes", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(k).to_numpy() for k in ("token", "node", "at")]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            # the last token may go on in the next batch
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield gathered(*(x[:cut] for x in rows))
            held = [x[cut:].copy() for x in rows]
        if held is not None:
            yield gathered(*held)

    rows = classes.select("node", F.posexplode("cool").alias("at", "token")).repartition("token").sortWithinPartitions("token", "node")
    with batches_of(classes.sparkSession, 20_000):
        lists = pinned(rows.mapInArrow(run, "nodes array<bigint>, places array<int>"), "shared")
    # of equal lists the one with the smallest places holds the first token, for any of the nodes
    lists = lists.groupBy("nodes").agg(F.count("*").alias("c"), F.min_by("places", F.element_at("places", 1)).alias("places"))
    return pinned(lists.select(F.monotonically_increasing_id().alias("key"), "nodes", "c", "places"), "lists")


def _stars(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of a node and a leader: of the first nodes of its lists the one that shares most tokens, and the first and last node of its bands and of three of its hot tokens.

    There are a few pairs a node, however large a group of sets is, and what they link needs no further look.
    """
    short = lists.select(F.element_at("nodes", 1).alias("b"), F.explode(F.slice("nodes", 2, F.size("nodes"))).alias("a"), "c")
    best = short.groupBy("a", "b").agg(F.sum("c").alias("c")).groupBy("a").agg(F.max_by("b", F.struct("c", -F.col("b"))).alias("b"))
    least = lambda k: F.array_min(F.transform("hot", lambda t: F.struct(F.xxhash64(t, F.lit(k)).alias("o"), t.alias("t"))))["t"]
    keys = pinned(classes.select("node", F.explode(F.array_distinct(F.concat("bands", F.array_compact(F.array(*[least(k) for k in range(3)]))))).alias("key")), "keys")
    lead = pinned(keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last"), "leaders")
    led = keys.join(lead, "key").select(F.col("node").alias("a"), F.explode(F.array("first", "last")).alias("b")).where("a <> b")
    return best.select("a", "b").unionByName(led.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct()


def _near_size(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose set sizes allow a link."""
    size = classes.select("node", "n")
    both = pairs.join(size.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").join(size.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
    return both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")


def possible(n_a: int, a: np.ndarray, n_b: int, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets may be linked, judged by their cool tokens alone.

    Both lists hold every cool token up to the smaller of their last ones (a list that is short of its length holds all).
    What one of them has there and the other hasn't, the sets don't share.
    """
    p_a, p_b = n_a - need(n_a, percent) + 1, n_b - need(n_b, percent) + 1
    if len(a) == p_a:
        b = b[: np.searchsorted(b, a[-1], side="right")] if len(a) else b
    if len(b) == p_b and len(b):
        a = a[: np.searchsorted(a, b[-1], side="right")]
    both = len(np.intersect1d(a, b, assume_unique=True))
    most = min(n_a - len(a) + both, n_b - len(b) + both)
    return most * (100 + percent) >= percent * (n_a + n_b)


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and cool tokens allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, x0), (y, y0) = ((batch.column(k).values.to_numpy().view(np.uint64), batch.column(k).offsets.to_numpy()) for k in ("x", "y"))
            n_a, n_b = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            ok = pa.array([possible(n_a[k], x[x0[k] : x0[k + 1]], n_b[k], y[y0[k] : y0[k + 1]], percent) for k in range(batch.num_rows)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(ok) for k in ("a", "b")], ["a", "b"])

    near = pinned(_near_size(pairs, classes, percent), "near")
    side = lambda k, s: _only(classes, near.select(F.col(k).alias("node"))).select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("cool").alias(s))
    return near.join(side("a", "x"), "a").join(side("b", "y"), "b").mapInArrow(run, "a bigint, b bigint")


def _least_shared(n: Column, least: Column, most: Column, percent: int) -> Column:
    """Least number of common prefix tokens of a set of ``n`` and one that it may be linked with, of ``least`` to ``most`` tokens.

    Up to ``n`` the number doesn't fall with the size. Above, it falls by percent**2 / (100 (100 + percent)) a token on average,
    and by rounding it is at most 1 more at a larger size: the least is at one of the last sizes that make a fall of 1.
    """
    overlap = lambda m: F.ceil(percent * (n + m) / (100 + percent))
    floor = lambda m: F.ceil(percent * m / 100)
    last = [F.greatest(most - k, least, n) for k in range(-(-100 * (100 + percent) // percent**2))]
    return F.greatest(F.lit(1), F.least(overlap(least) - floor(n), *[overlap(m) - floor(m) for m in last]) + 1)


def _size_class(n: Column) -> Column:
    """A number for sizes that are near: sizes below 32 are each their own, above, 16 classes a doubling."""
    fall = F.greatest(F.length(F.bin(n)) - 5, F.lit(0)).cast("int")
    return F.call_function("shiftright", n.cast("bigint"), fall) + 16 * fall


def _sizes_met(posts: DataFrame, percent: int) -> DataFrame:
    """key, node, comp, n of the posts with each class of sizes that the key may lead to (least to most), and the common tokens that takes (due).

    If the key is the first that is common, the overlap is at most ``n`` less the tokens before it: so sizes end at ``far``.
    """
    n, c = F.col("n"), F.col("class")
    low = F.ceil(percent * n / 100)
    far = F.least(F.floor(100 * n / percent), F.floor((n - F.col("at")) * (100 + percent) / percent) - n)
    met = posts.withColumns({"low": low, "far": far}).where("low <= far")
    met = met.withColumn("class", F.explode(F.sequence(_size_class(F.col("low")), _size_class(F.col("far")))))
    fall = F.greatest(F.floor(c / 16) - 1, F.lit(0)).cast("int")
    first, last = F.call_function("shiftleft", c - 16 * fall, fall), F.call_function("shiftleft", c - 16 * fall + 1, fall) - 1
    # generators keep the planner from putting the long expressions into each other, which would be too long to compile
    sizes = F.array(F.struct(F.greatest(first, "low").alias("least"), F.least(last, "far").alias("most")))
    earlier = [c for c in posts.columns if c in {f"e{k}" for k in range(EARLIER)}]
    met = met.select("key", "node", "comp", "n", "class", "left", *earlier, F.inline(sizes)).where("least <= most")
    due = F.explode(F.array(_least_shared(n, F.col("least"), F.col("most"), percent)))
    return met.select("key", "node", "comp", "n", "class", "least", "most", "left", *earlier, due.alias("due")).where("due <= left").drop("left")


def _open_groups(lists: DataFrame, comp: DataFrame, rows: DataFrame, classes: DataFrame, percent: int, group: int, reach: str) -> DataFrame:
    """Links between components that the stars didn't show, through the token-group matrix.

    A query goes to every group that a key leads it to. With the reach "one" it is compared with one member of each
    qualifying group, with "all" with every one. Only "all" is whole; "one" comes before it, since what it links is one
    component and needs no further look.

    Two linked sets share at least o - need(n) + 1 of the tokens that each is found by, n being the size of the one whose
    tokens end first and o the overlap that a link takes. What stands from the first common token on, in the order that
    all sets have, must be that many tokens of those that other components have too, and o tokens in all, in both sets.
    So a key brings a query only to sets of those sizes for which it may be the first one; a hot token, which stands
    last, to few. Hot tokens carry the ``EARLIER`` keys before them: where a query and all of a group's sets of a key have
    one of those in common, the key isn't their first common one, and it doesn't bring them together again.
    """
    nodes = classes.select("node", "n", "hot", F.size("cool").alias("cools")).join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    nodes = pinned(nodes, "nodes")
    of_lists = lists.select("key", F.col("c"), F.explode(F.arrays_zip("nodes", "places")).alias("post"))
    of_lists = of_lists.select("key", "c", "post.nodes", "post.places").toDF("key", "c", "node", "at").join(nodes.select("node", "n", "comp"), "node").withColumn("warm", F.lit(False))
    of_hot = nodes.where("size(hot) > 0").select("node", "n", "comp", "cools", F.posexplode("hot").alias("at", "key"))
    of_hot = of_hot.select("key", F.lit(1).cast("bigint").alias("c"), "node", (F.col("cools") + F.col("at")).alias("at"), "n", "comp", F.lit(True).alias("warm"))
    posts = pinned(of_lists.select(*of_hot.columns).unionByName(of_hot), "posts")
    mixed = pinned(posts.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key"), "mixed")
    backwards = Window.partitionBy("node").orderBy(F.desc("at"))
    left = F.sum("c").over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    earlier = [F.when(F.col("warm"), F.lead("key", k + 1).over(backwards)).alias(f"e{k}") for k in range(EARLIER)]
    posts = pinned(posts.join(mixed, "key").select("key", "node", "at", "n", "comp", left.alias("left"), *earlier), "mixed-posts")
    members = posts.select("node", "comp", "n").distinct()
    sizes = pinned(members.groupBy("comp").agg(F.count("*").alias("size")), "sizes")
    members = members.join(sizes, "comp").withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / group)))
    members = pinned(members.select("node", F.xxhash64("comp", "part").alias("group")), "members")
    # a query goes to groups of components before its own; per key and class of sizes only the distinct groups matter
    n = F.col("n")
    far = F.floor((n - F.col("at")) * (100 + percent) / percent) - n
    to = posts.join(members, "node").groupBy("key", _size_class(n).alias("class"), "group")
    to = to.agg(F.min("comp").alias("g_comp"), F.max("left").alias("g_left"), F.max(far).alias("g_far"), F.min("n").alias("g_least"), F.max("n").alias("g_most"), *[F.when((F.min(f"e{k}") == F.max(f"e{k}")) & (F.count(f"e{k}") == F.count("*")), F.min(f"e{k}")).alias(f"g_e{k}") for k in range(EARLIER)])
    to = pinned(to, "to")
    from_ = pinned(_sizes_met(posts, percent), "from")
    meets = (F.col("g_comp") < F.col("comp")) & (F.col("g_left") >= F.col("due")) & (F.col("g_far") >= n) & (F.col("g_least") <= F.col("most")) & (F.col("g_most") >= F.col("least"))
    met_before = [F.coalesce(F.col(f"e{k}").isin(*[F.col(f"g_e{j}") for j in range(EARLIER)]), F.lit(False)) for k in range(EARLIER)]
    meets = meets & ~reduce(or_, met_before)
    asked = pinned(from_.join(to, ["key", "class"]).where(meets).select(F.col("node").alias("q"), "group").distinct(), "asked")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_united([(x["n"], np.array(x["cool"], np.int64).view(np.uint64)) for x in g.as_py()], percent) for g in batch.column("sets")]
            least, until, united = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(least, pa.int64()), pa.array(until, pa.int64()), pa.array(united, pa.list_(pa.int64()))], ["group", "least", "until", "united"])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ([np.array(x.as_py(), np.int64).view(np.uint64) for x in batch.column(k)] for k in ("cool", "united"))
            ok = [_reaches(n, x, least, until, u, percent) for n, x, least, until, u in zip(batch.column("n").to_pylist(), next(sets), batch.column("least").to_pylist(), batch.column("until").to_pylist(), next(sets), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(ok, pa.bool_())) for k in ("q", "group")], ["q", "group"])

    inside = pinned(members.select("node", "group").join(asked.select("group").distinct(), "group", "left_semi"), "inside")
    inside = inside.join(_only(classes, inside), "node")
    matrix = inside.groupBy("group").agg(F.collect_list(F.struct("n", "cool")).alias("sets"))
    matrix = pinned(matrix.mapInArrow(unite, "group bigint, least bigint, until bigint, united array<bigint>"), "matrix")
    tried = asked.join(_only(classes, asked.select(F.col("q").alias("node"))).withColumnRenamed("node", "q"), "q").join(matrix, "group")
    opened = pinned(tried.select("q", "group", "n", "cool", "least", "until", "united").mapInArrow(bound, "q bigint, group bigint"), "opened")
    met = members.groupBy("group").agg(F.min("node").alias("b")) if reach != "all" else members.select(F.col("node").alias("b"), "group")
    pairs = opened.join(pinned(met, "met"), "group").select(F.col("q").alias("a"), "b").distinct()
    return _checked(pairs, rows, classes, percent)


def _united(sets: list[tuple[int, np.ndarray]], percent: int) -> tuple[int, int, np.ndarray]:
    """Of a group's sets: least size, the last token up to which all their cool tokens are known (-1: all), token union."""
    ends = [int(t[-1]) for n, t in sets if len(t) and len(t) == n - need(n, percent) + 1]
    union = np.unique(np.concatenate([t for _, t in sets]))
    until = min(ends, default=None)
    if until is not None:
        union = union[: np.searchsorted(union, np.uint64(until), side="right")]
    return min(n for n, _ in sets), -1 if until is None else int(np.uint64(until).view(np.int64)), union.view(np.int64)


def _reaches(n: int, tokens: np.ndarray, least: int, until: int, union: np.ndarray, percent: int) -> bool:
    """Whether a query's overlap with the union leaves a link with some member possible."""
    known = tokens if until == -1 else tokens[: np.searchsorted(tokens, np.array(until, np.int64).view(np.uint64), side="right")]
    most = n - len(known) + len(np.intersect1d(known, union, assume_unique=True))
    return most * (100 + percent) >= percent * (n + least)


def _checked(pairs: DataFrame, rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked: bounds first, then whole sets of what is left."""
    left = pinned(_possible(pairs, classes, percent), "possible")
    sets = _fetch(rows, classes, left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct())
    return pinned(_verified(left, sets, percent), "links")


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, hot_docs: int = HOT_DOCS, hot_limit: int = HOT_LIMIT, group: int = GROUP, tag: str | None = None) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included).

    With ``tag``, a column of long integers, that column too, by which a caller finds a row again.

    Null and empty texts have empty sets and are linked with nothing, so each is its own component. Equal texts have
    equal sets and are linked. A null doc_id is in its component but doesn't name it; a component of nulls alone has a
    null name. Repeated rows each get a row.
    """
    with small_batches(docs.sparkSession):
        return _similar(docs, doc_id, text, percent, hot_docs, hot_limit, group, tag)


def _similar(docs: DataFrame, doc_id: str, text: str, percent: int, hot_docs: int, hot_limit: int, group: int, tag: str | None) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), (F.col(tag) if tag else F.lit(None)).cast("bigint").alias("tag"))
    sets = _sets(rows)
    hot, rank = _hot_tokens(sets, hot_docs, hot_limit)
    classes = _classes(rows, hot, rank, percent)
    lists = _posted(classes)
    edges = _checked(_stars(lists, classes), rows, classes, percent)
    comp = components(edges)
    for reach in ("one", "all"):
        more = _open_groups(lists, comp, rows, classes, percent, group, reach)
        if not more.isEmpty():
            edges = edges.unionByName(more)
            comp = components(edges)
    # names: only sets in a component of two or more take another name than their own first document
    named = comp.join(classes.select("node", "first", "digest"), "node")
    names = pinned(named.groupBy("comp").agg(F.min("first").alias("name")), "names")
    moved = pinned(named.join(names, "comp").select("digest", "name"), "moved")
    names = pinned(classes.select("digest", "first").join(moved, "digest", "left").select("digest", F.coalesce("name", "first").alias("name")), "names")
    every = sets.where("digest is not null").select("doc_id", F.col("n").alias("n_shingles"), "digest", *([F.col("tag").alias(tag)] if tag else []))
    name = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    return every.join(names, "digest", "left").select("doc_id", "n_shingles", name, *([tag] if tag else []))
