"""Near duplicates by an LSH forest over word shingles.

Equal sets fall together first. Each distinct set has a MinHash signature for each of several trees; a tree sorts all sets by
its signature, so that sets which agree on more leading values stand closer. Candidates come from these orders:

1. Neighbours: sets next to each other in an order, with the longest common prefix. What they link is joined to components.
2. Regions: sets that agree on the first ``base`` values of a tree are one region. Inside it, pairs from different components
   are compared by all values of their signatures; those that may reach the threshold are checked on full sets. Of a region
   with many sets each first gives its best partner alone, as most sets are then of one component and their pairs need no
   further look. A pair is only put out by the first tree that brings it together.
3. Depth by region: a region of more than ``region`` sets is too dense for that. Its sets get new, longer signatures in more
   trees, so that dense regions are looked at with deeper prefixes and sparse ones with short ones. At the deepest level a
   region that still is too large is compared tile by tile.

At a level with T trees and prefixes of p values, a pair of similarity s meets with probability 1 - (1 - s^p)^T. The number of
trees of each level follows from the threshold, so that a pair just at it is missed with at most ``MISS``. Each link is
confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import marked
from gavelkit.llm.jaccard import components, shingles
from gavelkit.session import pinned

PERCENT, REGION, VALUES, TOGETHER, MANY = 85, 2048, 384, 4, 8
#: Values of a prefix at each level, and how probable a missed pair at the threshold may be.
DEPTHS, MISS = (3, 8, 16), 3e-9
#: A pair is checked on full sets if its share of equal values is within so many standard deviations of the threshold.
DEVIATIONS = 5.0
_MIX = np.uint32(0x85EBCA6B)


def multipliers(count: int) -> np.ndarray:
    """Odd 32-bit numbers, the same in all tasks."""
    return np.random.default_rng(7).integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def signature(tokens: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of factor * token for each factor, as 16 mixed bits. Tokens are hashes already, so a product orders them anew."""
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    least = None
    for k in range(0, len(x), 256):
        part = np.multiply.outer(factors, x[k : k + 256]).min(1)
        least = part if least is None else np.minimum(least, part)
    return ((least ^ (least >> np.uint32(15))) * _MIX >> np.uint32(16)).astype("<u2")


def levels(percent: int, depths: tuple = DEPTHS, miss: float = MISS) -> list[tuple[int, int]]:
    """(trees, values of a prefix) of each level."""
    return [(max(1, math.ceil(math.log(miss) / math.log1p(-min(1 - 1e-9, (percent / 100) ** p)))), p) for p in depths]


def shape(level: tuple[int, int]) -> tuple[int, int]:
    """Trees and values of each tree's signature, of which the first are the prefix."""
    trees, base = level
    return trees, max(base, -(-VALUES // trees))


def sure(percent: int, values: int, deviations: float = DEVIATIONS) -> float:
    """Least share of equal values with which a pair goes on to the check."""
    s = percent / 100
    return s - deviations * (s * (1 - s) / values) ** 0.5


def text_key(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode()) >> 1


def _signed(rows: DataFrame, level: tuple[int, int]) -> DataFrame:
    """A row for each document: doc_id, n, digest of the set, key of the text; and the signature where a task sees a set first."""
    trees, values = shape(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, seen = multipliers(trees * values), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                out = []
                part = batch.slice(at, 1024)
                for i, text in zip(part.column(0), part.column(1), strict=True):
                    text = text.as_py()
                    s = shingles(text)
                    digest, sign = xxhash.xxh3_128_digest(s.tobytes()), None
                    if len(s) and digest not in seen:
                        if len(seen) >= 100_000:
                            seen.clear()
                        seen.add(digest)
                        sign = signature(s, factors).tobytes()
                    out.append((i.as_py(), len(s), digest, text_key(text), sign))
                kinds = pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "n", "digest", "key", "sign"])
            pa.default_memory_pool().release_unused()

    return pinned(rows.mapInArrow(run, "doc_id bigint, n bigint, digest binary, key bigint, sign binary"), "signed")


def _classes(signed: DataFrame) -> DataFrame:
    """node, digest, n, first (smallest doc_id), key of one of its texts, signature: a row for each distinct set that isn't empty."""
    sets = signed.where("n > 0")
    one = sets.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("n").alias("n"))
    # tasks have signed a set at most a few times each, so few rows are left to choose from
    sign = sets.where("sign is not null").groupBy("digest").agg(F.first("sign").alias("sign"))
    return pinned(one.join(sign, "digest").withColumn("node", F.monotonically_increasing_id()), "classes")


def _entries(classes: DataFrame, level: tuple[int, int]) -> DataFrame:
    """node, n, prefix (a hash of tree and prefix), next (the values after it, as bytes): the places of sets in the orders, of prefixes that several sets have."""
    trees, values = shape(level)
    base = level[1]
    cut = lambda t, k, size: F.substring("sign", t * (2 * values) + (2 * k + 1), F.lit(2 * size))
    place = lambda t: F.struct(F.xxhash64(t, cut(t, 0, base)).alias("prefix"), cut(t, base, min(4, values - base)).alias("next"))
    rows = classes.select("node", "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), place)).alias("at")).select("node", "n", "at.prefix", "at.next")
    several = rows.groupBy("prefix").count().where("count > 1").select("prefix")
    return pinned(rows.join(several, "prefix"), "entries")


def _neighbours(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that are neighbours in ``TOGETHER`` orders at least and may be linked by their sizes.

    They only join most sets early; what they leave out is compared in the regions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix, node, n = (batch.column(k).to_numpy() for k in ("prefix", "node", "n"))
            if last is not None:
                prefix, node, n = (np.concatenate([x, y]) for x, y in zip(last, (prefix, node, n), strict=True))
            last = prefix[-1:], node[-1:], n[-1:]
            ok = (prefix[1:] == prefix[:-1]) & (100 * np.minimum(n[1:], n[:-1]) >= percent * np.maximum(n[1:], n[:-1]))
            a, b = node[:-1][ok], node[1:][ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    spread = entries.repartition("prefix", F.substring("next", 1, 2)).sortWithinPartitions("prefix", "next", "node")
    return spread.select("prefix", "node", "n").mapInArrow(run, "a bigint, b bigint").where("a <> b").groupBy("a", "b").count().where(F.col("count") >= TOGETHER).select("a", "b")


def _compared(ids: np.ndarray, comp: np.ndarray, n: np.ndarray, sign: np.ndarray, heads: np.ndarray, mine: int, least: float, percent: int, tile: np.ndarray, best: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a region from different components that may be linked and aren't brought together by an earlier tree.

    ``heads`` has the hashes of all trees' prefixes, ``mine`` is this tree. In a tile only pairs of its two sides are compared.
    With ``best`` each set gives only the pair with the one that shares most values.
    """
    out_a, out_b, values, sides = [], [], sign.shape[1], tile.max() > tile.min()
    for k in range(len(ids) - 1):
        rest = slice(k + 1, None)
        ok = (comp[rest] != comp[k]) & (100 * np.minimum(n[rest], n[k]) >= percent * np.maximum(n[rest], n[k])) & (ids[rest] != ids[k])
        if sides:
            ok &= tile[rest] != tile[k]
        at = np.flatnonzero(ok) + k + 1
        if len(at):
            equal = np.count_nonzero(sign[at] == sign[k], axis=1)
            at = at[equal >= least * values]
            if best and len(at):
                at = at[np.argmax(equal[equal >= least * values])][None]
        if len(at) and mine and not best:
            at = at[~(heads[at, :mine] == heads[k, :mine]).any(1)]
        out_a.append(np.full(len(at), ids[k]))
        out_b.append(ids[at])
    a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (out_a, out_b))
    return np.minimum(a, b), np.maximum(a, b)


def _heads(sign: np.ndarray, trees: int, values: int, base: int) -> np.ndarray:
    """A number for the prefix of each tree: its values' bytes, or a hash where they are more than eight."""
    cut = np.ascontiguousarray(sign.reshape(len(sign), trees, values)[:, :, :base])
    if base <= 4:
        wide = np.zeros((len(sign), trees, 4), np.uint16)
        wide[:, :, :base] = cut
        return wide.view(np.uint64)[:, :, 0]
    return np.array([[xxhash.xxh3_64_intdigest(p.tobytes()) for p in row] for row in cut], np.uint64).reshape(len(sign), trees)


def _regions(entries: DataFrame, classes: DataFrame, comp: DataFrame, level: tuple[int, int], percent: int, region: int, deepest: bool, best: bool) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs between components inside regions, and the nodes of regions too large for that (none at the deepest level).

    With ``best`` only regions of more than ``MANY`` sets are looked at, for the best partner of each set.
    """
    trees, values = shape(level)
    base, least = level[1], sure(percent, trees * values, 2 if best else DEVIATIONS)
    named = entries.select("prefix", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = pinned(named, "named")
    size = named.groupBy("prefix").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").where(F.col("size") > (MANY if best else 0)).select("prefix", "size")
    size = pinned(size, "mixed")
    large = named.join(size.where(F.col("size") > region), "prefix").select("node").distinct()
    small = named.join(size.where(F.col("size") <= region).select("prefix"), "prefix").withColumns({"lo": F.lit(0), "hi": F.lit(0), "tile": F.lit(0)})
    if deepest:
        # a region too large is cut into tiles: each set goes to the pairs of its chunk with all others
        half = max(1, region // 2)
        chunks = F.ceil(F.col("size") / half).cast("int")
        cut = named.join(size.where(F.col("size") > region), "prefix").withColumn("tile", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        cut = cut.select("prefix", "node", "comp", "tile", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        small = small.unionByName(cut.select("prefix", "node", "comp", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "tile"))
    full = small.join(classes.select("node", "n", "sign"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def close():
            t = pa.Table.from_batches(held)
            sign = np.frombuffer(b"".join(t.column("sign").to_pylist()), "<u2").reshape(t.num_rows, trees * values)
            cut = sign.reshape(-1, trees, values)[:, :, :base]
            mine = int((cut == cut[0]).all(2).all(0).argmax())
            ids, comps, n, tile = (t.column(k).to_numpy() for k in ("node", "comp", "n", "tile"))
            a, b = _compared(ids, comps, n, sign, _heads(sign, trees, values, base), mine, least, percent, tile, best)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("prefix", "lo", "hi")], 1)
            starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for lo, hi in zip(starts, starts[1:], strict=False):
                if now is not None and now != tuple(key[lo]):
                    yield close()
                    held = []
                now = tuple(key[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield close()

    spread = full.select("prefix", "lo", "hi", "node", "comp", "n", "sign", "tile").repartition("prefix", "lo", "hi").sortWithinPartitions("prefix", "lo", "hi", "node")
    pairs = pinned(spread.mapInArrow(run, "a bigint, b bigint").distinct(), "near")
    return pairs, pinned(large.limit(0) if deepest or best else large, "dense")


def _sets(rows: DataFrame, wanted: DataFrame, level: tuple[int, int] | None = None, bits: int = 22) -> DataFrame:
    """node and the token sets (or, with a level, signatures) of wanted classes (node, digest, key), made again from the texts.

    A bitmap of fixed size over keys of texts tells tasks which texts may be wanted; a join then settles it.
    """
    bitmap = marked(wanted.select((F.col("key") % (1 << bits)).alias("spot")), bits)
    trees, values = shape(level) if level else (0, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(trees * values)
        made = lambda out: pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], ["digest", "made"])
        for batch in batches:
            out, held = {}, 0
            for text in batch.column(1):
                text = text.as_py()
                at = text_key(text) % (1 << bits)
                if int(bitmap[at >> 5]) >> (at & 31) & 1:
                    s = shingles(text)
                    raw = s.tobytes()
                    digest = xxhash.xxh3_128_digest(raw)
                    if len(s) and digest not in out:
                        out[digest] = signature(s, factors).tobytes() if level else raw
                        held += len(out[digest])
                    if held > 4 << 20:
                        yield made(out)
                        out, held = {}, 0
            if out:
                yield made(out)
            pa.default_memory_pool().release_unused()

    found = rows.mapInArrow(run, "digest binary, made binary").join(wanted.select("node", "digest"), "digest")
    return found.dropDuplicates(["node"]).select("node", "made")


def _linked(pairs: DataFrame, rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are linked. Pairs with their two sets pass row by row; no group is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for p, q in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in ("a", "b")], ["a", "b"])

    pairs = pinned(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = pinned(nodes.join(classes.select("node", "digest", "key"), "node"), "wanted")
    sets = pinned(_sets(rows, wanted), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("made").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("made").alias("y")), "b")
    return pinned(both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"), "links")


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, depths: tuple = DEPTHS, region: int = REGION) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself included), kept.

    Null and empty texts, and texts of white space, have empty sets: each is its own component and kept. Equal texts have equal
    sets and are linked. A null doc_id is in its component but doesn't name it; a component of nulls alone has a null
    name. kept says that a row has its component's name, nulls included; so of rows that repeat id and text all are kept.
    Only the two named columns are read, so others can't clash. An empty table gives an empty table.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    steps = levels(percent, depths)
    signed = _signed(rows, steps[0])
    classes = _classes(signed)
    entries = _entries(classes, steps[0])
    edges = _linked(_neighbours(entries, percent), rows, classes, percent)
    comp = components(edges)
    signs = classes.select("node", "n", "sign")
    for k, level in enumerate(steps):
        for best in (True, False):
            pairs, dense = _regions(entries, signs, comp, level, percent, region, level == steps[-1], best)
            more = _linked(pairs, rows, classes, percent)
            if not more.isEmpty():
                edges = edges.unionByName(more)
                comp = components(edges)
        if dense.isEmpty():
            break
        wanted = pinned(classes.select("node", "digest", "key", "n").join(dense, "node"), "wanted")
        signs = pinned(_sets(rows, wanted, steps[k + 1]).withColumnRenamed("made", "sign").join(wanted.select("node", "n"), "node"), "signs")
        entries = _entries(signs, steps[k + 1])
    named = comp.join(classes.select("node", "first", "digest"), "node")
    names = pinned(named.groupBy("comp").agg(F.min("first").alias("name")), "names")
    moved = pinned(named.join(names, "comp").select("digest", "name"), "moved")
    names = pinned(classes.select("digest", "first").join(moved, "digest", "left").select("digest", F.coalesce("name", "first").alias("name")), "names")
    name = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    out = signed.select("doc_id", "n", "digest").join(names, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), name)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
