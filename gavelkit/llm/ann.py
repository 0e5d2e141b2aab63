"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is put in a leaf. A query walks the tree best bin first: a priority
queue holds the nodes seen so far by their centre's distance, and leaves are visited in the order in which they come out.
How many leaves a search visits is found on the data: for some queries the exact answer is computed, and the number of
visits is widened until these queries' recall reaches the target.

Nearness is the largest inner product. Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and
queries a zero; then the nearest vector in the tree's space is the one with the largest product, whatever the norms are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.session import pinned

SAMPLE, BRANCH, LEAF_ROWS, MOST_LEAVES, BLOCK = 65_536, 16, 500, 4096, 4096
TRIALS, RECALL = 256, 0.97


@dataclass
class Tree:
    """Nodes by number: centre, and children (none: a leaf, whose number among leaves is in ``leaf``)."""

    centre: list[np.ndarray]
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def walk(self, query: np.ndarray, visits: int) -> list[int]:
        """Leaves in best-bin-first order, at most ``visits``."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
            else:
                apart = ((np.stack([self.centre[c] for c in self.children[node]]) - query) ** 2).sum(axis=1)
                for d, c in zip(apart.tolist(), self.children[node], strict=True):
                    heapq.heappush(queue, (d, c))
        return out

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: from the root, always the nearest child."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
            elif len(rows):
                near = _nearest(x[rows], np.stack([self.centre[c] for c in self.children[node]]))
                todo += [(c, rows[near == k]) for k, c in enumerate(self.children[node])]
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)


def grow(x: np.ndarray, leaves: int, branch: int = BRANCH, rounds: int = 12, seed: int = 1) -> Tree:
    """k-means at each node, until there are about ``leaves`` leaves of like size."""
    rng = np.random.default_rng(seed)
    tree = Tree([x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], [-1])
    todo, found, least = [(0, np.arange(len(x)))], 0, max(1, len(x) // max(1, leaves))
    while todo:
        node, rows = todo.pop()
        k = min(branch, -(-len(rows) // least))
        if k > 1:
            centres = x[rng.choice(rows, k, replace=False)]
            for _ in range(rounds):
                near = _nearest(x[rows], centres)
                centres = np.stack([x[rows[near == j]].mean(axis=0) if (near == j).any() else centres[j] for j in range(k)])
            near = _nearest(x[rows], centres)
            parts = [(c, rows[near == j]) for j, c in enumerate(centres) if (near == j).any()]
            k = len(parts)
        if k < 2:
            tree.leaf[node] = found
            found += 1
            continue
        for c, mine in parts:
            tree.children[node].append(len(tree.leaf))
            todo.append((len(tree.leaf), mine))
            tree.centre.append(c)
            tree.children.append([])
            tree.leaf.append(-1)
    return tree


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that turns the largest product into the nearest point."""
    return np.hstack([x, np.sqrt(np.maximum(most**2 - (x**2).sum(axis=1, keepdims=True), 0.0))])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vec of vectors that take part: no nulls, finite, not zero, of the length that most vectors have."""
    vec = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and size(vec) > 0")
    finite = F.forall("vec", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v))
    rows = rows.where(finite & F.exists("vec", lambda v: v != 0))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["size"] if sizes else 0))


def _merged(found: DataFrame, key: str, keep: int) -> DataFrame:
    """The best ``keep`` of the lists ``best`` (struct of minus score, and more) of each key."""
    return found.groupBy(key).agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, keep).alias("best"))


def _best(q: np.ndarray, c: np.ndarray, tie: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the numbers and scores of the best ``keep`` rows of ``c``, ties by ``tie``.

    The product picks a few more than needed; their scores are then summed in one fixed way for each pair of vectors, so
    that a score never depends on which vectors were multiplied together.
    """
    rough = q @ c.T
    spare = min(len(c), keep + 12)
    for k in range(len(q)):
        at = np.argpartition(-rough[k], spare - 1)[:spare] if spare < len(c) else np.arange(len(c))
        if spare < len(c):  # whatever ties with the last one is taken too
            at = np.flatnonzero(rough[k] >= rough[k][at].min() - 1e-12)
        score = (q[k] * c[at]).sum(axis=1)
        order = np.lexsort((tie[at], -score))[:keep]
        yield at[order], score[order]


def calibrated(tree: Tree, index: DataFrame, trial: list[tuple[int, np.ndarray]], top: int, recall: float) -> tuple[int, float]:
    """Leaf visits that a search needs, and the recall that they give on the trial queries."""
    if not trial:
        return 1, 1.0
    q = np.stack([v for _, v in trial])
    own = np.array([c for c, _ in trial])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("less", pa.float64()), ("class", pa.int64()), ("leaf", pa.int64())]))
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, cls = batch.column("leaf").to_numpy(), batch.column("class").to_numpy()
            best = [[{"less": -float(s), "class": int(cls[a]), "leaf": int(leaf[a])} for a, s in zip(at, score, strict=True)] for at, score in _best(q, _matrix(batch.column("vec")), cls, top + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(q)), pa.int32()), pa.array(best, kind)], ["trial", "best"])

    found = index.select("leaf", "class", "vec").mapInArrow(exact, "trial int, best array<struct<less:double,class:bigint,leaf:bigint>>")
    ranks, total = [], 0
    for r in _merged(found, "trial", top + 1).collect():
        order = {leaf: k for k, leaf in enumerate(tree.walk(np.append(q[r["trial"]], 0.0), tree.leaves))}
        near = [b["leaf"] for b in r["best"] if b["class"] != own[r["trial"]]][:top]
        ranks += [order[leaf] for leaf in near]
        total += len(near)
    visits = 1
    while visits < tree.leaves and sum(k < visits for k in ranks) < recall * total:
        visits += max(1, visits // 4)
    visits = min(visits, tree.leaves)
    return visits, sum(k < visits for k in ranks) / max(1, total)


def nearest(
    rows: DataFrame, is_query, top: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS, most_leaves: int = MOST_LEAVES, trials: int = TRIALS, recall: float = RECALL, block: int = BLOCK, visits: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's ``top`` nearest vectors but itself, ties to smaller vec_id.

    ``is_query``: condition on the id column. Vectors that are null, zero, hold nulls or non-finite values, have another
    length than most, or have no id take no part, as query or candidate; rows with a query's id aren't its candidates.
    Fewer candidates than ``top`` give fewer rows, an empty table none. ``visits`` overrides the calibration.

    Equal vectors are one class, searched once; a class keeps its ``top`` + 1 smallest ids, since no other id of it can be
    among the nearest. Candidates of a leaf, and queries that visit it, meet in blocks of about ``block`` rows each.
    """
    good = usable(rows, vec_id, vector)
    few = Window.partitionBy("vec").orderBy("vec_id")
    smallest = good.distinct().withColumn("k", F.row_number().over(few)).where(F.col("k") <= top + 1)
    classes = smallest.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("class", F.monotonically_increasing_id())
    classes = pinned(classes, "vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    n, most = classes.agg(F.count("*"), F.max(norm)).first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not n:
        return rows.sparkSession.createDataFrame([], empty)
    chance = min(1.0, sample / n)
    drawn = classes.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < chance * (1 << 30)).select("vec").toArrow()
    fitted = lifted(_matrix(drawn.column("vec").combine_chunks()), most) if drawn.num_rows else np.zeros((0, 1))
    tree = grow(fitted, min(most_leaves, max(1, n // leaf_rows), max(1, len(fitted) // 16)))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.place(lifted(_matrix(batch.column("vec")), most)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(batch.column(k) for k in ("class", "vec", "ids"))], ["leaf", "class", "vec", "ids"])

    index = pinned(classes.select("class", "vec", "ids").mapInArrow(put, "leaf bigint, class bigint, vec array<double>, ids array<bigint>"), "leaves")
    asking = pinned(good.where(is_query).select(F.col("vec_id").alias("query_id"), "vec").distinct().join(classes.select("vec", "class"), "vec").select("query_id", "class"), "asking")
    asked = pinned(classes.join(asking.select("class").distinct(), "class", "semi").select("class", "vec"), "asked")
    if visits is None:
        trial = asked.orderBy(F.xxhash64("vec")).limit(trials).collect()
        visits, _ = calibrated(tree, index, [(r["class"], np.array(r["vec"])) for r in trial], top, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = np.hstack([_matrix(batch.column("vec")), np.zeros((batch.num_rows, 1))]) if batch.num_rows else []
            ways = [tree.walk(x, visits) for x in q]
            at = np.repeat(np.arange(len(ways)), [len(w) for w in ways])
            leaf = np.array([leaf for w in ways for leaf in w], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(batch.column(k).take(pa.array(at)) for k in ("class", "vec"))], ["leaf", "class", "vec"])

    going = pinned(asked.mapInArrow(visit, "leaf bigint, class bigint, vec array<double>"), "visits")
    parts = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias(name))
    shape = pinned(parts(index, "c_parts").join(parts(going, "q_parts"), "leaf"), "shape")
    part = lambda name: F.pmod(F.xxhash64("class"), F.col(name)).cast("int")
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name).cast("int") - 1))
    left = index.join(shape, "leaf").select("leaf", part("c_parts").alias("c"), each("q_parts").alias("q"), "class", "vec", "ids")
    right = going.join(shape, "leaf").select("leaf", each("c_parts").alias("c"), part("q_parts").alias("q"), "class", "vec")

    def search(cands: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(cands) or not len(queries):
            return pd.DataFrame({"class": [], "best": []})
        c, q = (np.stack(x["vec"].to_numpy()) for x in (cands, queries))
        ids = cands["ids"].to_numpy()
        first, out = np.array([x[0] for x in ids]), []
        for at, score in _best(q, c, first, top + 1):
            one = sorted((-float(s), int(i)) for a, s in zip(at, score, strict=True) for i in ids[a])[: top + 1]
            out.append([{"less": s, "vec_id": i} for s, i in one])
        return pd.DataFrame({"class": queries["class"], "best": out})

    found = left.groupBy("leaf", "c", "q").cogroup(right.groupBy("leaf", "c", "q")).applyInPandas(search, "class bigint, best array<struct<less:double,vec_id:bigint>>")
    best = pinned(_merged(found, "class", top + 1), "nearest")
    out = asking.join(best, "class").select("query_id", F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, top).alias("best"))
    out = out.select("query_id", F.posexplode("best").alias("k", "b"))
    return out.select("query_id", (F.col("k") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score"))
