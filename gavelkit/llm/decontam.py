"""Benchmark decontamination with a distributed positional inverted index.

The index is split by documents: each of its rows is a block of whole documents of about ``BLOCK_TOKENS`` words, with its
terms in order, and each term's list of positions. So no posting is ever shuffled, a word that every document has is just
a longer list in each block, and the index serves any number of benchmarks. A window of test words is looked up from its
rarest term in the block: that term's positions, less the term's place in the window, are the first candidates, and each
further term's offset-adjusted list is intersected with them. Test items are taken in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import release, small_batches
from gavelkit.session import pinned

WIDTH = 13
BLOCK_TOKENS, GAP = 1_000_000, 64
_KEEP = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
INDEX = "block bigint, doc_ids array<bigint>, n_words array<bigint>, terms binary, counts binary, positions binary"


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered; digits, a-z and all that isn't ASCII belong to words, the rest parts them."""
    return (text or "").encode().translate(_KEEP).split()


def term_ids(terms: list[bytes]) -> np.ndarray:
    """64-bit hash of each term."""
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


def block_row(block: int, docs: list[tuple[int | None, list[bytes]]]) -> dict:
    """``coded_row`` of documents that are lists of words."""
    codes: dict[bytes, int] = {}
    return coded_row(block, [(d, np.array([codes.setdefault(w, len(codes)) for w in ws], np.int32)) for d, ws in docs], codes)


def coded_row(block: int, docs: list[tuple[int | None, np.ndarray]], codes: dict[bytes, int]) -> dict:
    """Postings of a block: terms in order of their hash, how many positions each has, and these, ascending.

    Documents hold a number for each word, ``codes`` has the word of each number, in order. Positions run through the whole
    block; documents are ``GAP`` apart, so that no stretch of words crosses a border.
    """
    ids = term_ids(list(codes))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    sizes = np.array([len(p) for _, p in docs], np.int64)
    starts = np.cumsum(sizes + GAP) - sizes - GAP
    keys = rank[np.concatenate([p for _, p in docs])] if len(ids) else np.zeros(0, np.int64)
    counts = np.bincount(keys, minlength=len(ids))
    keys <<= 32
    keys |= np.arange(len(keys)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    keys.sort()
    keys &= 0xFFFFFFFF
    z = zstandard.ZstdCompressor(level=1)
    return {
        "block": block,
        "doc_ids": [d for d, _ in docs],
        "n_words": sizes.tolist(),
        "terms": ids[order].astype("<u8").tobytes(),
        "counts": counts.astype("<u4").tobytes(),
        "positions": z.compress(np.diff(keys, prepend=0).astype("<i4").tobytes()),
    }


class Postings:
    """A block that was read back: ``keys`` is term number << 32 | position, ascending."""

    def __init__(self, row: dict):
        self.block, self.doc_ids = row["block"], row["doc_ids"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.starts = np.cumsum(self.n_words + GAP) - self.n_words - GAP
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["positions"]), "<i4")
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) << 32 | np.cumsum(steps, dtype=np.int64)
        self.first = np.cumsum(self.counts) - self.counts

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in this block, -1 where it doesn't occur."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term stands at the position beside it."""
        key = term << 32 | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (position >= 0)


class TestWindows:
    """Windows of a block of test items. Equal windows count once; ``items`` of window w: from ``begin[w]`` to ``begin[w+1]``."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int = WIDTH):
        self.width, self.names = width, sorted({name for name, _ in items})
        number = {n: k for k, n in enumerate(self.names)}
        codes: dict[bytes, int] = {}
        found: dict[bytes, set[int]] = {}
        for name, ws in items:
            seq = np.array([codes.setdefault(w, len(codes)) for w in ws], "<i4")
            for k in range(max(1, len(seq) - width + 1) if len(seq) else 0):
                found.setdefault(seq[k : k + width].tobytes(), set()).add(number[name])
        self.terms = term_ids(list(codes))
        self.size = np.array([len(w) // 4 for w in found], np.int64)
        self.grid = np.zeros((len(found), width), np.int32)
        for k, w in enumerate(found):
            self.grid[k, : len(w) // 4] = np.frombuffer(w, "<i4")
        lists = [sorted(x) for x in found.values()]
        self.begin = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        self.items = np.array([i for x in lists for i in x], np.int64)

    def in_block(self, p: Postings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows all of whose terms occur in the block; their terms there, rarest first, and the terms' places."""
        here = np.append(p.find(self.terms), -1)
        used = np.arange(self.width) < self.size[:, None]
        term = np.where(used, here[self.grid], -1)
        w = np.flatnonzero((term >= 0).sum(axis=1) == self.size) if len(self.size) else np.zeros(0, np.int64)
        count = np.where(used[w], p.counts[term[w]] if len(p.counts) else 0, 1 << 60)
        order = np.argsort(count, axis=1, kind="stable")
        return w, np.take_along_axis(term[w], order, 1), order

    def candidates(self, p: Postings) -> tuple[np.ndarray, ...]:
        """In-block windows and, for each position of a window's rarest term: row of the window, and position."""
        w, term, place = self.in_block(p)
        n = p.counts[term[:, 0]] if len(w) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(w)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(p.first[term[:, 0]] if len(w) else n, n)
        return w, term, place, row, p.keys[at] & 0xFFFFFFFF if len(row) else np.zeros(0, np.int64)

    def phrases(self, p: Postings) -> tuple[np.ndarray, np.ndarray]:
        """Exact matches: window and position of its first word."""
        w, term, place, row, at = self.candidates(p)
        start = at - place[row, 0]
        for k in range(1, self.width):
            if not len(row):
                break
            ends = self.size[w[row]] <= k
            ok = ends | p.has(np.where(ends, 0, term[row, k]), start + place[row, k])
            row, start = row[ok], start[ok]
        return w[row], start

    def near(self, p: Postings, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Proximity matches: window, and start of a stretch of its size + ``slop`` words that has all its terms in any order."""
        w, term, _, row, at = self.candidates(p)
        span = self.size[w[row]] + slop
        if len(span) and span.max() > GAP:
            raise ValueError(f"a stretch of {span.max()} words is longer than {GAP}")
        back = np.repeat(np.arange(len(row)), span)
        start = at[back] - (np.arange(len(back)) - np.repeat(np.cumsum(span) - span, span))
        row, span = row[back], span[back]
        # a stretch that would begin before the document has no word that the one at its first word hasn't
        ok = start >= p.starts[np.searchsorted(p.starts, at, side="right") - 1][back] if len(row) else start >= 0
        row, span, start = row[ok], span[ok], start[ok]
        for k in range(1, self.width):
            if not len(row):
                break
            ends = self.size[w[row]] <= k
            t = np.where(ends, 0, term[row, k])
            nxt = np.searchsorted(p.keys, t << 32 | start)
            nxt = p.keys[np.minimum(nxt, len(p.keys) - 1)]
            ok = ends | (nxt >= (t << 32 | start)) & (nxt < (t << 32 | start + span))
            row, span, start = row[ok], span[ok], start[ok]
        return w[row], start


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the index of all ``docs`` to the shared folder and return it; a row is a block of whole documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("terms", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary())])
        held, codes, size, block = [], {}, 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                # numbers, not words, are held until the block is full
                held.append((i.as_py(), np.array([codes.setdefault(w, len(codes)) for w in words(t.as_py())], np.int32)))
                size += len(held[-1][1]) + GAP
                if size >= block_tokens:
                    yield pa.RecordBatch.from_pylist([coded_row(block, held, codes)], schema=schema)
                    held, codes, size, block = [], {}, 0, block + 1
                    release()
        if held:
            yield pa.RecordBatch.from_pylist([coded_row(block, held, codes)], schema=schema)
        del held, codes
        release()

    with small_batches(docs.sparkSession):
        return pinned(docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(build, INDEX), "positions")


def test_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Test items in blocks of about ``block_bytes`` of text; one block at a time is on the driver."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        block = [(r["item"], words(r["text"])) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]
        if block := [x for x in block if x[1]]:
            yield block


def matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH, slop: int | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """Documents with a match: block, row (place in the block), spans (start, end in words), items.

    Exact phrases, or with ``slop`` stretches of that many more words that hold all of a window's words in any order.
    """
    found = None
    for block in test_blocks(items, item_id, text, block_bytes):
        part = index.mapInArrow(_matcher(block, width, slop), "block bigint, row int, spans array<struct<start:bigint,end:bigint>>, items array<string>")
        found = part if found is None else found.unionByName(part)
    return found


def _matcher(block: list[tuple[str, list[bytes]]], width: int, slop: int | None):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestWindows(block, width)
        schema = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])
        for batch in batches:
            for row in range(batch.num_rows):
                p = Postings({k: batch.column(k)[row].as_py() for k in ("block", "doc_ids", "n_words", "terms", "counts", "positions")})
                yield pa.RecordBatch.from_pylist(list(_found(tests, p, slop)), schema=schema)
                del p
        release()

    return match


def _found(tests: TestWindows, p: Postings, slop: int | None) -> Iterator[dict]:
    """A row for each document with a match; touching spans are joined."""
    w, start = tests.phrases(p) if slop is None else tests.near(p, slop)
    end = start + tests.size[w] + (slop or 0)
    doc = np.searchsorted(p.starts, start, side="right") - 1
    # a stretch may reach over its document's end; it can't reach the next one, which is GAP away
    end = np.minimum(end, p.starts[doc] + p.n_words[doc])
    order = np.lexsort((start, doc))
    w, start, end, doc = w[order], start[order], end[order], doc[order]
    cut = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cut], [*cut, len(doc)], strict=True):
        if a == b:
            continue
        d, spans = int(doc[a]), []
        for s, e in zip((start[a:b] - p.starts[d]).tolist(), (end[a:b] - p.starts[d]).tolist(), strict=True):
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], e)
            else:
                spans.append([s, e])
        mine = np.unique(w[a:b])
        items = np.unique(np.concatenate([tests.items[tests.begin[x] : tests.begin[x + 1]] for x in mine]))
        yield {"block": p.block, "row": d, "spans": [{"start": s, "end": e} for s, e in spans], "items": [tests.names[i] for i in items]}


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", share: int = 20, **settings) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated.

    ``contaminated``: some word is hit, and hit words times ``share`` reach the number of words. Null and empty texts have
    no words and are clean; items without words take no part, an item with null id is named by the empty string; repeated
    documents get a row each, repeated item ids count once. An empty table of items leaves every document clean.
    """
    index = build_index(docs, doc_id, text)
    every = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("row", "doc")).select("block", "row", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").alias("n_words"))
    found = matches(index, items, item_id, item_text, **settings)
    none = F.array().cast("array<string>")
    if found is None:
        out = every.withColumns({"n_hit": F.lit(0).cast("bigint"), "items": none})
    else:
        # one row a block of test items and document, so these lists are short
        whole = found.groupBy("block", "row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        covered = F.aggregate(
            "spans",
            F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n")),
            lambda s, x: F.struct(F.greatest(s["end"], x["end"]).alias("end"), (s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["end"]), F.lit(0))).alias("n")),
            lambda s: s["n"],
        )
        whole = whole.select("block", "row", covered.alias("n_hit"), "items")
        out = every.join(whole, ["block", "row"], "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")), "items": F.coalesce("items", none)})
    hit = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", hit.alias("contaminated"))
