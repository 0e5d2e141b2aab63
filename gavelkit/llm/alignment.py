"""Alignment of two tokenizers by external spill counting.

Where an A token and a B token of a document share bytes, they are linked. How many documents hold a pair of ids linked is
counted over the whole corpus without a table in memory:

1. Tasks encode documents and keep (pair, document) records until a run is full. A run is sorted by part (a radix of the A
   id), A id, B id, document, and spilled as zstd frames, with its documents' own columns, to a table of runs in the shared
   folder. Beside it stands each part's list of pairs with their counts of documents in the run; counting reads only these.
2. The lists of a part are merged from a heap, frame by frame, ``FAN`` at a time and level by level. As the order is
   A-major, an A id's highest count is known when its pairs have passed.
3. The counts stream back: each run gets its pairs' counts in the order of its own records, and adds them up by document.

Spark writes and reads all of it, so the shared folder may be in any store that Spark reaches.

A frequent A id is one pair list entry a run, however many documents hold it, so no task grows with its frequency.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import shown_bytes as _shown_bytes
from gavelkit.session import pinned

PARTS, RUN_LINKS, FAN, FRAME, SLICE = 128, 2_000_000, 64, 16_384, 1_000_000
# Fixed value: the rule by which byte-level vocabularies cut texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_DOCS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())])


class ByteVocabulary:
    """A byte-level merge vocabulary from a tokenizer file, without its special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        if ids != sorted(ids):
            raise ValueError(f"{path}: ids must rise with the order of merges")
        shown = _shown_bytes()
        self.bytes_of = {i: bytes(shown[c] for c in token) for token, i in model["vocab"].items() if all(c in shown for c in token)}
        letters = {i: b for i, b in self.bytes_of.items() if len(b) == 1} | {i: self.bytes_of[i] for i in ids}
        self.encoder = tiktoken.Encoding("side", pat_str=PATTERN, mergeable_ranks={b: i for i, b in letters.items()}, special_tokens={})
        self.size = max(self.bytes_of) + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoder.encode_to_numpy(f" {t}").astype(np.int64) for t in texts]


class PieceVocabulary:
    """A piece vocabulary from a model file, which puts the space before a text itself."""

    def __init__(self, path: str):
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        self.bytes_of = {i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(self.size)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


class Aligner:
    """Both vocabularies and the tables for whole-array work. A ids are ranked by (part, id), so that sorted records are in order of parts."""

    def __init__(self, path_a: str, path_b: str, parts: int):
        self.a, self.b = ByteVocabulary(path_a), PieceVocabulary(path_b)
        self.length = [np.array([len(v.bytes_of.get(i, b"")) for i in range(v.size)], np.int64) for v in (self.a, self.b)]
        self.text = [self._digits(v.size) for v in (self.a, self.b)]
        self.order, self.rank, self.first = ranked(self.a.size, parts)
        self.b_bits = int(self.b.size - 1).bit_length()
        self.doc_bits = 63 - int(self.a.size - 1).bit_length() - self.b_bits

    @staticmethod
    def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
        """Decimal digits of each id, a comma after them, and how many digits there are."""
        shown = [str(i) for i in range(size)]
        count = np.array([len(s) for s in shown])
        return np.array([s + "," for s in shown], f"S{count.max() + 1}").view(np.uint8).reshape(size, -1), count

    def encode(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that have tokens, and their ids on both sides."""
        at = [k for k, t in enumerate(texts) if t]
        found = zip(at, self.a.encode([texts[k] for k in at]), self.b.encode([texts[k] for k in at]), strict=True)
        whole = [(k, x, y) for k, x, y in found if self._says(x, y, f" {texts[k]}".encode())]
        return [k for k, _, _ in whole], [x for _, x, _ in whole], [y for _, _, y in whole]

    def _says(self, x: np.ndarray, y: np.ndarray, text: bytes) -> bool:
        return all(b"".join(map(v.bytes_of.__getitem__, ids.tolist())) == text for v, ids in ((self.a, x), (self.b, y)))

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray]:
        """Of each text n_a, n_b, n_groups, n_links, digest of groups; and a record (rank of A id, B id, place of the text) for each link.

        All texts are laid end to end. A mark stands at each byte where a token ends; between two marks lies one link.
        """
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        at, xs, ys = self.encode(texts)
        if not at:
            return rows, np.zeros(0, np.int64)
        x, y = np.concatenate(xs), np.concatenate(ys)
        end_x, end_y = np.cumsum(self.length[0][x]), np.cumsum(self.length[1][y])
        size = int(end_x[-1]) + 1
        mark_x, mark_y = np.zeros(size, bool), np.zeros(size, bool)
        mark_x[end_x], mark_y[end_y] = True, True
        upto_x, upto_y = np.cumsum(mark_x, dtype=np.int32), np.cumsum(mark_y, dtype=np.int32)
        both, any_ = np.flatnonzero(mark_x & mark_y), np.flatnonzero(mark_x | mark_y)
        n_x, n_y = np.array([len(v) for v in xs]), np.array([len(v) for v in ys])
        doc_end = end_x[np.cumsum(n_x) - 1]
        i, j = upto_x[any_] - mark_x[any_], upto_y[any_] - mark_y[any_]
        doc = np.repeat(np.array(at), n_x)[i]
        records = (self.rank[x[i]] << self.b_bits | y[j]) << self.doc_bits | doc
        n_groups, n_links = (np.diff(np.searchsorted(marks, doc_end, side="right"), prepend=0) for marks in (both, any_))
        digests = self._groups(x, y, end_x, end_y, both, upto_x, upto_y, n_x, n_y)
        for k, place in enumerate(at):
            rows[place] = (int(n_x[k]), int(n_y[k]), int(n_groups[k]), int(n_links[k]), digests[k])
        return rows, records

    def _groups(self, x, y, end_x, end_y, both, upto_x, upto_y, n_x, n_y) -> list[str]:
        """Digest of each text's groups, ``a1,a2|b1;a3|b2,b3``: ids of a group stand together, A's before B's."""
        until_x, until_y = upto_x[both].astype(np.int64), upto_y[both].astype(np.int64)
        of_x, of_y = np.searchsorted(both, end_x), np.searchsorted(both, end_y)
        row_x = np.arange(len(x)) + np.concatenate([[0], until_y])[of_x]
        row_y = np.arange(len(y)) + until_x[of_y]
        (text_x, digits_x), (text_y, digits_y) = self.text
        width = max(text_x.shape[1], text_y.shape[1])
        chars, digits = np.zeros((len(x) + len(y), width), np.uint8), np.empty(len(x) + len(y), np.int64)
        chars[row_x, : text_x.shape[1]], chars[row_y, : text_y.shape[1]] = text_x[x], text_y[y]
        digits[row_x], digits[row_y] = digits_x[x], digits_y[y]
        for rows, mark in ((row_x[until_x - 1], b"|"), (row_y[until_y - 1], b";")):
            chars[rows, digits[rows]] = mark[0]
        ends = np.cumsum(digits + 1)[np.cumsum(n_x + n_y) - 1].tolist()
        flat = chars[chars != 0].tobytes()
        return [hashlib.sha256(flat[a : b - 1]).hexdigest() for a, b in pairwise([0, *ends])]


def ranked(size: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order of (part, id), the rank of each id in that order, and the rank at which each part begins."""
    ids = np.arange(size, dtype=np.int64)
    part = (ids * 0x9E3779B1 >> 7) % parts
    order = np.lexsort((ids, part))
    rank = np.empty(size, np.int64)
    rank[order] = ids
    return order, rank, np.searchsorted(part[order], np.arange(parts + 1))


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str, parts: int) -> Aligner:
    return Aligner(path_a, path_b, parts)


def _planes(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, which packs far better than number by number."""
    return b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)


def _unplaned(raw: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel())
        at += n * size
    return out


def framed(keys: np.ndarray, counts: np.ndarray, frame: int = FRAME) -> bytes:
    """A sorted list of pairs with counts as frames: number of pairs, packed size, zstd of key steps and counts."""
    out = []
    for k in range(0, len(keys), frame):
        part = keys[k : k + frame]
        packed = zstandard.compress(_planes(np.diff(part, prepend=0).astype("<i8"), counts[k : k + frame].astype("<i8")), 3)
        out.append(struct.pack("<II", len(part), len(packed)) + packed)
    return b"".join(out)


def frames(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of a list, frame by frame."""
    at = 0
    while at < len(raw):
        n, size = struct.unpack_from("<II", raw, at)
        steps, counts = _unplaned(zstandard.decompress(raw[at + 8 : at + 8 + size]), n, "<i8", "<i8")
        yield np.cumsum(steps), counts
        at += 8 + size


def merged(lists: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sum of sorted lists in order of keys. A heap has the last key of each list's open frame; up to the least of them all is known."""
    streams = [frames(raw) for raw in lists]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def refill(k: int) -> None:
        nxt = next(streams[k], None)
        if nxt is not None:
            held[k] = nxt
            heapq.heappush(heap, (int(nxt[0][-1]), k))

    for k in range(len(streams)):
        refill(k)
    while heap:
        bound, done = heap[0][0], []
        while heap and heap[0][0] == bound:
            done.append(heapq.heappop(heap)[1])
        keys, counts = [], []
        for k in list(held):
            key, count = held[k]
            cut = int(np.searchsorted(key, bound, side="right"))
            keys.append(key[:cut])
            counts.append(count[:cut])
            held[k] = key[cut:], count[cut:]
        for k in done:
            del held[k]
            refill(k)
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[starts], np.add.reduceat(count, starts)


def with_best(chunks: Iterator[tuple[np.ndarray, np.ndarray]], b_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a pair's count is its A id's highest; only the last A id of a chunk waits for the next chunk."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k, c in chunks:
        keys, counts = np.concatenate([keys, k]), np.concatenate([counts, c])
        cut = int(np.searchsorted(keys, keys[-1] >> b_bits << b_bits))
        if cut:
            yield keys[:cut], counts[:cut], _is_best(keys[:cut], counts[:cut], b_bits)
            keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield keys, counts, _is_best(keys, counts, b_bits)


def _is_best(keys: np.ndarray, counts: np.ndarray, b_bits: int) -> np.ndarray:
    a = keys >> b_bits
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, starts), np.diff(starts, append=len(a)))


class _Run:
    """Records of some documents, until they are spilled."""

    def __init__(self):
        self.records, self.docs, self.links = [], [], 0

    def add(self, ids: list, rows: list[tuple], records: np.ndarray) -> None:
        self.records.append(records + len(self.docs))
        self.docs += [(i, *row) for i, row in zip(ids, rows, strict=True)]
        self.links += len(records)

    def spill(self, aligner: Aligner) -> list[tuple[str, int, bytes | None, bytes | None]]:
        """Rows run, part, pairs, records: each part's pair list, and as part -1 the records with the documents."""
        keys = np.concatenate(self.records)
        keys.sort()
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(starts, append=len(keys))
        keys = keys[starts]
        doc, pair = keys & ((1 << aligner.doc_bits) - 1), keys >> aligner.doc_bits
        heads = np.flatnonzero(np.diff(pair, prepend=-1))
        docs = np.diff(heads, append=len(pair))
        pair, heads = pair[heads], np.append(heads, len(keys))
        cuts = np.searchsorted(pair, aligner.first << aligner.b_bits)
        name, lists, sections = uuid.uuid4().hex, [], []
        for part in range(len(cuts) - 1):
            lo, hi = int(cuts[part]), int(cuts[part + 1])
            if lo < hi:
                a, b = int(heads[lo]), int(heads[hi])
                packed = zstandard.compress(_planes(docs[lo:hi].astype("<u4"), np.diff(doc[a:b], prepend=0).astype("<i4"), times[a:b].astype("<u4")), 3)
                sections.append((part, hi - lo, b - a, packed))
                lists.append((name, part, framed(pair[lo:hi], docs[lo:hi]), None))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.docs, strict=True), _DOCS, strict=True)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS) as w:
            w.write_batch(pa.RecordBatch.from_arrays(columns, schema=_DOCS))
        table = zstandard.compress(sink.getvalue().to_pybytes(), 3)
        raw = [struct.pack("<QI", len(table), len(sections)), table]
        for part, pairs, records, packed in sections:
            raw += [struct.pack("<IIII", part, pairs, records, len(packed)), packed]
        return [*lists, (name, -1, None, b"".join(raw))]


def _slices(column: pa.Array, most: int) -> Iterator[slice]:
    """Rows of a batch a few at a time: up to ``most`` bytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > start and (held + n > most or k - start >= 1024):
            yield slice(start, k)
            start, held = k, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def spilled(rows: DataFrame, path_a: str, path_b: str, parts: int, run_links: int) -> DataFrame:
    """run, part, pairs, records: the runs of a table (doc_id, text), with each part's list of pairs."""
    schema = pa.schema([("run", pa.string()), ("part", pa.int32()), ("pairs", pa.binary()), ("records", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held = _aligner(path_a, path_b, parts), _Run()
        batch_of = lambda lists: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lists, strict=True), schema, strict=True)], schema=schema)
        for batch in batches:
            for s in _slices(batch.column(1), SLICE):
                n = s.stop - s.start
                found, records = aligner.align(batch.column(1).slice(s.start, n).to_pylist())
                held.add(batch.column(0).slice(s.start, n).to_pylist(), found, records)
                if held.links >= run_links or len(held.docs) >= run_links:
                    yield batch_of(held.spill(aligner))
                    held = _Run()
            pa.default_memory_pool().release_unused()
        if held.docs:
            yield batch_of(held.spill(aligner))

    return pinned(rows.mapInArrow(run, "run string, part int, pairs binary, records binary"), "runs")


def counted(runs: DataFrame, blocks: int, fan: int, b_bits: int) -> DataFrame:
    """part, pairs: one list a part with the counts of all runs. Each level merges up to about ``fan`` lists in a task."""

    def run(table: pa.Table) -> pa.Table:
        raw = table.column("pairs").to_pylist()
        return pa.table({"part": table.column("part").slice(0, 1), "block": table.column("block").slice(0, 1), "pairs": pa.array([b"".join(framed(k, c) for k, c in merged(raw))], pa.binary())})

    lists = runs.where("part >= 0").select("part", _block(blocks), "pairs")
    while True:
        lists = lists.groupBy("part", "block").applyInArrow(run, "part int, block bigint, pairs binary")
        if blocks == 1:
            return pinned(lists.select("part", "pairs"), "pair-counts")
        blocks = -(-blocks // fan)
        lists = lists.withColumn("block", F.col("block") % blocks)


def _block(blocks: int):
    return F.pmod(F.xxhash64("run"), F.lit(blocks)).alias("block")


def _known(raw: bytes, b_bits: int) -> list[np.ndarray]:
    """Keys, counts and best marks of a part."""
    found = list(with_best(frames(raw), b_bits))
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]


def returned(runs: DataFrame, counts: DataFrame, blocks: int, b_bits: int) -> DataFrame:
    """run, part, back: for the pairs of a run's part, in its order, the corpus-wide count and whether it is the A id's highest."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, all_, best = _known(right.column("pairs")[0].as_py(), b_bits) if right.num_rows else _known(b"", b_bits)
        out = []
        for raw in left.column("pairs"):
            at = np.searchsorted(keys, np.concatenate([k for k, _ in frames(raw.as_py())]))
            out.append(struct.pack("<I", len(at)) + zstandard.compress(_planes(all_[at].astype("<i8"), best[at].astype("<u1")), 3))
        return pa.table({"run": left.column("run"), "part": left.column("part"), "back": pa.array(out, pa.binary())})

    lists = runs.where("part >= 0").select("run", "part", _block(blocks), "pairs")
    every = lists.select(F.col("part").alias("of"), F.col("block").alias("to")).distinct()
    every = every.join(counts.select(F.col("part").alias("of"), "pairs"), "of")
    return lists.groupBy("part", "block").cogroup(every.groupBy("of", "to")).applyInArrow(run, "run string, part int, back binary")


def _added(doc: np.ndarray, times: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Sum of times * counts by document, exactly: low and high halves of the counts are added apart."""
    low, high = counts & 0xFFFFF, counts >> 20
    return np.bincount(doc, times * low, n).astype(np.int64) + (np.bincount(doc, times * high, n).astype(np.int64) << 20)


def documents(backs: DataFrame, partitions: int) -> DataFrame:
    """The rows of all documents: each run's records are read once, and take the counts that came back."""

    def run(table: pa.Table) -> pa.Table:
        back = dict(zip(table.column("part").to_pylist(), table.column("back"), strict=True))
        f = pa.BufferReader(back[-1].as_buffer())
        size, sections = struct.unpack("<QI", f.read(12))
        docs = pa.ipc.open_stream(zstandard.decompress(f.read(size))).read_all()
        n = docs.num_rows
        sums, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for _ in range(sections):
            part, pairs, records, size = struct.unpack("<IIII", f.read(16))
            raw = zstandard.decompress(f.read(size))
            held, = _unplaned(raw, pairs, "<u4")
            doc, times = _unplaned(raw[4 * pairs :], records, "<i4", "<u4")
            known = back[part].as_py()
            count, is_best = _unplaned(zstandard.decompress(known[4:]), struct.unpack_from("<I", known)[0], "<i8", "<u1")
            doc = np.cumsum(doc)
            sums += _added(doc, times, np.repeat(count, held), n)
            best += np.bincount(doc, times * np.repeat(is_best, held), n).astype(np.int64)
        out = docs.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(sums))
        return out.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return backs.repartition(partitions, "run").groupBy("run").applyInArrow(run, kind)


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", parts: int = PARTS, run_links: int = RUN_LINKS, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Two tables: a row for each document, and a row for each pair of ids that some document holds linked.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A text is read as a space and the
    text. One that is null or empty, or whose joined tokens of either side aren't the same bytes, has no tokens: zeros and ''.
    Every row counts as a document of its own, repeated rows and null ids too, and has a row. Pairs: a, b, docs (documents
    that hold it linked), best (whether docs is the highest of its A id; ties all are). Empty tables give empty tables. Only the two
    named columns are read, so others can't clash. A text of any length is aligned whole; it makes a run of its own.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    runs = spilled(rows, path_a, path_b, parts, run_links)
    n = runs.where("part = -1").count()
    aligner = _aligner(path_a, path_b, parts)
    b_bits, order = aligner.b_bits, aligner.order
    blocks = max(1, -(-n // fan))
    counts = counted(runs, blocks, fan, b_bits)
    alone = runs.where("part = -1").select("run", "part", F.col("records").alias("back"))
    backs = alone.unionByName(returned(runs, counts, blocks, b_bits))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("pairs"):
                for keys, found, best in with_best(frames(raw.as_py()), b_bits):
                    yield pa.RecordBatch.from_arrays([pa.array(order[keys >> b_bits]), pa.array(keys & ((1 << b_bits) - 1)), pa.array(found), pa.array(best)], ["a", "b", "docs", "best"])

    cores = docs.sparkSession.sparkContext.defaultParallelism
    every = documents(backs, max(1, min(n, max(2 * cores, n // 4))))
    return every, counts.select("pairs").mapInArrow(pairs, "a bigint, b bigint, docs bigint, best boolean")
