"""Token ids in binary files, coded with Simple-8b.

A word of 64 bits holds a selector (4 bits) and as many ids of equal width as fit in the other 60. An id that needs more
than 60 bits, or one much wider than its neighbours, is an escape: the word holds 0 and the block lists its place and value.

File: magic, blocks, footer, length of the footer, counts of documents and of ids (8 bytes each, high byte first), magic,
a zero byte. A block holds up to ``BLOCK`` ids of one document:
counts of ids, words and escapes (3 x 32 bits, padded to 16 bytes), the words, escape places (32 bits), escape values
(64 bits), padded to 8 bytes. The footer has for each block its byte offset, and for each document its count of ids; so a
reader goes to any block, and decodes it with array operations alone.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gavelkit.llm.common import END, BoundedCache, file_contents, release, shown_bytes, write_files
from gavelkit.session import pinned, work_path

# Ids in a word and bits of each, by selector.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([c for c, _ in SELECTORS])
MAGIC, BLOCK, ESCAPE = b"GKIDS001", 32768, (1 << 60) - 1


def pack(ids: np.ndarray, escape_above: int = ESCAPE) -> bytes:
    """One block of ids."""
    return pack_all(ids, np.array([0, len(ids)]), escape_above)[0]


def pack_all(ids: np.ndarray, bounds: np.ndarray, escape_above: int = ESCAPE) -> list[bytes]:
    """Blocks ``ids[bounds[k] : bounds[k + 1]]``, made together.

    For all places at once, the selector is found that takes most ids without crossing a block's end; then places are
    walked from word to word, and words of one selector are put together at once.
    """
    n = len(ids)
    ids = ids.astype(np.uint64)
    places = np.flatnonzero(ids > escape_above)
    values = ids[places]
    ids[places] = 0
    most, choice = int(ids.max()) if n else 0, np.full(n, -1, np.int8)
    slim = ids.astype(np.uint32) if most < 1 << 32 else ids
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    wide = np.zeros(n + 1, np.int32)
    for s, (count, bits) in enumerate(SELECTORS):
        if count > n:
            continue
        ok = (room[: n + 1 - count] >= count) & (choice[: n + 1 - count] < 0)
        if most >> bits:
            np.cumsum(slim >= slim.dtype.type(1 << bits), out=wide[1:])
            ok &= wide[count:] == wide[: n + 1 - count]
        choice[: n + 1 - count][ok] = s
    step, starts, k = COUNTS[choice].tolist() if n else [], [], 0
    while k < n:
        starts.append(k)
        k += step[k]
    first = np.array(starts, np.int64)
    chosen = choice[first] if n else np.zeros(0, np.int8)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        mine = np.flatnonzero(chosen == s)
        at = first[mine]
        for j in range(count):
            words[mine] |= ids[at + j] << np.uint64(j * bits)
    raw, cut, far = words.astype("<u8").tobytes(), np.searchsorted(first, bounds).tolist(), np.searchsorted(places, bounds).tolist()
    out = []
    for k in range(len(bounds) - 1):
        a, b, c, d = cut[k], cut[k + 1], far[k], far[k + 1]
        block = struct.pack("<IIII", int(bounds[k + 1] - bounds[k]), b - a, d - c, 0) + raw[8 * a : 8 * b]
        if c < d:
            block += (places[c:d] - bounds[k]).astype("<u4").tobytes() + values[c:d].astype("<u8").tobytes()
        out.append(block + b"\0" * (-len(block) % 8))
    return out


def unpack(block: bytes | memoryview, at: int = 0) -> np.ndarray:
    """Ids of the block that begins at byte ``at``."""
    return unpack_all(block, np.array([at]))


def unpack_all(raw: bytes | memoryview, at: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at the bytes ``at``, one block after the other; words of one selector are taken apart at once."""
    head = np.frombuffer(raw, "<u4", len(raw) // 4)
    n, n_words, n_escapes = (head[at // 4 + k].astype(np.int64) for k in range(3))
    place = np.arange(n_words.sum()) + np.repeat(at // 8 + 2 - np.cumsum(n_words) + n_words, n_words)
    words = np.frombuffer(raw, "<u8", len(raw) // 8)[place]
    chosen = (words >> np.uint64(60)).astype(np.int64)
    starts = np.cumsum(COUNTS[chosen]) - COUNTS[chosen]
    out = np.zeros(n.sum(), np.uint64)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        mine = np.flatnonzero(chosen == s)
        held, first = words[mine], starts[mine]
        for j in range(count):
            out[first + j] = held >> np.uint64(j * bits) & np.uint64((1 << bits) - 1)
    begin = np.cumsum(n) - n
    for k in np.flatnonzero(n_escapes):
        tail = int(at[k] + 16 + 8 * n_words[k])
        out[begin[k] + np.frombuffer(raw, "<u4", n_escapes[k], tail)] = np.frombuffer(raw, "<u8", n_escapes[k], tail + 4 * n_escapes[k])
    return out


def end_marked(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """An encoder with the merges of a tokenizer file whose parts end in ``</w>``, and which ids end a part.

    A space stands for the mark. A last byte and its mark are one of the first tokens of such a file, so they are merged
    before all else, as in the library. Texts for the encoder are parts, each followed by a space.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    special, shown, mark = model["end_of_word_suffix"], shown_bytes(), len(model["end_of_word_suffix"])
    ranks = {bytes(shown[c] for c in t[:-mark]) + b" " if t.endswith(special) else bytes(shown[c] for c in t): i for t, i in model["vocab"].items()}
    ids = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if ids != sorted(ids) or (ids and any(ranks[bytes([b, 32])] >= ids[0] for b in range(256))):
        raise ValueError(f"{path}: ids don't follow the order of merges")
    ends = np.zeros(max(ranks.values()) + 1, bool)
    ends[[i for b, i in ranks.items() if len(b) > 1 and b.endswith(b" ")]] = True
    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), ends


class WordTokenizer:
    """Ids of texts as the tokenizers library gives them, with each distinct word encoded once.

    White space never is part of a token of this vocabulary kind, so a text is split at it. Words of plain Latin
    characters are lower-cased and cut into letter runs, digits and the rest here; the parts of all new words are merged
    in one call, by the same merges. Words with any other character, and very long ones, go to the library whole.
    """

    PLAIN = re.compile("[!-~¡-\u012f\u0131-\u024f]*")
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    ODD_SPACE = re.compile("[\x1c-\x1f]")
    LONG = 1000

    def __init__(self, path: str, keep: int = 700_000):
        self.library = Tokenizer.from_file(path)
        self.encoder, self.ends = end_marked(path)
        # parts of new words are merged together, so one memo of words is all
        self.words = self.parts = BoundedCache(keep)

    def raw(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def split(self, text: str) -> list[str]:
        # these four are white space to Python and not to the library
        return re.split("[ \n\t\r]+", text) if self.ODD_SPACE.search(text) else text.split()

    def learn(self, words: set[str]) -> dict[str, bytes]:
        plain, parts, upto, other = [], [], [0], []
        for w in words:
            low = w.lower()
            if len(w) > self.LONG or "<|" in w or not (w.isascii() or self.PLAIN.fullmatch(w)):
                other.append(w)
                continue
            if low.isalpha():  # letters alone are one part; with one mark after them, two
                parts.append(low)
            elif low[:-1].isalpha() and low[-1] in ".,;:!?":
                parts += (low[:-1], low[-1])
            elif self.PLAIN.fullmatch(w):
                parts += self.PARTS.findall(low)
            else:
                other.append(w)
                continue
            plain.append(w)
            upto.append(len(parts))
        out = dict(zip(other, self.raw(other), strict=True))
        if plain:
            ids = self.encoder.encode_to_numpy(" ".join(parts) + " " if parts else "").astype("<u4")
            ends = 4 * np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))[upto]
            raw, ends = ids.tobytes(), ends.tolist()
            out.update(zip(plain, [raw[a:b] for a, b in zip(ends, ends[1:])], strict=True))
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        known, out, late, fresh = self.words, [], [], set()
        for t in texts:
            ws = self.split(t)
            parts = list(map(known.get, ws))
            if None in parts:
                gaps = [k for k, p in enumerate(parts) if p is None]
                fresh.update([ws[k] for k in gaps])
                late.append((len(out), parts, gaps, ws))
                out.append(b"")
            else:
                out.append(b"".join(parts))
        made = self.learn(fresh)
        for k, parts, gaps, ws in late:
            for g in gaps:
                parts[g] = made[ws[g]]
            out[k] = b"".join(parts)
        known.keep_all(made)
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a Python worker; its caches are bounded and outlive a task."""
    return WordTokenizer(path)


def _runs(batch: pa.RecordBatch, chars: int = 4_000_000):
    """Rows of an Arrow batch in runs of bounded text length."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(i.as_py())
        texts.append(t.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_FOOT, _TAIL = "<QQ", ">QQQ"
#: A task begins a new file beyond so many bytes: a file is one row when Spark writes and reads it.
FILE_BYTES = 8 << 20


class _File:
    """A file that is being made: blocks of ids, and what its footer says."""

    def __init__(self):
        self.blocks, self.at, self.docs, self.counts, self.offsets = [MAGIC], len(MAGIC), [], [], []

    def add(self, docs: list, raw: list[bytes]) -> None:
        """The ids of some documents, as little-endian 32-bit integers."""
        sizes = [len(r) // 4 for r in raw]
        ends = np.cumsum(sizes)
        bounds = np.array([0, *(min(k + BLOCK, e) for e, n in zip(ends.tolist(), sizes, strict=True) for k in range(e - n, e, BLOCK))])
        for block in pack_all(np.frombuffer(b"".join(raw), "<u4"), bounds):
            self.blocks.append(block)
            self.offsets.append(self.at)
            self.at += len(block)
        self.docs += docs
        self.counts += sizes

    def content(self) -> bytes:
        known = np.array([d is not None for d in self.docs], np.uint8)
        numbers = np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.counts, "<u8").tobytes() + np.array(self.offsets, "<u8").tobytes()
        foot = struct.pack(_FOOT, len(self.docs), len(self.offsets)) + numbers + known.tobytes()
        return b"".join([*self.blocks, foot, struct.pack(_TAIL, len(foot), len(self.docs), sum(self.counts)), MAGIC, END])


def write_ids(df: DataFrame, folder: str, vocab: str, end_id: int, doc_id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of every text to files below ``folder``, in ascending order of ``doc_id``; return the list of files.

    Texts are dealt out by range of ``doc_id`` (nulls first) and sorted; each task encodes its range block by block into files
    of about ``file_bytes``, and Spark writes them, so the folder may be anywhere Spark can write. A file left by an attempt
    that failed is never seen. Null texts count as empty. Rows with equal ids stand in an order that follows from their
    texts; one id that very many rows share is dealt out by texts, and by where equal rows were read, so it doesn't fill one task.
    """
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", "gk_hash", "text", "gk_read_at"]
    rows = rows.withColumns({"gk_hash": F.xxhash64("text"), "gk_read_at": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange("doc_id", "gk_hash", "gk_read_at").sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, held = tokenizer(vocab), np.array([end_id], "<u4").tobytes(), _File()
        one = lambda made: pa.RecordBatch.from_pydict({"content": pa.array([made.content()], pa.binary())})
        for batch in batches:
            for ids, texts in _runs(batch):
                held.add(ids, [r + end for r in encode.batch(texts)])
                if held.at >= file_bytes:
                    yield one(held)
                    held = _File()
                    release()
        if held.docs:
            yield one(held)
        del held
        release()

    paths = write_files(dealt.mapInArrow(write, "content binary"), folder, "ids")
    number = lambda at: F.conv(F.hex(F.substring("content", -len(MAGIC + END) - at, 8)), 16, 10).cast("bigint")
    part = F.regexp_extract("path", r"(\d+)-[^/]*$", 1).cast("int")
    return pinned(file_contents(df.sparkSession, paths).select(part.alias("part"), "path", number(16).alias("n_docs"), number(8).alias("n_ids")), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """Rows of doc_id, start, n_tokens, ids (little-endian 32-bit integers) from the listed files; Spark reads the files.

    ``start`` counts the ids of all documents before: those in files before come from the list, which has one row a file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("path", "start")
    contents = file_contents(files.sparkSession, [r.path for r in files.select("path").collect()])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, content in zip(*batch.columns, strict=True):
                yield from read_file(path.as_py(), start.as_py(), content.as_buffer())

    # a broadcast of one small row a file, so that contents stay where they are read
    listed = contents.join(F.broadcast(begins), "path").select("path", "start", "content")
    return listed.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_file(path: str, start: int, content: pa.Buffer, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Documents of one file, in batches of about ``most`` ids; a batch's blocks are taken apart together."""
    tail = content.size - len(MAGIC + END)
    if tail < 0 or content[tail:].to_pybytes() != MAGIC + END:
        raise ValueError(f"{path} has no footer")
    foot_at = (tail := tail - struct.calcsize(_TAIL)) - struct.unpack_from(_TAIL, content, tail)[0]
    foot = content[foot_at:tail].to_pybytes()
    n_docs, n_blocks = struct.unpack_from(_FOOT, foot)
    docs, counts, offsets = (np.frombuffer(foot, kind, n, 16 + 8 * skip) for kind, n, skip in (("<i8", n_docs, 0), ("<i8", n_docs, n_docs), ("<i8", n_blocks, 2 * n_docs)))
    known = np.frombuffer(foot, np.uint8, n_docs, 16 + 8 * (2 * n_docs + n_blocks)).astype(bool)
    blocks, upto = np.append(offsets, foot_at), np.concatenate(([0], np.cumsum(counts)))
    of_docs = np.concatenate(([0], np.cumsum(-(-counts // BLOCK))))
    a = 0
    while a < n_docs:
        b = min(n_docs, max(a + 1, int(np.searchsorted(upto, upto[a] + most))))
        first, last = of_docs[a], of_docs[b]
        raw = content[int(blocks[first]) : int(blocks[last])].to_pybytes()
        ids = unpack_all(raw, blocks[first:last] - blocks[first]).astype("<u4")
        ends = pa.array(4 * (upto[a : b + 1] - upto[a]), pa.int64())
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, ends.buffers()[1], pa.py_buffer(ids)]).cast(pa.binary())
        begins, n = pa.array(start + upto[a:b]), pa.array(counts[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(docs[a:b], mask=~known[a:b]), begins, n, held], ["doc_id", "start", "n_tokens", "ids"])
        a = b


def round_trip(spark: SparkSession, df: DataFrame, vocab: str, end_id: int = 1) -> DataFrame:
    """Write the ids of ``df`` to a new folder below the shared one and read them back from the files."""
    return read_ids(write_ids(df, work_path(spark, "ids"), vocab, end_id))
