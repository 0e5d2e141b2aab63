"""SentencePiece (merge type) encoding by a prefix table, and decoding.

Every prefix of a text has one merge encoding, so one last token. That token is the only vocabulary entry that ends the
prefix, and whose pair with the last token of the prefix before it is itself what merging would give. The table is filled
from left to right with the entries that an automaton finds at each place, and ids are read off backwards.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import BoundedCache, arrow_rows

SPACE = "▁"
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_KIND = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])


class PieceModel:
    """A merge-type vocabulary with byte fallback, read from a model file."""

    def __init__(self, path: str, cache_rows: int = 150_000):
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end, size = m.bos_id(), m.eos_id(), m.get_piece_size()
        plain = [i for i in range(size) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.piece = {i: m.id_to_piece(i) for i in plain}
        self.ids = {p: i for i, p in self.piece.items()}
        self.score = {i: m.get_score(i) for i in plain}
        byte_ids = {int(m.id_to_piece(i)[3:5], 16): i for i in range(size) if m.is_byte(i)}
        self.byte_id = [byte_ids[b] for b in range(256)]
        self.bytes_of = [b"" if m.is_control(i) else bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        self.pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.chars = {c for p in self.ids for c in p if c in self.ids}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        # no entry has a space mark after another character, so a text falls apart before each run of marks
        self.falls_apart = not any(a != SPACE and b == SPACE for a, b in self.pairs)
        self.fits: BoundedCache = BoundedCache(3 * cache_rows)
        self.short: BoundedCache = BoundedCache(2 * cache_rows)
        self.long: BoundedCache = BoundedCache(cache_rows)

    def merged(self, text: str) -> list[str]:
        """Plain merging of a short string: best score first, then leftmost."""
        parts, ids, score = list(text), self.ids, self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def pair_fits(self, a: int, b: int) -> bool:
        """Whether merging the two entries' text gives just these two (for a first entry, a = -2: just itself)."""
        want = [self.piece[b]] if a == -2 else [self.piece[a], self.piece[b]]
        return self.fits.keep(a << 20 | b, self.merged("".join(want)) == want)

    def table(self, text: str) -> list[int]:
        """Last token of each prefix of ``text``, all of whose characters are in the vocabulary; the empty one has -2."""
        last, fits = [-1] * (len(text) + 1), self.fits.get
        last[0] = -2
        for at, (size, token) in self.automaton.iter(text):
            if last[at + 1] == -1:
                before = last[at + 1 - size]
                if before != -1:
                    known = fits(before << 20 | token)
                    if self.pair_fits(before, token) if known is None else known:
                        last[at + 1] = token
        return last

    def stretch(self, text: str) -> bytes:
        """Ids of a stretch that no entry crosses, as little-endian 32-bit integers."""
        if len(text) == 1 and text not in self.ids:
            out = [self.byte_id[b] for b in text.encode()]
        else:
            last, e, out = self.table(text), len(text), []
            while e:
                out.append(last[e])
                e -= len(self.piece[last[e]])
            out.reverse()
        return array("I", out).tobytes()

    def word(self, text: str) -> bytes:
        """Ids of a run of marks with the characters after it: of stretches between places that no entry crosses.

        Where all characters are in the vocabulary, only a last one (mostly a full stop or comma) is looked at.
        """
        if self.chars.issuperset(text):
            parts = (text[:-1], text[-1]) if len(text) > 1 and text[-2:] not in self.pairs else (text,)
            return b"".join([self.short.get(p) or self.short.keep(p, self.stretch(p)) for p in parts])
        out, at = [], 0
        for k in range(1, len(text) + 1):
            if k == len(text) or text[k - 1 : k + 1] not in self.pairs:
                part = text[at:k]
                known = self.short.get(part)
                out.append(self.short.keep(part, self.stretch(part)) if known is None else known)
                at = k
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text with begin and end ids, as little-endian 32-bit integers."""
        first, last = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        if not text:
            return first + last
        if not self.falls_apart:
            return first + self.word(SPACE + text.replace(" ", SPACE)) + last
        if SPACE in text or "  " in text or text[-1] == " " or text[0] == " ":
            words = [x for x in _RUNS.findall(SPACE + text.replace(" ", SPACE))]
            words = [x[1:] if x[0] == SPACE and x[1:2] != SPACE and len(x) > 1 else SPACE + x for x in words]
        else:
            words = text.split(" ")
        known = self.long
        for w in {w for w in words if w not in known and len(w) <= known.LONGEST}:
            # a key that begins with a mark is a stretch with its own marks; other keys have one mark before them
            known.keep(w, self.word(w[1:] if w[0] == SPACE else SPACE + w))
        try:
            return b"".join([first, *map(known.__getitem__, words), last])
        except KeyError:  # long words aren't kept, and the cache may have been emptied on the way
            return b"".join([first, *(known.get(w) or self.word(w[1:] if w[0] == SPACE else SPACE + w) for w in words), last])

    def decode(self, ids: bytes) -> str:
        """Text of ids: marks are spaces, the one before the first word goes, bytes that aren't UTF-8 become U+FFFD."""
        out = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = out.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One model a Python worker; its caches are bounded and outlive a task."""
    return PieceModel(path)


def encode_decode(text: Column, path: str) -> Column:
    """Struct of ids (little-endian unsigned 32-bit integers, begin and end ids included) and the text decoded from them.

    Null counts as empty and gives the two border ids. Texts of any length are encoded whole; equal texts give equal ids.
    """

    def make():
        m = model(path)

        def one(value: str | None) -> tuple[bytes, str]:
            ids = m.encode(value or "")
            return ids, m.decode(ids)

        return one

    return arrow_rows(make, "ids binary, decoded string", _KIND)(text)


def with_pieces(df: DataFrame, path: str, text: str = "text", out: str = "pieces") -> DataFrame:
    """``df`` with a struct column ``out`` of ids and decoded text; every row stays."""
    return df.withColumn(out, encode_decode(F.col(text), path))


def ids_digest(ids: bytes) -> str:
    return hashlib.sha256(ids).hexdigest()
