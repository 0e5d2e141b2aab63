"""Language identification by compression with a dictionary for each language.

Each language's dictionary is raw text of that language. A text is compressed against every dictionary; the language
whose dictionary makes it smallest is the answer, and a tie is a rejection; narrow margins are too if ``min_share`` says so.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.llm.common import arrow_rows, new_name


def _not_letters(last: int) -> re.Pattern:
    """Runs of characters up to code ``last`` that aren't letters; numbers such as halves or Roman ones are none either.

    Letters are given as ranges of codes: a set with classes such as ``\\W`` in it is tried entry by entry for each letter.
    """
    ranges, start = [], None
    for c in range(last + 2):
        is_letter = c <= last and chr(c).isalpha()
        if is_letter and start is None:
            start = c
        elif not is_letter and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[^{''.join(ranges)}]+")


# characters beyond the first plane are few, and their ranges are tried one by one
_ASCII, _PLANE, _ALL = re.compile("[^a-z]+"), _not_letters(0xFFFF), _not_letters(0x10FFFF)
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_KIND = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("margin", pa.int64()), ("rejected", pa.bool_())])


def letters(text: str) -> str:
    """Lower-cased runs of letters, one space between: what is compared."""
    low = text.lower()
    gaps = _ASCII if low.isascii() else _ALL if _BEYOND.search(low) else _PLANE
    return gaps.sub(" ", low).strip()


@dataclass(frozen=True)
class LanguageModel:
    """``dictionaries``: text of each language. Texts are compressed in blocks of ``block`` bytes at ``level``.

    The first block of each text follows ``primer`` bytes of the dictionary, whose own size is taken off: alone, a short
    text would be stored as it is by every language.
    ``min_share``: a text is rejected if the best size is within this share of the second best; 0 rejects ties alone.
    """

    dictionaries: dict[str, bytes]
    level: int = 5
    block: int = 8192
    primer: int = 200
    min_share: float = 0.0

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        out = []
        for lang, raw in sorted(self.dictionaries.items()):
            made = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=self.level)
            out.append((lang, zstandard.ZstdCompressor(level=self.level, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)))
        return out

    def classifier(self):
        """The function for one text: language, score, margin in bytes, rejected."""
        sized = self.compressors()
        primers = [self.dictionaries[lang][: self.primer] + b" " for lang, _ in sized]
        alone = [len(z.compress(p)) for (_, z), p in zip(sized, primers, strict=True)]

        def classify(text: str | None) -> tuple[str, float, int, bool]:
            raw = letters(text or "").encode()
            if not raw or not sized:
                return "und", 0.0, 0, True
            sizes = [-x for x in alone]
            for at in range(0, len(raw), self.block):
                part = raw[at : at + self.block]
                for k, (_, z) in enumerate(sized):
                    sizes[k] += len(z.compress(part if at else primers[k] + part))
            best = min(range(len(sized)), key=lambda k: (sizes[k], sized[k][0]))
            second = min((s for k, s in enumerate(sizes) if k != best), default=2 * abs(sizes[best]) + 1)
            margin = second - sizes[best]
            score = 1 / sum(2.0 ** -min(s - sizes[best], 1000) for s in sizes)
            return sized[best][0], score, margin, margin <= max(0.0, self.min_share * second)

        return classify


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", dictionary_bytes: int = 32768, sample_rows: int = 400, piece_chars: int = 1000, **settings) -> LanguageModel:
    """Fit on a bounded sample: about ``sample_rows`` rows a language, ``piece_chars`` of each, ``dictionary_bytes`` kept.

    Rows are chosen by a hash of their text, so copies count once and the choice is the same on any cluster; where in a
    long text the piece lies also follows from the hash. Rows with null text or language, or without a letter, teach
    nothing. A table without such rows gives a model that answers ``und``.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null and text rlike '\\\\p{L}'")
    # the draw is by hash of the text, so its rate follows from the number of distinct texts; twice the rows wanted leave room for the estimate
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    if not counts:
        return LanguageModel({}, **settings)
    chance = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2 * sample_rows / max(n, 1))))])
    spot = F.xxhash64("text", F.lit(1))
    drawn = rows.where((F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)) < chance[F.col("lang")])
    start = F.pmod(spot, F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1).cast("int") + 1
    drawn = drawn.select("lang", spot.alias("spot"), F.substring("text", start, F.lit(piece_chars)).alias("piece"))
    found: dict[str, list] = {k: [] for k in counts}
    for r in drawn.distinct().collect():
        found[r["lang"]].append((r["spot"], r["piece"]))
    made = {}
    for k, pieces in found.items():
        raw = b" ".join(letters(x).encode() for _, x in sorted(pieces)[:sample_rows])
        made[k] = raw[-dictionary_bytes:]
    return LanguageModel({k: v for k, v in made.items() if v}, **settings)


def identify(text: Column, model: LanguageModel) -> Column:
    """Struct of lang, score, margin and rejected for each text.

    A text that is null or has no letter is ``und`` with score 0 and rejected. Ties go to the language that sorts first,
    and are rejected. A text of any length is compressed whole, block by block.
    """
    return arrow_rows(model.classifier, "lang string, score double, margin bigint, rejected boolean", _KIND)(text)


def with_language(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``; every row stays, repeated rows get equal answers."""
    return df.withColumn(out, identify(F.col(text), model))


def accepted(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``df`` that aren't rejected, with the same columns."""
    name = new_name(df, "gk_language")
    return with_language(df, model, text, name).where(~F.col(name)["rejected"]).drop(name)

