"""Rendered text, markdown and written replies."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gavelkit.functions.numbers import positive
from gavelkit.functions.text import category_of, era_of, last_cents, retail_note, tidy
from gavelkit.sources.extract.base import items_of, listing_rows


def rendered_blocks(raw: DataFrame, brand: str, dealer: str) -> DataFrame:
    """Blocks of brand, title, ``Buy now`` and price in the text of a page.

    The brand line opens every block and is no part of the title, so no brand filter follows.
    """
    pattern = re.escape(brand) + r"\s*\n\s*([^\n]+?)\s*\n\s*Buy now\s*\n\s*([\d,]+(?:\.\d+)?)\s*([A-Z]{3})(?![A-Za-z0-9_])"
    part = lambda g: F.regexp_extract_all("body", F.lit(pattern), F.lit(g))
    rows = items_of(raw, F.arrays_zip(part(1).alias("name"), part(2).alias("price"), part(3).alias("currency")))
    rows = rows.select("*", positive(F.replace("it.price", F.lit(","), F.lit(""))).alias("amount"), tidy(F.col("it.name")).alias("name"))
    rows = rows.where(F.col("amount").isNotNull())
    return listing_rows(
        rows,
        piece_name=F.col("name"),
        category=category_of(F.col("name"), "B"),
        era_or_year=era_of(F.col("name")),
        price_type=F.lit("asking"),
        asking_price=F.col("amount"),
        currency_note=F.col("it.currency"),
        dealer=F.lit(dealer),
    )


def markdown_blocks(raw: DataFrame, brand: str, site: str, dealer: str) -> DataFrame:
    """Product blocks of a markdown page; each starts at a link with the brand as its text.

    The asking price is the last figure of a block that shows cents. Pictures are linked to
    products by url anywhere on the page; the last picture of a url counts.
    """
    product = re.escape(site) + r"/products/[^\s)]+"
    anchor = r"\[" + re.escape(brand) + r"\]\((" + product + r")\)\n([^\n]+)"
    picture = r"\[!\[Image \d+:[^\]]*\]\((https://[^\s)]+)\)\]\((" + product + r")\)"
    blocks = F.filter(F.split("body", f"(?={anchor})"), lambda b: b.rlike("^" + anchor))
    shots = F.arrays_zip(
        F.regexp_extract_all("body", F.lit(picture), F.lit(1)).alias("img"),
        F.regexp_extract_all("body", F.lit(picture), F.lit(2)).alias("url"),
    )
    paired = F.transform(blocks, lambda b: F.struct(b.alias("block"), F.col("shots").alias("shots")))
    rows = items_of(raw.withColumn("shots", shots), paired)
    block = F.col("it.block")
    body = F.regexp_replace(block, "^" + anchor, "")
    rows = rows.select(
        "*", F.regexp_extract(block, anchor, 1).alias("url"), tidy(F.regexp_extract(block, anchor, 2)).alias("title"),
        positive(last_cents(body)).alias("amount"), retail_note(body).alias("note"),
    ).where(F.col("amount").isNotNull())
    shot = F.try_element_at(F.filter("it.shots", lambda s: s["url"] == F.col("url")), F.lit(-1))["img"]
    return listing_rows(
        rows,
        piece_name=F.col("title"),
        category=category_of(F.col("title"), "C"),
        price_type=F.lit("asking"),
        asking_price=F.col("amount"),
        currency_note=F.lit("USD"),
        dealer=F.lit(dealer),
        listing_url=F.col("url"),
        image_url=shot,
        notes=F.col("note"),
    )


# --- written replies -------------------------------------------------------------------
_SIGNS = re.compile(r'\\.|["\[\]]', re.S)


def _balanced_arrays(text: str):
    """The bracketed stretches of a text, outermost first, in order of their opening."""
    for start in re.finditer(r"\[", text):
        depth, quoted = 0, False
        for m in _SIGNS.finditer(text, start.start()):
            sign = m.group()
            if sign == '"':
                quoted = not quoted
            elif quoted or sign[0] == "\\":
                continue
            else:
                depth += 1 if sign == "[" else -1
                if depth == 0:
                    yield text[start.start():m.end()]
                    break


def _first_array(text: str | None) -> str | None:
    import json

    for stretch in _balanced_arrays(text) if text else ():
        try:
            json.loads(stretch)
            return stretch
        except ValueError:
            continue
    return None


@F.pandas_udf(StringType())
def _scan(lists: pd.Series) -> pd.Series:
    """The first array that a bracket scan finds in a list of texts, text by text."""
    return lists.map(lambda texts: None if texts is None else next(filter(None, map(_first_array, texts)), None))


def _as_array(text: Column) -> Column:
    """The text if it is a JSON array, else null."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("ARRAY"), F.to_json(v))


def json_array_of(text: Column) -> Column:
    """The JSON array in a reply: the whole text, or from the first to the last bracket."""
    plain = tidy(F.regexp_replace(F.regexp_replace(text, r"(?i)```(?:json)?\s*", ""), "```", ""))
    first = F.instr(plain, "[")
    end = F.length(plain) - F.instr(F.reverse(plain), "]") + 1
    inner = F.when((first > 0) & (end > first) & F.contains(plain, F.lit("]")), F.substr(plain, first, end - first + 1))
    return F.coalesce(_as_array(plain), _as_array(inner))


_REPLY = "content ARRAY<STRUCT<type STRING, text STRING>>"


def reply_items(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Objects of the array that a reply holds, with the wanted fields as text.

    The last text block is tried first, then the earlier ones, then all of them together. Each text is tried in full
    before the next one: as it is, from its first to its last bracket, then by a scan for balanced brackets. Only texts
    with a bracket that stand before the first one which the built-in slices can read reach Python.
    """
    blocks = F.transform(
        F.filter(F.from_json("body", _REPLY)["content"], lambda b: (b["type"] == "text") & (b["text"] != "")),
        lambda b: b["text"],
    )
    tried = F.concat(F.reverse(blocks), F.array(F.array_join(blocks, "\n")))
    keep = [c for c in raw.columns if c != "body"]
    rows = raw.withColumn("_tried", tried).where(F.size(blocks) > 0)
    plain = lambda t: tidy(F.regexp_replace(F.regexp_replace(t, r"(?i)```(?:json)?\s*", ""), "```", ""))
    # exploding a one-element array keeps the slices from being tried again for each use
    rows = rows.withColumn("_quick", F.explode(F.array(F.transform("_tried", json_array_of))))
    at = F.array_position(F.transform("_quick", lambda a: a.isNotNull()), True)
    early = F.slice("_tried", F.lit(1), F.when(at > 0, at - 1).otherwise(F.size("_tried")).cast("int"))
    early = F.filter(F.transform(early, plain), lambda t: F.contains(t, F.lit("[")))
    rows = rows.withColumn("_array", F.coalesce(_scan(F.when(F.size(early) > 0, early)), F.get("_quick", (at - 1).cast("int"))))
    items = F.from_json("_array", "array<variant>")
    out = rows.select(*keep, F.posexplode(items).alias("item", "_v"))
    out = out.where(F.schema_of_variant("_v").startswith("OBJECT"))
    return out.select(
        *keep, "item", *[F.coalesce(F.try_variant_get("_v", f"$.{f}", "string"), F.lit("")).alias(f) for f in fields]
    )
