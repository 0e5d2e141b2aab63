"""Product feeds of dealer shops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import minor_units, positive
from gavelkit.functions.text import blank_to_null, brand_match, category_of, decode_entities, era_of, strip_tags
from gavelkit.sources.extract.base import items_of, listing_rows

# fixed values: the fields of each feed
_SHOP_FEED = (
    "products ARRAY<STRUCT<id STRING, handle STRING, title STRING, vendor STRING, product_type STRING, tags STRING, "
    "body_html STRING, image STRUCT<src STRING>, images ARRAY<STRUCT<src STRING>>, "
    "variants ARRAY<STRUCT<price STRING, sku STRING>>>>"
)
_STORE_FEED = (
    "ARRAY<STRUCT<id STRING, name STRING, permalink STRING, sku STRING, categories ARRAY<STRUCT<name STRING>>, "
    "tags ARRAY<STRUCT<name STRING>>, short_description STRING, description STRING, "
    "prices STRUCT<price STRING, currency_code STRING, currency_minor_unit STRING>, "
    "images ARRAY<STRUCT<src STRING, thumbnail STRING>>>>"
)


def _joined(*parts):
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts])


def shop_feed(raw: DataFrame, shop: str, dealer: str, currency: str, brand: str) -> DataFrame:
    """A feed of ``{"products": [...]}``; the price is the cheapest variant."""
    p = lambda name: F.col(f"it.{name}")
    rows = items_of(raw, F.from_json("body", _SHOP_FEED)["products"])
    rows = rows.where(brand_match(brand, p("vendor"), p("title"), p("product_type"), p("tags")))
    words = _joined(p("title"), p("product_type"), p("tags"), p("body_html"))
    prices = F.filter(F.transform(p("variants"), lambda v: positive(v["price"])), lambda x: x.isNotNull())
    return listing_rows(
        rows,
        piece_name=p("title"),
        category=category_of(words, "A"),
        era_or_year=era_of(words),
        price_type=F.lit("asking"),
        asking_price=F.array_min(prices),
        currency_note=F.lit(currency),
        dealer=F.lit(dealer),
        listing_url=F.concat(F.lit(f"https://{shop}/products/"), blank_to_null(p("handle"))),
        image_url=F.coalesce(blank_to_null(p("image.src")), F.get(p("images"), F.lit(0))["src"]),
        sku=F.coalesce(blank_to_null(F.get(p("variants"), F.lit(0))["sku"]), p("id")),
        notes=F.left(strip_tags(p("body_html"), "A"), F.lit(fixed.FEED_NOTE_CHARS)),
    )


def store_feed(raw: DataFrame, dealer: str, brand: str) -> DataFrame:
    """A feed that is a bare array, with prices in minor units and entities in names."""
    p = lambda name: F.col(f"it.{name}")
    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), " ")
    rows = items_of(raw, F.from_json("body", _STORE_FEED))
    rows = rows.where(
        brand_match(
            brand, p("name"), names(p("categories")), names(p("tags")), p("short_description"), p("description")
        )
    )
    words = _joined(p("name"), names(p("categories")), p("short_description"), p("description"))
    body = F.coalesce(blank_to_null(p("short_description")), p("description"))
    picture = F.get(p("images"), F.lit(0))
    return listing_rows(
        rows,
        piece_name=decode_entities(p("name"), "A"),
        category=category_of(words, "A"),
        era_or_year=era_of(words),
        price_type=F.lit("asking"),
        asking_price=minor_units(p("prices.price"), p("prices.currency_minor_unit")),
        currency_note=p("prices.currency_code"),
        dealer=F.lit(dealer),
        listing_url=p("permalink"),
        image_url=F.coalesce(blank_to_null(picture["src"]), picture["thumbnail"]),
        sku=F.coalesce(blank_to_null(p("sku")), p("id")),
        notes=F.left(strip_tags(body, "A"), F.lit(fixed.FEED_NOTE_CHARS)),
    )
