"""Result pages of auction houses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions.dates import day_of_text, month_of_path
from gavelkit.functions.numbers import locale_number, positive
from gavelkit.functions.text import blank_to_null, category_of, decode_entities, join_parts, tidy
from gavelkit.sources.extract.base import auction_rows, items_of, price_type

# fixed values: the patterns of each page
_PAGE_ATTRIBUTE = r'data-page="([^"]*)"'
_PAGE_PATH = "$.props.results.primary_results.paginator.items.data"
_PAGE_ITEMS = (
    "ARRAY<STRUCT<name STRING, result_amount STRING, result_premium_amount STRING, estimate_low STRING, "
    "estimate_high STRING, alias STRING, lot_number STRING, year_designed STRING, year_produced STRING, "
    "material STRING, passed_lot STRING, caption_brief STRING, auction STRUCT<title STRING>, session STRUCT<title STRING>>>"
)
_CARD = r'<li class="[^"]*search-result-item[^"]*"[^>]*>([\s\S]*?)</li>'
_CARD_HREF = r"<a href='([^']+)'"
_CARD_MAKER = r'<strong class="maker">([^<]*)</strong>'
_CARD_TITLE = r"<em>([^<]*)</em>"
_CARD_SALE = r"<span>([^<]*)</span>"
_CARD_DATE = r"<p>\s*([^<\n]+?)\s*</p>"
_CARD_LOT = r"/detail/[^/]+/(\d+)"
_CHUNK = '<div class="auction-lot">'
_CHUNK_HREF = r'<a href="([^"]+)"'
_CHUNK_TITLE = r"<span class='lot-title[^']*'>Lot\s+(\S+)<br\s*/>\s*([^<]*)</span>"
_CHUNK_ORIGIN = r'<p class="stockfields-list">([^<]*)</p>'
_CHUNK_SOLD = r"Sold for\s*\$([\d,]+(?:\.\d+)?)"
_CHUNK_ESTIMATE = r"Estimated at\s*\$([\d,]+(?:\.\d+)?)\s*-\s*\$([\d,]+(?:\.\d+)?)"


def attribute_state(raw: DataFrame, house: str, site: str) -> DataFrame:
    """A JSON state in an attribute of the page."""
    state = decode_entities(F.regexp_extract("body", _PAGE_ATTRIBUTE, 1), "A")
    rows = items_of(raw, F.from_json(F.get_json_object(state, _PAGE_PATH), _PAGE_ITEMS))
    i = lambda name: F.col(f"it.{name}")
    hammer, premium = positive(i("result_amount")), positive(i("result_premium_amount"))
    low, high = positive(i("estimate_low")), positive(i("estimate_high"))
    paid = F.concat(F.lit("Premium price $"), locale_number(premium), F.lit(" (incl. buyer's premium)"))
    return auction_rows(
        rows,
        piece_name=i("name"),
        category=category_of(i("name"), "A"),
        era_or_year=F.coalesce(blank_to_null(i("year_designed")), i("year_produced")),
        materials_gemstones=i("material"),
        price_type=price_type(hammer, low, high),
        sold_price=hammer,
        estimate_low=low,
        estimate_high=high,
        sale_date=month_of_path(i("alias")),
        auction_house=F.lit(house),
        sale_name=F.coalesce(blank_to_null(i("auction.title")), i("session.title")),
        lot_number=i("lot_number"),
        listing_url=F.concat(F.lit(site + "/"), F.regexp_replace(blank_to_null(i("alias")), "^/", "")),
        notes=join_parts(
            F.when(hammer.isNotNull(), paid),
            tidy(i("caption_brief")),
            F.when(i("passed_lot") == "1", F.lit("Passed / unsold")),
        ),
    )


def _decoded(block, pattern: str, group: int = 1):
    return decode_entities(F.regexp_extract(block, pattern, group), "C")


def list_cards(raw: DataFrame, house: str, brand: str) -> DataFrame:
    """Cards that are list items; a card counts if its maker or its title names the brand."""
    rows = items_of(raw, F.regexp_extract_all("body", F.lit(_CARD), F.lit(1)))
    block = F.col("it")
    rows = rows.where(F.regexp_extract(block, _CARD_HREF, 1) != "").select(
        "*",
        F.get(F.split(_decoded(block, _CARD_HREF), r"\?"), F.lit(0)).alias("url"),
        _decoded(block, _CARD_MAKER).alias("maker"),
        _decoded(block, _CARD_TITLE).alias("title"),
    )
    rows = rows.where(F.col("maker").rlike("(?i)" + brand) | F.col("title").rlike("(?i)" + brand))
    return auction_rows(
        rows,
        piece_name=F.col("title"),
        category=category_of(F.col("title"), "A"),
        sale_date=day_of_text(_decoded(block, _CARD_DATE)),
        auction_house=F.lit(house),
        sale_name=_decoded(block, _CARD_SALE),
        lot_number=F.regexp_extract("url", _CARD_LOT, 1),
        listing_url=F.col("url"),
    )


def split_cards(raw: DataFrame, house: str, site: str) -> DataFrame:
    """Cards that begin at a literal opening tag; what precedes the first is no card."""
    chunks = F.split("body", _CHUNK)
    rows = items_of(raw, F.slice(chunks, F.lit(2), F.greatest(F.size(chunks) - 1, F.lit(0))))
    c = F.col("it")
    amount = lambda p, g: F.replace(F.regexp_extract(c, p, g), F.lit(","), F.lit("")).try_cast("double")
    rows = rows.where((F.regexp_extract(c, _CHUNK_HREF, 1) != "") & c.rlike(_CHUNK_TITLE)).select(
        "*",
        _decoded(c, _CHUNK_HREF).alias("href"),
        _decoded(c, _CHUNK_TITLE, 2).alias("title"),
        amount(_CHUNK_SOLD, 1).alias("sold"),
        amount(_CHUNK_ESTIMATE, 1).alias("low"),
        amount(_CHUNK_ESTIMATE, 2).alias("high"),
    )
    priced = F.col("sold").isNotNull() | F.col("low").isNotNull()
    return auction_rows(
        rows,
        piece_name=F.col("title"),
        category=category_of(F.col("title"), "B"),
        price_type=F.when(F.col("sold").isNotNull(), "hammer").when(F.col("low").isNotNull(), "estimate"),
        sold_price=F.col("sold"),
        estimate_low=F.col("low"),
        estimate_high=F.col("high"),
        currency_note=F.when(priced, "USD"),
        auction_house=F.lit(house),
        lot_number=F.regexp_extract(c, _CHUNK_TITLE, 1),
        listing_url=F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(site), "href")),
        notes=_decoded(c, _CHUNK_ORIGIN),
    )
