"""Search responses of auction houses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.dates import day_of_unix_millis, day_of_unix_seconds
from gavelkit.functions.numbers import locale_number, positive
from gavelkit.functions.text import (
    blank_to_null, brand_match, capital, category_of, decode_entities, join_parts, money_pair, money_range, strip_tags,
    tidy,
)
from gavelkit.sources.extract.base import auction_rows, items_of, price_type, trimmed

# fixed values: the fields of each response
_HITS = (
    "results ARRAY<STRUCT<hits ARRAY<STRUCT<guaranteeLine STRING, title STRING, fullText STRING, soldStatus STRING, "
    "hammerPrice STRING, salePrice STRING, lowEstimate STRING, highEstimate STRING, estimateCurrency STRING, "
    "endDate STRING, saleNumber STRING, auctionType STRING, auctionLocations ARRAY<STRING>>>>>"
)
_LOTS = (
    "lots ARRAY<STRUCT<title_primary_txt STRING, price_realised_txt STRING, estimate_txt STRING, start_date STRING, "
    "url STRING, lot_id_txt STRING, description_txt STRING, consigner_information STRING, lot_withdrawn BOOLEAN, "
    "sale STRUCT<number STRING, location STRING>>>"
)
_DOCUMENTS = (
    "results ARRAY<STRUCT<hits ARRAY<STRUCT<document STRUCT<id STRING, title STRING, brand STRING, "
    "price STRUCT<hammerPrice STRING, estimateLow STRING, estimateHigh STRING>, currency STRUCT<iso_code STRING>, "
    "hammerTime STRUCT<timestamp STRING>, lotNo STRUCT<full STRING>, department STRUCT<name STRING>, "
    "auctionStatus STRING, styledDescription STRING>>>>>"
)
_MARKED_HITS = (
    "results ARRAY<STRUCT<hits ARRAY<STRUCT<_highlightResult STRUCT<lotDescription STRUCT<value STRING>>, "
    "priceResult STRING, estimateLow STRING, estimateHigh STRING, currentBid STRING, currencyCode STRING, "
    "dateTimeUTCUnix STRING, houseName STRING, lotNumber STRING, lotTitle STRING>>>>"
)
HIGHLIGHT_TAG = r"</?ais-highlight-0000000000>"


def _first_result(schema: str):
    return F.get(F.from_json("body", schema)["results"], F.lit(0))["hits"]


def search_hits(raw: DataFrame, house: str) -> DataFrame:
    """Hits with a sold status and the end date in milliseconds."""
    h = lambda name: F.col(f"it.{name}")
    rows = items_of(raw, _first_result(_HITS))
    title = F.coalesce(blank_to_null(h("guaranteeLine")), h("title"))
    paid = F.coalesce(positive(h("hammerPrice")), positive(h("salePrice")))
    sold = F.when(h("soldStatus") == "SOLD", paid)
    low, high = positive(h("lowEstimate")), positive(h("highEstimate"))
    places = F.array_join(h("auctionLocations"), ", ")
    return auction_rows(
        rows,
        piece_name=title,
        category=category_of(title, "B"),
        price_type=price_type(sold, low, high),
        sold_price=sold,
        estimate_low=low,
        estimate_high=high,
        currency_note=h("estimateCurrency"),
        sale_date=day_of_unix_millis(h("endDate")),
        auction_house=F.lit(house),
        sale_name=h("saleNumber"),
        notes=join_parts(
            F.when(~h("fullText").eqNullSafe(title), tidy(h("fullText"))),
            F.concat(F.lit("Auction type: "), blank_to_null(h("auctionType"))),
            F.concat(F.lit("Location: "), F.when(F.size(h("auctionLocations")) > 0, places)),
        ),
    )


def money_text_lots(raw: DataFrame, house: str) -> DataFrame:
    """Lots whose prices are text such as ``USD 7,698,500``."""
    lot = lambda name: F.col(f"it.{name}")
    rows = items_of(raw, F.from_json("body", _LOTS)["lots"])
    rows = rows.select("*", money_pair(lot("price_realised_txt")).alias("paid"), money_range(lot("estimate_txt")).alias("est"))
    about = strip_tags(lot("description_txt"), "B")
    consigner = trimmed(lot("consigner_information"))
    place = F.concat(F.lit(" ("), blank_to_null(lot("sale.location")), F.lit(")"))
    notes = join_parts(
        about,
        F.when((consigner != "") & (consigner != about), strip_tags(lot("consigner_information"), "B")),
        F.when(lot("lot_withdrawn"), F.lit("Lot withdrawn from sale")),
    )
    return auction_rows(
        rows,
        piece_name=lot("title_primary_txt"),
        category=category_of(lot("title_primary_txt"), "A"),
        price_type=price_type(F.col("paid.amount"), F.col("est.low"), F.col("est.high")),
        sold_price=F.col("paid.amount"),
        estimate_low=F.col("est.low"),
        estimate_high=F.col("est.high"),
        currency_note=F.coalesce("paid.currency", "est.currency"),
        sale_date=F.left(lot("start_date"), F.lit(10)),
        auction_house=F.lit(house),
        sale_name=F.concat(F.lit("Sale "), blank_to_null(lot("sale.number")), F.coalesce(place, F.lit(""))),
        lot_number=lot("lot_id_txt"),
        listing_url=lot("url"),
        notes=F.left(notes, F.lit(fixed.MONEY_NOTE_CHARS)),
    )


def document_hits(raw: DataFrame, default_house: str) -> DataFrame:
    """Documents that several responses of one capture may repeat; the first one counts, broken bodies are skipped.

    A capture is a source on a run date: the same document on another day, or from another source, is a row of its own.
    """
    found = items_of(raw, _first_result(_DOCUMENTS)).withColumn("it", F.col("it.document"))
    found = found.where(blank_to_null(F.col("it.id")).isNotNull())
    keep = [c for c in found.columns if c != "it"]
    # an aggregate per document, so repeats shrink before the shuffle
    order = F.struct(*[c for c in ("page", "pos", "item") if c in keep])
    capture = [c for c in ("source", "run_date") if c in keep]
    once = found.groupBy(*[F.col(c).alias(f"_{c}") for c in capture], F.col("it.id").alias("_doc")).agg(F.min_by(F.struct(*keep, "it"), order).alias("r"))
    rows = once.select("r.*")
    d = lambda name: F.col(f"it.{name}")
    sold, low, high = (positive(d(f"price.{n}")) for n in ("hammerPrice", "estimateLow", "estimateHigh"))
    about = strip_tags(d("styledDescription"), "C")
    return auction_rows(
        rows,
        piece_name=d("title"),
        category=category_of(d("title"), "B"),
        price_type=price_type(sold, low, high),
        sold_price=sold,
        estimate_low=low,
        estimate_high=high,
        currency_note=d("currency.iso_code"),
        sale_date=day_of_unix_seconds(d("hammerTime.timestamp")),
        auction_house=F.coalesce(capital(blank_to_null(d("brand"))), F.lit(default_house)),
        lot_number=d("lotNo.full"),
        notes=join_parts(
            F.when(about != F.coalesce(d("title"), F.lit("")), about),
            F.concat(F.lit("Department: "), blank_to_null(d("department.name"))),
            F.concat(F.lit("Auction status: "), blank_to_null(d("auctionStatus"))),
        ),
    )


def marked_hits(raw: DataFrame, brand: str) -> DataFrame:
    """Hits of a fuzzy search with highlight tags; only those that name the brand are kept."""
    h = lambda name: F.col(f"it.{name}")
    rows = items_of(raw, _first_result(_MARKED_HITS))
    marked = h("_highlightResult.lotDescription.value")
    about = tidy(decode_entities(F.regexp_replace(marked, HIGHLIGHT_TAG, ""), "B"))
    rows = rows.select("*", decode_entities(h("lotTitle"), "B").alias("title"), about.alias("about"))
    rows = rows.where(brand_match(brand, F.col("title"), F.col("about")))
    sold, low, high = positive(h("priceResult")), positive(h("estimateLow")), positive(h("estimateHigh"))
    bid = positive(h("currentBid"))
    return auction_rows(
        rows,
        piece_name=F.col("title"),
        category=category_of(F.col("title"), "B"),
        price_type=price_type(sold, low, high),
        sold_price=sold,
        estimate_low=low,
        estimate_high=high,
        currency_note=h("currencyCode"),
        sale_date=day_of_unix_seconds(h("dateTimeUTCUnix")),
        auction_house=h("houseName"),
        lot_number=h("lotNumber"),
        notes=join_parts(
            F.when(F.col("about") != F.col("title"), F.col("about")),
            F.when(sold.isNull(), F.concat(F.lit("Current bid at capture: $"), locale_number(bid))),
        ),
    )
