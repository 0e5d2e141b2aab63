"""State objects that pages embed in scripts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gavelkit.functions.dates import day_of_unix_seconds
from gavelkit.functions.numbers import locale_number, positive
from gavelkit.functions.text import blank_to_null, brand_match, category_of, era_of, join_parts
from gavelkit.operators.profiling import lot_objects
from gavelkit.sources.extract.base import PROVENANCE, auction_rows, computed_once, listing_rows, price_type

_SIGNS = re.compile(r"\\.|[\"'{}]", re.S)


def balanced_object(text: str | None, marker: str, slack: int | None = 5) -> str | None:
    """The ``{...}`` after a marker; braces in strings do not count.

    With ``slack`` the object must open at most that many characters after the marker.
    """
    at = text.find(marker) if text else -1
    if at < 0:
        return None
    begin = text.find("{", at + len(marker))
    if begin < 0 or (slack is not None and begin - at - len(marker) > slack):
        return None
    depth, quote = 0, ""
    for m in _SIGNS.finditer(text, begin):
        sign = m.group()
        if quote:
            quote = "" if sign == quote else quote
        elif sign in "\"'":
            quote = sign
        elif sign == "{":
            depth += 1
        elif sign == "}":
            depth -= 1
            if depth == 0:
                return text[begin:m.end()]
    return None


def _scanner(marker: str, slack: int | None):
    @F.pandas_udf(StringType())
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: balanced_object(t, marker, slack), na_action="ignore")

    return scan


def as_json(literal: Column) -> Column:
    """A script literal as JSON text: an undefined value becomes null."""
    return F.regexp_replace(literal, r":(\s*)undefined(?![A-Za-z0-9_])", ":$1null")


def with_inline_state(rows: DataFrame, html: str, name: str) -> DataFrame:
    """Add ``state``: the object assigned to ``window.name`` as text, or null.

    A script that holds nothing else is cut with a pattern inside the JVM. Only other pages
    that have the marker are scanned in Python.
    """
    marker = f"window.{name}="
    whole = F.regexp_extract(html, re.escape(marker) + r"\s{0,5}(\{[\s\S]*?\})\s*;?\s*</script>", 1)
    rows = computed_once(rows, "_whole", F.nullif(whole, F.lit("")))
    rows = computed_once(rows, "_quick", F.when(F.try_parse_json(as_json(F.col("_whole"))).isNotNull(), F.col("_whole")))
    rest = F.when(F.col("_quick").isNull() & F.contains(F.col(html), F.lit(marker)), F.col(html))
    scanned = rows.withColumn("_scanned", _scanner(marker, 5)(rest))
    return scanned.withColumn("state", F.coalesce("_quick", "_scanned")).drop("_whole", "_quick", "_scanned")


# fixed values: the fields of a lot in a page state
_LOT = (
    "STRUCT<itemId STRING, lotNumber STRING, title STRING, slug STRING, slugWithLocation STRING, catalogTitle STRING, "
    "sellerName STRING, currency STRING, salePrice STRING, buyNowPrice STRING, leadingBid STRING, lowBidEstimate STRING, "
    "highBidEstimate STRING, isSold BOOLEAN, isPassed BOOLEAN, isAvailable BOOLEAN, saleStartTs STRING>"
)


def page_state(raw: DataFrame, name: str, site: str, brand: str, fallback: str = "itemSummary") -> DataFrame:
    """Lots anywhere in a page's state; if the state as a whole is broken, those of one named part."""
    keep = [c for c in PROVENANCE if c in raw.columns and c != "item"]
    states = with_inline_state(raw.select(*keep, "body"), "body", name).drop("body").where(F.col("state").isNotNull())
    states = computed_once(states, "json", as_json(F.col("state")))
    states = computed_once(states, "ok", F.try_parse_json("json").isNotNull())
    whole = lot_objects(states.where("ok").select(*keep, "json"), "json").select(
        *keep, F.lit(0).alias("item"), F.from_json("lot", _LOT).alias("it")
    )
    part = as_json(_scanner(f'"{fallback}":', None)("state"))
    by_id = F.from_json(F.get_json_object(part, "$.byId"), f"map<string,{_LOT}>")
    pieces = states.where(~F.col("ok")).select(*keep, F.posexplode(F.map_values(by_id)).alias("item", "it"))
    return state_lots(whole.unionByName(pieces), site, brand)


def state_lots(rows: DataFrame, site: str, brand: str) -> DataFrame:
    i = lambda name: F.col(f"it.{name}")
    rows = rows.where(brand_match(brand, i("title")))
    sold = F.when(i("isSold"), positive(i("salePrice")))
    low, high = positive(i("lowBidEstimate")), positive(i("highBidEstimate"))
    open_ = sold.isNull()
    dollars = lambda label, c: F.concat(F.lit(label + " $"), locale_number(positive(c)))
    slug = F.coalesce(blank_to_null(i("slugWithLocation")), blank_to_null(i("slug")))
    return auction_rows(
        rows,
        piece_name=i("title"),
        category=category_of(i("title"), "A"),
        price_type=price_type(sold, low, high),
        sold_price=sold,
        estimate_low=low,
        estimate_high=high,
        currency_note=i("currency"),
        sale_date=day_of_unix_seconds(i("saleStartTs")),
        auction_house=i("sellerName"),
        sale_name=i("catalogTitle"),
        lot_number=i("lotNumber"),
        listing_url=F.concat(F.lit(site + "/item/"), blank_to_null(i("itemId")), F.lit("_"), slug),
        notes=join_parts(
            F.when(i("isPassed") & open_, F.lit("Passed / did not sell")),
            F.when(i("isAvailable") & open_, F.lit("Currently listed / bidding open")),
            dollars("Buy-now price", i("buyNowPrice")),
            F.when(open_, dollars("Leading bid at capture:", i("leadingBid"))),
        ),
    )


def object_store(raw: DataFrame, site: str, cdn: str, fallback_dealer: str, brand: str) -> DataFrame:
    """Listings of a flat record store whose records point to each other.

    The store of one page is a map from key to record, so a pointer is followed by a map
    look-up inside the row; nothing is shuffled.
    """
    keep = [c for c in PROVENANCE if c in raw.columns and c != "item"]
    store = F.from_json("body", "map<string,string>")
    rows = raw.select(*keep, store.alias("store")).where(F.col("store").isNotNull())
    tracked = F.transform(
        F.map_values("store"), lambda r: F.get_json_object(r, "$.ecommerceTrackingParams")
    )
    rows = rows.select("*", F.posexplode(F.filter(tracked, lambda t: t.isNotNull())).alias("item", "t"))
    field = lambda c, path: blank_to_null(F.get_json_object(c, path))
    at = lambda key: F.try_element_at(F.col("store"), key)
    rows = rows.select(
        "*", field("t", "$.id").alias("id_"), field("t", "$.name").alias("name"), positive(field("t", "$.price")).alias("amount")
    ).where(F.col("id_").isNotNull() & F.col("amount").isNotNull() & brand_match(brand, F.col("name")))
    key = F.base64(F.encode(F.concat(F.lit("Item:"), F.col("id_")), "UTF-8"))
    rows = rows.withColumn("record", at(key))
    rows = rows.withColumn("seller", at(field("record", "$.seller.__ref")))
    profile = F.coalesce(at(field("seller", "$.sellerProfile.__ref")), field("seller", "$.sellerProfile"))
    rows = rows.withColumn("profile", profile)
    company = F.coalesce(at(field("profile", "$.company.__ref")), field("profile", "$.company"))
    # the photo field carries its arguments in its name, such as photos(limit:1)
    photo_field = F.get(
        F.filter(F.map_entries(F.from_json("record", "map<string,string>")), lambda e: e["key"].startswith("photos(")), F.lit(0)
    )["value"]
    photo = at(F.get_json_object(photo_field, "$.__refs[0]"))
    path = F.coalesce(field(photo, "$.masterOrZoomPath"), field(photo, "$.smallPath"))
    return listing_rows(
        rows,
        piece_name=F.col("name"),
        category=category_of(F.col("name"), "A"),
        era_or_year=era_of(F.col("name")),
        price_type=F.lit("asking"),
        asking_price=F.col("amount"),
        currency_note=F.lit("USD"),
        dealer=F.coalesce(company, F.lit(fallback_dealer)),
        listing_url=F.concat(F.lit(site), field("record", "$.localizedPdpUrl")),
        image_url=F.when(path.startswith("http"), path).otherwise(F.concat(F.lit(cdn), path)),
        sku=F.col("id_"),
    )
