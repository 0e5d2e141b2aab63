"""The browse view: both stores in one shape, filtered, sorted and paged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import is_foreign, positive
from gavelkit.functions.text import auction_status, dealer_status, text_or


def _t(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _pushed(rows: DataFrame, column: str, default: str, wanted: str | None) -> DataFrame:
    """A filter on a shown value as one on the stored column, which a Parquet scan can use.

    What isn't the default is shown as it is stored; missing values are shown as the default and stay with it.
    """
    if not wanted:
        return rows
    same = F.col(column) == wanted
    return rows.where(same if wanted != default else same | F.col(column).isNull() | (F.col(column) == ""))


def browse_union(auctions: DataFrame, listings: DataFrame, f: BrowseFilter | None = None) -> DataFrame:
    """Sales and listings in one shape of 22 columns and the id.

    With ``f`` its source and category are also tested on the stored columns, so that they reach both scans.
    """
    if f is not None:
        auctions = _pushed(_pushed(auctions, "auction_house", "Unknown house", f.source), "category", "other", f.category)
        listings = _pushed(_pushed(listings, "dealer", "Unknown dealer", f.source), "category", "other", f.category)
    cur = F.col("currency_note")
    note = F.when(is_foreign(cur), cur).otherwise("")
    a = auctions.select(
        "id",
        F.lit("auction").alias("type"),
        _t("sale_date").alias("date"),
        text_or(F.col("piece_name"), "(untitled)").alias("piece_name"),
        text_or(F.col("category"), "other").alias("category"),
        _t("era_or_year").alias("era_or_year"),
        _t("materials_gemstones").alias("materials_gemstones"),
        text_or(F.col("auction_house"), "Unknown house").alias("source"),
        _t("sale_name").alias("sale_name"),
        _t("lot_number").alias("lot_number"),
        _t("price_type").alias("price_type"),
        positive(F.col("sold_price_usd")).alias("price"),
        F.when(is_foreign(cur), positive(F.col("sold_price"))).alias("native_amount"),
        note.alias("native_currency"),
        positive(F.col("estimate_low")).alias("estimate_low"),
        positive(F.col("estimate_high")).alias("estimate_high"),
        text_or(cur, "USD").alias("currency"),
        auction_status(F.col("sold_price"), F.col("estimate_low"), F.col("estimate_high")).alias("status"),
        _t("listing_url").alias("listing_url"),
        F.lit("").alias("image_url"),
        _t("notes").alias("notes"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
    )
    d = listings.select(
        "id",
        F.lit("dealer").alias("type"),
        _t("first_seen").alias("date"),
        text_or(F.col("piece_name"), "(untitled)").alias("piece_name"),
        text_or(F.col("category"), "other").alias("category"),
        _t("era_or_year").alias("era_or_year"),
        _t("materials_gemstones").alias("materials_gemstones"),
        text_or(F.col("dealer"), "Unknown dealer").alias("source"),
        F.lit("").alias("sale_name"),
        _t("sku").alias("lot_number"),
        text_or(F.col("price_type"), "asking").alias("price_type"),
        positive(F.col("asking_price_usd")).alias("price"),
        F.when(is_foreign(cur), positive(F.col("asking_price"))).alias("native_amount"),
        note.alias("native_currency"),
        F.lit(None).cast("double").alias("estimate_low"),
        F.lit(None).cast("double").alias("estimate_high"),
        text_or(cur, "USD").alias("currency"),
        dealer_status(F.col("status")).alias("status"),
        _t("listing_url").alias("listing_url"),
        _t("image_url").alias("image_url"),
        _t("notes").alias("notes"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
    )
    return a.unionByName(d)


def with_flags(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Attach the flags of a listing by its raw url.

    A url names one record in each store, so a row gets at most one flag of each kind. Rows
    without a url are left out of the join and get no flag.
    """
    per_url = flags.where(F.col("url") != "").groupBy("url").agg(
        F.sort_array(F.collect_list(F.struct("flag", "reason"))).alias("_flags")
    )
    none = F.array().cast("array<struct<flag:string,reason:string>>")
    linked = rows.join(per_url, F.when(F.col("listing_url") != "", F.col("listing_url")) == F.col("url"), "left")
    return linked.withColumn("flags", F.coalesce("_flags", none)).drop("_flags", "url")


@dataclass(frozen=True)
class BrowseFilter:
    type: str | None = None
    status: str | None = None
    source: str | None = None
    category: str | None = None
    tag: str | None = None
    flagged_only: bool = False
    text: str | None = None


def browse_filter(rows: DataFrame, f: BrowseFilter) -> DataFrame:
    for name in ("type", "status", "source", "category"):
        wanted = getattr(f, name)
        if wanted:
            rows = rows.where(F.col(name) == wanted)
    if f.tag:
        rows = rows.where(F.array_contains("tags", f.tag))
    if f.flagged_only:
        rows = rows.where(F.size("flags") > 0)
    needle = (f.text or "").strip().lower()
    if needle:
        fields = ("piece_name", "source", "materials_gemstones", "notes", "lot_number", "sale_name")
        hay = F.lower(F.concat_ws(" ", *[F.col(c) for c in fields]))
        rows = rows.where(F.contains(hay, F.lit(needle)))
    return rows


def known_filter(rows: DataFrame, column: str, value: str) -> DataFrame:
    """Filter by a linked value; a value that no row has filters nothing."""
    held = F.array_contains(column, value) if column == "tags" else F.col(column) == value
    exists = rows.agg(F.max(F.coalesce(held, F.lit(False))).alias("e")).select("e").scalar()
    return rows.where(held | ~F.coalesce(exists, F.lit(False)))


def _sort_column(key: str) -> Column:
    if key == "estimate":
        return F.coalesce(F.col("estimate_low"), F.col("estimate_high"), F.lit(-1.0))
    if key == "price":
        return F.coalesce(F.col("price"), F.lit(-1.0))
    return F.col(key)


def _sorting(key: str, ascending: bool) -> list[Column]:
    c = _sort_column(key)
    return [c.asc() if ascending else c.desc(), F.col("type").asc(), F.col("id").asc()]


def browse_sort(rows: DataFrame, key: str = "date", ascending: bool = False) -> DataFrame:
    """Any column; missing prices sort as -1, ties by type and id."""
    return rows.orderBy(*_sorting(key, ascending))


def browse_page(rows: DataFrame, page: int, key: str = "date", ascending: bool = False,
                size: int = fixed.PAGE_SIZE) -> DataFrame:
    """One page; a number past the end gives the last page.

    The count is one cheap aggregate. The page comes from a top-k plan over the sort keys
    and the id only; the full rows are then joined to its few keys.
    """
    total = rows.count()
    last = max(1, -(-total // size))
    at = (min(max(page, 1), last) - 1) * size
    keys = rows.select("type", "id", _sort_column(key).alias("_key"))
    order = [F.col("_key").asc() if ascending else F.col("_key").desc(), F.col("type").asc(), F.col("id").asc()]
    # reading from the nearer end halves the number of keys that a late page passes over
    if at <= total // 2:
        few = keys.orderBy(*order).offset(at).limit(size)
    else:
        n = min(size, total - at)
        back = [F.col("_key").desc() if ascending else F.col("_key").asc(), F.col("type").desc(), F.col("id").desc()]
        few = keys.orderBy(*back).offset(total - at - n).limit(n)
    return rows.join(few.drop("_key"), ["type", "id"], "left_semi").orderBy(*_sorting(key, ascending))


def browse_facets(rows: DataFrame) -> DataFrame:
    """The distinct values of each filter. One pass; every row counts once per facet."""
    pairs = F.concat(
        F.array(
            F.struct(F.lit("source").alias("facet"), F.col("source").alias("value")),
            F.struct(F.lit("category").alias("facet"), F.col("category").alias("value")),
            F.struct(F.lit("status").alias("facet"), F.col("status").alias("value")),
        ),
        F.transform("tags", lambda t: F.struct(F.lit("tag").alias("facet"), t.alias("value"))),
    )
    return rows.select(F.explode(pairs).alias("f")).select("f.facet", "f.value").distinct()


def browse_header(rows: DataFrame, matching: DataFrame) -> DataFrame:
    """Totals per type, the number of matching rows and the date range."""
    dated = F.when(F.col("date") != "", F.col("date"))
    shown = matching.agg(F.count("*").alias("n")).select("n").scalar()
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("type") == "auction").alias("auction"),
        F.count_if(F.col("type") == "dealer").alias("dealer"),
        F.min(dated).alias("first_date"),
        F.max(dated).alias("last_date"),
    ).select("total", "auction", "dealer", shown.alias("matching"), "first_date", "last_date")
