"""Merging batches into the stores: identity, newest value wins, lifecycle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions.fx import usd_price
from gavelkit.functions.text import auction_key, listing_key, norm_url, tags_of
from gavelkit.schemas import AUCTION, AUCTION_FIELDS, LISTING, LISTING_FIELDS


def with_auction_key(rows: DataFrame) -> DataFrame:
    key = auction_key(*[F.col(c) for c in ("listing_url", "auction_house", "lot_number", "sale_date", "piece_name")])
    return rows.withColumn("id", key)


def with_listing_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("id", listing_key(*[F.col(c) for c in ("listing_url", "dealer", "sku", "piece_name")]))


def fold_batch(batch: DataFrame, fields: list[str], order: list[str], *more: Column) -> DataFrame:
    """One row per id: of each field the newest non-empty value, of the source the first, and what ``more`` adds.

    ``order`` names the columns that say which row of a batch came later. The fold is a
    partial aggregation, so a key that fills a large part of the batch shrinks in each
    task before the shuffle.
    """
    at = F.struct(*order)
    newest = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields]
    first_source = F.min_by(F.col("source"), F.when(F.col("source").isNotNull(), at)).alias("source")
    return batch.groupBy("id").agg(*newest, first_source, *more)


def _merged(prev: DataFrame, folded: DataFrame, fields: list[str], kept: list[str], carried: tuple = (), late: Column | None = None) -> DataFrame:
    """Full outer join on id; the batch value wins where it is not empty, in a ``late`` batch row the stored one. Both sides are unique per id."""
    p, b = prev.alias("p"), folded.withColumn("_in_batch", F.lit(True)).alias("b")

    def pick(f: str) -> Column:
        old, new = F.col(f"p.{f}"), F.col(f"b.{f}")
        first = F.coalesce(new, old)
        return (first if late is None else F.when(late, F.coalesce(old, new)).otherwise(first)).alias(f)

    return p.join(b, F.col("p.id") == F.col("b.id"), "full_outer").select(
        pick("id"),
        *[pick(f) for f in fields],
        F.coalesce(F.col("p.source"), F.col("b.source")).alias("source"),
        *[F.col(f"p.{f}").alias(f) for f in kept],
        F.col("p.id").isNotNull().alias("_on_file"),
        F.coalesce(F.col("b._in_batch"), F.lit(False)).alias("_in_batch"),
        F.col("p.tags").alias("_tags"),
        *[F.col(f"b.{c}").alias(c) for c in carried],
    )


def _tags(rules) -> Column:
    text = F.concat(F.coalesce("piece_name", F.lit("")), F.lit(" "), F.coalesce("notes", F.lit("")))
    return F.when(F.col("_in_batch"), tags_of(text, F.col("era_or_year"), rules)).otherwise(F.col("_tags"))


def merge_auctions(prev: DataFrame, batch: DataFrame, run_date: str, order: list[str], rules=None) -> DataFrame:
    """The next version of the store of sales.

    ``first_captured`` and ``source`` keep their first value; tags and the dollar price are
    computed from the merged row. Rows that the batch does not bring stay as they are.
    """
    out = _merged(prev, fold_batch(batch, AUCTION_FIELDS, order), AUCTION_FIELDS, ["first_captured", "sold_price_usd"])
    usd = usd_price(F.col("sold_price"), F.col("currency_note"), F.col("sale_date"), int(run_date[:4]))
    return (
        out.withColumn("tags", _tags(rules))
        .withColumn("sold_price_usd", F.when(F.col("_in_batch"), usd).otherwise(F.col("sold_price_usd")))
        .withColumn("first_captured", F.coalesce("first_captured", F.when(F.col("_in_batch"), F.lit(run_date))))
        .select(*AUCTION.fieldNames())
    )


def merge_listings(prev: DataFrame, batch: DataFrame, run_date: str, order: list[str], rules=None) -> DataFrame:
    """The next version of the store of listings.

    A listing in the batch is active and seen today. Its count of runs grows once per day,
    so a second run on the same day changes nothing.
    """
    kept = ["first_seen", "last_seen", "times_seen", "status", "asking_price_usd"]
    out = _merged(prev, fold_batch(batch, LISTING_FIELDS, order), LISTING_FIELDS, kept)
    seen = F.col("_in_batch")
    again = F.when(F.col("last_seen").eqNullSafe(F.lit(run_date)), 0).otherwise(1)
    first = F.coalesce(F.col("first_seen"), F.when(seen, F.lit(run_date)))
    usd = usd_price(F.col("asking_price"), F.col("currency_note"), first, int(run_date[:4]))
    return (
        out.withColumn("tags", _tags(rules))
        .withColumn("asking_price_usd", F.when(seen, usd).otherwise(F.col("asking_price_usd")))
        .withColumn("times_seen", F.when(seen, F.coalesce("times_seen", F.lit(0)) + again).otherwise(F.col("times_seen")))
        .withColumn("first_seen", first)
        .withColumn("last_seen", F.when(seen, F.lit(run_date)).otherwise(F.col("last_seen")))
        .withColumn("status", F.when(seen, "active").otherwise(F.col("status")))
        .select(*LISTING.fieldNames())
    )


def merge_listing_days(prev: DataFrame, rows: DataFrame, day: str, order: list[str], rules=None) -> DataFrame:
    """The next version of the store of listings after all the runs that ``rows`` hold, named by the column ``day``.

    The same as merging day after day, in one fold and one join whatever the number of days; ``mark_missing`` with the
    last day comes after it. A row whose days all lie before the stored last day is late: it may move the first day back, but
    stored values win over its own and the last day stays. The stored first and last day may come again and don't count twice.
    """
    kept = ["first_seen", "last_seen", "times_seen", "status", "asking_price_usd"]
    runs = F.min(day).alias("_from"), F.max(day).alias("_to"), F.collect_set(day).alias("_days")
    folded = fold_batch(rows, LISTING_FIELDS, [day, *order], *runs)
    out = _merged(prev, folded, LISTING_FIELDS, kept, ("_from", "_to", "_days"), F.coalesce(F.col("b._to") < F.col("p.last_seen"), F.lit(False)))
    seen = F.col("_in_batch")
    fresh = F.size(F.array_except("_days", F.array("first_seen", "last_seen")))
    first = F.least("first_seen", "_from")
    usd = usd_price(F.col("asking_price"), F.col("currency_note"), first, 1970)  # a listing in the rows has a first day
    return (
        out.withColumn("tags", _tags(rules))
        .withColumn("asking_price_usd", F.when(seen, usd).otherwise(F.col("asking_price_usd")))
        .withColumn("times_seen", F.when(seen, F.coalesce("times_seen", F.lit(0)) + fresh).otherwise(F.col("times_seen")))
        .withColumn("first_seen", first)
        .withColumn("last_seen", F.greatest("last_seen", "_to"))
        .withColumn("status", F.when(seen, "active").otherwise(F.col("status")))
        .select(*LISTING.fieldNames())
    )


def mark_missing(store: DataFrame, run_date: str, sources: DataFrame | list[str] | None = None) -> DataFrame:
    """Listings not seen today become inactive.

    Without ``sources`` every listing is judged, also those of a source that failed today.
    With ``sources`` (names, or a column ``source``, of the sources that delivered) the others stay as they are; names need no join.
    """
    unseen = ~F.col("last_seen").eqNullSafe(F.lit(run_date))
    if sources is None:
        return store.withColumn("status", F.when(unseen, "inactive").otherwise(F.col("status")))
    if isinstance(sources, list):
        return store.withColumn("status", F.when(unseen & F.col("source").isin(sources), "inactive").otherwise(F.col("status")))
    came = sources.select("source", F.lit(True).alias("_came")).distinct()
    return (
        store.join(came, "source", "left")
        .withColumn("status", F.when(unseen & F.col("_came"), "inactive").otherwise(F.col("status")))
        .select(*store.columns)
    )


def without_blocked(rows: DataFrame, blocked: DataFrame, url: str = "listing_url") -> DataFrame:
    """Rows whose url is not on the blocklist; queries and fragments of urls do not count."""
    deny = blocked.select(norm_url(F.col("url")).alias("_deny")).where(F.col("_deny") != "").distinct()
    keyed = rows.withColumn("_deny", norm_url(F.col(url)))
    return keyed.join(deny, "_deny", "left_anti").drop("_deny")


def identity_collisions(batch: DataFrame) -> DataFrame:
    """Ids that several rows of one batch share."""
    return batch.groupBy("id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def store_order(store: DataFrame, price: str) -> DataFrame:
    """Most expensive first, a missing price last."""
    return store.orderBy(F.coalesce(F.col(price), F.lit(0.0)).desc(), "id")
