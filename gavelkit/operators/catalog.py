"""The catalog: one row per piece from all dated scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.functions.numbers import positive

_TEXT = ["piece_name", "category", "era_or_year", "materials_gemstones", "price_type", "source_site", "listing_url", "notes"]


def catalog(sightings: DataFrame) -> DataFrame:
    """Fold sightings (id, date, pos, price, text fields) into the catalog.

    The first price is that of the first sighting, also when it is missing; the current
    price is the last known one. A piece is active if the newest scan shows it.
    """
    price = positive(F.col("price"))
    at = F.struct("date", "pos")
    known = F.when(price.isNotNull(), at)
    newest = sightings.agg(F.max("date").alias("d")).select("d").scalar()
    text = [F.max_by(F.col(c), F.when(F.col(c) != "", at)).alias(c) for c in _TEXT if c in sightings.columns]
    folded = sightings.groupBy("id").agg(
        *text,
        F.min_by(price, at).alias("first_price"),
        F.max_by(price, known).alias("current_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
        F.countDistinct("date").alias("times_seen"),
    )
    return folded.withColumn("status", F.when(F.col("last_seen") == newest, "active").otherwise("inactive"))


def day_fold(sightings: DataFrame) -> DataFrame:
    """A partial catalog of some whole days: values with their places, so that folds of other days can be merged with it.

    Nothing of it is final: ``folded_catalog`` reads the catalog off. Folds of days that are apart may be merged in any order.
    """
    price, at = positive(F.col("price")), [F.col("date"), F.col("pos")]
    text = [c for c in _TEXT if c in sightings.columns]
    newest = [F.max(F.when(F.col(c) != "", F.struct(*at, F.col(c).alias("v")))).alias(c) for c in text]
    return sightings.groupBy("id").agg(
        *newest,
        F.min(F.struct(*at, price.alias("v"))).alias("first_price"),
        F.max(F.when(price.isNotNull(), F.struct(*at, price.alias("v")))).alias("current_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
        F.countDistinct("date").alias("times_seen"),
    )


def merged_folds(kept: DataFrame, new: DataFrame) -> DataFrame:
    """One fold of two whose days are apart. A day's cost is the stored fold and that day, not the days before."""
    least, most = ["first_price", "min_price", "first_seen"], ["current_price", "max_price", "last_seen"]
    text = [c for c in kept.columns if c in _TEXT]
    both = kept.unionByName(new).groupBy("id")
    return both.agg(*[F.max(c).alias(c) for c in text + most], *[F.min(c).alias(c) for c in least], F.sum("times_seen").alias("times_seen")).select(kept.columns)


def folded_catalog(kept: DataFrame) -> DataFrame:
    """The catalog of a fold: the same rows as ``catalog`` over all its days."""
    newest = kept.agg(F.max("last_seen").alias("d")).select("d").scalar()
    values = {c: F.col(c)["v"] for c in kept.columns if c in _TEXT or c in ("first_price", "current_price")}
    return kept.withColumns(values).withColumn("status", F.when(F.col("last_seen") == newest, "active").otherwise("inactive"))


def catalog_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.coalesce(F.col("current_price"), F.lit(0.0)).desc(), "piece_name", "id")


def catalog_counters(sightings: DataFrame, pieces: DataFrame) -> DataFrame:
    """Raw rows, pieces, active and inactive pieces, and pieces new in the newest scan."""
    newest = sightings.agg(F.max("date").alias("d")).select("d").scalar()
    raw = sightings.agg(F.count("*").alias("n")).select("n").scalar()
    return pieces.agg(
        F.count("*").alias("pieces"),
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if(F.col("status") != "active").alias("inactive"),
        F.count_if(F.col("first_seen") == newest).alias("new_in_latest"),
    ).select(raw.alias("sightings"), "pieces", "active", "inactive", "new_in_latest")
