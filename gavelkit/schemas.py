"""Row shapes of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _shape(ddl: str) -> StructType:
    # built without a session, so that importing the module needs none
    pairs = [field.split(" ") for field in ddl.split(", ")]
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


AUCTION = _shape(
    "id STRING, piece_name STRING, category STRING, era_or_year STRING, materials_gemstones STRING, price_type STRING, "
    "sold_price DOUBLE, estimate_low DOUBLE, estimate_high DOUBLE, currency_note STRING, sale_date STRING, "
    "auction_house STRING, sale_name STRING, lot_number STRING, listing_url STRING, notes STRING, "
    "tags ARRAY<STRING>, sold_price_usd DOUBLE, source STRING, first_captured STRING"
)
LISTING = _shape(
    "id STRING, piece_name STRING, category STRING, era_or_year STRING, materials_gemstones STRING, price_type STRING, "
    "asking_price DOUBLE, currency_note STRING, dealer STRING, listing_url STRING, image_url STRING, sku STRING, "
    "notes STRING, tags ARRAY<STRING>, asking_price_usd DOUBLE, source STRING, first_seen STRING, last_seen STRING, "
    "times_seen INT, status STRING"
)
SIGHTING = _shape(
    "date_pulled STRING, query STRING, piece_name STRING, category STRING, era_or_year STRING, "
    "materials_gemstones STRING, asking_or_hammer_price DOUBLE, price_type STRING, source_site STRING, "
    "listing_url STRING, notes STRING, pos INT"
)
RAW_CAPTURE = _shape(
    "source STRING, run_date STRING, page INT, pos INT, url STRING, http_status INT, content_type STRING, "
    "method STRING, post_data STRING, headers MAP<STRING,STRING>, body STRING"
)
STATS = _shape(
    "date STRING, auctionRecords BIGINT, dealerRecords BIGINT, activeDealerListings BIGINT, "
    "newDealerListings1wk BIGINT, closedDealerListings4wk BIGINT, dealerAskingMedian DOUBLE, recentSalesMedian DOUBLE"
)

# fields that a merge takes from the newest non-empty value
AUCTION_FIELDS = [
    "piece_name", "category", "era_or_year", "materials_gemstones", "price_type", "sold_price", "estimate_low",
    "estimate_high", "currency_note", "sale_date", "auction_house", "sale_name", "lot_number", "listing_url", "notes",
]
LISTING_FIELDS = [
    "piece_name", "category", "era_or_year", "materials_gemstones", "price_type", "asking_price", "currency_note",
    "dealer", "listing_url", "image_url", "sku", "notes",
]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The fields of a shape in its order and types; absent ones are null, empty text is null."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif kind == "string":
            text = F.col(f.name).cast("string")
            cols.append(F.when(text != "", text).alias(f.name))
        elif kind == "double":
            cols.append(F.col(f.name).try_cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)
