"""What extraction jobs share, and the registry that runs them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions.text import tidy
from gavelkit.schemas import AUCTION, LISTING

# columns that say where a row came from and in which order
PROVENANCE = ["source", "run_date", "page", "pos", "item"]


class Extractor(Protocol):
    """Takes landed captures (source, run_date, page, pos, body) and returns normalized rows."""

    def __call__(self, raw: DataFrame, **params) -> DataFrame: ...


@dataclass(frozen=True)
class Source:
    """A registered source. ``needs_brand`` is false where the source is queried by a maker field; ``item_url`` is a pattern of its item pages."""

    name: str
    kind: str  # "auction" or "listing"
    extract: Extractor
    params: dict = field(default_factory=dict)
    needs_brand: bool = True
    item_url: str | None = None
    status: str = "structured"


def items_of(raw: DataFrame, items: Column) -> DataFrame:
    """One row per item of a page, with provenance; pages without items vanish."""
    keep = [c for c in PROVENANCE if c in raw.columns and c != "item"]
    return raw.select(*keep, F.posexplode(items).alias("item", "it"))


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is costly to compute and used several times.

    Exploding a one-element array keeps the optimizer from copying the expression into each use.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _shaped(rows: DataFrame, values: dict[str, Column], shape) -> DataFrame:
    kept = [c for c in PROVENANCE if c in rows.columns]
    out = []
    for f in shape.fields:
        if f.name in kept or f.name == "id":
            continue
        c = values.get(f.name)
        if c is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.simpleString() == "string":
            c = c.cast("string")
            out.append(F.nullif(c, F.lit("")).alias(f.name))
        else:
            out.append(c.cast(f.dataType).alias(f.name))
    return rows.select(*kept, *out)


def auction_rows(rows: DataFrame, **values: Column) -> DataFrame:
    return _shaped(rows, values, AUCTION)


def listing_rows(rows: DataFrame, **values: Column) -> DataFrame:
    return _shaped(rows, values, LISTING)


def price_type(sold: Column, low: Column, high: Column) -> Column:
    return F.when(sold.isNotNull(), "hammer").when(low.isNotNull() | high.isNotNull(), "estimate")


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def trimmed(c: Column) -> Column:
    return tidy(text_of(c))


def run_sources(raw: DataFrame, sources: list[Source], write: Callable[[str, DataFrame], None]) -> list[dict]:
    """Run every source on its own captures; a failing one is reported and the others go on."""
    outcome = []
    for s in sources:
        if s.status != "structured":
            outcome.append({"source": s.name, "status": s.status, "error": None})
            continue
        try:
            write(s.name, s.extract(raw.where(F.col("source") == s.name), **s.params))
            outcome.append({"source": s.name, "status": "done", "error": None})
        except Exception as e:  # noqa: BLE001 - the next source must still run
            outcome.append({"source": s.name, "status": "failed", "error": str(e)})
    return outcome
