"""Conversion to US dollars with the rate of the nearest year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import positive, round_half_up


def _nearest(table: dict[int, float], year: int) -> float:
    """The rate of the nearest listed year; of two equally near years, the lower."""
    return table[min(table, key=lambda y: (abs(y - year), y))]


def rate_of(currency: Column, year: Column, rates: dict[str, dict[int, float]] | None = None) -> Column:
    """Dollars for one unit of ``currency`` in ``year``; null for an unlisted currency.

    The table is a few hundred literal numbers, so it travels inside the expression:
    one array per currency, indexed by the year clamped to the listed range. No join
    and no shuffle is needed. Years between the listed ones hold the nearest rate.
    """
    tables = sorted((rates or fixed.FX_RATES).items())
    filled, first = [], []
    for code, table in tables:
        years = range(min(table), max(table) + 1)
        filled += [F.lit(code), F.array(*[F.lit(_nearest(table, y)) for y in years])]
        first += [F.lit(code), F.lit(min(table))]
    row = F.try_element_at(F.create_map(*filled), currency)
    slot = year - F.try_element_at(F.create_map(*first), currency) + F.lit(1)
    return F.element_at(row, F.greatest(F.least(slot, F.size(row)), F.lit(1)))


def to_usd(amount: Column, currency: Column, day: Column, run_year: int) -> Column:
    """Whole dollars, or null if the amount or the currency is not usable."""
    code = F.upper(F.trim(F.coalesce(currency, F.lit(""))))
    year = F.substring(day, 1, 4).try_cast("int")
    year = F.when(year >= fixed.FIRST_FX_YEAR, year).otherwise(F.lit(run_year))
    rate = F.when(code.isin("", "USD"), F.lit(1.0)).otherwise(rate_of(code, year))
    return round_half_up(positive(amount) * rate).cast("double")


def usd_price(amount: Column, currency: Column, day: Column, run_year: int) -> Column:
    """Dollars if the currency is known, else the raw positive number."""
    return F.coalesce(to_usd(amount, currency, day, run_year), positive(amount))


def rate_table(spark, rates: dict[str, dict[int, float]] | None = None) -> DataFrame:
    """The listed rates as rows (currency, year, rate)."""
    rows = [(c, y, r) for c, t in (rates or fixed.FX_RATES).items() for y, r in t.items()]
    return spark.createDataFrame(rows, "currency string, year int, rate double")
