"""Numbers, prices and their text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelkit.functions import fixed


def blank_to_null(c: Column | str) -> Column:
    """Empty text is a missing value; the text is not trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c != "", c)


def _between(c: Column, low: float, strict: bool) -> Column:
    # NaN sorts above infinity, so the upper bound removes both
    d = c.try_cast("double")
    return F.when(((d > F.lit(low)) if strict else (d >= F.lit(low))) & (d < F.lit(float("inf"))), d)


def number(c: Column) -> Column:
    """A finite double, else null. Accepts text and numbers."""
    return _between(c, float("-inf"), strict=True)


def positive(c: Column) -> Column:
    return _between(c, 0.0, strict=True)


def plausible(c: Column, floor: float = fixed.PRICE_FLOOR) -> Column:
    """A price that counts in statistics: finite and not below the floor."""
    return _between(c, float(floor), strict=False)


def round_half_up(c: Column) -> Column:
    """Round with halves going towards plus infinity; a BIGINT."""
    return F.floor(c + F.lit(0.5)).cast("bigint")


def grouped(c: Column) -> Column:
    """An integer with thousands separators."""
    return F.format_number(round_half_up(c), 0)


def money(c: Column) -> Column:
    n = round_half_up(c)
    body = F.concat(F.lit("$"), F.format_number(n, 0))
    return F.when(c.isNull(), F.lit("n/a")).otherwise(F.regexp_replace(body, r"^\$-", r"\$-"))


def locale_number(c: Column) -> Column:
    """A number as people write it: separators, at most three decimals, no trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_number(c, 3), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def plain_number(c: Column) -> Column:
    """The shortest text of a double: 1200, not 1200.0."""
    d = c.cast("double")
    whole = (F.floor(d) == d) & (F.abs(d) < 1e15)
    return F.when(whole, d.cast("bigint").cast("string")).otherwise(d.cast("string"))


def minor_units(price: Column, exponent: Column) -> Column:
    """A price given in minor units, two decimals unless stated."""
    raw = positive(price)
    return raw / F.pow(F.lit(10.0), F.coalesce(number(exponent), F.lit(2.0)))


def axis_ceiling(value: Column, step: float) -> Column:
    """The chart ceiling: 15 percent head-room, rounded up to a whole step."""
    s = F.lit(float(step))
    return F.greatest(s, F.ceil(value * F.lit(1.15) / s) * s)


def price_gap(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(a, b)


def is_foreign(currency: Column) -> Column:
    code = F.upper(F.trim(F.coalesce(currency, F.lit(""))))
    return ~code.isin("", "USD")


def native_note(amount: Column, currency: Column) -> Column:
    """`` (CHF 15,000)`` for a price in another currency, else empty."""
    a = positive(amount)
    note = F.concat(F.lit(" ("), F.upper(F.trim(currency)), F.lit(" "), grouped(a), F.lit(")"))
    return F.coalesce(F.when(is_foreign(currency), note), F.lit(""))


def native_suffix(amount: Column, currency: Column) -> Column:
    """`` (orig. CHF 15,000)`` for a price in another currency, else empty."""
    a = positive(amount)
    note = F.concat(F.lit(" (orig. "), F.upper(F.trim(currency)), F.lit(" "), grouped(a), F.lit(")"))
    return F.coalesce(F.when(is_foreign(currency), note), F.lit(""))


def estimate_text(low: Column, high: Column) -> Column:
    """The estimate as a range, as its one known bound, or as a dash."""
    both = F.concat(money(low), F.lit("–"), money(high))
    one = money(F.coalesce(low, high))
    return (
        F.when(low.isNull() & high.isNull(), F.lit("—"))
        .when(low.isNotNull() & high.isNotNull(), both)
        .otherwise(one)
    )
