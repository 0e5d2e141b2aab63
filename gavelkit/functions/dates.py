"""Dates. All of them are UTC and stay text, because partial dates compare as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelkit.functions.numbers import positive


def days_before(run_date: str, days: int) -> str:
    return (dt.date.fromisoformat(run_date) - dt.timedelta(days=days)).isoformat()


def since(c: Column, first_day: str) -> Column:
    """Text dates on or after a day; a missing date never passes."""
    return F.coalesce(c, F.lit("")) >= F.lit(first_day)


def day_of_unix_seconds(c: Column) -> Column:
    days = F.floor(positive(c) / F.lit(86400.0)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def day_of_unix_millis(c: Column) -> Column:
    days = F.floor(positive(c) / F.lit(86400000.0)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def day_of_text(c: Column) -> Column:
    """``10 June 2026`` or an ISO date."""
    long_form = F.try_to_timestamp(c, F.lit("d MMMM yyyy"))
    short_form = F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))
    return F.coalesce(long_form, short_form).cast("date").cast("string")


def month_of_path(c: Column) -> Column:
    """``2026-06`` of a path such as ``auctions/2026/06``."""
    p = r"auctions/([0-9]{4})/([0-9]{2})"
    year, month = F.regexp_extract(c, p, 1), F.regexp_extract(c, p, 2)
    return F.when(year != "", F.concat(year, F.lit("-"), month))


def day_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")
