"""Column expressions for event times and calendar parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts tried in turn when a column mixes them; ISO text is tried first.
MIXED_FORMATS = ("MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss", "yyyy/MM/dd", "yyyyMMdd", "dd-MMM-yyyy")


def lenient_timestamp(text: Column) -> Column:
    """Parse ISO text; anything else becomes null."""
    return F.try_to_timestamp(text)


def strict_timestamp(text: Column) -> Column:
    """Parse text in any known layout; text that does not parse fails the query, null stays null."""
    parsed = mixed_timestamp(text)
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp")).otherwise(parsed)


def mixed_timestamp(text: Column, formats: Iterable[str] = MIXED_FORMATS) -> Column:
    """Parse text in any of several layouts; anything else becomes null."""
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def day_of_week(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date)


def quarter(date: Column) -> Column:
    return F.quarter(date)


def is_holiday(date: Column, holidays: Iterable[dt.date]) -> Column:
    """1 on the listed days, else 0."""
    return date.isin(*[F.lit(h) for h in holidays]).cast("int")
