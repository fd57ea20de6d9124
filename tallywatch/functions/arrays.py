"""Column expressions over small arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _middle(ordered: Column) -> Column:
    n = F.size(ordered)
    low = F.floor((n - 1) / 2).cast("int")
    high = F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / 2


def array_median(values: Column) -> Column:
    """Median of an array of numbers; null for an empty array."""
    return bind(F.sort_array(values), lambda s: F.when(F.size(s) > 0, _middle(s)))


def array_mad(values: Column) -> Column:
    """Median absolute deviation from the median."""
    return bind(array_median(values), lambda m: array_median(F.transform(values, lambda v: F.abs(v - m))))


def spaced_dates(dates: Column, gap_days: int) -> Column:
    """Greedy subset of an array of dates: the first, then each that lies more
    than ``gap_days`` after the last one kept."""
    start = F.array().cast("array<date>")
    return F.aggregate(
        F.array_sort(dates),
        start,
        lambda kept, day: F.when(
            (F.size(kept) == 0) | (F.datediff(day, F.try_element_at(kept, F.lit(-1))) > gap_days),
            F.array_append(kept, day),
        ).otherwise(kept),
    )


def squared_distance(values: Column, centre: list[float]) -> Column:
    """Squared Euclidean distance of an array column to a fixed point."""
    point = F.array(*[F.lit(float(c)) for c in centre])
    return F.aggregate(
        F.zip_with(values, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, d: acc + d
    )
