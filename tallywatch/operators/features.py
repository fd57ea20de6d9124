"""Rolling-window, change and calendar features of a daily series.

Every window is partitioned by segment, and a segment has one row per date, so a
window group is bounded by the calendar, however many postings lie behind it.
All windows use one sort order and share one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions import arrays, dates
from tallywatch.functions.joins import lookup
from tallywatch.operators.cleaning import drop_null_keys

FEATURES = (
    "job_count", "mean_7", "mean_14", "mean_28", "std_7", "std_28", "mad_28",
    "pct_chg_1", "pct_chg_7", "z_7", "z_28", "roll_min_14", "roll_max_14",
    "lt_mean", "share_vs_lt", "dow", "woy", "month",
)


@dataclass(frozen=True)
class Frame:
    """A row frame ending at the current row and the observations it must hold."""

    rows: int | None
    least: int


# Window lengths and minimum observations.
WEEK = Frame(7, 3)
FORTNIGHT = Frame(14, 5)
MONTH = Frame(28, 7)
EXPANDING = Frame(None, 14)


def _segment(group: str):
    return Window.partitionBy(group, "src").orderBy("date")


def over_frame(group: str, frame: Frame, value: str, aggregate) -> Column:
    """``aggregate(value)`` over the frame, null until it holds enough observations."""
    start = Window.unboundedPreceding if frame.rows is None else 1 - frame.rows
    w = _segment(group).rowsBetween(start, Window.currentRow)
    return F.when(F.count(value).over(w) >= frame.least, aggregate(F.col(value)).over(w))


def rolling_mad(group: str, frame: Frame, value: str) -> Column:
    window_values = over_frame(group, frame, value, F.collect_list)
    return arrays.array_mad(window_values)


def change(group: str, value: str, rows_back: int) -> Column:
    """Relative change to the value some rows back; null on a zero base."""
    return F.try_divide(F.col(value), F.lag(value, rows_back).over(_segment(group))) - 1


def rolling_columns(group: str, value: str = "job_count") -> dict[str, Column]:
    """The features that need a window."""
    return {
        "mean_7": over_frame(group, WEEK, value, F.avg),
        "mean_14": over_frame(group, FORTNIGHT, value, F.avg),
        "mean_28": over_frame(group, MONTH, value, F.avg),
        "std_7": over_frame(group, WEEK, value, F.stddev_pop),
        "std_28": over_frame(group, MONTH, value, F.stddev_pop),
        "mad_28": rolling_mad(group, MONTH, value),
        "pct_chg_1": change(group, value, 1),
        "pct_chg_7": change(group, value, 7),
        "roll_min_14": over_frame(group, FORTNIGHT, value, F.min),
        "roll_max_14": over_frame(group, FORTNIGHT, value, F.max),
        "lt_mean": over_frame(group, EXPANDING, value, F.avg),
    }


def derived_columns(value: str = "job_count") -> dict[str, Column]:
    """The features computed from those of the same row."""
    x = F.col(value)
    return {
        "z_7": F.try_divide(x - F.col("mean_7"), F.col("std_7")),
        "z_28": F.try_divide(x - F.col("mean_28"), F.col("std_28")),
        "share_vs_lt": F.try_divide(x.cast("double"), F.col("lt_mean")),
        "dow": dates.day_of_week(F.col("date")),
        "woy": dates.iso_week(F.col("date")),
        "month": F.month("date"),
    }


def add_features(daily: DataFrame, group: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Segment, date, the 18 features and any extra columns, warm-up rows included."""
    rows = drop_null_keys(daily, [group, "src", "date"]).select(group, "src", "date", "job_count")
    full = rows.withColumns(rolling_columns(group)).withColumns(derived_columns())
    full = full.select(group, "src", "date", *FEATURES)
    return full.withColumns(extra) if extra else full


def drop_warmup(features: DataFrame) -> DataFrame:
    """Rows for which every rolling mean has enough observations."""
    return features.dropna(subset=["mean_7", "mean_14", "mean_28"])


def build_features(daily: DataFrame, group: str, extra: dict[str, Column] | None = None) -> DataFrame:
    return drop_warmup(add_features(daily, group, extra))


def fill_calendar(daily: DataFrame, group: str) -> DataFrame:
    """Optional: one row per calendar day of each segment, absent days counting 0."""
    rows = drop_null_keys(daily, [group, "src", "date"])
    spans = rows.groupBy(group, "src").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = spans.select(group, "src", F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.join(rows.select(group, "src", "date", "job_count"), [group, "src", "date"], "left").select(
        "date", group, "src", F.coalesce("job_count", F.lit(0).cast("long")).alias("job_count")
    )


def join_by_date(features: DataFrame, outside: DataFrame, column: str) -> DataFrame:
    """Optional: attach an outside daily series; days without a value stay null.

    A date that ``outside`` holds more than once is an error. The join broadcasts the
    series only if it is as small as a calendar should be.
    """
    once = F.when(F.count("*") > 1, F.raise_error(F.lit("a date of the outside series repeats")).cast("double")).otherwise(
        F.first(F.col(column).cast("double")))
    kind = outside.schema[column].dataType
    return lookup(features, "date", outside.groupBy("date").agg(once.cast(kind).alias(column)))
