"""Checks on coverage and on the shape of segment series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.operators.cleaning import drop_null_keys


def date_coverage(df: DataFrame, group: str, date: str = "date") -> DataFrame:
    """Per segment: rows, first and last date, rows without a date."""
    return drop_null_keys(df, [group, "src"]).groupBy(group, "src").agg(
        F.count("*").alias("records"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count_if(F.col(date).isNull()).alias("null_dates"),
    )


def first_coverage(df: DataFrame, group: str, date: str = "date", rows: int = 5) -> DataFrame:
    """The coverage of the first segments in key order."""
    return date_coverage(df, group, date).orderBy(group, "src").limit(rows)


def missing_combinations(df: DataFrame, group: str, date: str = "date",
                         valid_groups: Iterable[str] | None = None,
                         master_sources: Iterable[str] | None = None) -> DataFrame:
    """(group, src) pairs expected but absent on the latest day.

    Expected is every observed group, restricted to ``valid_groups`` if given, with
    every source. Each group subtracts its own sources of that day from the list of
    all sources, so only the missing pairs are produced.
    """
    # One row per (group, src): everything after works on segments.
    pairs = df.groupBy(group, "src").agg(F.max(F.to_date(date)).alias("last_day"))
    latest = pairs.agg(F.max("last_day")).scalar()
    if master_sources is not None:
        sources = F.array(*[F.lit(s) for s in sorted(set(master_sources))]).cast("array<string>")
    else:
        sources = pairs.agg(F.collect_set("src")).scalar()
    groups = pairs.where(F.col(group).isNotNull())
    if valid_groups is not None:
        groups = groups.where(F.col(group).isin(*sorted(set(valid_groups))))
    present = groups.groupBy(group).agg(
        F.collect_set(F.when(F.col("last_day") == latest, F.col("src"))).alias("present")
    )
    return present.select(group, F.explode(F.array_except(sources, F.col("present"))).alias("src"))


def seasonal_bursts(daily: DataFrame, group: str, value: str = "job_count", spike: float = 6.0,
                    lull_below: float = 1000, min_lull_days: int = 14, min_spikes: int = 2) -> DataFrame:
    """Per segment: whether it has enough spikes that are followed by enough lull days.

    A spike is a day of at least ``spike`` sample standard deviations; its lull days
    are counted from the day itself to the end of the series.
    """
    segment = Window.partitionBy(group, "src")
    # From the latest day backwards, so that the count runs on from row to row.
    onwards = segment.orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.col(value)
    marked = (
        drop_null_keys(daily, [group, "src"])
        .withColumn("_spike", x >= spike * F.stddev_samp(value).over(segment))
        .withColumn("_lulls", F.count_if(x < lull_below).over(onwards))
    )
    return marked.groupBy(group, "src").agg(
        (F.count_if(F.col("_spike") & (F.col("_lulls") >= min_lull_days)) >= min_spikes)
        .alias("is_seasonal_burst")
    )
