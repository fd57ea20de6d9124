"""Pivot, run summary and the projections that sinks write."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_dates(df: DataFrame) -> list[dt.date]:
    """The dates present, in order; bounded by the calendar."""
    return [r[0] for r in df.select("date").distinct().orderBy("date").collect()]


def pivot_counts(df: DataFrame, group: str, dates: list[dt.date] | None = None) -> DataFrame:
    """Segments as rows, dates as columns, mean job count as cells."""
    dates = distinct_dates(df) if dates is None else dates
    return (
        df.groupBy(group, "src").pivot("date", dates).agg(F.avg("job_count"))
        .orderBy(group, "src")
    )


def run_summary(flagged: DataFrame, group: str, qmin: float = 0.95, qmax: float = 0.999,
                alert_budget_per_week: int = 2) -> DataFrame:
    """One row describing a detection run; the quantiles and the budget are echoed.

    Segments are aggregated first, so that counting them needs no distinct.
    """
    segments = flagged.groupBy(group, "src").agg(
        F.count("*").alias("n"), F.sum("is_anomaly").alias("a"),
        F.min("date").alias("lo"), F.max("date").alias("hi"),
    )
    day = "yyyy-MM-dd"
    return segments.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_records"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("long").alias("total_anomalies"),
        F.try_divide(F.sum("a"), F.sum("n")).alias("anomaly_rate"),
        F.concat(F.date_format(F.min("lo"), day), F.lit(" to "), F.date_format(F.max("hi"), day)).alias("date_range"),
        F.count("*").alias("segments"),
        F.lit(qmin).alias("qmin"),
        F.lit(qmax).alias("qmax"),
        F.lit(alert_budget_per_week).cast("long").alias("alert_budget_per_week"),
    )


def result_table_rows(flagged: DataFrame, group: str, stamped_at: dt.datetime) -> DataFrame:
    """The nine-column layout of a result table in a database, without the generated id."""
    return flagged.select(
        F.lit(stamped_at).cast("timestamp").alias("timestamp"),
        F.col(group).alias("geo_level"),
        "src", "date",
        F.col("job_count").cast("int").alias("job_count"),
        F.col("score_ens").alias("anomaly_score"),
        (F.col("is_anomaly") == 1).alias("is_anomaly"),
        "threshold",
    )
