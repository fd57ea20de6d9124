"""Trimming and statistics of the daily history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions import dates
from tallywatch.operators.cleaning import drop_null_keys

HISTORY_DATES = 45
RETENTION_DAYS = 90


def decode_history(rows: DataFrame) -> DataFrame:
    """Dates from text in mixed layouts, bad ones null; adds ``date_only``, drops ``_id``."""
    parsed = dates.mixed_timestamp(F.col("date").cast("string"))
    return rows.drop("_id").withColumns({"date": parsed, "date_only": F.to_date(parsed)})


def last_n_dates(history: DataFrame, group: str, n: int = HISTORY_DATES) -> DataFrame:
    """Rows of the newest ``n`` dates present in each segment.

    The rank filter lets Spark drop older dates before the shuffle.
    """
    newest = Window.partitionBy(group, "src").orderBy(F.col("date").desc())
    return (
        drop_null_keys(history, [group, "src"])
        .withColumn("_rank", F.dense_rank().over(newest))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def retain_days(history: DataFrame, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows no older than ``days`` before ``as_of``; the boundary day stays."""
    return history.where(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def history_stats(history: DataFrame) -> DataFrame:
    """One row: total rows and the latest date."""
    return history.agg(F.count("*").alias("total_rows"), F.max("date").alias("latest_date"))


def existing_data_stats(history: DataFrame, lo=None, hi=None) -> DataFrame:
    """One row: rows, first and last date, distinct dates; optionally between two dates."""
    rows = history
    if lo is not None:
        rows = rows.where(F.col("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        rows = rows.where(F.col("date") <= F.lit(hi).cast("date"))
    per_date = rows.groupBy("date").agg(F.count("*").alias("n"))
    return per_date.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count("date").alias("unique_dates"),
    )


def latest_record(history: DataFrame, group: str) -> DataFrame:
    """The row with the latest date; ties go to the first segment."""
    return history.orderBy(F.col("date").desc(), group, "src").limit(1)
