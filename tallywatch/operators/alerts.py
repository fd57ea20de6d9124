"""Segment thresholds, flags, cooldown and budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions import arrays, dates


def with_threshold(scored: DataFrame, group: str, score: str = "score_ens", q: float = 0.95) -> DataFrame:
    """Add the segment's own interpolated score quantile as ``threshold``."""
    w = Window.partitionBy(group, "src")
    return scored.withColumn("threshold", F.percentile(score, F.lit(q)).over(w))


def threshold_report(scored: DataFrame, group: str, score: str = "score_ens", q: float = 0.95) -> DataFrame:
    """Per segment: rows, span in days, quantile and threshold."""
    return scored.groupBy(group, "src").agg(
        F.count("*").alias("records"),
        (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("days"),
        F.lit(q).alias("quantile"),
        F.percentile(score, F.lit(q)).alias("threshold"),
    )


def flag(scored: DataFrame, score: str = "score_ens") -> DataFrame:
    """``is_anomaly`` is 1 from the threshold upwards."""
    return scored.withColumn("is_anomaly", (F.col(score) >= F.col("threshold")).cast("int"))


def cooldown(flagged: DataFrame, group: str, days: int = 1) -> DataFrame:
    """Keep an alert only if the last kept alert lies more than ``days`` back.

    Each segment's alert dates are folded once, in its first row, and handed to the others.
    The windows have the partitioning of the threshold, so no further shuffle is needed.
    """
    if days <= 0:
        return flagged
    w = Window.partitionBy(group, "src")
    alert_day = F.when(F.col("is_anomaly") == 1, F.col("date"))
    return (
        flagged.withColumn("_first", F.row_number().over(w.orderBy("date")) == 1)
        .withColumn("_alerts", F.collect_list(alert_day).over(w))
        .withColumn("_once", F.when(F.col("_first"), arrays.spaced_dates(F.col("_alerts"), days)))
        .withColumn("_kept", F.first("_once", ignorenulls=True).over(w))
        .withColumn("is_anomaly", F.when(
            (F.col("is_anomaly") == 1) & F.array_contains("_kept", F.col("date")), 1).otherwise(0))
        .drop("_first", "_alerts", "_once", "_kept")
    )


def weekly_budget(flagged: DataFrame, group: str, alerts: int = 2, score: str = "score_ens") -> DataFrame:
    """Optional: at most so many alerts per segment and ISO week, highest score first."""
    w = Window.partitionBy(
        group, "src", "is_anomaly", dates.iso_year(F.col("date")), dates.iso_week(F.col("date"))
    ).orderBy(F.col(score).desc(), "date")
    return (
        flagged.withColumn("_rank", F.row_number().over(w))
        .withColumn("is_anomaly", F.when((F.col("is_anomaly") == 1) & (F.col("_rank") <= alerts), 1).otherwise(0))
        .drop("_rank")
    )


def today_anomalies(flagged: DataFrame, group: str, score: str = "score_ens") -> DataFrame:
    """Alerts on the latest day of the whole result, in segment order."""
    latest = flagged.agg(F.max("date")).scalar()
    return (
        flagged.where((F.col("date") == latest) & (F.col("is_anomaly") == 1))
        .select(group, "src", "date", "job_count", score)
        .orderBy(group, "src")
    )


def detection_rate(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Rows, alerts and their share for each combination of ``by``."""
    return flagged.groupBy(*by).agg(
        F.count("*").alias("records"),
        F.sum("is_anomaly").cast("long").alias("anomalies"),
        F.avg("is_anomaly").alias("anomaly_rate"),
    )
