"""Daily counts as an event-time aggregate with a bound on late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.operators.cleaning import drop_null_keys


def windowed_counts(stream: DataFrame, event_time: str, group: str, late_by: str = "2 days") -> DataFrame:
    """(date, group, src, job_count) per tumbling day; the session time zone is UTC.

    State of a day is dropped once the watermark has passed it, so state does not
    grow with the length of the stream.
    """
    timed = drop_null_keys(stream, [event_time, group, "src"]).withColumn(
        event_time, F.col(event_time).cast("timestamp")
    )
    return (
        timed.withWatermark(event_time, late_by)
        .groupBy(F.window(event_time, "1 day").alias("day"), group, "src")
        .agg(F.count("*").alias("job_count"))
        .select(F.to_date("day.start").alias("date"), group, "src", "job_count")
    )


def write_closed_days(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each day to a Parquet folder once the watermark has passed it."""
    return (
        counts.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_current_days(counts: DataFrame, path: str, checkpoint: str, group: str) -> StreamingQuery:
    """Write every changed (day, segment) with its new count, one folder per micro-batch.

    ``read_current_days`` picks the newest.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={number}")

    return (
        counts.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_current_days(spark, path: str, group: str) -> DataFrame:
    """The newest count of each (date, segment)."""
    keys = ["date", group, "src"]
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by("job_count", "version").alias("job_count"))
