"""Queries that run a stream over whole tables and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.operators import daily
from tallywatch.sources import ledger
from tallywatch.sources.scratch import new_folder
from tallywatch.streaming import cooldown as stream_alerts
from tallywatch.streaming import daily as stream_daily
from tallywatch.streaming.ingest import first_arrivals, ingest
from workload.series import COOLED_1, DAILY_OUT, G, KEYS, _flagged
from workload.tables import EVENTS_DAILY, day, event_rows, load

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def _event_stream(spark, sf):
    """The events file as a stream; the folder is matched by a pattern, as a stream needs."""
    schema = load(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("G"), F.col("user_id") % 5).alias(G), F.col("event_type").alias("src"),
    )


def _wait(running) -> None:
    running.awaitTermination()


@query("stream_daily_counts", f"WITH {EVENTS_DAILY} {DAILY_OUT}")
def stream_daily_counts(spark, sf):
    out = new_folder(spark, "stream")
    counts = stream_daily.windowed_counts(_event_stream(spark, sf), "ts", G)
    _wait(stream_daily.write_current_days(counts, f"{out}/days", f"{out}/checkpoint", G))
    return day(stream_daily.read_current_days(spark, f"{out}/days", G))


# Only days that end at or before the watermark, two days behind the last event, are written.
@query("stream_closed_days", f"""WITH {EVENTS_DAILY} {DAILY_OUT}
WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def stream_closed_days(spark, sf):
    out = new_folder(spark, "stream")
    counts = stream_daily.windowed_counts(_event_stream(spark, sf), "ts", G)
    _wait(stream_daily.write_closed_days(counts, f"{out}/days", f"{out}/checkpoint"))
    return day(spark.read.parquet(f"{out}/days"))


@query("stream_ledger", f"WITH {EVENTS_DAILY} {DAILY_OUT}")
def stream_ledger(spark, sf):
    """Three files one after the other into the ledger."""
    out = new_folder(spark, "stream")
    rows = event_rows(spark, sf)
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).repartition(2, G, "src").write.mode("append").parquet(f"{out}/rows")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/rows")
    _wait(ingest(stream, lambda batch: daily.daily_counts(batch, G), G, f"{out}/ledger", f"{out}/checkpoint"))
    return day(ledger.read_history(spark, f"{out}/ledger", G))


@query("stream_dedup", f"WITH {EVENTS_DAILY} {DAILY_OUT}")
def stream_dedup(spark, sf):
    """All events, a third of them again and all of them again, each counted once."""
    out = new_folder(spark, "stream")
    rows = event_rows(spark, sf).withColumn("ts", F.col("date").cast("timestamp"))
    for copies in (rows, rows.where(F.col("event_id") % 3 == 0), rows):
        copies.coalesce(1).write.mode("append").parquet(f"{out}/rows")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/rows")
    once = first_arrivals(stream, "ts", key="event_id")
    _wait(ingest(once, lambda batch: daily.daily_counts(batch, G), G, f"{out}/ledger", f"{out}/checkpoint"))
    return day(ledger.read_history(spark, f"{out}/ledger", G))


@query("stream_cooldown", f"""WITH {COOLED_1}
SELECT grp, src, CAST(date AS VARCHAR) AS date FROM cooled WHERE is_anomaly = 1""")
def stream_cooldown(spark, sf):
    """Alert days in three files in date order, with the cooldown as state between them."""
    out = new_folder(spark, "stream")
    flagged = _flagged(spark, sf).where(F.col("is_anomaly") == 1).select(*KEYS)
    # Cut by date; a segment's days of one cut are in one file, so they arrive in order.
    first, last = flagged.agg(F.min("date"), F.max("date")).first()
    third = F.least(F.floor(F.datediff("date", F.lit(first)) * 3 / F.greatest(F.datediff(F.lit(last), F.lit(first)), F.lit(1))), F.lit(2))
    for part in range(3):
        flagged.where(third == part).repartition(2, G, "src").write.mode("append").parquet(f"{out}/alerts")
    stream = spark.readStream.schema(flagged.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/alerts")
    kept = stream_alerts.stream_cooldown(stream, G, 1)
    _wait(
        kept.writeStream.outputMode("append").format("parquet")
        .option("path", f"{out}/kept").option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start()
    )
    return day(spark.read.schema(flagged.schema).parquet(f"{out}/kept"))
