import datetime as dt

from pyspark.sql import functions as F

from tallywatch.operators import alerts, daily
from tallywatch.plans.grains import country_daily
from tallywatch.sources import ledger
from tallywatch.sources.postings import stream_postings
from tallywatch.streaming.cooldown import stream_cooldown
from tallywatch.streaming.daily import read_current_days, windowed_counts, write_closed_days, write_current_days
from tallywatch.streaming.ingest import ingest
from tests.series import days
from workload import tables

SF = "/root/testdata/sf0.001"
ROWS = "ts timestamp, grp string, src string"


def at(day, hour=0):
    return dt.datetime(2025, 1, day, hour)


def put(spark, rows, path):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows(spark, tmp_path):
    rows, out = str(tmp_path / "rows"), str(tmp_path / "out")
    put(spark, [(at(1, 5), "A", "x"), (at(1, 6), "A", "x"), (at(2, 1), None, "x")], rows)
    put(spark, [(at(8), "A", "x")], rows)
    put(spark, [(at(8, 1), "A", "x")], rows)
    # A row of a day that the watermark has passed is left out; the ledger would add it.
    put(spark, [(at(1, 7), "A", "x"), (at(8, 3), "A", "x")], rows)
    counts = windowed_counts(stream(spark, rows), "ts", "grp", "2 days")
    write_current_days(counts, f"{out}/days", f"{out}/c1", "grp").awaitTermination()
    got = {r["date"].day: r["job_count"] for r in read_current_days(spark, f"{out}/days", "grp").collect()}
    assert got == {1: 2, 8: 3}
    closed = windowed_counts(stream(spark, rows), "ts", "grp", "2 days")
    write_closed_days(closed, f"{out}/closed", f"{out}/c2").awaitTermination()
    assert [(r["date"].day, r["job_count"]) for r in spark.read.parquet(f"{out}/closed").collect()] == [(1, 2)]


def test_ingest_adds_late_rows_and_survives_a_replay(spark, tmp_path):
    rows, out = str(tmp_path / "rows"), str(tmp_path / "out")

    def to_daily(batch):
        return daily.daily_counts(batch.withColumn("date", F.to_date("ts")), "grp")

    def run(checkpoint):
        ingest(stream(spark, rows), to_daily, "grp", f"{out}/ledger", f"{out}/{checkpoint}").awaitTermination()
        return {r["date"].day: r["job_count"] for r in ledger.read_history(spark, f"{out}/ledger", "grp").collect()}

    put(spark, [(at(1), "A", "x"), (at(9), "A", "x")], rows)
    assert run("c") == {1: 1, 9: 1}
    put(spark, [(at(1), "A", "x")], rows)
    assert run("c") == {1: 2, 9: 1}
    # Another checkpoint starts over with the same batch numbers.
    assert run("again") == {1: 2, 9: 1}


def test_postings_stream(spark, tmp_path):
    folder, out = str(tmp_path / "postings"), str(tmp_path / "out")
    batch = tables.postings(spark, SF)
    batch.repartition(3).write.parquet(folder)
    ingest(stream_postings(spark, folder, 1), country_daily, "geo_level", f"{out}/ledger",
           f"{out}/c").awaitTermination()
    got = ledger.read_history(spark, f"{out}/ledger", "geo_level")
    want = country_daily(batch)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_cooldown_state(spark, tmp_path):
    rows, out = str(tmp_path / "rows"), str(tmp_path / "out")
    flagged = days(spark, range(1, 16)).withColumn("is_anomaly", F.col("job_count").isin(1, 3, 4, 5, 9, 10, 13).cast("int"))
    hits = flagged.where("is_anomaly = 1").select("grp", "src", "date")
    for lo, hi in ((1, 4), (5, 9), (10, 15)):
        hits.where(F.dayofmonth("date").between(lo, hi)).coalesce(1).write.mode("append").parquet(rows)
    kept = stream_cooldown(
        spark.readStream.schema(hits.schema).option("maxFilesPerTrigger", 1).parquet(rows), "grp", 2)
    (kept.writeStream.format("parquet").option("path", f"{out}/kept").option("checkpointLocation", f"{out}/c")
     .trigger(availableNow=True).start().awaitTermination())
    got = sorted(r["date"] for r in spark.read.parquet(f"{out}/kept").collect())
    want = sorted(r["date"] for r in alerts.cooldown(flagged, "grp", 2).where("is_anomaly = 1").collect())
    assert got == want and len(got) == 4
