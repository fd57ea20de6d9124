from pyspark.sql import functions as F

from tallywatch.operators import history
from tallywatch.sources import ledger
from tests.series import START, days


def total(spark, path):
    return ledger.read_history(spark, path, "grp").agg(F.sum("job_count")).first()[0]


def test_replay_counts_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    one = days(spark, [5])
    assert ledger.read_history(spark, path, "grp").count() == 0
    for batch in ("b1", "b1", "b2"):
        ledger.add_batch(one, path, "grp", batch)
    assert [tuple(r) for r in ledger.read_history(spark, path, "grp").collect()] == [(START, "A", "x", 10)]


def test_numeric_batch_ids_stay_text(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.add_batch(days(spark, [5]), path, "grp", "007")
    assert ledger.read_increments(spark, path, "grp").first()["batch_id"] == "007"


def test_compaction_keeps_sums_and_ids(spark, tmp_path):
    old, new, newest = (str(tmp_path / n) for n in ("old", "new", "newest"))
    ledger.add_batch(days(spark, [5, 6, 7]), old, "grp", "b1")
    ledger.add_batch(days(spark, [1]), old, "grp", "b2")
    ledger.compact(spark, old, new, "grp")
    assert total(spark, new) == 19
    assert ledger.add_batch(days(spark, [1]), new, "grp", "b2") is False
    assert ledger.add_batch(days(spark, [100]), new, "grp", "b3") is True
    assert total(spark, new) == 119
    ledger.compact(spark, new, newest, "grp", as_of="2025-01-03", retention_days=1)
    assert total(spark, newest) == 13
    assert {r[0] for r in ledger.absorbed_batches(spark, newest).collect()} == {"b1", "b2", "b3"}


def test_clear(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.add_batch(days(spark, [5]), path, "grp", "b1")
    ledger.clear(spark, path, "grp")
    assert ledger.read_history(spark, path, "grp").count() == 0
    ledger.add_batch(days(spark, [2]), path, "grp", "b1")
    assert total(spark, path) == 2


def test_load_trims(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.add_batch(days(spark, range(60)), path, "grp", "b1")
    assert ledger.load_history(spark, path, "grp").count() == 45


def test_load_reads_only_increments_with_new_dates(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = days(spark, range(1, 41))
    week = F.floor(F.datediff("date", F.lit(START)) / 5)
    for part in range(8):
        ledger.add_batch(rows.where(week == part), path, "grp", f"w{part}")
    # A late correction of a new day, one of an old day, and a segment with too few dates.
    ledger.add_batch(rows.where(week == 7), path, "grp", "late")
    ledger.add_batch(rows.where(week == 0), path, "grp", "old")
    quiet = rows.where(week == 2).withColumn("src", F.lit("quiet"))
    ledger.add_batch(quiet, path, "grp", "quiet")
    want = sorted(map(tuple, history.last_n_dates(ledger.read_history(spark, path, "grp"), "grp", 8).collect()))
    read = {r[0] for r in ledger.recent_increments(spark, path, "grp", 8).select("batch_id").distinct().collect()}
    assert read == {"w6", "w7", "late", "quiet"}
    # Files of the others are not even opened.
    for part in ("w0", "w3", "old"):
        for file in (tmp_path / "ledger" / "increments" / f"batch_id={part}").glob("*.parquet"):
            file.write_bytes(b"no Parquet file")
        for check in (tmp_path / "ledger" / "increments" / f"batch_id={part}").glob(".*.crc"):
            check.unlink()
    assert sorted(map(tuple, ledger.load_history(spark, path, "grp", 8).collect())) == want
    assert len(want) == 13


def test_batch_without_bounds_is_read(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = days(spark, range(1, 11))
    ledger.add_batch(rows, path, "grp", "all")
    ledger.add_batch(rows.where(F.col("job_count") <= 2), path, "grp", "first")
    assert ledger.recent_increments(spark, path, "grp", 3).select("batch_id").distinct().count() == 1
    # As after a run that stopped before it had written the bounds.
    ledger._clear_bounds(spark, path, "grp", "first")
    assert ledger.recent_increments(spark, path, "grp", 3).select("batch_id").distinct().count() == 2
    ledger.clear(spark, path, "grp")
    assert ledger.load_history(spark, path, "grp", 3).count() == 0
    ledger.add_batch(rows.where(F.col("job_count") <= 2), path, "grp", "first")
    assert ledger.load_history(spark, path, "grp", 3).count() == 2


def test_overlapping_spans_are_not_counted_twice(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = days(spark, range(1, 11))
    ledger.add_batch(rows, path, "grp", "all")
    for batch in ("a", "b", "c"):
        ledger.add_batch(rows.where(F.col("job_count") == 10), path, "grp", batch)
    got = sorted(tuple(r)[3] for r in ledger.load_history(spark, path, "grp", 3).collect())
    assert got == [8, 9, 40]


def test_more_dates_than_the_bounds_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BOUND_DATES", 2)
    path = str(tmp_path / "ledger")
    rows = days(spark, range(1, 13))
    for part in range(3):
        ledger.add_batch(rows.where(F.floor((F.col("job_count") - 1) / 4) == part), path, "grp", f"b{part}")
    starts = {n: ledger.segment_starts(ledger.read_bounds(spark, path, "grp"), "grp", n).first()["start"] for n in (2, 4, 7)}
    assert [starts[n].day if starts[n] else None for n in (2, 4, 7)] == [11, 7, None]
    for n in (2, 4, 7):
        assert sorted(r["job_count"] for r in ledger.load_history(spark, path, "grp", n).collect()) == list(range(13 - n, 13))


def test_decode(spark):
    docs = spark.createDataFrame([("k", "01/02/2025", 3), ("l", "?", 4)], "_id string, date string, job_count long")
    out = history.decode_history(docs).orderBy("job_count").collect()
    assert out[0]["date_only"].isoformat() == "2025-01-02" and out[1]["date"] is None
    assert "_id" not in out[0].asDict()
