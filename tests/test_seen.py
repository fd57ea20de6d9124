"""Postings that occur in several batches."""

import datetime as dt

import pytest

from tallywatch.plans.grains import country_daily, run_grain
from tallywatch.schemas import POSTING
from tallywatch.sources import ledger, seen
from tallywatch.streaming.ingest import first_arrivals


def batch(spark, *rows):
    """Postings from (job_key, scraped, src)."""
    return spark.createDataFrame(
        [(key, None, None, None, scraped, None, src, None, None, None) for key, scraped, src in rows], POSTING)


def kept(df):
    return sorted((r["job_key"] or "", r["first_scrape_timestamp"], r["src"]) for r in df.collect())


D1, D2, D3 = "2025-01-01", "2025-01-02", "2025-01-03"


def test_each_key_counts_in_one_batch(spark, tmp_path):
    path = str(tmp_path / "it's a 'folder'")
    first = batch(spark, ("a", D2, "x"), ("a", D1, "y"), ("b", D1, "x"), (None, D1, "x"), (None, D1, "x"), ("", D1, "z"))
    second = batch(spark, ("a", D1, "x"), ("c", D3, "x"), ("c", D2, "x"), (None, D1, "x"))
    want = [("", D1, "x"), ("", D1, "x"), ("", D1, "z"), ("a", D1, "y"), ("b", D1, "x")]
    assert kept(seen.claim(first, path, "b'1")) == want
    assert kept(seen.claim(second, path, "b/2")) == [("", D1, "x"), ("c", D2, "x")]
    # Repeats give the same postings and own the same keys.
    assert kept(seen.claim(first, path, "b'1")) == want
    assert kept(seen.claim(second, path, "b/2")) == [("", D1, "x"), ("c", D2, "x")]
    owned = {(r["job_key"], r["owner"], r["part"]) for r in seen.read_seen(spark, path).collect()}
    assert owned == {("a", "b'1", "b'1"), ("b", "b'1", "b'1"), ("", "b'1", "b'1"), ("c", "b/2", "b/2")}
    # A repeat with other postings gives up what it no longer has.
    seen.claim(batch(spark, ("a", D1, "x")), path, "b'1")
    assert kept(seen.claim(batch(spark, ("b", D3, "x"), ("a", D3, "x")), path, "b3")) == [("b", D3, "x")]
    with pytest.raises(ValueError):
        seen.claim(first, path, seen.COMPACTED)


def test_empty_and_extra_columns(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert seen.claim(batch(spark), path, "none").isEmpty()
    rows = batch(spark, ("a", D1, "x"), ("b", None, None)).selectExpr(
        "*", "1 as owner", "'p' as part", "map('k', 1) as m", "1 as `a.b`")
    got = seen.claim(rows, path, "one")
    assert got.columns == rows.columns and got.count() == 2
    assert seen.claim(rows, path, "two").isEmpty()


def test_old_keys_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "seen")
    seen.claim(batch(spark, ("a", D1, "x"), ("b", D1, "x")), path, "one", buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = seen.unseen(batch(spark, ("a", D1, "x"), ("c", D1, "x")), path, "two")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert kept(fresh) == [("c", D1, "x")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # One shuffle ranks the batch and joins it; the copies are dropped in front of it.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")


def test_buckets_stay_and_compaction_keeps_owners(spark, tmp_path):
    path, small = str(tmp_path / "seen"), str(tmp_path / "small")
    one, two = batch(spark, ("a", D1, "x"), ("b", D1, "x")), batch(spark, ("b", D2, "x"), ("c", D1, "x"))
    seen.claim(one, path, "one", buckets=3)
    seen.claim(two, path, "two", buckets=7)
    assert spark.read.json(f"{path}/layout").first()["buckets"] == 3
    seen.compact(spark, path, small, buckets=2)
    assert {tuple(r) for r in seen.read_seen(spark, small).select("job_key", "owner").collect()} == {
        ("a", "one"), ("b", "one"), ("c", "two")}
    assert kept(seen.claim(two, small, "two")) == [("c", D1, "x")]
    assert kept(seen.claim(one, small, "one")) == [("a", D1, "x"), ("b", D1, "x")]
    assert seen.claim(batch(spark, ("a", D1, "x"), ("c", D1, "x")), small, "three").isEmpty()


def test_another_session_sees_all_batches(spark, tmp_path):
    path = str(tmp_path / "seen")
    seen.claim(batch(spark, ("a", D1, "x")), path, "one")
    name = seen._table(spark, path)[0]
    spark.sql(f"DROP TABLE {name}")
    assert seen.claim(batch(spark, ("a", D1, "x")), path, "two").isEmpty()


def test_run_counts_a_posting_once(spark, tmp_path):
    days = [f"2025-01-{d:02d}" for d in range(1, 31)]
    rows = batch(spark, *[(f"{d}-{i}", d, "x") for n, d in enumerate(days) for i in range(3 + n % 2)])
    more = rows.unionByName(batch(spark, ("new", D1, "x")))
    folder, keys = str(tmp_path / "ledger"), str(tmp_path / "seen")
    for batch_id, postings in (("one", rows), ("two", more), ("one", rows)):
        run_grain(spark, "country", postings, folder, batch_id, str(tmp_path / "out"), dt.date(2025, 1, 31),
                  seen_path=keys, models=("hbos",))
    got = ledger.read_history(spark, folder, "geo_level")
    want = country_daily(more)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_stream_keeps_first_arrivals(spark, tmp_path):
    rows, out = str(tmp_path / "rows"), str(tmp_path / "out")
    ts = lambda d: dt.datetime(2025, 1, d)
    schema = "job_key string, ts timestamp, n int"
    files = [
        [("a", ts(1), 1), (None, ts(1), 2), (None, ts(1), 3), ("b", None, 4), ("b", ts(2), 5)],
        [("a", ts(3), 6), ("b", None, 7), ("c", ts(20), 8)],
        [("c", ts(19), 9)],
        [("a", ts(20), 10)],
    ]
    for part in files:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(rows)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(rows)
    (first_arrivals(stream, "ts", "5 days").writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    # The state of "a" has ended with the third file: its last copy is 19 days younger.
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5, 7, 8, 10]
