"""Queries that write tables derived from the given ones and return what is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallywatch.operators import alerts, detectors, occupation
from tallywatch.plans.detect import detect
from tallywatch.plans.grains import country_daily
from tallywatch.schemas import conform, daily
from tallywatch.sources import ledger, maps, seen, sinks
from tallywatch.sources.postings import read_postings
from tallywatch.sources.scratch import new_folder
from workload.postings import POSTINGS, WEIGHTED, _rolled, _weighted_days
from workload.series import COOLED_1, DAILY_OUT, EVENT_FEATURES, FLAG_OUT, G, _flag_select, _flagged
from workload.tables import FIX_ROWS, ORDERS_DAILY, STATE_ROWS, day, events_daily, orders_daily, postings, sql_rows
from workload.tables import maps as literal_maps

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@query("posting_scan", f"""WITH {POSTINGS}
SELECT job_key, state, zipcode, correct_date, first_scrape_timestamp, scraped_location, src, nlp_soc_code,
       weight AS job_count FROM postings""")
def posting_scan(spark, sf):
    """All postings written in many files with a column too many, then read with the wanted columns."""
    path = new_folder(spark, "postings")
    rows = postings(spark, sf, weighted=True).withColumn("unwanted", F.lit("x"))
    rows.repartition(6).write.parquet(path)
    return read_postings(spark, path, with_job_count=True).drop("scrape_method", "db_insert_timestamp")


@query("map_scan", f"""SELECT 'fix' AS map, row_no, zipcode, zipcode3 AS a, zipcode4 AS b
FROM (VALUES {sql_rows(FIX_ROWS)}) v(row_no, zipcode, zipcode3, zipcode4), (SELECT count(*) AS n FROM orders) WHERE n > 0
UNION ALL SELECT 'state', row_no, zipcode, state, NULL FROM (VALUES {sql_rows(STATE_ROWS)}) v(row_no, zipcode, state)
UNION ALL SELECT 'orders', o_orderkey, lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0'), o_orderstatus, NULL FROM orders""")
def map_scan(spark, sf):
    """Both maps, as CSV and as Parquet, the second with a row for each order as well."""
    given = literal_maps(spark)
    fix, state = new_folder(spark, "zip-fix") + ".csv", new_folder(spark, "zip-state")
    given.zip_fix.write.option("header", True).csv(fix)
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").cast("int").alias("row_no"),
        F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("zipcode"), F.col("o_orderstatus").alias("state"))
    given.zip_state.withColumn("map", F.lit("state")).unionByName(orders.withColumn("map", F.lit("orders"))).write.partitionBy(
        "map").parquet(state)
    named = [maps.read_zip_state(spark, f"{state}/map={m}").select(
        F.lit(m).alias("map"), "row_no", "zipcode", F.col("state").alias("a"), F.lit(None).cast("string").alias("b"))
        for m in ("state", "orders")]
    first = maps.read_zip_fix(spark, fix).select(
        F.lit("fix").alias("map"), "row_no", "zipcode", F.col("zipcode3").alias("a"), F.col("zipcode4").alias("b"))
    return first.unionByName(named[0]).unionByName(named[1])


@query("ledger_cleared", f"WITH {ORDERS_DAILY} {DAILY_OUT} WHERE grp <> '1-URGENT'")
def ledger_cleared(spark, sf):
    """A ledger filled, emptied, filled again, and one of its batches replayed without a row."""
    path, counts = new_folder(spark, "ledger"), orders_daily(spark, sf)
    ledger.add_batch(counts, path, G, "first")
    ledger.clear(spark, path, G)
    urgent = F.col(G) == "1-URGENT"
    ledger.add_batch(counts.where(urgent), path, G, "a b/c=1")
    ledger.add_batch(counts.where(~urgent), path, G, "rest")
    ledger.add_batch(counts.limit(0), path, G, "a b/c=1")
    return day(ledger.read_history(spark, path, G))


@query("dedup_across_batches", f"""WITH {POSTINGS},
first AS (SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY CASE WHEN src < '3' THEN 0 ELSE 1 END,
    try_cast(first_scrape_timestamp AS TIMESTAMP) NULLS LAST, state NULLS FIRST, zipcode NULLS FIRST,
    correct_date NULLS FIRST, first_scrape_timestamp NULLS FIRST) AS r FROM cleaned)
SELECT CAST(date AS VARCHAR) AS date, 'US' AS geo_level, src, count(*) AS job_count FROM first
WHERE r = 1 AND date IS NOT NULL AND src IS NOT NULL GROUP BY first.date, src""")
def dedup_across_batches(spark, sf):
    """The two most urgent priorities as one batch, all postings as the next, and the first one once more."""
    keys, path, rows = new_folder(spark, "seen"), new_folder(spark, "ledger"), postings(spark, sf)
    early = rows.where(F.col("src") < "3")
    for batch_id, batch in (("early", early), ("all", rows), ("early", early)):
        ledger.add_batch(country_daily(seen.claim(batch, keys, batch_id)), path, "geo_level", batch_id)
    return day(ledger.read_history(spark, path, "geo_level"))


def _read_csv(spark, path, result):
    return spark.read.schema(result.schema).option("header", True).csv(path)


@query("result_csv", f"WITH {COOLED_1} {FLAG_OUT} cooled")
def result_csv(spark, sf):
    path, result = new_folder(spark, "csv"), alerts.cooldown(_flagged(spark, sf), G, 1)
    sinks.write_result_csv(result, G, path)
    return _flag_select(_read_csv(spark, path, result))


@query("today_csv", f"""WITH {COOLED_1.replace("0.95", "0.3")}
SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(score_ens, 6) + 0.0 AS score_ens FROM cooled
WHERE is_anomaly = 1 AND date = (SELECT max(date) FROM cooled)""")
def today_csv(spark, sf):
    scored = _flagged(spark, sf).drop("threshold", "is_anomaly")
    result = alerts.cooldown(alerts.flag(alerts.with_threshold(scored, G, q=0.3)), G, 1)
    path = sinks.write_today_csv(result, G, new_folder(spark, "today"), "run", dt.date(2024, 2, 1))
    rows = _read_csv(spark, path, result.select(G, "src", "date", "job_count", "score_ens"))
    return day(rows).withColumn("score_ens", F.round("score_ens", 6) + F.lit(0.0))


@query("json_alerts", f"""WITH {COOLED_1}
SELECT 'anomaly' AS record, grp, src, CAST(date AS VARCHAR) AS date, NULL AS total FROM cooled WHERE is_anomaly = 1
UNION ALL SELECT 'metadata', NULL, NULL, NULL, count(*) FROM cooled""")
def json_alerts(spark, sf):
    path, result = new_folder(spark, "json"), alerts.cooldown(_flagged(spark, sf), G, 1)
    sinks.write_json_report(result, G, path, dt.datetime(2024, 2, 1))
    lines = spark.read.text(path).select(F.from_json(
        "value", "record string, metadata struct<total_records: long>, anomaly struct<grp: string, src: string, date: string>"
    ).alias("r"))
    return lines.where("r.record <> 'summary'").select(
        "r.record", "r.anomaly.grp", "r.anomaly.src", "r.anomaly.date", F.col("r.metadata.total_records").alias("total"))


@query("conformed", f"WITH {ORDERS_DAILY} {DAILY_OUT}")
def conformed(spark, sf):
    """Columns as text and in another order, one too many, brought to the daily schema."""
    rows = orders_daily(spark, sf).select(
        F.col("job_count").cast("string").alias("job_count"), "src", F.lit(1).alias("unwanted"), G,
        F.col("date").cast("string").alias("date"))
    return day(conform(rows, daily(G)))


def _share(m):
    """A detector of a user's own: how far a day's count lies from its segment's mean."""
    mean = m.df.groupBy(m.group, "src").agg(F.avg("job_count").alias("_mean"))

    def score(df, name):
        return df.join(mean, [m.group, "src"]).withColumn(name, F.abs(F.col("job_count") - F.col("_mean"))).drop("_mean")

    return score


@query("user_detector", f"""WITH {EVENT_FEATURES},
far AS (SELECT grp, src, date, job_count, abs(job_count - avg(job_count) OVER (PARTITION BY grp, src)) AS d FROM feat),
unit AS (SELECT *, round((d - min(d) OVER ()) / (max(d) OVER () - min(d) OVER ()), 9) AS score_ens FROM far),
held AS (SELECT *, quantile_cont(score_ens, 0.8) OVER (PARTITION BY grp, src) AS threshold FROM unit)
SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(score_ens, 6) + 0.0 AS score_ens,
       round(threshold, 6) + 0.0 AS threshold, CASE WHEN score_ens >= threshold THEN 1 ELSE 0 END AS is_anomaly FROM held""")
def user_detector(spark, sf):
    """The detection run with other settings and a registered detector."""
    detectors.register("share_of_mean", _share)
    result = detect(events_daily(spark, sf), G, models=("share_of_mean",), quantile_bounds=(0.8, 0.9), cooldown_days=0)
    return _flag_select(result)


@query("two_step_rollup", f"""WITH {WEIGHTED},
means2 AS (SELECT nlp_soc_code_rolled, avg(weight) AS m FROM rolled WHERE nlp_soc_code_rolled IS NOT NULL GROUP BY 1),
twice AS (
  SELECT r.date, r.src, r.weight, CASE WHEN m2.m < 1.2
         THEN {_rolled(2).replace('nlp_soc_code', 'r.nlp_soc_code_rolled')} ELSE r.nlp_soc_code_rolled END AS code
  FROM rolled r LEFT JOIN means2 m2 ON m2.nlp_soc_code_rolled = r.nlp_soc_code_rolled)
SELECT CAST(date AS VARCHAR) AS date, code AS nlp_soc_code_rolled, src, CAST(sum(weight) AS BIGINT) AS job_count FROM twice
WHERE code IS NOT NULL AND date IS NOT NULL AND src IS NOT NULL GROUP BY twice.date, code, src""")
def two_step_rollup(spark, sf):
    return day(occupation.daily_rolled_counts(occupation.roll_twice(_weighted_days(spark, sf), below=1.2)))

