"""Queries on daily series: counts, history, features, thresholds, alerts, reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallywatch.operators import alerts, audit, cleaning, daily, ensemble, features, history, reports
from tallywatch.operators.detectors import bands
from tallywatch.functions import dates, text
from tallywatch.plans.detect import detect_zscore
from tallywatch.sources import ledger
from tallywatch.sources.scratch import new_folder
from workload.fixed import FEATURES
from workload.tables import (
    EVENT_ROWS, EVENTS_DAILY, LINEITEM_DAILY, ORDERS_DAILY, day, event_rows, events_daily, lineitem_daily, load,
    orders_daily, r6,
)

G = "grp"
KEYS = [G, "src", "date"]
QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# ---- counts and history ----

DAILY_OUT = "SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM daily"


@query("daily_counts", f"WITH {EVENTS_DAILY} {DAILY_OUT}")
def daily_counts(spark, sf):
    return day(events_daily(spark, sf))


@query("daily_counts_orders", f"WITH {ORDERS_DAILY} {DAILY_OUT}")
def daily_counts_orders(spark, sf):
    return day(orders_daily(spark, sf))


@query("daily_sum", f"WITH {LINEITEM_DAILY} {DAILY_OUT}")
def daily_sum(spark, sf):
    return day(lineitem_daily(spark, sf))


@query("multi_grain_counts", f"""WITH {EVENT_ROWS},
tagged AS (SELECT *, 'US' AS geo, CASE WHEN event_id % 7 = 0 THEN NULL ELSE grp END AS g FROM event_rows)
SELECT CASE WHEN grouping(geo) = 0 THEN 'country' WHEN grouping(g) = 0 THEN 'state' ELSE 'occupation' END AS grain,
       CAST(date AS VARCHAR) AS date, coalesce(geo, g, k) AS "group", src, count(*) AS job_count
FROM (SELECT *, CAST(event_id % 3 AS VARCHAR) AS k FROM tagged)
GROUP BY GROUPING SETS ((date, src, geo), (date, src, g), (date, src, k))
HAVING coalesce(geo, g, k) IS NOT NULL""")
def multi_grain_counts(spark, sf):
    rows = event_rows(spark, sf).select(
        "date", "src", F.lit("US").alias("geo"),
        F.when(F.col("event_id") % 7 != 0, F.col(G)).alias("g"),
        (F.col("event_id") % 3).cast("string").alias("k"),
    )
    return day(daily.multi_grain_counts(rows, {"country": "geo", "state": "g", "occupation": "k"}))


@query("accumulate_batches", f"WITH {EVENTS_DAILY} {DAILY_OUT}")
def accumulate_batches(spark, sf):
    rows = event_rows(spark, sf)
    slices = [daily.daily_counts(rows.where(F.col("event_id") % 3 == i), G) for i in range(3)]
    return day(daily.accumulate(slices, G))


@query("ledger_history", f"""WITH {EVENTS_DAILY}, extra AS (
  SELECT date, grp, src, job_count + (SELECT count(*) FROM event_rows e
    WHERE e.date = d.date AND e.grp = d.grp AND e.src = d.src AND e.event_id % 3 = 0) AS job_count FROM daily d)
SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM extra""")
def ledger_history(spark, sf):
    """Three batches, one of them replayed, and a fourth that repeats rows under a new id."""
    rows, path = event_rows(spark, sf), new_folder(spark, "ledger")
    for batch, part in (("b0", 0), ("b1", 1), ("b1", 1), ("b2", 2), ("b3", 0)):
        ledger.add_batch(daily.daily_counts(rows.where(F.col("event_id") % 3 == part), G), path, G, batch)
    return day(ledger.read_history(spark, path, G))


@query("ledger_compacted", f"""WITH {ORDERS_DAILY}
SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM daily
WHERE date >= DATE '2001-08-01' - 400""")
def ledger_compacted(spark, sf):
    """A compaction with retention, after which a replay of a merged batch is ignored."""
    counts, path, smaller = orders_daily(spark, sf), new_folder(spark, "ledger"), new_folder(spark, "ledger")
    ledger.add_batch(counts, path, G, "first")
    ledger.compact(spark, path, smaller, G, as_of="2001-08-01", retention_days=400)
    ledger.add_batch(counts, smaller, G, "first")
    return day(ledger.read_history(spark, smaller, G))


@query("ledger_recent", f"""WITH {EVENTS_DAILY}
SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM (
  SELECT *, dense_rank() OVER (PARTITION BY grp, src ORDER BY date DESC) AS r FROM daily) WHERE r <= 5""")
def ledger_recent(spark, sf):
    """Newest dates from a ledger of four batches cut by date, the older ones of which are not read."""
    counts, path = events_daily(spark, sf), new_folder(spark, "ledger")
    first, last = counts.agg(F.min("date"), F.max("date")).first()
    quarter = F.least(F.floor(F.datediff("date", F.lit(first)) * 4 / F.greatest(F.datediff(F.lit(last), F.lit(first)), F.lit(1))), F.lit(3))
    for part in range(4):
        ledger.add_batch(counts.where(quarter == part), path, G, f"quarter-{part}")
    return day(ledger.load_history(spark, path, G, 5))


def _last_n(source: str, n: int) -> str:
    return f"""WITH {source}
SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM (
  SELECT *, dense_rank() OVER (PARTITION BY grp, src ORDER BY date DESC) AS r FROM daily) WHERE r <= {n}"""


@query("last_n_dates", _last_n(LINEITEM_DAILY, 45))
def last_n_dates(spark, sf):
    return day(history.last_n_dates(lineitem_daily(spark, sf), G))


@query("last_n_dates_events", _last_n(EVENTS_DAILY, 20))
def last_n_dates_events(spark, sf):
    return day(history.last_n_dates(events_daily(spark, sf), G, 20))


@query("retention_delete", f"WITH {ORDERS_DAILY} {DAILY_OUT} WHERE date >= DATE '2001-08-01' - 90")
def retention_delete(spark, sf):
    return day(history.retain_days(orders_daily(spark, sf), "2001-08-01", 90))


@query("history_stats", f"""WITH {ORDERS_DAILY}
SELECT count(*) AS total_rows, CAST(max(date) AS VARCHAR) AS latest_date FROM daily""")
def history_stats(spark, sf):
    return day(history.history_stats(orders_daily(spark, sf)), "latest_date")


@query("latest_record", f"WITH {ORDERS_DAILY} {DAILY_OUT} ORDER BY daily.date DESC, grp, src LIMIT 1")
def latest_record(spark, sf):
    return day(history.latest_record(orders_daily(spark, sf), G))


STATS_OUT = """SELECT count(*) AS total_rows, CAST(min(date) AS VARCHAR) AS min_date,
CAST(max(date) AS VARCHAR) AS max_date, count(DISTINCT date) AS unique_dates FROM daily"""


@query("existing_data_stats", f"WITH {ORDERS_DAILY} {STATS_OUT}")
def existing_data_stats(spark, sf):
    return day(history.existing_data_stats(orders_daily(spark, sf)), "min_date", "max_date")


@query("existing_data_range", f"WITH {ORDERS_DAILY} {STATS_OUT} "
       "WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
def existing_data_range(spark, sf):
    stats = history.existing_data_stats(orders_daily(spark, sf), "1997-01-01", "1997-12-31")
    return day(stats, "min_date", "max_date")


@query("decode_history", """
SELECT o_orderkey, strftime(t, '%Y-%m-%d %H:%M:%S') AS date, CAST(CAST(t AS DATE) AS VARCHAR) AS date_only FROM (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate WHEN 2 THEN NULL
         ELSE o_orderdate + INTERVAL 510 MINUTE END AS t FROM orders)""")
def decode_history(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    layout = (
        F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 4 == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(k % 4 == 2, F.lit("unknown"))
        .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 08:30:00")))
    )
    docs = load(spark, sf, "orders").select(k, k.cast("string").alias("_id"), layout.alias("date"))
    decoded = history.decode_history(docs)
    return decoded.withColumns({
        "date": F.date_format("date", "yyyy-MM-dd HH:mm:ss"),
        "date_only": F.date_format("date_only", "yyyy-MM-dd"),
    })


@query("segment_keys", f"""WITH {EVENTS_DAILY}
SELECT grp || '_' || src || '_' || CAST(date AS VARCHAR) AS segment_key, job_count FROM daily""")
def segment_keys(spark, sf):
    return events_daily(spark, sf).select(
        text.segment_key(F.col(G), F.col("src"), F.col("date")).alias("segment_key"), "job_count")


# ---- features ----

def _guard(fn: str, w: str, least: int) -> str:
    return f"CASE WHEN count(job_count) OVER {w} >= {least} THEN {fn}(job_count) OVER {w} END"


def feature_sql(source: str) -> str:
    """All feature columns of ``daily`` as the table ``full_feat``, warm-up rows dropped in ``feat``."""
    part = "PARTITION BY grp, src ORDER BY date"
    return f"""{source},
rolled AS (
  SELECT grp, src, date, job_count,
    {_guard('avg', 'w7', 3)} AS mean_7, {_guard('avg', 'w14', 5)} AS mean_14, {_guard('avg', 'w28', 7)} AS mean_28,
    {_guard('stddev_pop', 'w7', 3)} AS std_7, {_guard('stddev_pop', 'w28', 7)} AS std_28,
    {_guard('mad', 'w28', 7)} AS mad_28,
    CAST(job_count AS DOUBLE) / nullif(lag(job_count, 1) OVER w, 0) - 1 AS pct_chg_1,
    CAST(job_count AS DOUBLE) / nullif(lag(job_count, 7) OVER w, 0) - 1 AS pct_chg_7,
    {_guard('min', 'w14', 5)} AS roll_min_14, {_guard('max', 'w14', 5)} AS roll_max_14,
    {_guard('avg', 'wall', 14)} AS lt_mean
  FROM daily
  WINDOW w AS ({part}),
         w7 AS ({part} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w14 AS ({part} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
         w28 AS ({part} ROWS BETWEEN 27 PRECEDING AND CURRENT ROW),
         wall AS ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
full_feat AS (
  SELECT *, (job_count - mean_7) / nullif(std_7, 0) AS z_7, (job_count - mean_28) / nullif(std_28, 0) AS z_28,
         job_count / nullif(lt_mean, 0) AS share_vs_lt,
         isodow(date) - 1 AS dow, week(date) AS woy, month(date) AS month
  FROM rolled
),
feat AS (SELECT * FROM full_feat WHERE mean_7 IS NOT NULL AND mean_14 IS NOT NULL AND mean_28 IS NOT NULL)"""


WHOLE = ("job_count", "dow", "woy", "month")


def _feature_out(columns, table: str) -> str:
    cols = [f"CAST({c} AS BIGINT) AS {c}" if c in WHOLE else f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}"
            for c in columns]
    return f"SELECT grp, src, CAST(date AS VARCHAR) AS date, {', '.join(cols)} FROM {table}"


def _feature_select(df, columns):
    return day(df).select(*KEYS, *[F.col(c).cast("long").alias(c) if c in WHOLE else r6(c).alias(c) for c in columns])


EVENT_FEATURES = feature_sql(EVENTS_DAILY)

FEATURE_QUERIES = {
    "roll_means": ("mean_7", "mean_14", "mean_28"),
    "roll_std": ("std_7", "std_28"),
    "roll_mad": ("mad_28",),
    "roll_minmax": ("roll_min_14", "roll_max_14"),
    "expanding_mean": ("lt_mean", "share_vs_lt"),
    "pct_change": ("pct_chg_1", "pct_chg_7"),
    "zscores": ("z_7", "z_28"),
    "date_parts": ("dow", "woy", "month"),
}


def _feature_query(columns):
    def run(spark, sf):
        return _feature_select(features.add_features(events_daily(spark, sf), G), columns)

    return run


for _name, _columns in FEATURE_QUERIES.items():
    query(_name, f"WITH {EVENT_FEATURES} {_feature_out(_columns, 'full_feat')}")(_feature_query(_columns))


@query("feature_table", f"WITH {EVENT_FEATURES} {_feature_out(FEATURES, 'feat')}")
def feature_table(spark, sf):
    return _feature_select(features.build_features(events_daily(spark, sf), G), FEATURES)


@query("feature_table_orders", f"WITH {feature_sql(ORDERS_DAILY)} {_feature_out(FEATURES, 'feat')}")
def feature_table_orders(spark, sf):
    return _feature_select(features.build_features(orders_daily(spark, sf), G), FEATURES)


DENSE = ORDERS_DAILY.replace("daily AS", "present AS") + """,
daily AS (
  SELECT s.grp, s.src, s.date, coalesce(p.job_count, 0) AS job_count FROM (
    SELECT grp, src, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
    FROM present GROUP BY grp, src) s
  LEFT JOIN present p ON p.grp = s.grp AND p.src = s.src AND p.date = s.date
)"""


@query("dense_calendar_features", f"WITH {feature_sql(DENSE)} {_feature_out(FEATURES, 'feat')}")
def dense_calendar_features(spark, sf):
    filled = features.fill_calendar(orders_daily(spark, sf), G)
    return _feature_select(features.build_features(filled, G), FEATURES)


HOLIDAYS = (dt.date(1997, 1, 1), dt.date(1997, 7, 4), dt.date(1997, 12, 25))


@query("holiday_flag", f"""WITH {ORDERS_DAILY}
SELECT grp, src, CAST(date AS VARCHAR) AS date, CAST(quarter(date) AS BIGINT) AS season,
       CASE WHEN date IN ({', '.join(f"DATE '{d}'" for d in HOLIDAYS)}) THEN 1 ELSE 0 END AS is_holiday
FROM daily""")
def holiday_flag(spark, sf):
    counts = orders_daily(spark, sf)
    return day(counts.select(
        *KEYS, dates.quarter(F.col("date")).cast("long").alias("season"),
        dates.is_holiday(F.col("date"), HOLIDAYS).alias("is_holiday"),
    ))


@query("external_series", f"""WITH {ORDERS_DAILY},
ship AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS shipped
         FROM lineitem GROUP BY 1 HAVING extract(year FROM CAST(l_shipdate AS DATE)) <> 1995)
SELECT grp, src, CAST(daily.date AS VARCHAR) AS date, job_count, shipped FROM daily LEFT JOIN ship USING (date)""")
def external_series(spark, sf):
    """All lines are summed; the outside series lacks one year, whose days must stay null."""
    ship = load(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum(F.col("l_quantity").cast("long")).cast("double").alias("shipped")).where(F.year("date") != 1995)
    joined = features.join_by_date(orders_daily(spark, sf), ship, "shipped")
    return day(joined.select(*KEYS, "job_count", "shipped"))


# ---- scores, thresholds, alerts ----

SCORED = EVENT_FEATURES + """,
scored AS (SELECT grp, src, date, job_count, round(coalesce(abs(z_28), 0.0), 9) AS score_ens FROM feat),
bounded AS (SELECT *, quantile_cont(score_ens, 0.95) OVER (PARTITION BY grp, src) AS threshold FROM scored),
flagged AS (SELECT *, CASE WHEN score_ens >= threshold THEN 1 ELSE 0 END AS is_anomaly FROM bounded)"""

# With a gap of one day the kept alerts are the odd places in each run of consecutive alert days.
COOLED_1 = SCORED + """,
runs AS (
  SELECT grp, src, date, date - CAST(row_number() OVER (PARTITION BY grp, src ORDER BY date) AS INTEGER) AS island
  FROM flagged WHERE is_anomaly = 1),
kept AS (
  SELECT grp, src, date FROM (
    SELECT *, row_number() OVER (PARTITION BY grp, src, island ORDER BY date) AS place FROM runs)
  WHERE place % 2 = 1),
cooled AS (
  SELECT f.grp, f.src, f.date, f.job_count, f.score_ens, f.threshold,
         CASE WHEN k.date IS NULL THEN 0 ELSE 1 END AS is_anomaly
  FROM flagged f LEFT JOIN kept k ON f.grp = k.grp AND f.src = k.src AND f.date = k.date)"""

COOLED_3 = "RECURSIVE " + SCORED + """,
alarms AS (
  SELECT grp, src, date, row_number() OVER (PARTITION BY grp, src ORDER BY date) AS place
  FROM flagged WHERE is_anomaly = 1),
walk AS (
  SELECT grp, src, date, place, 1 AS keep, date AS last FROM alarms WHERE place = 1
  UNION ALL
  SELECT a.grp, a.src, a.date, a.place, CASE WHEN a.date - w.last > 3 THEN 1 ELSE 0 END,
         CASE WHEN a.date - w.last > 3 THEN a.date ELSE w.last END
  FROM walk w JOIN alarms a ON a.grp = w.grp AND a.src = w.src AND a.place = w.place + 1),
cooled AS (
  SELECT f.grp, f.src, f.date, f.job_count, f.score_ens, f.threshold, coalesce(k.keep, 0) AS is_anomaly
  FROM flagged f LEFT JOIN walk k ON f.grp = k.grp AND f.src = k.src AND f.date = k.date)"""

FLAG_OUT = """SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(score_ens, 6) + 0.0 AS score_ens,
round(threshold, 6) + 0.0 AS threshold, is_anomaly FROM """


def _scored(spark, sf):
    feat = features.build_features(events_daily(spark, sf), G)
    score = ensemble.comparable(F.coalesce(F.abs("z_28"), F.lit(0.0)))
    return feat.select(*KEYS, "job_count", score.alias("score_ens"))


def _flagged(spark, sf):
    return alerts.flag(alerts.with_threshold(_scored(spark, sf), G))


def _flag_select(df):
    return day(df).select(*KEYS, "job_count", r6("score_ens").alias("score_ens"),
                          r6("threshold").alias("threshold"), "is_anomaly")


@query("zscore_detector", f"""WITH {EVENT_FEATURES}
SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(abs(z_28), 6) + 0.0 AS score_z,
       CASE WHEN abs(z_28) >= 2.5 THEN 1 ELSE 0 END AS is_anomaly FROM feat""")
def zscore_detector(spark, sf):
    scored = bands.zscore(features.build_features(events_daily(spark, sf), G))
    return day(scored).select(*KEYS, "job_count", r6("score_z").alias("score_z"), "is_anomaly")


@query("band_detector", f"""WITH {EVENT_FEATURES}
SELECT grp, src, CAST(date AS VARCHAR) AS date, round(mean_28 - 1.5 * std_28, 6) + 0.0 AS band_low,
       round(mean_28 + 1.5 * std_28, 6) + 0.0 AS band_high,
       CASE WHEN job_count < mean_28 - 1.5 * std_28 OR job_count > mean_28 + 1.5 * std_28 THEN 1 ELSE 0 END
       AS is_anomaly FROM feat""")
def band_detector(spark, sf):
    flagged = bands.band(features.build_features(events_daily(spark, sf), G))
    return day(flagged).select(*KEYS, r6("band_low").alias("band_low"), r6("band_high").alias("band_high"), "is_anomaly")


@query("segment_threshold", f"""WITH {SCORED}
SELECT DISTINCT grp, src, round(threshold, 6) + 0.0 AS threshold FROM bounded""")
def segment_threshold(spark, sf):
    bounded = alerts.with_threshold(_scored(spark, sf), G)
    return bounded.select(G, "src", r6("threshold").alias("threshold")).distinct()


@query("threshold_report", f"""WITH {SCORED}
SELECT grp, src, count(*) AS records, CAST(max(date) - min(date) + 1 AS BIGINT) AS days, 0.95::DOUBLE AS quantile,
       round(quantile_cont(score_ens, 0.95), 6) + 0.0 AS threshold FROM scored GROUP BY grp, src""")
def threshold_report(spark, sf):
    return alerts.threshold_report(_scored(spark, sf), G).withColumn("threshold", r6("threshold"))


@query("anomaly_flags", f"WITH {SCORED} {FLAG_OUT} flagged")
def anomaly_flags(spark, sf):
    return _flag_select(_flagged(spark, sf))


@query("cooldown_d1", f"WITH {COOLED_1} {FLAG_OUT} cooled")
def cooldown_d1(spark, sf):
    return _flag_select(alerts.cooldown(_flagged(spark, sf), G, 1))


@query("cooldown_d3", f"WITH {COOLED_3} {FLAG_OUT} cooled")
def cooldown_d3(spark, sf):
    return _flag_select(alerts.cooldown(_flagged(spark, sf), G, 3))


SLICE = SCORED.replace(EVENTS_DAILY, EVENTS_DAILY.replace("daily AS", "whole AS") + """,
daily AS (
  SELECT date, grp, src, job_count FROM (
    SELECT *, dense_rank() OVER (PARTITION BY grp, src ORDER BY date DESC) AS r FROM whole) WHERE r <= 20)""")


@query("zscore_run", "WITH " + COOLED_1.replace(SCORED, SLICE) + FLAG_OUT + " cooled")
def zscore_run(spark, sf):
    """The whole run end to end with one statistical score: counts, trim, features,
    warm-up, threshold, flag, cooldown, order."""
    kept = history.last_n_dates(events_daily(spark, sf), G, 20)
    return _flag_select(detect_zscore(kept, G).orderBy(G, "src", "date"))


@query("alert_budget", f"""WITH {SCORED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY grp, src, is_anomaly, isoyear(date), week(date)
                                        ORDER BY score_ens DESC, date) AS r FROM flagged)
SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(score_ens, 6) + 0.0 AS score_ens,
       round(threshold, 6) + 0.0 AS threshold, CASE WHEN is_anomaly = 1 AND r <= 1 THEN 1 ELSE 0 END AS is_anomaly
FROM ranked""")
def alert_budget(spark, sf):
    return _flag_select(alerts.weekly_budget(_flagged(spark, sf), G, 1))


@query("today_anomalies", f"""WITH {COOLED_1.replace("0.95", "0.3")}
SELECT grp, src, CAST(date AS VARCHAR) AS date, job_count, round(score_ens, 6) + 0.0 AS score_ens FROM cooled
WHERE is_anomaly = 1 AND date = (SELECT max(date) FROM cooled)""")
def today_anomalies(spark, sf):
    """At the quantile 0.3, so that the latest day has alerts at every scale factor."""
    flagged = alerts.flag(alerts.with_threshold(_scored(spark, sf), G, q=0.3))
    today = alerts.today_anomalies(alerts.cooldown(flagged, G, 1), G)
    return day(today).withColumn("score_ens", r6("score_ens"))


RATE_OUT = "count(*) AS records, CAST(sum(is_anomaly) AS BIGINT) AS anomalies, " \
           "round(avg(is_anomaly), 6) + 0.0 AS anomaly_rate FROM cooled"


@query("detection_rate", f"WITH {COOLED_1} SELECT grp, src, {RATE_OUT} GROUP BY grp, src")
def detection_rate(spark, sf):
    rates = alerts.detection_rate(alerts.cooldown(_flagged(spark, sf), G, 1), [G, "src"])
    return rates.withColumn("anomaly_rate", r6("anomaly_rate"))


@query("detection_rate_by_day", f"WITH {COOLED_1} SELECT CAST(date AS VARCHAR) AS date, {RATE_OUT} GROUP BY cooled.date")
def detection_rate_by_day(spark, sf):
    rates = alerts.detection_rate(alerts.cooldown(_flagged(spark, sf), G, 1), ["date"])
    return day(rates).withColumn("anomaly_rate", r6("anomaly_rate"))


@query("run_summary", f"""WITH {COOLED_1}
SELECT count(*) AS total_records, CAST(sum(is_anomaly) AS BIGINT) AS total_anomalies,
       round(avg(is_anomaly), 6) + 0.0 AS anomaly_rate,
       CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR) AS date_range,
       count(DISTINCT grp || '/' || src) AS segments, 0.95::DOUBLE AS qmin, 0.999::DOUBLE AS qmax,
       CAST(2 AS BIGINT) AS alert_budget_per_week FROM cooled""")
def run_summary(spark, sf):
    summary = reports.run_summary(alerts.cooldown(_flagged(spark, sf), G, 1), G)
    return summary.withColumn("anomaly_rate", r6("anomaly_rate"))


PIVOT_DATES = [dt.date(2024, 1, d) for d in range(1, 31)]


@query("pivot_counts", f"WITH {EVENTS_DAILY} SELECT grp, src, " + ", ".join(
    f"avg(CASE WHEN date = DATE '{d}' THEN job_count END) AS \"{d}\"" for d in PIVOT_DATES
) + " FROM daily GROUP BY grp, src")
def pivot_counts(spark, sf):
    return reports.pivot_counts(events_daily(spark, sf), G)


@query("result_table", f"""WITH {COOLED_1}
SELECT '2024-02-01 00:00:00' AS timestamp, grp AS geo_level, src, CAST(date AS VARCHAR) AS date, job_count,
       round(score_ens, 6) + 0.0 AS anomaly_score, CAST(is_anomaly AS BIGINT) AS is_anomaly,
       round(threshold, 6) + 0.0 AS threshold FROM cooled""")
def result_table(spark, sf):
    rows = reports.result_table_rows(
        alerts.cooldown(_flagged(spark, sf), G, 1), G, dt.datetime(2024, 2, 1))
    return day(rows).withColumns({
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        "job_count": F.col("job_count").cast("long"),
        "anomaly_score": r6("anomaly_score"), "threshold": r6("threshold"),
        "is_anomaly": F.col("is_anomaly").cast("long"),
    })


# ---- audits ----

SPARSE = EVENT_ROWS + """,
coverage AS (SELECT CASE WHEN event_id % 11 <> 0 THEN date END AS date, grp, src FROM event_rows)"""


def _coverage_rows(spark, sf):
    return event_rows(spark, sf).withColumn("date", F.when(F.col("event_id") % 11 != 0, F.col("date")))


COVERAGE_OUT = """SELECT grp, src, count(*) AS records, CAST(min(date) AS VARCHAR) AS min_date,
CAST(max(date) AS VARCHAR) AS max_date, count(*) FILTER (WHERE date IS NULL) AS null_dates
FROM coverage GROUP BY grp, src"""


@query("date_coverage", f"WITH {SPARSE} {COVERAGE_OUT}")
def date_coverage(spark, sf):
    return day(audit.date_coverage(_coverage_rows(spark, sf), G), "min_date", "max_date")


@query("date_coverage_first", f"WITH {SPARSE} {COVERAGE_OUT} ORDER BY grp, src LIMIT 5")
def date_coverage_first(spark, sf):
    return day(audit.first_coverage(_coverage_rows(spark, sf), G), "min_date", "max_date")


@query("missing_combinations", f"""WITH {ORDERS_DAILY},
expected AS (SELECT g.grp, s.src FROM (SELECT DISTINCT grp FROM daily) g, (SELECT DISTINCT src FROM daily) s)
SELECT grp, src FROM expected
EXCEPT SELECT grp, src FROM daily WHERE date = (SELECT max(date) FROM daily)""")
def missing_combinations(spark, sf):
    return audit.missing_combinations(orders_daily(spark, sf), G)


@query("missing_combinations_valid", f"""WITH {ORDERS_DAILY},
expected AS (SELECT g.grp, s.src FROM (
    SELECT DISTINCT grp FROM daily INTERSECT SELECT unnest(['1-URGENT', '2-HIGH', '9-NONE'])) g,
  (SELECT unnest(['F', 'O', 'X']) AS src) s)
SELECT grp, src FROM expected
EXCEPT SELECT grp, src FROM daily WHERE date = (SELECT max(date) FROM daily)""")
def missing_combinations_valid(spark, sf):
    return audit.missing_combinations(
        orders_daily(spark, sf), G, valid_groups=["1-URGENT", "2-HIGH", "9-NONE"], master_sources=["F", "O", "X"])


@query("seasonal_burst", f"""WITH {LINEITEM_DAILY}, marked AS (
  SELECT grp, src, job_count >= 3.0 * stddev_samp(job_count) OVER (PARTITION BY grp, src) AS spike,
         count(*) FILTER (WHERE job_count < 100) OVER (PARTITION BY grp, src ORDER BY date
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lulls FROM daily)
SELECT grp, src, CAST(count(*) FILTER (WHERE spike AND lulls >= 14) >= 2 AS INTEGER) AS is_seasonal_burst
FROM marked GROUP BY grp, src""")
def seasonal_burst(spark, sf):
    found = audit.seasonal_bursts(lineitem_daily(spark, sf), G, spike=3.0, lull_below=100)
    return found.withColumn("is_seasonal_burst", F.col("is_seasonal_burst").cast("int"))


@query("volume_floor", f"""WITH {LINEITEM_DAILY},
recent AS (SELECT * FROM daily WHERE date > DATE '2001-06-30' - 30 AND date <= DATE '2001-06-30'),
floors AS (SELECT *, sum(job_count) OVER (PARTITION BY grp, src) AS v,
                  var_pop(job_count) OVER (PARTITION BY grp, src) AS s FROM recent)
SELECT CAST(date AS VARCHAR) AS date, grp, src, job_count FROM floors WHERE v >= 500 AND s >= 0.5""")
def volume_floor(spark, sf):
    return day(cleaning.segment_floors(lineitem_daily(spark, sf), G, as_of="2001-06-30", min_volume=500))


@query("quality_rules", f"""WITH {ORDERS_DAILY}, odd AS (
  SELECT CASE WHEN job_count = 2 THEN NULL ELSE date END AS date, grp, src,
         CASE WHEN job_count = 3 THEN -1 WHEN job_count = 4 THEN NULL ELSE job_count END AS job_count FROM daily)
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE date IS NULL OR grp IS NULL OR src IS NULL OR job_count IS NULL) AS not_has_values,
  count(*) FILTER (WHERE NOT coalesce(date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31', FALSE))
    AS not_date_in_range,
  count(*) FILTER (WHERE NOT coalesce(job_count > 0, FALSE)) AS not_count_positive,
  count(*) FILTER (WHERE NOT coalesce(grp IN ('1-URGENT', '2-HIGH'), FALSE)) AS not_group_valid
FROM odd""")
def quality_rules(spark, sf):
    n = F.col("job_count")
    odd = orders_daily(spark, sf).withColumns({
        "date": F.when(n != 2, F.col("date")),
        "job_count": F.when(n == 3, F.lit(-1).cast("long")).when(n == 4, None).otherwise(n),
    })
    return cleaning.quality_report(odd, G, "1996-01-01", "1999-12-31",
                                   valid_group=lambda c: c.isin("1-URGENT", "2-HIGH"))
