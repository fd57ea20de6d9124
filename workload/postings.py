"""Queries on derived raw postings: cleaning, geography, occupation, whole grains."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions import text
from tallywatch.operators import cleaning, geography, occupation
from tallywatch.plans import grains
from workload.fixed import CODE_PATTERN, NAME_PATTERN, STATE_NAMES
from workload.tables import FIX_ROWS, POSTINGS, STATE_ROWS, day, maps, postings, sql_rows

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


_CODES = ", ".join(f"'{c}'" for c in STATE_NAMES)
_NAME_CASES = " ".join(f"WHEN '{n.replace(' ', '').upper()}' THEN '{c}'" for c, n in STATE_NAMES.items())
_PAD = "CASE WHEN length({0}) < 5 THEN lpad({0}, 5, '0') ELSE {0} END"

REPAIRED = POSTINGS + f""",
zip_fix(row_no, zipcode, zipcode3, zipcode4) AS (VALUES {sql_rows(FIX_ROWS)}),
short_zip AS (
  SELECT zipcode3 AS short, arg_min(zipcode, row_no) AS fixed FROM zip_fix
  WHERE length(zipcode3) = 3 AND zipcode IS NOT NULL GROUP BY 1
  UNION ALL
  SELECT zipcode4, arg_min(zipcode, row_no) FROM zip_fix
  WHERE length(zipcode4) = 4 AND zipcode IS NOT NULL GROUP BY 1),
repaired AS (
  SELECT c.* EXCLUDE (zipcode), c.zipcode AS original_zipcode,
         CASE WHEN regexp_matches(s.fixed, '^[0-9]{{5}}$') THEN s.fixed ELSE c.zipcode END AS zipcode
  FROM cleaned c LEFT JOIN short_zip s ON s.short = c.zipcode)"""

IMPUTED = REPAIRED + f""",
zip_state(row_no, zipcode, state) AS (VALUES {sql_rows(STATE_ROWS)}),
zip_map AS (SELECT {_PAD.format('zipcode')} AS padded, arg_max(state, row_no) AS s FROM zip_state GROUP BY 1),
step3 AS (
  SELECT r.*, CASE WHEN r.state IN ({_CODES}) THEN r.state END AS s1,
         coalesce(CASE WHEN r.state IN ({_CODES}) THEN r.state END,
                  CASE WHEN lower(trim(r.zipcode)) = 'remote' THEN 'REMOTE' END) AS s2,
         coalesce(CASE WHEN r.state IN ({_CODES}) THEN r.state END,
                  CASE WHEN lower(trim(r.zipcode)) = 'remote' THEN 'REMOTE' END, z.s) AS s3
  FROM repaired r LEFT JOIN zip_map z ON z.padded = {_PAD.format('r.zipcode')}),
step4 AS (
  SELECT *, CASE WHEN coalesce(s3, '') = ''
    THEN coalesce(nullif(regexp_extract(scraped_location, '{CODE_PATTERN}', 1), ''), s3) ELSE s3 END AS s4
  FROM step3),
imputed AS (
  SELECT *, CASE WHEN s4 IS NULL THEN
    CASE upper(replace(regexp_extract(scraped_location, '{NAME_PATTERN}', 1), ' ', '')) {_NAME_CASES} END
    ELSE s4 END AS correct_state
  FROM step4)"""


@query("event_time_repair", f"""WITH {POSTINGS}
SELECT first_scrape_timestamp, correct_date, CAST(date AS VARCHAR) AS date, count(*) AS n FROM cleaned
GROUP BY first_scrape_timestamp, correct_date, cleaned.date""")
def event_time_repair(spark, sf):
    cleaned = cleaning.clean_postings(postings(spark, sf))
    return day(cleaned).groupBy("first_scrape_timestamp", "correct_date", "date").agg(F.count("*").alias("n"))


@query("event_time_report", f"""WITH {POSTINGS}
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE try_cast(first_scrape_timestamp AS TIMESTAMP) IS NULL) AS missing_first,
  count(*) FILTER (WHERE try_cast(first_scrape_timestamp AS TIMESTAMP) IS NULL AND correct_date IS NOT NULL) AS filled,
  count(*) FILTER (WHERE date IS NULL) AS missing_last FROM cleaned""")
def event_time_report(spark, sf):
    return cleaning.event_time_report(postings(spark, sf))


@query("null_counts", f"""WITH {POSTINGS}
SELECT count(*) AS total_rows, """ + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}"
    for c in ("state", "zipcode", "first_scrape_timestamp", "scraped_location", "nlp_soc_code")
) + " FROM postings")
def null_counts(spark, sf):
    return cleaning.null_counts(
        postings(spark, sf), ("state", "zipcode", "first_scrape_timestamp", "scraped_location", "nlp_soc_code"))


@query("dedup_postings", f"""WITH {POSTINGS}
SELECT job_key, first_scrape_timestamp, correct_date, state, zipcode FROM (
  SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY try_cast(first_scrape_timestamp AS TIMESTAMP)
    NULLS LAST, state NULLS FIRST, zipcode NULLS FIRST, correct_date NULLS FIRST, first_scrape_timestamp NULLS FIRST) AS r FROM postings) WHERE r = 1""")
def dedup_postings(spark, sf):
    return cleaning.dedup_postings(postings(spark, sf)).select(
        "job_key", "first_scrape_timestamp", "correct_date", "state", "zipcode")


@query("zip_repair", f"""WITH {REPAIRED}
SELECT original_zipcode, zipcode, count(*) AS n FROM repaired GROUP BY 1, 2""")
def zip_repair(spark, sf):
    repaired = geography.repair_zip(postings(spark, sf), maps(spark).zip_fix)
    return repaired.groupBy("original_zipcode", "zipcode").agg(F.count("*").alias("n"))


@query("zip_pad", f"""WITH {POSTINGS}
SELECT zipcode, {_PAD.format('zipcode')} AS padded, count(*) AS n FROM postings GROUP BY 1, 2""")
def zip_pad(spark, sf):
    rows = postings(spark, sf).withColumn("padded", text.pad_zip(F.col("zipcode")))
    return rows.groupBy("zipcode", "padded").agg(F.count("*").alias("n"))


@query("zip_lengths", f"""WITH {REPAIRED}
SELECT length(zipcode) AS zip_length, count(*) AS n FROM repaired WHERE zipcode IS NOT NULL GROUP BY 1""")
def zip_lengths(spark, sf):
    lengths = geography.zip_lengths(geography.repair_zip(postings(spark, sf), maps(spark).zip_fix))
    return lengths.withColumn("zip_length", F.col("zip_length").cast("long"))


@query("state_impute_cases", f"""WITH {IMPUTED}
SELECT state, original_zipcode, scraped_location, correct_state, count(*) AS n FROM imputed GROUP BY 1, 2, 3, 4""")
def state_impute_cases(spark, sf):
    tables = maps(spark)
    imputed = geography.impute_states(geography.repair_zip(postings(spark, sf), tables.zip_fix), tables.zip_state)
    return imputed.groupBy("state", "original_zipcode", "scraped_location", "correct_state").agg(
        F.count("*").alias("n"))


@query("state_impute", f"""WITH {IMPUTED}
SELECT CAST(date AS VARCHAR) AS date, correct_state AS state, src, count(*) AS job_count FROM imputed
WHERE date IS NOT NULL AND correct_state IS NOT NULL AND src IS NOT NULL GROUP BY imputed.date, correct_state, src""")
def state_impute(spark, sf):
    return day(grains.state_daily(postings(spark, sf), maps(spark)))


@query("impute_funnel", f"""WITH {IMPUTED}
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE coalesce(s1, '') <> '') AS by_state,
  count(*) FILTER (WHERE coalesce(s2, '') <> '' AND coalesce(s1, '') = '') AS by_remote,
  count(*) FILTER (WHERE coalesce(s3, '') <> '' AND coalesce(s2, '') = '') AS by_zip,
  count(*) FILTER (WHERE coalesce(s4, '') <> '' AND coalesce(s3, '') = '') AS by_code,
  count(*) FILTER (WHERE coalesce(correct_state, '') <> '' AND coalesce(s4, '') = '') AS by_name,
  count(*) FILTER (WHERE coalesce(correct_state, '') = '') AS unresolved FROM imputed""")
def impute_funnel(spark, sf):
    tables = maps(spark)
    return geography.impute_funnel(geography.repair_zip(postings(spark, sf), tables.zip_fix), tables.zip_state)


@query("country_daily", f"""WITH {POSTINGS}
SELECT CAST(date AS VARCHAR) AS date, 'US' AS geo_level, src, count(*) AS job_count FROM cleaned
WHERE date IS NOT NULL AND src IS NOT NULL GROUP BY cleaned.date, src""")
def country_daily(spark, sf):
    return day(grains.country_daily(postings(spark, sf)))


def _rolled(level: int) -> str:
    short = "left(nlp_soc_code, 6) || '0'" if level == 1 else "left(nlp_soc_code, 4) || '000'"
    return f"CASE WHEN regexp_matches(nlp_soc_code, '^[^-]{{2}}-[^-]{{4}}$') THEN {short} ELSE nlp_soc_code END"


def _soc_sql(level: int) -> str:
    return f"""WITH {POSTINGS}
SELECT CAST(date AS VARCHAR) AS date, {_rolled(level)} AS nlp_soc_code_rolled, src, count(*) AS job_count FROM cleaned
WHERE nlp_soc_code IS NOT NULL AND date IS NOT NULL AND src IS NOT NULL GROUP BY cleaned.date, 2, src"""


@query("soc_rollup_l1", _soc_sql(1))
def soc_rollup_l1(spark, sf):
    return day(grains.occupation_daily(postings(spark, sf)))


@query("soc_rollup_l2", _soc_sql(2))
def soc_rollup_l2(spark, sf):
    days = occupation.code_days(cleaning.clean_postings(postings(spark, sf)))
    return day(occupation.daily_rolled_counts(occupation.roll_low_volume(days, level=2)))


# With weights the mean decides: below 1.2 a code is rolled up, from there on it stays.
WEIGHTED = POSTINGS + f""",
means AS (SELECT nlp_soc_code, avg(weight) AS mean_count FROM cleaned WHERE nlp_soc_code IS NOT NULL GROUP BY 1),
rolled AS (
  SELECT c.*, CASE WHEN m.mean_count < 1.2 THEN {_rolled(1).replace('nlp_soc_code', 'c.nlp_soc_code')}
              ELSE c.nlp_soc_code END AS nlp_soc_code_rolled
  FROM cleaned c LEFT JOIN means m ON m.nlp_soc_code = c.nlp_soc_code)"""


def _weighted_days(spark, sf):
    return occupation.code_days(cleaning.clean_postings(postings(spark, sf, weighted=True)))


@query("low_volume_codes", f"""WITH {WEIGHTED}
SELECT nlp_soc_code, round(mean_count, 6) + 0.0 AS mean_count FROM means WHERE mean_count < 1.2""")
def low_volume_codes(spark, sf):
    codes = occupation.low_volume_codes(_weighted_days(spark, sf), below=1.2)
    return codes.withColumn("mean_count", F.round("mean_count", 6))


@query("weighted_rollup", f"""WITH {WEIGHTED}
SELECT CAST(date AS VARCHAR) AS date, nlp_soc_code_rolled, src, CAST(sum(weight) AS BIGINT) AS job_count FROM rolled
WHERE nlp_soc_code_rolled IS NOT NULL AND date IS NOT NULL AND src IS NOT NULL
GROUP BY rolled.date, nlp_soc_code_rolled, src""")
def weighted_rollup(spark, sf):
    rolled = occupation.roll_low_volume(_weighted_days(spark, sf), below=1.2)
    return day(occupation.daily_rolled_counts(rolled))


CONSERVED = f"""WITH {WEIGHTED},
before AS (SELECT nlp_soc_code, nlp_soc_code_rolled, CAST(sum(weight) AS BIGINT) AS job_count_before FROM rolled
           WHERE nlp_soc_code IS NOT NULL GROUP BY 1, 2),
after AS (SELECT nlp_soc_code_rolled, CAST(sum(weight) AS BIGINT) AS job_count_after FROM rolled GROUP BY 1)
SELECT nlp_soc_code, nlp_soc_code_rolled, job_count_before, job_count_after
FROM before LEFT JOIN after USING (nlp_soc_code_rolled)"""


@query("rollup_conservation", CONSERVED)
def rollup_conservation(spark, sf):
    return occupation.rollup_comparison(occupation.roll_low_volume(_weighted_days(spark, sf), below=1.2))


@query("rollup_conservation_first", CONSERVED + " ORDER BY nlp_soc_code LIMIT 50")
def rollup_conservation_first(spark, sf):
    return occupation.first_comparisons(occupation.roll_low_volume(_weighted_days(spark, sf), below=1.2))


# The postings' weights enter the occupation grain alone.
@query("all_grains_weighted", f"""WITH {IMPUTED}{WEIGHTED[len(POSTINGS):]},
days AS (SELECT date, src, 'US' AS geo, correct_state AS st FROM imputed WHERE date IS NOT NULL AND src IS NOT NULL)
SELECT 'country' AS grain, CAST(date AS VARCHAR) AS date, geo AS "group", src, count(*) AS job_count
FROM days GROUP BY days.date, geo, src
UNION ALL SELECT 'state', CAST(date AS VARCHAR), st, src, count(*) FROM days WHERE st IS NOT NULL GROUP BY days.date, st, src
UNION ALL SELECT 'occupation', CAST(date AS VARCHAR), nlp_soc_code_rolled, src, CAST(sum(weight) AS BIGINT) FROM rolled
WHERE nlp_soc_code_rolled IS NOT NULL AND date IS NOT NULL AND src IS NOT NULL
GROUP BY rolled.date, nlp_soc_code_rolled, src""")
def all_grains_weighted(spark, sf):
    return day(grains.all_grains(postings(spark, sf, weighted=True), maps(spark), below=1.2))


@query("all_grains", f"""WITH {IMPUTED},
tagged AS (SELECT date, src, 'US' AS geo, correct_state AS st, {_rolled(1)} AS soc FROM imputed
           WHERE date IS NOT NULL AND src IS NOT NULL)
SELECT 'country' AS grain, CAST(date AS VARCHAR) AS date, geo AS "group", src, count(*) AS job_count
FROM tagged GROUP BY tagged.date, geo, src
UNION ALL SELECT 'state', CAST(date AS VARCHAR), st, src, count(*) FROM tagged
WHERE st IS NOT NULL GROUP BY tagged.date, st, src
UNION ALL SELECT 'occupation', CAST(date AS VARCHAR), soc, src, count(*) FROM tagged
WHERE soc IS NOT NULL GROUP BY tagged.date, soc, src""")
def all_grains(spark, sf):
    return day(grains.all_grains(postings(spark, sf), maps(spark)))
