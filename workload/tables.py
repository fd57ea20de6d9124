"""The tables the registered queries run on, in Spark and as SQL text.

Daily series come straight from ``events``, ``orders`` and ``lineitem``. Raw
postings have no counterpart in the given tables, so they are derived from every
row of ``orders`` by arithmetic that both engines share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators import daily
from tallywatch.plans.grains import Maps
from tallywatch.schemas import POSTING_COLUMNS, ZIP_FIX, ZIP_STATE

STATES = ["CA", "NY", "TX", "WA", "XX", None, "", "Ontario"]
ZIPS = ["94105", "941", "2139", "Remote ", None, "10001-1234", "99999"]
LOCATIONS = [
    "San Jose, CA", "charleston, west virginia", "NewYork metro", "London, UK", None,
    "Arkansas City, Kansas", "WASHINGTON", "Remote in us", "District of Columbia", "CAT, Inc", "Guam",
]
FIX_ROWS = [(1, "94105", "941", None), (2, "94107", "941", None), (3, "02139", None, "2139")]
STATE_ROWS = [(1, "94105", "CA"), (2, "2139", "MA"), (3, "10001", "NJ"), (4, "10001", "NY")]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text, so that both engines return the same type."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns or ("date",)})


def r6(column) -> F.Column:
    """Six decimals, and never a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), 6) + F.lit(0.0)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with date, group and source."""
    return load(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("date"),
        F.concat(F.lit("G"), F.col("user_id") % 5).alias("grp"),
        F.col("event_type").alias("src"),
    )


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_counts(event_rows(spark, sf_dir), "grp")


def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("grp"), F.col("o_orderstatus").alias("src"),
    )
    return daily.daily_counts(rows, "grp")


def lineitem_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("grp"), F.col("l_linestatus").alias("src"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    return daily.daily_sums(rows, "grp", "quantity")


def _choose(values: list, index) -> F.Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def postings(spark: SparkSession, sf_dir: str, weighted: bool = False) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    start = F.lit("2024-10-01").cast("date")
    offset = (k % 90).cast("int")
    scraped = F.concat(F.date_format(F.date_add(start, offset), "yyyy-MM-dd"), F.lit(" 08:30:00"))
    columns = {
        "job_key": F.concat(F.lit("job-"), F.when(k % 50 == 1, k - 1).otherwise(k).cast("string")),
        "state": _choose(STATES, c % 8),
        "zipcode": _choose(ZIPS, k % 7),
        "correct_date": F.date_format(F.date_add(start, offset + 1), "yyyy-MM-dd"),
        "first_scrape_timestamp": F.when(k % 10 == 0, "not-a-date").when(k % 10 == 1, None).otherwise(scraped),
        "scraped_location": _choose(LOCATIONS, k % 11),
        "src": F.col("o_orderpriority"),
        "nlp_soc_code": F.when(k % 17 == 0, None).when(k % 13 == 0, "151032").otherwise(
            F.concat((11 + 2 * (k % 5)).cast("string"), F.lit("-"), (1010 + c % 40).cast("string"))),
        "scrape_method": F.lit("derived"),
        "db_insert_timestamp": F.lit(None).cast("string"),
    }
    weight = [F.when(k % 90 == 60, 20).otherwise(1).cast("long").alias("job_count")] if weighted else []
    return load(spark, sf_dir, "orders").select(*[columns[n].alias(n) for n in POSTING_COLUMNS], *weight)


def maps(spark: SparkSession) -> Maps:
    return Maps(spark.createDataFrame(FIX_ROWS, ZIP_FIX), spark.createDataFrame(STATE_ROWS, ZIP_STATE))


# ---- the same tables as SQL ----

def sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def sql_rows(rows: list[tuple]) -> str:
    def one(v):
        return "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"

    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


EVENT_ROWS = """
event_rows AS (
  SELECT event_id, CAST(ts AS DATE) AS date, 'G' || CAST(user_id % 5 AS VARCHAR) AS grp, event_type AS src
  FROM events
)"""

EVENTS_DAILY = EVENT_ROWS + """,
daily AS (
  SELECT date, grp, src, count(*) AS job_count FROM event_rows
  WHERE date IS NOT NULL AND grp IS NOT NULL AND src IS NOT NULL GROUP BY date, grp, src
)"""

ORDERS_DAILY = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS grp, o_orderstatus AS src, count(*) AS job_count
  FROM orders
  WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL
  GROUP BY 1, 2, 3
)"""

LINEITEM_DAILY = """
daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS grp, l_linestatus AS src,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS job_count
  FROM lineitem
  WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
  GROUP BY 1, 2, 3
)"""

POSTINGS = f"""
postings AS (
  SELECT 'job-' || CAST(CASE WHEN k % 50 = 1 THEN k - 1 ELSE k END AS VARCHAR) AS job_key,
         ({sql_list(STATES)})[CAST(c % 8 AS INTEGER) + 1] AS state,
         ({sql_list(ZIPS)})[CAST(k % 7 AS INTEGER) + 1] AS zipcode,
         CAST(DATE '2024-10-01' + CAST(k % 90 AS INTEGER) + 1 AS VARCHAR) AS correct_date,
         CASE k % 10 WHEN 0 THEN 'not-a-date' WHEN 1 THEN NULL
              ELSE CAST(DATE '2024-10-01' + CAST(k % 90 AS INTEGER) AS VARCHAR) || ' 08:30:00' END
              AS first_scrape_timestamp,
         ({sql_list(LOCATIONS)})[CAST(k % 11 AS INTEGER) + 1] AS scraped_location,
         p AS src,
         CASE WHEN k % 17 = 0 THEN NULL WHEN k % 13 = 0 THEN '151032'
              ELSE CAST(11 + 2 * (k % 5) AS VARCHAR) || '-' || CAST(1010 + c % 40 AS VARCHAR) END AS nlp_soc_code,
         CASE WHEN k % 90 = 60 THEN 20 ELSE 1 END AS weight
  FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p FROM orders)
),
cleaned AS (
  SELECT *, CAST(coalesce(try_cast(first_scrape_timestamp AS TIMESTAMP), CAST(correct_date AS TIMESTAMP)) AS DATE)
         AS date
  FROM postings
)"""
