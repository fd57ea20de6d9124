"""Event-time repair, validation and quality checks of raw postings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions import dates
from tallywatch.schemas import POSTING_COLUMNS

EVENT_TIME = "correct_date_filled"


def drop_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows with a null in any grouping key take no part in an aggregate."""
    return df.dropna(subset=list(keys))


def rebuild_event_time(df: DataFrame) -> DataFrame:
    """Event time from the first scrape, in any known layout; other text becomes null."""
    return df.withColumn(EVENT_TIME, dates.mixed_timestamp(F.col("first_scrape_timestamp")))


def fill_event_time(df: DataFrame) -> DataFrame:
    """Fill a missing event time from ``correct_date``, which must parse if present."""
    fallback = dates.strict_timestamp(F.col("correct_date"))
    return df.withColumn(EVENT_TIME, F.coalesce(F.col(EVENT_TIME), fallback))


def with_day(df: DataFrame) -> DataFrame:
    """Add the day key ``date``; without an event time it is null."""
    return df.withColumn("date", F.to_date(EVENT_TIME))


def clean_postings(df: DataFrame) -> DataFrame:
    """Event time, its fallback and the day key, in one projection."""
    return with_day(fill_event_time(rebuild_event_time(df)))


def default_job_count(df: DataFrame) -> DataFrame:
    """A posting without a ``job_count`` column counts as one."""
    return df if "job_count" in df.columns else df.withColumn("job_count", F.lit(1).cast("long"))


def tag_country(df: DataFrame, tag: str = "US") -> DataFrame:
    return df.withColumn("geo_level", F.lit(tag))


def first_copies(df: DataFrame, copies) -> DataFrame:
    """Of each window of ``copies`` the posting scraped first.

    Times are compared, not text; a posting without a time comes after all others, and
    further ties go by the other columns. The rank filter drops copies before the
    shuffle, so a key with very many is no hot spot.
    """
    scraped = dates.mixed_timestamp(F.col("first_scrape_timestamp"))
    # Maps have no order of their own.
    ties = [F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
            for f in df.schema.fields if f.name not in ("job_key", "_own")]
    first = copies.orderBy(F.col("_scraped").asc_nulls_last(), *ties)
    return (
        df.withColumn("_scraped", scraped)
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_scraped", "_rank")
    )


def dedup_postings(df: DataFrame) -> DataFrame:
    """Optional: keep one posting per ``job_key``, the one scraped first.

    Postings without a key are all kept: each is a group of its own. One scan.
    """
    own = F.when(F.col("job_key").isNull(), F.monotonically_increasing_id())
    return first_copies(df.withColumn("_own", own), Window.partitionBy("job_key", "_own")).drop("_own")


def null_metrics(columns: Iterable[str]) -> list[Column]:
    return [F.count("*").alias("total_rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in columns]]


def null_counts(df: DataFrame, columns: Iterable[str] = POSTING_COLUMNS) -> DataFrame:
    """One row: total rows and the nulls of each column."""
    return df.agg(*null_metrics(columns))


def event_time_metrics() -> list[Column]:
    parsed = dates.mixed_timestamp(F.col("first_scrape_timestamp"))
    fallback = dates.strict_timestamp(F.col("correct_date"))
    return [
        F.count_if(parsed.isNull()).alias("missing_first"),
        F.count_if(parsed.isNull() & fallback.isNotNull()).alias("filled"),
        F.count_if(parsed.isNull() & fallback.isNull()).alias("missing_last"),
    ]


def event_time_report(df: DataFrame) -> DataFrame:
    """One row: event times missing after the first parse, filled, and still missing."""
    return df.agg(F.count("*").alias("total_rows"), *event_time_metrics())


def quality_flags(daily: DataFrame, group: str, lo, hi, valid_group=None) -> DataFrame:
    """One boolean column per rule; a null value fails the rules on that value.

    ``lo`` and ``hi`` bound the dates, both ends allowed. ``valid_group`` maps the
    group column to a boolean column.
    """
    valid = valid_group(F.col(group)) if valid_group else F.col(group).isNotNull()
    return daily.withColumns({
        "has_values": F.col("date").isNotNull() & F.col(group).isNotNull()
        & F.col("src").isNotNull() & F.col("job_count").isNotNull(),
        "date_in_range": F.coalesce(F.col("date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), F.lit(False)),
        "count_positive": F.coalesce(F.col("job_count") > 0, F.lit(False)),
        "group_valid": F.coalesce(valid, F.lit(False)),
    })


def quality_report(daily: DataFrame, group: str, lo, hi, valid_group=None) -> DataFrame:
    """One row: rows, and rows that break each rule."""
    flags = quality_flags(daily, group, lo, hi, valid_group)
    rules = ("has_values", "date_in_range", "count_positive", "group_valid")
    return flags.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(~F.col(r)).alias(f"not_{r}") for r in rules],
    )


def segment_floors(daily: DataFrame, group: str, as_of=None, lookback_days: int | None = 30,
                   min_volume: int | None = 10, min_variance: float | None = 0.5,
                   max_code_length: int | None = None) -> DataFrame:
    """Optional segment filters: keep the rows of segments that pass every floor set.

    ``lookback_days`` before ``as_of`` restricts rows first; a segment then needs
    ``min_volume`` in total and a population variance of ``min_variance``.
    """
    rows = daily
    if as_of is not None and lookback_days is not None:
        end = F.lit(as_of).cast("date")
        rows = rows.where((F.col("date") > F.date_sub(end, lookback_days)) & (F.col("date") <= end))
    if max_code_length is not None:
        rows = rows.where(F.length(F.col(group)) <= max_code_length)
    segment = Window.partitionBy(group, "src")
    tests = []
    if min_volume is not None:
        rows = rows.withColumn("_volume", F.sum("job_count").over(segment))
        tests.append(F.col("_volume") >= min_volume)
    if min_variance is not None:
        rows = rows.withColumn("_variance", F.var_pop("job_count").over(segment))
        tests.append(F.col("_variance") >= min_variance)
    for test in tests:
        rows = rows.where(test)
    return rows.drop("_volume", "_variance")
