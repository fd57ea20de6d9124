"""Occupation-code roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.text import rollup_soc
from tallywatch.operators.cleaning import default_job_count
from tallywatch.operators.daily import daily_sums

LOW_VOLUME = 50.0


def code_days(postings: DataFrame) -> DataFrame:
    """Postings and job counts per (date, code, src), null dates included.

    Everything below works on this table, whose size follows days and codes and
    no longer the postings.
    """
    return (
        default_job_count(postings)
        .groupBy("date", "nlp_soc_code", "src")
        .agg(F.sum("job_count").cast("long").alias("job_count"), F.count("job_count").alias("postings"))
    )


def low_volume_codes(days: DataFrame, below: float = LOW_VOLUME) -> DataFrame:
    """Codes whose mean job count per posting is below the limit."""
    return (
        days.where(F.col("nlp_soc_code").isNotNull())
        .groupBy("nlp_soc_code")
        .agg(F.try_divide(F.sum("job_count"), F.sum("postings")).alias("mean_count"))
        .where(F.col("mean_count") < below)
    )


def roll_low_volume(days: DataFrame, level: int = 1, below: float = LOW_VOLUME) -> DataFrame:
    """Add ``nlp_soc_code_rolled``: low-volume codes rolled up, the others as they are.

    The mean is taken over the whole input. Each window group holds one code's
    (date, src) rows.
    """
    code = F.col("nlp_soc_code")
    w = Window.partitionBy("nlp_soc_code")
    mean = F.try_divide(F.sum("job_count").over(w), F.sum("postings").over(w))
    return (
        days.withColumn("_mean", mean)
        .withColumn("nlp_soc_code_rolled",
                    F.when(F.col("_mean") < below, rollup_soc(code, level)).otherwise(code))
        .drop("_mean")
    )


def roll_twice(days: DataFrame, below: float = LOW_VOLUME) -> DataFrame:
    """Roll low-volume codes to level 1, then those of the result that are still low-volume to level 2.

    The second means are taken over the rolled codes. Null codes stay null.
    """
    once = roll_low_volume(days, 1, below)
    merged = once.groupBy("date", "nlp_soc_code", "nlp_soc_code_rolled", "src").agg(
        F.sum("job_count").cast("long").alias("job_count"), F.sum("postings").alias("postings"))
    names = {"nlp_soc_code": "_code", "nlp_soc_code_rolled": "nlp_soc_code"}
    twice = roll_low_volume(merged.withColumnsRenamed(names), 2, below)
    return twice.drop("nlp_soc_code").withColumnRenamed("_code", "nlp_soc_code")


def daily_rolled_counts(rolled: DataFrame) -> DataFrame:
    """Job counts per (date, rolled code, src)."""
    return daily_sums(rolled, "nlp_soc_code_rolled")


def rollup_comparison(rolled: DataFrame) -> DataFrame:
    """Per code: its rolled code and the job counts before and after the roll-up."""
    before = (
        rolled.where(F.col("nlp_soc_code").isNotNull())
        .groupBy("nlp_soc_code", "nlp_soc_code_rolled")
        .agg(F.sum("job_count").cast("long").alias("job_count_before"))
    )
    after = before.groupBy("nlp_soc_code_rolled").agg(
        F.sum("job_count_before").cast("long").alias("job_count_after")
    )
    return before.join(after, "nlp_soc_code_rolled", "left").select(
        "nlp_soc_code", "nlp_soc_code_rolled", "job_count_before", "job_count_after"
    )


def first_comparisons(rolled: DataFrame, rows: int = 50) -> DataFrame:
    """The first rows of the comparison in code order."""
    return rollup_comparison(rolled).orderBy("nlp_soc_code").limit(rows)
