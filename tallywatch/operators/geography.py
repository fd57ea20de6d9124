"""Postal-code repair and state imputation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import states, text
from tallywatch.functions.joins import BROADCAST_ROWS, lookup


def short_zip_table(zip_fix: DataFrame) -> DataFrame:
    """(short, fixed): the first full code listed for each three- and four-digit prefix."""

    def one(column: str, length: int) -> DataFrame:
        return zip_fix.where(
            (F.length(column) == length) & F.col("zipcode").isNotNull()
        ).select(F.col(column).alias("short"), "zipcode", "row_no")

    return (
        one("zipcode3", 3).unionByName(one("zipcode4", 4))
        .groupBy("short").agg(F.min_by("zipcode", "row_no").alias("fixed"))
    )


def zip_state_table(zip_state: DataFrame) -> DataFrame:
    """(padded, state): the last state listed for each code padded to five characters."""
    return (
        zip_state.where(F.col("zipcode").isNotNull())
        .groupBy(text.pad_zip(F.col("zipcode")).alias("padded"))
        .agg(F.max_by("state", "row_no").alias("state_of_zip"))
    )


def repair_zip(df: DataFrame, zip_fix: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Replace three- and four-character codes by the mapped code if it has five digits.

    The code as read is kept in ``original_zipcode``.
    """
    short = F.when(F.length("zipcode").isin(3, 4), F.col("zipcode"))
    looked = lookup(df.withColumn("short", short), "short", short_zip_table(zip_fix), max_rows)
    repaired = F.when(text.is_five_digits(F.col("fixed")), F.col("fixed")).otherwise(F.col("zipcode"))
    return (
        looked.withColumns({"original_zipcode": F.col("zipcode"), "zipcode": repaired})
        .drop("short", "fixed")
    )


def impute_steps(df: DataFrame, zip_state: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the state found after each rule: ``s_valid``, ``s_remote``, ``s_zip``, ``s_code``, ``s_name``.

    Rules in order: a valid state as given, the word remote as postal code, the
    state of the postal code, a state code in the location text (which also
    replaces an empty state), a full state name in the location text.
    """
    looked = lookup(
        df.withColumn("padded", text.pad_zip(F.col("zipcode"))), "padded", zip_state_table(zip_state), max_rows
    )
    location = F.col("scraped_location")
    valid = states.valid_state(F.col("state"))
    remote = F.coalesce(valid, F.when(text.is_remote(F.col("zipcode")), F.lit(states.REMOTE)))
    return (
        looked.withColumns({"s_valid": valid, "s_remote": remote})
        .withColumn("s_zip", F.coalesce("s_remote", "state_of_zip"))
        # Text is searched only in rows that no earlier rule resolved.
        .withColumn("s_code", F.when(
            F.coalesce(F.col("s_zip"), F.lit("")) == "",
            F.coalesce(states.state_code_in(location), F.col("s_zip")),
        ).otherwise(F.col("s_zip")))
        .withColumn("s_name", F.when(
            F.col("s_code").isNull(), states.state_name_in(location),
        ).otherwise(F.col("s_code")))
        .drop("padded", "state_of_zip")
    )


STEPS = ("s_valid", "s_remote", "s_zip", "s_code", "s_name")


def impute_states(df: DataFrame, zip_state: DataFrame, max_rows: int = BROADCAST_ROWS,
                  watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``correct_state``, the outcome of the whole rule cascade; ``watch`` may observe the steps."""
    steps = impute_steps(df, zip_state, max_rows)
    return (watch(steps) if watch else steps).withColumn("correct_state", F.col("s_name")).drop(*STEPS)


def use_imputed_state(df: DataFrame) -> DataFrame:
    return df.withColumn("state", F.col("correct_state")).drop("correct_state")


def funnel_metrics() -> list[Column]:
    solved = [F.coalesce(F.col(s), F.lit("")) != "" for s in STEPS]
    names = ("by_state", "by_remote", "by_zip", "by_code", "by_name")
    counts = [F.count_if(solved[0]).alias(names[0])]
    for i in range(1, len(STEPS)):
        counts.append(F.count_if(solved[i] & ~solved[i - 1]).alias(names[i]))
    return [F.count("*").alias("total_rows"), *counts, F.count_if(~solved[-1]).alias("unresolved")]


def impute_funnel(df: DataFrame, zip_state: DataFrame) -> DataFrame:
    """One row: postings resolved by each rule, and those left without a state."""
    return impute_steps(df, zip_state).agg(*funnel_metrics())


def zip_lengths(df: DataFrame) -> DataFrame:
    """Postings per length of postal code; a missing code has no length."""
    return (
        df.where(F.col("zipcode").isNotNull())
        .groupBy(F.length("zipcode").alias("zip_length"))
        .agg(F.count("*").alias("n"))
    )
