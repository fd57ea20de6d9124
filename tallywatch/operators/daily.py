"""Daily counts per segment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key(df: DataFrame, keys: list[str], count: Column) -> DataFrame:
    """``count`` as ``job_count`` per combination of keys without a null.

    The null groups are left out after counting, by a flag that is itself an
    aggregate. A filter on the keys would be pushed below the projections that
    compute them, and every date would be parsed and every state imputed twice.
    """
    gap = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys).agg(count.alias("job_count"), F.bool_or(gap).alias("_gap"))
        .where(~F.col("_gap")).drop("_gap")
    )


def daily_counts(df: DataFrame, group: str) -> DataFrame:
    """Rows per (date, group, src)."""
    return per_key(df, ["date", group, "src"], F.count("*"))


def daily_sums(df: DataFrame, group: str, value: str = "job_count") -> DataFrame:
    """Sum of ``value`` per (date, group, src)."""
    return per_key(df, ["date", group, "src"], F.sum(value).cast("long"))


def multi_grain_counts(df: DataFrame, grains: dict[str, str]) -> DataFrame:
    """All grains from one pass: (grain, date, group, src, job_count).

    ``grains`` names the group column of each grain. The rows are first counted at
    the finest grain, so only counts, not rows, are repeated once per grain. A null
    group leaves out the row in that grain only.
    """
    finest = df.groupBy("date", "src", *dict.fromkeys(grains.values())).agg(F.count("*").alias("job_count"))
    variants = F.array(*[
        F.struct(F.lit(name).alias("grain"), F.col(column).cast("string").alias("group"))
        for name, column in grains.items()
    ])
    every = finest.select("date", "src", "job_count", F.inline(variants))
    return per_key(every, ["grain", "date", "group", "src"], F.sum("job_count").cast("long"))


def accumulate(increments: list[DataFrame], group: str) -> DataFrame:
    """Add up increments of the same (date, group, src) from several batches."""
    keys = ["date", group, "src"]
    total = increments[0].select(*keys, "job_count")
    for part in increments[1:]:
        total = total.unionByName(part.select(*keys, "job_count"))
    return daily_sums(total, group)
