"""Exact ranks and quantiles of many columns over a table of any size.

A global rank needs an order over all rows, which one task cannot hold. Here
equal values are first merged into counts, the distinct values of each column
are cut into ranges of bounded size, running counts are taken inside each range
and the totals of the earlier ranges are added. Where the cuts fall affects only
the balance of the work, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 500_000
CUT_SAMPLE = 20_000


def stack_columns(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """One row (keys, feature, value) per non-null cell; ``feature`` is the column position."""
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*keys, F.posexplode(cells).alias("feature", "value")).where(F.col("value").isNotNull())


def value_counts(cells: DataFrame) -> DataFrame:
    """Rows per (feature, value); merged on the map side, so frequent values cost nothing extra."""
    return cells.groupBy("feature", "value").agg(F.count("*").alias("n"))


def running_counts(counts: DataFrame, n_rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``upto``: the number of cells of the feature with a value at most this one.

    ``n_rows`` bounds the distinct values of one feature; the number of ranges follows it.
    """
    ranges = -(-n_rows // range_rows)
    if ranges <= 1:
        order = Window.partitionBy("feature").orderBy("value")
        return counts.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    # The cuts come from a hash sample of the distinct values: the same rows are
    # chosen however often and wherever the sample is taken.
    every = max(1, n_rows // CUT_SAMPLE)
    probs = [i / ranges for i in range(1, ranges)]
    cuts = (
        counts.where(F.pmod(F.xxhash64("value"), F.lit(every)) == 0)
        .groupBy("feature")
        .agg(F.percentile("value", F.array(*[F.lit(p) for p in probs])).alias("cuts"))
    )
    # At most one row per feature, hence the broadcast.
    ranged = (
        counts.join(F.broadcast(cuts), "feature", "left")
        .withColumn("range", F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")),
                                             lambda c: c < F.col("value"))))
        .drop("cuts")
    )
    inside = Window.partitionBy("feature", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and feature.
    offsets = (
        ranged.groupBy("feature", "range").agg(F.sum("n").alias("total"))
        .select("feature", "range", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    )
    return (
        ranged.withColumn("upto", F.sum("n").over(inside))
        .join(F.broadcast(offsets), ["feature", "range"])
        .select("feature", "value", "n", (F.col("upto") + F.col("offset")).alias("upto"))
    )


def exact_quantiles(df: DataFrame, columns: list[str], q: float, n_rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row holding the interpolated ``q`` quantile of every column, nulls skipped; null for a column without values."""
    ranked = running_counts(value_counts(stack_columns(df, columns)), n_rows, range_rows)
    sized = ranked.groupBy("feature").agg(F.sum("n").alias("cells"))
    position = F.lit(q) * (F.col("cells") - 1)
    per_feature = (
        # At most one row per column.
        ranked.join(F.broadcast(sized), "feature")
        .groupBy("feature")
        .agg(
            F.first("cells").alias("cells"),
            F.min(F.when(F.col("upto") > F.floor(position), F.col("value"))).alias("low"),
            F.min(F.when(F.col("upto") > F.ceil(position), F.col("value"))).alias("high"),
        )
        .select("feature", (F.col("low") + (F.col("high") - F.col("low")) * (position - F.floor(position))).alias("v"))
    )
    picked = [F.max(F.when(F.col("feature") == i, F.col("v"))).alias(c) for i, c in enumerate(columns)]
    return per_feature.agg(*picked)

