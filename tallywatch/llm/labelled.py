"""Bounded samples of labelled rows, the only thing a model is fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 40


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int, seed: int = 0) -> DataFrame:
    """At most ``per_label`` rows of each label: those whose hashed key is smallest.

    The hash cuts first, at a threshold made from the label's number of rows, so that
    only about twice the sample is ordered. Rows without a label are left out. The result
    does not depend on how rows are partitioned.
    """
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(RANGE))
    labelled = rows.where(F.col(label).isNotNull()).withColumn("_draw", draw)
    # One row per label.
    counts = {r[0]: r[1] for r in labelled.groupBy(label).agg(F.count("*")).collect()}
    near = F.lit(False)
    for value, n in counts.items():
        near = near | ((F.col(label) == F.lit(value)) & (F.col("_draw") < int(RANGE * min(1.0, 2 * per_label / n))))
    order = Window.partitionBy(label).orderBy("_draw", F.col(key), F.xxhash64(*rows.columns))
    return labelled.where(near).withColumn("_place", F.row_number().over(order)).where(
        F.col("_place") <= per_label).drop("_draw", "_place")
