"""Histogram score (Goldstein and Dengel 2012).

Each feature gets equal-width bins over its range; a row's score is the sum of the
negative logs of its bins' densities. The model is one number per feature and bin.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.detectors.matrix import Matrix

BINS = 10
SMOOTHING = 0.1


def fit(m: Matrix, bins: int = BINS, smoothing: float = SMOOTHING):
    x = F.col("x")
    ranges = m.df.agg(
        F.array(*[F.min(x[i]) for i in range(m.width)]).alias("lo"),
        F.array(*[F.max(x[i]) for i in range(m.width)]).alias("hi"),
    ).first()
    lo, hi = ranges["lo"], ranges["hi"]

    def slot(i: int) -> Column:
        """Position of the row's bin of feature ``i`` among all bins of all features."""
        if not hi[i] > lo[i]:
            return F.lit(i * bins)
        steps = F.floor((x[i] - lo[i]) / ((hi[i] - lo[i]) / bins)).cast("int")
        return i * bins + F.least(steps, F.lit(bins - 1))

    slots = F.array(*[slot(i) for i in range(m.width)])
    counts = m.df.select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).collect()
    terms = [0.0] * (m.width * bins)
    for row in counts:
        i = row["slot"] // bins
        # A constant feature tells rows apart by nothing.
        if hi[i] > lo[i]:
            terms[row["slot"]] = -math.log2(row["n"] / m.n_rows / ((hi[i] - lo[i]) / bins) + smoothing)
    table = F.array(*[F.lit(t) for t in terms])

    def score(df: DataFrame, name: str) -> DataFrame:
        total = F.aggregate(slots, F.lit(0.0), lambda acc, s: acc + F.get(table, s))
        return df.withColumn(name, total)

    return score
