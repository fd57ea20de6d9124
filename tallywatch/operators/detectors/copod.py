"""Copula score (Li et al. 2020).

For each feature the share of rows at most and at least as large as a row's value
gives two tail probabilities. Their negative logs are summed over the features
three ways, left tails, right tails, and the tail named by the sign of the
feature's skewness, and the largest sum is the score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.joins import BROADCAST_ROWS, join_frequent_apart
from tallywatch.functions.ranks import RANGE_ROWS, running_counts, value_counts
from tallywatch.operators.detectors.matrix import Matrix
from tallywatch.sources.scratch import materialise


def fit(m: Matrix, range_rows: int = RANGE_ROWS, broadcast_rows: int = BROADCAST_ROWS):
    cells = m.df.select(*m.keys, F.posexplode("x").alias("feature", "value"))
    rows = F.lit(float(m.n_rows))
    tails = materialise(
        running_counts(value_counts(cells), m.n_rows, range_rows).select(
            "feature", "value", "n",
            (-F.log(F.col("upto") / rows)).alias("left"),
            (-F.log((m.n_rows - F.col("upto") + F.col("n")) / rows)).alias("right"),
        ),
        "tails",
    )
    skews = m.df.agg(*[F.skewness(F.col("x")[i]) for i in range(m.width)]).first()
    # A constant feature has no skewness; both its tails are 0.
    leftward = [i for i, s in enumerate(skews) if s is not None and s < 0]
    skewed = F.when(F.col("feature").isin(*leftward), F.col("left")).otherwise(F.col("right"))
    found = join_frequent_apart(cells, tails, ["feature", "value"], "n", m.n_rows, broadcast_rows)
    scores = found.groupBy(*m.keys).agg(
        F.greatest(F.sum("left"), F.sum("right"), F.sum(skewed)).alias("score")
    )

    def score(df: DataFrame, name: str) -> DataFrame:
        return df.join(scores.withColumnRenamed("score", name), m.keys, "left")

    return score
