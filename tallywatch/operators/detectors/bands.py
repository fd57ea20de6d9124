"""Fixed-threshold statistical detectors, plain expressions over the features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Z_THRESHOLD = 2.5
BAND_MULTIPLIER = 1.5


def zscore(features: DataFrame, threshold: float = Z_THRESHOLD, z: str = "z_28") -> DataFrame:
    """``score_z`` is the absolute z-score, ``is_anomaly`` is 1 from the threshold upwards."""
    return features.withColumn("score_z", F.abs(z)).withColumn(
        "is_anomaly", F.coalesce((F.col("score_z") >= threshold).cast("int"), F.lit(0))
    )


def band(features: DataFrame, multiplier: float = BAND_MULTIPLIER, mean: str = "mean_28",
         std: str = "std_28") -> DataFrame:
    """Flag counts further than ``multiplier`` rolling deviations from the rolling mean."""
    reach = multiplier * F.col(std)
    return features.withColumns({
        "band_low": F.col(mean) - reach,
        "band_high": F.col(mean) + reach,
    }).withColumn(
        "is_anomaly", (~F.col("job_count").between(F.col("band_low"), F.col("band_high"))).cast("int")
    )
