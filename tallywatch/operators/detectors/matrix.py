"""The common input of all detectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.ranks import exact_quantiles
from tallywatch.operators.features import FEATURES
from tallywatch.sources.scratch import materialise

DECIMALS = 9


class DetectorDataError(ValueError):
    """The data cannot be fitted or scored by this detector; the others of an ensemble go on without it.

    Anything else that a detector raises, a failed Spark job above all, ends the run.
    """


@dataclass(frozen=True)
class Matrix:
    """``df`` has the segment keys, ``job_count`` and the array ``x`` without nulls."""

    df: DataFrame
    group: str
    features: tuple[str, ...]
    n_rows: int

    @property
    def keys(self) -> list[str]:
        return [self.group, "src", "date"]

    @property
    def width(self) -> int:
        return len(self.features)


def build_matrix(features: DataFrame, group: str, columns: tuple[str, ...] = FEATURES) -> Matrix:
    """Fill each null feature with the median of its column and write the result.

    The medians are over all segments. A column without any value becomes 0. Values
    are rounded to nine decimals, so that ranks see equal values as equal. Detectors
    read the matrix many times, hence the written tables.
    """
    cells = F.array(*[F.round(F.col(c).cast("double"), DECIMALS) for c in columns])
    stored = materialise(features.select(group, "src", "date", "job_count", cells.alias("cells")), "features")
    n_rows = stored.count()
    spread = stored.select(*[F.col("cells")[i].alias(f"f{i}") for i in range(len(columns))])
    medians = exact_quantiles(spread, spread.columns, 0.5, n_rows).first()
    fill = F.array(*[F.lit(float(v) if v is not None else 0.0) for v in medians])
    x = F.zip_with("cells", fill, lambda value, median: F.coalesce(value, median))
    matrix = materialise(stored.select(group, "src", "date", "job_count", x.alias("x")), "matrix")
    return Matrix(matrix, group, tuple(columns), n_rows)
