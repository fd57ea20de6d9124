"""Reading raw postings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.schemas import POSTING, POSTING_COLUMNS, require_columns


def read_postings(spark: SparkSession, path: str, columns: Iterable[str] = POSTING_COLUMNS,
                  with_job_count: bool = False) -> DataFrame:
    """The listed columns of a Parquet data set, all of which must be present.

    Only the file footers are read here; later projections prune the scan further.
    """
    wanted = [*columns, "job_count"] if with_job_count else list(columns)
    table = require_columns(spark.read.parquet(path), wanted)
    types = {f.name: f.dataType for f in POSTING.fields}
    return table.select(*[
        F.col(c).cast(types[c]).alias(c) if c in types else F.col(c).cast("long").alias(c) for c in wanted
    ])


def stream_postings(spark: SparkSession, path: str, files_per_batch: int | None = None,
                    columns: Iterable[str] = POSTING_COLUMNS) -> DataFrame:
    """The same table as an unbounded stream of new files in a folder."""
    reader = spark.readStream.schema(POSTING)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*columns)
