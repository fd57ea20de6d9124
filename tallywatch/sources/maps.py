"""Reading the postal-code reference maps, all values as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.schemas import ZIP_FIX, ZIP_STATE, require_columns


def _read_map(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder, or else CSV with a header line in the schema's column order."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    table = require_columns(spark.read.parquet(path), schema.names)
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_zip_fix(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, zipcode, zipcode3, zipcode4); ``row_no`` is the order of precedence."""
    return _read_map(spark, path, ZIP_FIX)


def read_zip_state(spark: SparkSession, path: str) -> DataFrame:
    """(row_no, zipcode, state)."""
    return _read_map(spark, path, ZIP_STATE)
