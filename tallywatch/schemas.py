"""Explicit schemas of the inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POSTING_COLUMNS = (
    "job_key", "state", "zipcode", "correct_date", "first_scrape_timestamp",
    "scraped_location", "src", "nlp_soc_code", "scrape_method", "db_insert_timestamp",
)

POSTING = T.StructType([T.StructField(c, T.StringType()) for c in POSTING_COLUMNS])

ZIP_FIX = T.StructType([
    T.StructField("row_no", T.LongType()),
    T.StructField("zipcode", T.StringType()),
    T.StructField("zipcode3", T.StringType()),
    T.StructField("zipcode4", T.StringType()),
])

ZIP_STATE = T.StructType([
    T.StructField("row_no", T.LongType()),
    T.StructField("zipcode", T.StringType()),
    T.StructField("state", T.StringType()),
])


def daily(group: str) -> T.StructType:
    """Schema of one row per (date, segment)."""
    return T.StructType([
        T.StructField("date", T.DateType()),
        T.StructField(group, T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("job_count", T.LongType()),
    ])


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail fast when a column is missing, instead of reading it as null."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check presence and cast to ``schema``, in its column order.

    Values that do not parse raise, except ``job_count``, where a bad number
    becomes null for the quality report to count.
    """
    require_columns(df, schema.names)
    casts = []
    for field in schema.fields:
        col = df[field.name]
        if field.name == "job_count" and isinstance(df.schema["job_count"].dataType, T.StringType):
            casts.append(col.try_cast(field.dataType).alias(field.name))
        else:
            casts.append(col.cast(field.dataType).alias(field.name))
    return df.select(*casts)
