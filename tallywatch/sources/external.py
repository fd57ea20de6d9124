"""Postings from a database or a message log, by configuration of Spark's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.schemas import POSTING, POSTING_COLUMNS, require_columns


def read_postings_jdbc(spark: SparkSession, url: str, table: str, split_column: str, lower: str, upper: str,
                       splits: int, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table read in parallel ranges of ``split_column``."""
    rows = spark.read.jdbc(url, table, column=split_column, lowerBound=lower, upperBound=upper,
                           numPartitions=splits, properties=properties)
    return require_columns(rows, POSTING_COLUMNS).select(*POSTING_COLUMNS)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Postings from JSON text in the column ``value``."""
    return messages.select(F.from_json(F.col("value").cast("string"), POSTING).alias("p")).select("p.*")


def stream_postings_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Postings as JSON messages of a topic; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in options.items():
        reader = reader.option(key, value)
    return parse_messages(reader.load())
