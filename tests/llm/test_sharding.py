"""Shards against the same rule in DuckDB, and the cases no split can help."""

import pytest
from pyspark.sql import functions as F

from tallywatch.llm import sharding
from tests import oracle
from tests.llm import edge

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("limit", [1 << 24, 60_000, 25_000])
def test_matches_sql(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = oracle.from_spark(sharding.assign_shards(docs, limit=limit).select("doc_id", "n_bytes", "depth", "shard_bytes", "shard"))
    assert got == oracle.from_sql(oracle.connect(SF), sharding.shards_sql(limit))


def check(out, limit):
    groups = out.groupBy("shard").agg(F.sum("n_bytes").alias("total"), F.count("*").alias("n"), F.max("shard_bytes").alias("said")).collect()
    assert all(g["total"] == g["said"] and (g["total"] <= limit or g["n"] == 1) for g in groups)
    return len(groups)


@pytest.mark.parametrize("limit", [200_000, 7_000, 500])
def test_odd_rows(spark, limit):
    docs = edge.docs(spark)
    out = sharding.assign_shards(docs, limit=limit)
    assert out.count() == docs.count()
    check(out, limit)
    assert set(docs.columns) <= set(out.columns)
    assert sharding.assign_shards(edge.empty(spark)).count() == 0


def test_one_id_overflows(spark):
    docs = spark.range(400).select(F.lit(5).cast("long").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"))
    out = sharding.assign_shards(docs, limit=1000)
    assert out.count() == 400 and check(out, 1000) <= 100


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = sharding.assign_shards(docs, limit=60_000)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == placed.select("shard").distinct().count()
