"""A cleaning pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

1. toxicity: documents whose likeliest window reaches the threshold go.
2. near duplicates: of each SimHash group the document with the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: what is left is mixed to source weights; a document stays with the words that
   each pass through its source takes, a document taken whole with its text unchanged.
5. sharding: every document of the mix gets its shard.

The first four return the columns of ``documents``, the last adds size, shard, depth and
shard size. Each stage reads all that the one before it kept. The toxicity model is fitted
on all labelled documents of the input, not on those of a sample kept apart. An empty
table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm import decontaminate, mixing, sharding, simhash, toxicity
from tallywatch.llm.words import load
from tallywatch.sources.scratch import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, net)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    blocks = decontaminate.fit(docs, load(spark, sf_dir, "benchmark"))
    return decontaminate.keep_clean(docs, blocks)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Neither the trained network nor the fingerprints can be written in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
