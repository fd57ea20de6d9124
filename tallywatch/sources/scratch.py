"""The shared folder for intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Like Spark's own checkpoints, what is
    written there stays until the folder is cleared.

    Only a local-mode session may go without the setting; it then gets a
    temporary folder, because driver and executors share one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tallywatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{scratch_root(spark)}/tallywatch/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs read one intermediate result: the files outlive a
    lost executor, cut the lineage and carry sizes for join planning.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Hash-partition by ``columns`` into the session's shuffle partitions, all cores at least.

    For steps that are heavy per row: merging partitions by their size in bytes
    would leave such work to a few tasks. A later window or grouping on the same
    columns needs no further shuffle.
    """
    spark = df.sparkSession
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(partitions, *columns)
