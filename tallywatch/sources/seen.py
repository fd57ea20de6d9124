"""The keys of postings counted so far, so that a posting counts once over all batches.

A folder beside the ledger holds one row per key with its ``owner``, the batch that counted
it. It is a bucketed Parquet table: keys lie by their hash in a fixed number of buckets, so a
new batch is shuffled to the buckets and the keys of earlier batches are not shuffled at all.
With as many buckets as the session has shuffle partitions, ranking the copies within the
batch uses that same shuffle.

Each batch writes a partition of its own and replaces it when repeated; its own earlier keys
do not count as seen. One batch is added at a time: two at once might both own a key.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.operators.cleaning import first_copies
from tallywatch.sources.scratch import materialise

KEY = "job_key"
COMPACTED = "compacted"


def _buckets(spark: SparkSession, path: str, wanted: int | None) -> int:
    """The number of buckets is fixed when the folder is first used."""
    layout = f"{path}/layout"
    try:
        return spark.read.schema("buckets int").json(layout).first()["buckets"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    count = wanted or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The folder must exist before its partitions are listed; an empty write makes it.
    spark.createDataFrame([], f"{KEY} string, part string").write.mode("ignore").partitionBy("part").parquet(f"{path}/keys")
    spark.range(1).select(F.lit(count).alias("buckets")).coalesce(1).write.json(layout)
    return count


def _table(spark: SparkSession, path: str, buckets: int | None = None) -> tuple[str, int]:
    """Name of the session's table over the folder, with all partitions known, and its buckets."""
    count = _buckets(spark, path, buckets)
    name = f"tallywatch_seen_{hashlib.md5(path.encode()).hexdigest()}"
    place = f"{path}/keys".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({KEY} STRING, owner STRING, part STRING) USING parquet "
        f"PARTITIONED BY (part) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {count} BUCKETS LOCATION '{place}'")
    # Another session may have added batches since.
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name, count


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """(job_key, owner, part) of all batches; empty if there is none yet."""
    return spark.table(_table(spark, path)[0])


def _write(keys: DataFrame, path: str, part: str) -> None:
    """Replace one partition; each bucket is one sorted file."""
    spark = keys.sparkSession
    name, count = _table(spark, path)
    keys.repartition(count, KEY).createOrReplaceTempView(f"{name}_new")
    quoted = part.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (part = '{quoted}') SELECT {KEY}, owner FROM {name}_new")
    spark.catalog.dropTempView(f"{name}_new")


def unseen(postings: DataFrame, path: str, batch_id: str, buckets: int | None = None) -> DataFrame:
    """Of each key the posting scraped first, if no other batch owns the key.

    Postings without a key are all kept; they take no part in the shuffle. Nothing is recorded.
    """
    name, _ = _table(postings.sparkSession, path, buckets)
    others = postings.sparkSession.table(name).where(F.col("owner") != batch_id).select(KEY)
    keyed = first_copies(postings.where(F.col(KEY).isNotNull()), Window.partitionBy(KEY))
    # Old keys are read where they lie, whatever their number, unless the planner finds them small.
    return keyed.join(others, KEY, "left_anti").select(*[f"`{c}`" for c in postings.columns]).unionByName(
        postings.where(F.col(KEY).isNull()))


def claim(postings: DataFrame, path: str, batch_id: str, buckets: int | None = None) -> DataFrame:
    """Record the unseen keys of a batch as its own and return its unseen postings.

    Keys are recorded before anything is counted: a run that stops in between must be repeated
    under the same id, which gives the same postings again. A repeat with other postings gives
    up the keys it no longer has; other batches that left them out are not counted anew.
    """
    if batch_id == COMPACTED:
        raise ValueError(f"{COMPACTED!r} is not a batch id")
    fresh = materialise(unseen(postings, path, batch_id, buckets), "unseen")
    keys = fresh.where(F.col(KEY).isNotNull()).select(KEY, F.lit(batch_id).alias("owner"))
    _write(keys, path, batch_id)
    return fresh


def compact(spark: SparkSession, path: str, new_path: str, buckets: int | None = None) -> None:
    """Write the same keys and owners as one partition of a new folder, also with other buckets.

    A batch repeated afterwards still finds its own keys; keys it no longer has stay its own.
    """
    _table(spark, new_path, buckets)
    _write(read_seen(spark, path).select(KEY, "owner").distinct(), new_path, COMPACTED)
