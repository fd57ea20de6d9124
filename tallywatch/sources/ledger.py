"""The daily history as an append-only ledger of increments.

A ledger is a Parquet folder with one partition per ``batch_id``. Adding a batch
replaces the partition of that batch only, so a replayed batch counts once and a
new one adds to the sums. Readers add up the increments of each (date, segment).

Beside each increment lie its bounds: the last dates of each segment, at most ``BOUND_DATES``. ``load_history`` finds from them which increments can hold one of a segment's newest
dates and reads no others. A batch without bounds is always read; the bounds of a batch are
emptied before its increments change, so a run that stops in between is safe.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators import history
from tallywatch.operators.daily import daily_sums
from tallywatch.schemas import conform, daily

COMPACTED = "compacted"
#: So many dates of a segment are named in an increment's bounds.
BOUND_DATES = history.HISTORY_DATES


def _increments(path: str) -> str:
    return f"{path}/increments"


def _absorbed(path: str) -> str:
    return f"{path}/absorbed"


def _bounds(path: str) -> str:
    return f"{path}/bounds"


def _bounds_schema(group: str) -> T.StructType:
    return T.StructType([
        T.StructField(group, T.StringType()), T.StructField("src", T.StringType()),
        T.StructField("dates", T.ArrayType(T.DateType()))])


def _ids() -> T.StructType:
    return T.StructType([T.StructField("batch_id", T.StringType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet folder, or an empty table where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_increments(spark: SparkSession, path: str, group: str) -> DataFrame:
    """All increments with their ``batch_id``; empty if there is no ledger yet."""
    return _read(spark, _increments(path), T.StructType([*daily(group).fields, *_ids().fields]))


def absorbed_batches(spark: SparkSession, path: str) -> DataFrame:
    """Ids of the batches merged by a compaction."""
    return _read(spark, _absorbed(path), _ids())


def is_absorbed(spark: SparkSession, path: str, batch_id: str) -> bool:
    return not absorbed_batches(spark, path).where(F.col("batch_id") == batch_id).isEmpty()


def read_bounds(spark: SparkSession, path: str, group: str) -> DataFrame:
    """(group, src, dates, batch_id), newest dates first, of the increments that have bounds."""
    return _read(spark, _bounds(path), T.StructType([*_bounds_schema(group).fields, *_ids().fields]))


def _batch_folder(root: str, batch_id: str) -> str:
    return f"{root}/batch_id={quote(batch_id, safe='')}"


def _clear_bounds(spark: SparkSession, path: str, group: str, batch_id: str) -> None:
    spark.createDataFrame([], _bounds_schema(group)).write.mode("overwrite").parquet(_batch_folder(_bounds(path), batch_id))


def _write_bounds(spark: SparkSession, path: str, group: str, batch_id: str) -> None:
    """The bounds of a batch from its increments as they were written: one row for each date of a segment."""
    rows = _read(spark, _batch_folder(_increments(path), batch_id), daily(group))
    newest = F.slice(F.sort_array(F.collect_list("date"), asc=False), 1, BOUND_DATES)
    rows.groupBy(group, "src").agg(newest.alias("dates")).write.mode("overwrite").parquet(_batch_folder(_bounds(path), batch_id))


def add_batch(counts: DataFrame, path: str, group: str, batch_id: str) -> bool:
    """Record the daily counts of one batch; returns False if a compaction holds it already."""
    spark = counts.sparkSession
    if batch_id == COMPACTED:
        raise ValueError(f"{COMPACTED!r} is not a batch id")
    if is_absorbed(spark, path, batch_id):
        return False
    rows = conform(daily_sums(counts, group), daily(group))
    # Sorted by date, so that files can be skipped by their date range. The batch's folder
    # is named here and replaced as a whole, also by a replay without any row.
    _clear_bounds(spark, path, group, batch_id)
    rows.sortWithinPartitions("date").write.mode("overwrite").parquet(_batch_folder(_increments(path), batch_id))
    _write_bounds(spark, path, group, batch_id)
    return True


def read_history(spark: SparkSession, path: str, group: str) -> DataFrame:
    """One row per (date, group, src) with the sum over all batches."""
    return daily_sums(read_increments(spark, path, group), group)


def segment_starts(bounds: DataFrame, group: str, n_dates: int) -> DataFrame:
    """(group, src, start): a date from which on a segment surely has ``n_dates`` dates, null if none is sure.

    Up to ``BOUND_DATES`` it is the oldest of the segment's newest dates over all increments.
    For more dates it may lie before that one, never after it.
    """
    known = bounds.select(group, "src", F.explode("dates").alias("date")).distinct()
    newest = Window.partitionBy(group, "src").orderBy(F.col("date").desc())
    kept = known.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n_dates)
    return kept.groupBy(group, "src").agg(F.when(F.count("*") == n_dates, F.min("date")).alias("start"))


def recent_increments(spark: SparkSession, path: str, group: str, n_dates: int = history.HISTORY_DATES) -> DataFrame:
    """Every increment row of each segment's newest ``n_dates`` dates, and some older ones.

    Batches that end before the start of every segment in them are left out by their folder.
    Their ids, at most one for each folder that Spark lists anyway, pass through the driver.
    """
    rows = read_increments(spark, path, group)
    bounds = read_bounds(spark, path, group)
    starts = segment_starts(bounds, group, n_dates)
    # Without a start all of a segment's increments are needed. Keys are never null in a ledger.
    needed = F.col("start").isNull() | (F.col("dates")[0] >= F.col("start"))
    old = bounds.join(starts, [group, "src"]).groupBy("batch_id").agg(F.bool_or(needed).alias("needed")).where(~F.col("needed"))
    skipped = [row["batch_id"] for row in old.select("batch_id").toLocalIterator()]
    return rows.where(~F.col("batch_id").isin(skipped)) if skipped else rows


def load_history(spark: SparkSession, path: str, group: str, n_dates: int = history.HISTORY_DATES) -> DataFrame:
    """The history trimmed to the newest dates of each segment, from the increments that can hold them.

    Sums of older days may lack increments that were not read; the trim drops these days.
    """
    return history.last_n_dates(daily_sums(recent_increments(spark, path, group, n_dates), group), group, n_dates)


def compact(spark: SparkSession, path: str, new_path: str, group: str, as_of=None,
            retention_days: int | None = None) -> None:
    """Write a smaller ledger with the same sums to a new folder.

    With ``as_of`` and ``retention_days`` older days are left out. The merged batch
    ids are kept, so that a late replay still counts once.
    """
    rows = read_history(spark, path, group)
    if retention_days is not None:
        rows = history.retain_days(rows, as_of, retention_days)
    ids = read_increments(spark, path, group).select("batch_id").where(F.col("batch_id") != COMPACTED).distinct()
    rows.withColumn("batch_id", F.lit(COMPACTED)).sortWithinPartitions("date").write.partitionBy(
        "batch_id").parquet(_increments(new_path))
    _write_bounds(spark, new_path, group, COMPACTED)
    ids.unionByName(absorbed_batches(spark, path)).distinct().write.parquet(_absorbed(new_path))


def clear(spark: SparkSession, path: str, group: str) -> None:
    """Empty the ledger, its record of merged batches included."""
    # Bounds first: those of increments that are gone would move the starts of segments.
    spark.createDataFrame([], T.StructType([*_bounds_schema(group).fields, *_ids().fields])).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("batch_id").parquet(_bounds(path))
    empty = spark.createDataFrame([], T.StructType([*daily(group).fields, *_ids().fields]))
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "batch_id").parquet(_increments(path))
    spark.createDataFrame([], _ids()).write.mode("overwrite").parquet(_absorbed(path))
