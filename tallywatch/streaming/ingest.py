"""Incremental ingest of a stream of rows into the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.sources import ledger


def first_arrivals(stream: DataFrame, event_time: str, within: str = "30 days", key: str = "job_key") -> DataFrame:
    """Of each key the row that arrives first; copies at least up to ``within`` after it in event time go.

    The state of a key is dropped once the watermark has passed its event time by ``within``, so
    state holds the keys of that span only. A keyed row that arrives behind the watermark goes,
    copy or not. Rows without key or event time are all kept: neither can tell a copy, and no
    null key gathers rows in one task.
    """
    timed = stream.withWatermark(event_time, within)
    known = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    return timed.where(known).dropDuplicatesWithinWatermark([key]).unionByName(timed.where(~known))


def ingest(stream: DataFrame, to_daily: Callable[[DataFrame], DataFrame], group: str, ledger_path: str,
           checkpoint: str, source: str = "stream") -> StreamingQuery:
    """Turn each micro-batch into daily increments and add them to the ledger.

    A micro-batch that Spark repeats after a failure has the same id and replaces
    its own increments. Late rows are added to their day however late they are.
    """

    def add(batch: DataFrame, number: int) -> None:
        ledger.add_batch(to_daily(batch), ledger_path, group, f"{source}-{number}")

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
