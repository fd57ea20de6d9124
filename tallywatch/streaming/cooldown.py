"""The alert cooldown as state carried from batch to batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallywatch.operators.cleaning import drop_null_keys

_EPOCH = dt.date(1970, 1, 1)


def stream_cooldown(alerts: DataFrame, group: str, days: int = 1) -> DataFrame:
    """(group, src, date) of the alerts kept, from a stream of alert days.

    The state of a segment is its last kept day. Each segment's days must arrive in
    date order across batches; within a batch they are sorted here.
    """

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        kept = []
        # Distinct days, so a segment takes no more memory than the calendar has days.
        for day in sorted({day for frame in frames for day in frame["date"]}):
            number = (day - _EPOCH).days
            if days <= 0 or last is None or number - last > days:
                kept.append(day)
                last = number
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({group: key[0], "src": key[1], "date": kept}, columns=[group, "src", "date"])

    return (
        drop_null_keys(alerts, [group, "src", "date"]).select(group, "src", "date")
        .groupBy(group, "src")
        .applyInPandasWithState(
            keep,
            outputStructType=f"`{group}` string, src string, date date",
            stateStructType="last int",
            outputMode="append",
            timeoutConf=GroupStateTimeout.NoTimeout,
        )
    )
