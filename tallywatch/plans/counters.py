"""Counts of what a run met on its way, taken by the job that does the work.

``DataFrame.observe`` adds up the metrics while rows pass, so no second scan of the postings
is needed. Tasks that Spark runs anew after a lost executor may add their rows twice; where
exact figures matter more than a scan, use the reports of ``cleaning`` and ``geography``.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation

from tallywatch.operators import cleaning, geography


class Counters:
    """Collects the metrics of one run; ``read`` after the job that carries them has ended."""

    def __init__(self) -> None:
        self._observed: dict[str, tuple[Observation, list[str]]] = {}

    def _watch(self, df: DataFrame, name: str, metrics: list[Column]) -> DataFrame:
        seen = Observation()
        self._observed[name] = seen, df.agg(*metrics).columns
        return df.observe(seen, *metrics)

    def postings(self, df: DataFrame) -> DataFrame:
        """Rows, nulls of each column and event times missing, filled and still missing."""
        return self._watch(df, "postings", [*cleaning.null_metrics(df.columns), *cleaning.event_time_metrics()])

    def states(self, steps: DataFrame) -> DataFrame:
        """Postings by the rule that gave their state; ``steps`` as from ``geography.impute_steps``."""
        return self._watch(steps, "states", geography.funnel_metrics())

    def read(self) -> dict[str, dict[str, int]]:
        return {name: _figures(seen, metrics) for name, (seen, metrics) in self._observed.items()}


def _figures(seen: Observation, metrics: list[str]) -> dict[str, int]:
    try:
        return dict(seen.get)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        # The planner saw that there is no row and left the observation out; its result has no columns.
        return dict.fromkeys(metrics, 0)
