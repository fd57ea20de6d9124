"""Running detectors by name and averaging their scores."""

from __future__ import annotations

import queue
import uuid
import warnings
from collections.abc import Iterable

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.ranks import exact_quantiles
from tallywatch.operators.detectors import DEFAULT_MODELS, DetectorDataError, Fit, Matrix, Scorer, resolve


SCORE_DECIMALS = 9


def comparable(score: Column) -> Column:
    """A score rounded so that equal scores do not fall on both sides of their own quantile."""
    return F.round(score, SCORE_DECIMALS)


def fit_together(m: Matrix, fits: dict[str, Fit]) -> dict[str, Scorer | DetectorDataError]:
    """Fit detectors at the same time, each in a thread, fair-scheduler pool and job tag of its own.

    A ``DetectorDataError`` is returned in the place of the scorer. The first other error
    cancels the jobs of all detectors still running and is raised.
    """
    context = m.df.sparkSession.sparkContext
    run = uuid.uuid4().hex
    tags = {name: f"fit-{name}-{run}" for name in fits}
    outcome: dict[str, Scorer | BaseException] = {}
    settled: queue.SimpleQueue[str] = queue.SimpleQueue()

    def work(name: str) -> None:
        try:
            context.setLocalProperty("spark.scheduler.pool", name)
            context.addJobTag(tags[name])
            outcome[name] = fits[name](m)
        except BaseException as error:  # handed to the caller below
            outcome[name] = error
        finally:
            settled.put(name)

    threads = [InheritableThread(target=work, args=(name,), daemon=True) for name in fits]
    for thread in threads:
        thread.start()
    failure = None
    for _ in fits:
        name = settled.get()
        error = outcome[name]
        if failure is None and isinstance(error, BaseException) and not isinstance(error, DetectorDataError):
            failure = error
            for tag in tags.values():
                context.cancelJobsWithTag(tag)
    for thread in threads:
        thread.join()
    if failure is not None:
        raise failure
    return outcome


def raw_scores(m: Matrix, models: Iterable[str] = DEFAULT_MODELS) -> tuple[DataFrame, list[str]]:
    """The matrix with one ``score_<name>`` column per detector, and their names.

    Detectors are fitted at the same time over the one stored matrix; two names of the same
    detector are fitted once. A detector that raises ``DetectorDataError`` while fitting is
    left out with a warning, one that raises it while scoring counts as 0 in every row. Any
    other error, such as a failed job, ends the run, so that no run votes with fewer
    detectors than were asked for unless the data is the reason.
    """
    chosen: dict[str, Fit] = {}
    for model in models:
        name, fit = resolve(model)
        chosen.setdefault(name, fit)
    first = {fit: name for name, fit in reversed(chosen.items())}
    scorers = fit_together(m, {name: fit for fit, name in first.items()})
    scored, columns = m.df, []
    for name, fit in chosen.items():
        column, source = f"score_{name}", first[fit]
        scorer = scorers[source]
        if isinstance(scorer, DetectorDataError):
            warnings.warn(f"detector {name} left out: {scorer}", stacklevel=2)
            continue
        if source != name:
            scored = scored.withColumn(column, F.col(f"score_{source}"))
        else:
            try:
                scored = scorer(scored, column)
            except DetectorDataError as error:
                warnings.warn(f"detector {name} scores 0: {error}", stacklevel=2)
                scored = scored.withColumn(column, F.lit(0.0))
        columns.append(column)
    if not columns:
        raise DetectorDataError("no detector could be fitted")
    return scored, columns


def fill_scores(scored: DataFrame, columns: list[str], n_rows: int) -> DataFrame:
    """Replace a missing score by the median of its column."""
    nulls = scored.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gaps = [c for c in columns if nulls[c]]
    if not gaps:
        return scored
    medians = exact_quantiles(scored, gaps, 0.5, n_rows).first()
    return scored.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in gaps})


def minmax(scored: DataFrame, columns: list[str]) -> DataFrame:
    """Scale every column to [0, 1]; a constant or empty column becomes 0."""
    ends = scored.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns],
    ).select(F.struct("*")).scalar()

    def scaled(c: str):
        lo, hi = F.col("_ends")[f"lo_{c}"], F.col("_ends")[f"hi_{c}"]
        return F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(0.0)

    return scored.withColumn("_ends", ends).withColumns({c: scaled(c) for c in columns}).drop("_ends")


def mean_score(scored: DataFrame, columns: list[str]) -> DataFrame:
    """``score_ens``: the mean of the scaled scores of a row."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return scored.withColumn("score_ens", comparable(total / len(columns)))


def align_direction(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Negate a score whose mean over flagged rows lies below that over normal rows.

    For user detectors that return a 0/1 label; applied only if exactly both occur.
    """
    stats = scored.agg(
        F.avg(F.when(F.col(label) == 1, F.col(score))).alias("flagged"),
        F.avg(F.when(F.col(label) == 0, F.col(score))).alias("normal"),
        F.count_if(~F.col(label).isin(0, 1)).alias("others"),
    ).select(F.struct("*")).scalar()
    turn = (stats["others"] == 0) & (stats["flagged"] < stats["normal"])
    return scored.withColumn(score, F.when(turn, -F.col(score)).otherwise(F.col(score)))
