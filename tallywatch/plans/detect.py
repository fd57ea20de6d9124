"""The detection run: features, detectors, ensemble, threshold, flag, cooldown."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.operators import alerts, ensemble
from tallywatch.operators.detectors import DEFAULT_MODELS, build_matrix, resolve
from tallywatch.operators.features import FEATURES, build_features, fill_calendar
from tallywatch.operators.history import last_n_dates
from tallywatch.sources.scratch import materialise, spread


def _result_columns(group: str, scores: list[str]) -> list[str]:
    return [group, "src", "date", "job_count", *scores, "score_ens", "date_only", "threshold", "is_anomaly"]


def _empty(history: DataFrame, group: str, scores: list[str]) -> DataFrame:
    doubles = [F.lit(None).cast("double").alias(c) for c in (*scores, "score_ens")]
    return history.limit(0).select(
        group, "src", "date", "job_count", *doubles,
        F.col("date").alias("date_only"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0).alias("is_anomaly"),
    )


def score_history(history: DataFrame, group: str, models: Iterable[str] = DEFAULT_MODELS,
                  extra_features: dict[str, Column] | None = None) -> tuple[DataFrame, list[str]]:
    """Segment, date, job count, scaled score per detector and ``score_ens``."""
    features = build_features(history, group, extra_features)
    m = build_matrix(features, group, (*FEATURES, *(extra_features or {})))
    if m.n_rows == 0:
        columns = [f"score_{resolve(name)[0]}" for name in models]
        return _empty(history, group, columns), columns
    raw, columns = ensemble.raw_scores(m, models)
    raw = materialise(raw.drop("x"), "scores")
    filled = ensemble.fill_scores(raw, columns, m.n_rows)
    return ensemble.mean_score(ensemble.minmax(filled, columns), columns), columns


def detect(history: DataFrame, group: str, models: Iterable[str] = DEFAULT_MODELS,
           quantile_bounds: tuple[float, float] = (0.95, 0.999), cooldown_days: int = 1,
           weekly_alerts: int | None = None, dense_calendar: bool = False,
           extra_features: dict[str, Column] | None = None, n_dates: int | None = None) -> DataFrame:
    """Score and flag every (segment, day) of a daily history.

    Only the lower quantile bound sets the threshold. ``weekly_alerts`` applies an
    alert budget after the cooldown and is off by default, and so is ``n_dates``,
    which keeps the newest dates of each segment only. What is left is partitioned by
    segment once, which all feature windows then share.
    """
    models = list(models)
    # The trim ranks on the map side, so that old dates are dropped before the exchange.
    days = history if n_dates is None else last_n_dates(history, group, n_dates)
    days = spread(days, group, "src")
    if dense_calendar:
        days = fill_calendar(days, group)
    scored, columns = score_history(days, group, models, extra_features)
    flagged = alerts.flag(alerts.with_threshold(scored, group, q=quantile_bounds[0]))
    flagged = alerts.cooldown(flagged, group, cooldown_days)
    if weekly_alerts is not None:
        flagged = alerts.weekly_budget(flagged, group, weekly_alerts)
    return flagged.withColumn("date_only", F.to_date("date")).select(*_result_columns(group, columns))


def detect_zscore(history: DataFrame, group: str, q: float = 0.95, cooldown_days: int = 1) -> DataFrame:
    """The same run with the absolute 28-row z-score as the only score."""
    features = build_features(history, group)
    scored = features.select(
        group, "src", "date", "job_count",
        ensemble.comparable(F.coalesce(F.abs("z_28"), F.lit(0.0))).alias("score_ens"),
    )
    flagged = alerts.flag(alerts.with_threshold(scored, group, q=q))
    return alerts.cooldown(flagged, group, cooldown_days)
