"""The three programs, country, state and occupation, as one run with a grain parameter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators import cleaning, daily, geography, occupation, reports
from tallywatch.operators.history import HISTORY_DATES
from tallywatch.plans.counters import Counters
from tallywatch.plans.detect import detect
from tallywatch.sources import ledger, seen, sinks
from tallywatch.sources.scratch import materialise


@dataclass(frozen=True)
class Maps:
    """The postal-code reference maps; needed by the state grain only."""

    zip_fix: DataFrame | None = None
    zip_state: DataFrame | None = None


def country_daily(postings: DataFrame, maps: Maps = Maps(), counters: Counters | None = None) -> DataFrame:
    """Postings per day and source under one country tag.

    Neither the postal code nor the state enters the result, so neither is repaired.
    """
    return daily.daily_counts(cleaning.tag_country(cleaning.clean_postings(postings)), "geo_level")


def imputed_postings(postings: DataFrame, maps: Maps, counters: Counters | None = None) -> DataFrame:
    """Cleaned postings with repaired postal code and imputed state; no shuffle."""
    cleaned = geography.repair_zip(cleaning.clean_postings(postings), maps.zip_fix)
    watch = counters.states if counters else None
    return geography.use_imputed_state(geography.impute_states(cleaned, maps.zip_state, watch=watch))


def state_daily(postings: DataFrame, maps: Maps, counters: Counters | None = None) -> DataFrame:
    """Postings per day, imputed state and source."""
    return daily.daily_counts(imputed_postings(postings, maps, counters), "state")


def occupation_daily(postings: DataFrame, maps: Maps = Maps(), counters: Counters | None = None) -> DataFrame:
    """Job counts per day, rolled occupation code and source."""
    days = occupation.code_days(cleaning.clean_postings(postings))
    return occupation.daily_rolled_counts(occupation.roll_low_volume(days))


@dataclass(frozen=True)
class Grain:
    group: str
    daily: Callable[[DataFrame, Maps, Counters | None], DataFrame]


GRAINS = {
    "country": Grain("geo_level", country_daily),
    "state": Grain("state", state_daily),
    "occupation": Grain("nlp_soc_code_rolled", occupation_daily),
}


def all_grains(postings: DataFrame, maps: Maps, below: float = occupation.LOW_VOLUME) -> DataFrame:
    """Daily counts of all grains from one scan of the postings, equal to the three single ones.

    Postings are counted once at the finest grain, with their job counts; country and
    state add up postings, the occupation grain job counts after the roll-up of
    low-volume codes. A null group leaves out the row in that grain only.
    """
    imputed = cleaning.default_job_count(cleaning.tag_country(imputed_postings(postings, maps)))
    finest = imputed.groupBy("date", "src", "geo_level", "state", "nlp_soc_code").agg(
        F.count("*").alias("rows"), F.sum("job_count").cast("long").alias("job_count"),
        F.count("job_count").alias("postings"))
    rolled = occupation.roll_low_volume(finest, below=below)
    counted = {"country": "rows", "state": "rows", "occupation": "job_count"}
    variants = F.array(*[
        F.struct(F.lit(name).alias("grain"), F.col(g.group).cast("string").alias("group"), F.col(counted[name]).alias("n"))
        for name, g in GRAINS.items()
    ])
    every = rolled.select("date", "src", F.inline(variants))
    return daily.per_key(every, ["grain", "date", "group", "src"], F.sum("n").cast("long"))


@dataclass(frozen=True)
class Run:
    result: DataFrame
    summary: DataFrame
    today_path: str | None
    #: Of this batch's postings; empty if not asked for or if a compaction holds the batch already.
    counters: dict[str, dict[str, int]]

    def pivot(self, group: str) -> DataFrame:
        return reports.pivot_counts(self.result, group)


def run_grain(spark: SparkSession, grain: str, postings: DataFrame, ledger_path: str, batch_id: str,
              out_path: str, run_date: dt.date, maps: Maps = Maps(), n_dates: int = HISTORY_DATES,
              seen_path: str | None = None, with_counters: bool = False,
              **detect_options) -> Run:
    """Clean, count, add to the ledger, load and trim the history, detect and write.

    With ``seen_path`` a posting counts once over all batches: its key must be in no other
    batch recorded there. Runs of several grains may share the folder under one batch id.
    ``with_counters`` reads all posting columns and counts gaps and, for states, the rules used.
    """
    spec = GRAINS[grain]
    if seen_path is not None and not ledger.is_absorbed(spark, ledger_path, batch_id):
        postings = seen.claim(postings, seen_path, batch_id)
    counters = Counters() if with_counters else None
    counts = spec.daily(counters.postings(postings) if counters else postings, maps, counters)
    added = ledger.add_batch(counts, ledger_path, spec.group, batch_id)
    history = ledger.load_history(spark, ledger_path, spec.group, n_dates)
    # Written once: the files and the summary below all read it.
    result = materialise(detect(history, spec.group, **detect_options), "result")
    sinks.write_result_csv(result, spec.group, f"{out_path}/anomalies_{grain}")
    today = sinks.write_today_csv(result, spec.group, out_path, grain, run_date)
    bounds = detect_options.get("quantile_bounds", (0.95, 0.999))
    return Run(result, reports.run_summary(result, spec.group, *bounds), today, counters.read() if counters and added else {})
