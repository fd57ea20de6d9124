"""Counters taken by the ledger write equal the reports that scan again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import cleaning, geography
from tallywatch.plans import grains
from tallywatch.plans.counters import Counters
from tallywatch.sources import ledger
from workload import tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("grain", sorted(grains.GRAINS))
def test_counters_equal_the_reports(spark, tmp_path, grain):
    rows, maps, watch = tables.postings(spark, SF), tables.maps(spark), Counters()
    spec = grains.GRAINS[grain]
    assert ledger.add_batch(spec.daily(watch.postings(rows), maps, watch), str(tmp_path / "l"), spec.group, "b")
    got = watch.read()
    want = {**cleaning.null_counts(rows).first().asDict(), **cleaning.event_time_report(rows).first().asDict()}
    assert got.pop("postings") == want and want["filled"] > 0 and want["null_state"] > 0
    if grain == "state":
        cleaned = geography.repair_zip(cleaning.clean_postings(rows), maps.zip_fix)
        assert got.pop("states") == geography.impute_funnel(cleaned, maps.zip_state).first().asDict()
    assert got == {}


def test_run_returns_them(spark, tmp_path):
    rows, paths = tables.postings(spark, SF), [str(tmp_path / n) for n in ("ledger", "out")]
    args = ("b", paths[1], dt.date(2025, 1, 31))
    run = grains.run_grain(spark, "country", rows, paths[0], *args, with_counters=True, models=("hbos",))
    assert run.counters["postings"]["total_rows"] == rows.count()
    # Nothing to count: no row, and a batch that a compaction holds.
    empty = grains.run_grain(spark, "country", rows.limit(0), paths[0], "none", *args[1:], with_counters=True, models=("hbos",))
    assert set(empty.counters["postings"].values()) == {0}
    ledger.compact(spark, paths[0], str(tmp_path / "new"), "geo_level")
    again = grains.run_grain(spark, "country", rows, str(tmp_path / "new"), *args, with_counters=True, models=("hbos",))
    assert again.counters == {}
    got, want = (ledger.read_history(spark, p, "geo_level").agg(F.sum("job_count")).first()[0] for p in (paths[0], str(tmp_path / "new")))
    assert got == want
