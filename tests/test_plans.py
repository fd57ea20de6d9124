"""Whole runs, and the shape of the plans behind them."""

import contextlib
import datetime as dt
import io
import json

import pytest
from pyspark.sql import functions as F

from tallywatch.operators import alerts, features, history
from tallywatch.plans import grains, run
from tallywatch.plans.detect import detect_zscore
from tallywatch.sources import ledger, sinks
from tallywatch.sources.external import parse_messages
from tallywatch.sources.maps import read_zip_fix, read_zip_state
from tallywatch.sources.postings import read_postings
from tests.series import noisy
from workload import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def postings_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "postings")
    tables.postings(spark, SF).write.parquet(path)
    return path


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def scanned(text: str) -> set[str]:
    line = next(line for line in text.splitlines() if line.startswith("ReadSchema") and "src" in line)
    return {f.split(":")[0] for f in line.split("struct<")[1].rstrip(">").split(",")}


def shuffles(text: str) -> int:
    tree = text.split("\n\n")[0]
    return sum("Exchange" in line and "Broadcast" not in line for line in tree.splitlines())


def test_country_plan_reads_three_columns(spark, postings_path):
    text = plan(grains.country_daily(read_postings(spark, postings_path)))
    assert scanned(text) == {"correct_date", "first_scrape_timestamp", "src"}
    assert shuffles(text) == 1 and "EvalPython" not in text


def test_state_plan_has_one_shuffle(spark, postings_path):
    maps = tables.maps(spark)
    text = plan(grains.state_daily(read_postings(spark, postings_path), maps))
    assert scanned(text) == {
        "state", "zipcode", "correct_date", "first_scrape_timestamp", "scraped_location", "src"}
    assert not any(word in text for word in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoop"))
    # The postings are shuffled once, after counting; the maps are broadcast.
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2


def test_occupation_plan(spark, postings_path):
    text = plan(grains.occupation_daily(read_postings(spark, postings_path)))
    assert scanned(text) == {"correct_date", "first_scrape_timestamp", "src", "nlp_soc_code"}
    assert "Join" not in text


def test_windows_share_one_shuffle(spark):
    series = noisy(spark, 3)
    assert shuffles(plan(features.build_features(series, "grp"))) == 1
    assert shuffles(plan(detect_zscore(series, "grp"))) == 1


def test_trim_limits_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(history.last_n_dates(noisy(spark, 3), "grp"))


def test_date_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.add_batch(noisy(spark, 2), path, "grp", "b")
    recent = history.retain_days(ledger.read_history(spark, path, "grp"), "2025-03-01", 30)
    assert "GreaterThanOrEqual(date" in plan(recent)


def test_missing_column_fails(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.postings(spark, SF).drop("src").write.parquet(path)
    with pytest.raises(ValueError, match="src"):
        read_postings(spark, path)


@pytest.mark.parametrize("grain", ["country", "state", "occupation"])
def test_whole_run(spark, postings_path, tmp_path, grain):
    out = str(tmp_path / "out")
    done = grains.run_grain(
        spark, grain, read_postings(spark, postings_path), str(tmp_path / "ledger"), "b1", out,
        dt.date(2025, 1, 2), tables.maps(spark), models=("hbos", "copod"))
    group = grains.GRAINS[grain].group
    saved = spark.read.option("header", True).csv(f"{out}/anomalies_{grain}")
    summary = done.summary.first()
    assert saved.columns[:4] == [group, "src", "date", "job_count"]
    assert saved.count() == summary["total_records"] > 0
    assert summary["total_anomalies"] >= summary["segments"] > 0
    assert len(done.pivot(group).columns) == 2 + done.result.select("date").distinct().count()
    today = alerts.today_anomalies(done.result, group)
    if done.today_path is None:
        assert today.isEmpty()
    else:
        assert done.today_path.endswith("2025-01-02")
        assert spark.read.option("header", True).csv(done.today_path).count() == today.count()


def test_all_grains_agree_with_each(spark, postings_path):
    postings, maps = read_postings(spark, postings_path), tables.maps(spark)
    together = grains.all_grains(postings, maps)
    for name, grain in grains.GRAINS.items():
        part = together.where(F.col("grain") == name).select("date", "group", "src", "job_count")
        alone = grain.daily(postings, maps).select("date", grain.group, "src", "job_count")
        assert part.exceptAll(alone).isEmpty() and alone.exceptAll(part).isEmpty()


def test_command_line(spark, postings_path, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(run, "build_session", lambda app: spark)
    monkeypatch.setattr(run, "run_grain", lambda *a, **k: grains.run_grain(*a, **k, models=("hbos",)))
    fix, states = tmp_path / "fix.csv", tmp_path / "states.csv"
    fix.write_text("row_no,zipcode,zipcode3,zipcode4\n1,94105,941,\n3,02139,,2139\n")
    states.write_text("row_no,zipcode,state\n1,94105,CA\n2,2139,MA\n")
    run.main(["--grain", "state", "--postings", postings_path, "--ledger", str(tmp_path / "l"), "--batch-id", "b",
              "--out", str(tmp_path / "o"), "--zip-fix", str(fix), "--zip-state", str(states)])
    assert "total_records" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        run.main(["--grain", "state", "--postings", "p", "--ledger", "l", "--batch-id", "b", "--out", "o"])


def test_maps_from_files(spark, tmp_path):
    tables.maps(spark).zip_fix.write.parquet(str(tmp_path / "fix"))
    assert read_zip_fix(spark, str(tmp_path / "fix")).count() == 3
    csv = tmp_path / "states.csv"
    csv.write_text("row_no,zipcode,state\n1,00501,NY\n")
    assert read_zip_state(spark, str(csv)).first()["zipcode"] == "00501"


def test_json_report(spark, tmp_path):
    result = detect_zscore(noisy(spark, 3), "grp").withColumn("date_only", F.col("date"))
    path = str(tmp_path / "report")
    sinks.write_json_report(result, "grp", path, dt.datetime(2025, 2, 1))
    records = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    kinds = [r["record"] for r in records]
    alerts_found = kinds.count("anomaly")
    metadata = next(r["metadata"] for r in records if r["record"] == "metadata")
    assert kinds.count("metadata") == kinds.count("summary") == 1
    assert metadata["anomaly_count"] == alerts_found > 0


def test_messages(spark):
    df = spark.createDataFrame([('{"src": "a", "zipcode": "00501"}',), ("broken",)], "value string")
    got = parse_messages(df).select("src", "zipcode").collect()
    assert [tuple(r) for r in got] == [("a", "00501"), (None, None)]
