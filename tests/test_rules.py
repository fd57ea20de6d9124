"""Cleaning, geography, occupation, feature and alert rules on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywatch.functions import arrays, dates, text
from tallywatch.operators import alerts, audit, cleaning, daily, ensemble, features, geography, history, occupation
from tallywatch.schemas import ZIP_FIX, ZIP_STATE, conform, require_columns
from tallywatch.schemas import daily as daily_schema
from tests.series import START, days

FIX = [(1, "94105", "941", None), (2, "94107", "941", None), (3, "02139", None, "2139"), (4, "abc", "777", None)]
STATE = [(1, "94105", "CA"), (2, "2139", "MA"), (3, "10001", "NJ"), (4, "10001", "NY"), (5, "00501", "")]

CASES = [
    ("CA", "941", "anything", "CA"),
    ("XX", "Remote ", "San Jose, CA", "REMOTE"),
    (None, " REMOTE", "Guam", "REMOTE"),
    (None, "941", "London, UK", "CA"),
    ("Ontario", "2139", None, "MA"),
    (None, "10001-1234", "London, UK", None),
    (None, "10001", None, "NY"),
    ("XX", "99999", "San Jose, CA", "CA"),
    ("XX", "99999", "CAT, Inc", None),
    ("XX", None, "charleston, west virginia", "WV"),
    ("XX", None, "NewYork metro", "NY"),
    ("XX", None, "Arkansas City, Kansas", "AR"),
    ("XX", None, "District of Columbia", "DC"),
    ("ca", None, "lower ca", None),
    (None, "501", "nowhere", ""),
    (None, "501", "Albany, NY", "NY"),
    (None, "501", "new york", ""),
    ("", None, None, None),
    ("XX", None, "Kansas, OR", "OR"),
]


@pytest.mark.parametrize("limit", [200_000, 1])
def test_state_cascade(spark, limit):
    rows = [(i, *case) for i, case in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, state string, zipcode string, scraped_location string, want string")
    fixed = geography.repair_zip(df, spark.createDataFrame(FIX, ZIP_FIX), limit)
    out = geography.impute_states(fixed, spark.createDataFrame(STATE, ZIP_STATE), limit)
    got = {r["i"]: r["correct_state"] for r in out.collect()}
    assert got == {i: case[3] for i, case in enumerate(CASES)}


def test_zip_repair_keeps_the_original(spark):
    df = spark.createDataFrame([("941",), ("2139",), ("777",), (None,), ("94",), ("94105-1",)], "zipcode string")
    out = geography.repair_zip(df, spark.createDataFrame(FIX, ZIP_FIX))
    assert {(r["original_zipcode"], r["zipcode"]) for r in out.collect()} == {
        ("941", "94105"), ("2139", "02139"), ("777", "777"), (None, None), ("94", "94"), ("94105-1", "94105-1")}


def test_pad_zip(spark):
    df = spark.createDataFrame([("501",), ("94105",), ("94105-1234",), ("",), (None,)], "z string")
    got = [r[0] for r in df.select(text.pad_zip(F.col("z"))).collect()]
    assert got == ["00501", "94105", "94105-1234", "00000", None]


@pytest.mark.parametrize("level, cases", [
    (1, {"11-1011": "11-1010", "11-1010": "11-1010", "151032": "151032", None: None, "1-10111": "1-10110",
         "11-101-": "11-101-", "1110111": "1110111", "111011-": "111011-", "-111011": "-111010"}),
    (2, {"11-1011": "11-1000", "15-1132": "15-1000"}),
    (3, {"11-1011": "11-1011"}),
])
def test_rollup(spark, level, cases):
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r[0]: r[1] for r in df.select("c", text.rollup_soc(F.col("c"), level)).collect()} == cases


def test_low_volume_decides_the_rollup(spark):
    rows = [("2025-01-01", "11-1011", "x", 10), ("2025-01-02", "11-1011", "y", 60), ("2025-01-01", "11-1019", "x", 80),
            ("2025-01-01", None, "x", 5)]
    df = spark.createDataFrame(rows, "date string, nlp_soc_code string, src string, job_count long")
    rolled = occupation.roll_low_volume(occupation.code_days(df))
    assert {(r["nlp_soc_code"], r["nlp_soc_code_rolled"]) for r in rolled.collect()} == {
        ("11-1011", "11-1010"), ("11-1019", "11-1019"), (None, None)}
    assert {r["nlp_soc_code"] for r in occupation.low_volume_codes(occupation.code_days(df)).collect()} == {"11-1011"}


def test_event_time(spark):
    rows = [("2025-01-02 08:30:00", "2025-01-09"), ("bad", "2025-01-03"), (None, None), (None, "2025-01-04")]
    df = spark.createDataFrame(rows, "first_scrape_timestamp string, correct_date string")
    got = [r["date"] for r in cleaning.clean_postings(df).collect()]
    assert got == [dt.date(2025, 1, 2), dt.date(2025, 1, 3), None, dt.date(2025, 1, 4)]


def test_bad_fallback_date_fails(spark):
    df = spark.createDataFrame([(None, "soon")], "first_scrape_timestamp string, correct_date string")
    with pytest.raises(PySparkException):
        cleaning.clean_postings(df).collect()


def test_mixed_dates(spark):
    df = spark.createDataFrame([("2025-01-31",), ("01/31/2025",), ("20250131",), ("31-Jan-2025",), ("?",)], "d string")
    got = [r[0] for r in df.select(F.to_date(dates.mixed_timestamp(F.col("d")))).collect()]
    assert got == [dt.date(2025, 1, 31)] * 4 + [None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    d = F.col("d")
    assert tuple(df.select(dates.day_of_week(d), dates.iso_week(d), dates.iso_year(d), dates.quarter(d)).first()) == (
        0, 1, 2025, 4)


def test_null_keys_are_not_counted(spark):
    df = spark.createDataFrame(
        [(START, "CA", "x"), (START, None, "x"), (None, "CA", "x"), (START, "CA", None)],
        "date date, state string, src string")
    assert [tuple(r) for r in daily.daily_counts(df, "state").collect()] == [(START, "CA", "x", 1)]


def test_dedup_keeps_unkeyed_rows(spark):
    df = spark.createDataFrame(
        [("a", "2025-01-02", "y"), ("a", "2025-01-01", "x"), (None, "2025-01-01", "z"), (None, "2025-01-01", "z")],
        "job_key string, first_scrape_timestamp string, src string")
    got = sorted(tuple(map(str, r)) for r in cleaning.dedup_postings(df).collect())
    assert got == [("None", "2025-01-01", "z"), ("None", "2025-01-01", "z"), ("a", "2025-01-01", "x")]


def test_required_columns(spark):
    df = days(spark, [1])
    with pytest.raises(ValueError, match="state"):
        require_columns(df, ["state"])
    text_counts = df.withColumn("job_count", F.lit("many"))
    assert conform(text_counts, daily_schema("grp")).first()["job_count"] is None


@pytest.mark.parametrize("length, left", [(6, 0), (7, 1), (8, 2)])
def test_warmup(spark, length, left):
    assert features.build_features(days(spark, [5] * length), "grp").count() == left


def test_changes_and_zero_deviation(spark):
    out = features.add_features(days(spark, [0, 5, 0, 0, 4, 4, 4, 4, 4, 4, 4]), "grp").orderBy("date").collect()
    assert [r["pct_chg_1"] for r in out[:4]] == [None, None, -1.0, None]
    assert out[-1]["z_7"] is None and out[-1]["std_7"] == 0.0


def test_mad(spark):
    out = features.add_features(days(spark, [1, 1, 2, 2, 4, 6, 9]), "grp").orderBy("date").collect()
    assert out[-1]["mad_28"] == 1.0


def test_rows_not_days_make_the_window(spark):
    gappy = days(spark, [1, None, None, None, None, None, None, 2, None, 3])
    out = features.add_features(gappy, "grp").orderBy("date").collect()
    assert out[-1]["mean_7"] == 2.0
    filled = features.fill_calendar(gappy, "grp")
    assert filled.count() == 10 and filled.agg(F.sum("job_count")).first()[0] == 6


def test_extra_feature(spark):
    out = features.build_features(days(spark, [3] * 8), "grp", {"season": F.quarter("date")})
    assert [r["season"] for r in out.collect()] == [1, 1]


def test_quantile_and_flags(spark):
    df = days(spark, [1, 2, 3, 4]).withColumn("score_ens", F.col("job_count").cast("double"))
    out = alerts.flag(alerts.with_threshold(df, "grp")).orderBy("date").collect()
    assert out[0]["threshold"] == pytest.approx(3.85)
    assert [r["is_anomaly"] for r in out] == [0, 0, 0, 1]


@pytest.mark.parametrize("gap, alert_days, kept", [
    (1, [1, 2, 3, 5, 6], [1, 3, 5]),
    (3, [1, 3, 5, 9], [1, 5, 9]),
    (0, [1, 2, 3], [1, 2, 3]),
    (2, [], []),
])
def test_cooldown(spark, gap, alert_days, kept):
    df = days(spark, range(1, 11)).withColumn(
        "is_anomaly", F.col("job_count").isin(*alert_days).cast("int") if alert_days else F.lit(0))
    out = alerts.cooldown(df, "grp", gap).where("is_anomaly = 1").orderBy("date")
    assert [r["job_count"] for r in out.collect()] == kept


def test_weekly_budget(spark):
    df = days(spark, [9, 8, 7, 6, 5], start=dt.date(2025, 1, 6)).withColumns(
        {"score_ens": F.col("job_count").cast("double"), "is_anomaly": (F.col("job_count") != 9).cast("int")})
    out = alerts.weekly_budget(df, "grp", 2).where("is_anomaly = 1")
    assert sorted(r["job_count"] for r in out.collect()) == [7, 8]


def test_last_n_dates(spark):
    df = days(spark, [1, None, 3, None, None, None, None, None, 9]).unionByName(days(spark, [4], group="B"))
    kept = history.last_n_dates(df, "grp", 2)
    assert sorted(r["job_count"] for r in kept.collect()) == [3, 4, 9]
    assert history.last_n_dates(kept, "grp", 2).exceptAll(kept).isEmpty()


def test_retention_keeps_the_boundary(spark):
    kept = history.retain_days(days(spark, [1, 2, 3]), START + dt.timedelta(days=3), 2)
    assert sorted(r["job_count"] for r in kept.collect()) == [2, 3]


def test_missing_combinations(spark):
    early = spark.createDataFrame(
        [(START, g, s) for g in "AB" for s in "xy"] + [(START, None, "z")], "date date, grp string, src string")
    late = spark.createDataFrame(
        [(START + dt.timedelta(days=1), "A", "x"), (START + dt.timedelta(days=1), "B", "y")], early.schema)
    df = early.unionByName(late)
    got = {tuple(r) for r in audit.missing_combinations(df.where("grp is not null"), "grp").collect()}
    assert got == {("A", "y"), ("B", "x")}
    # A source seen only without a group is still expected of every group.
    got = {tuple(r) for r in audit.missing_combinations(df, "grp", valid_groups=["A", "Q"]).collect()}
    assert got == {("A", "y"), ("A", "z")}


def test_seasonal_burst(spark):
    def burst(counts):
        return audit.seasonal_bursts(days(spark, counts), "grp").first()["is_seasonal_burst"]

    def spiky(n):
        return [10_000 if i in (9, 39) else 0 for i in range(n)]

    assert burst(spiky(100)) is True
    assert burst(spiky(45)) is False
    assert burst([499, 501] * 15) is True


def test_minmax_of_a_constant(spark):
    df = days(spark, [2, 2, 2]).withColumn("s", F.lit(2.0))
    assert [r["s"] for r in ensemble.minmax(df, ["s"]).collect()] == [0.0, 0.0, 0.0]


def test_missing_scores_become_the_median(spark):
    df = days(spark, [1, 2, 4, 9]).withColumn("s", F.when(F.col("job_count") < 9, F.col("job_count").cast("double")))
    assert sorted(r["s"] for r in ensemble.fill_scores(df, ["s"], 4).collect()) == [1.0, 2.0, 2.0, 4.0]


def test_align_direction(spark):
    df = days(spark, [1, 2, 9]).withColumns(
        {"s": F.col("job_count").cast("double"), "label": (F.col("job_count") < 9).cast("int")})
    assert sorted(r["s"] for r in ensemble.align_direction(df, "s", "label").collect()) == [-9.0, -2.0, -1.0]
    one_label = df.withColumn("label", F.lit(1))
    assert sorted(r["s"] for r in ensemble.align_direction(one_label, "s", "label").collect()) == [1.0, 2.0, 9.0]


def test_grains_conserve_counts(spark):
    rows = [(START, "x", "US", s, c) for s in ("CA", None) for c in ("11-1011", "11-1012", None)]
    df = spark.createDataFrame(rows, "date date, src string, geo string, st string, soc string")
    out = daily.multi_grain_counts(df, {"country": "geo", "state": "st", "occupation": "soc"})
    assert {(r["grain"], r["group"]): r["job_count"] for r in out.collect()} == {
        ("country", "US"): 6, ("state", "CA"): 3, ("occupation", "11-1011"): 2, ("occupation", "11-1012"): 2}


def test_batch_split_does_not_matter(spark):
    df = spark.range(1000).select(
        F.date_add(F.lit(START), (F.col("id") % 5).cast("int")).alias("date"),
        (F.col("id") % 3).cast("string").alias("grp"), F.lit("x").alias("src"), "id")
    whole = daily.daily_counts(df, "grp")
    parts = daily.accumulate([daily.daily_counts(df.where(F.col("id") % 7 == i), "grp") for i in range(7)], "grp")
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_spaced_dates_on_random_cases(spark):
    rng = random.Random(5)
    cases = []
    for i in range(400):
        gap = rng.randint(1, 6)
        offsets = sorted(rng.sample(range(40), rng.randint(0, 25)))
        kept = []
        for day in offsets:
            if not kept or day - kept[-1] > gap:
                kept.append(day)
        shuffled = rng.sample(offsets, len(offsets))
        cases.append((gap, [START + dt.timedelta(d) for d in shuffled], [START + dt.timedelta(d) for d in kept]))
    df = spark.createDataFrame(cases, "gap int, found array<date>, want array<date>")
    for gap in range(1, 7):
        got = df.where(F.col("gap") == gap).select("want", arrays.spaced_dates(F.col("found"), gap).alias("got"))
        assert got.where("want != got").isEmpty()


def test_rollup_conserves_counts(spark):
    rows = [(START, f"{11 + i % 3}-10{i % 40:02d}", "x", i % 9) for i in range(500)]
    df = spark.createDataFrame(rows, "date date, nlp_soc_code string, src string, job_count long")
    rolled = occupation.roll_low_volume(occupation.code_days(df), below=4.0)
    assert daily.daily_sums(rolled, "nlp_soc_code_rolled").agg(F.sum("job_count")).first()[0] == sum(r[3] for r in rows)
    after = {r["nlp_soc_code_rolled"]: r["job_count_after"] for r in occupation.rollup_comparison(rolled).collect()}
    assert sum(after.values()) == sum(r[3] for r in rows)


def test_array_statistics(spark):
    df = spark.createDataFrame([([3, 1, 2],), ([4, 1],), ([],), ([5, 5, 5, 9],)], "v array<long>")
    got = [tuple(r) for r in df.select(arrays.array_median(F.col("v")), arrays.array_mad(F.col("v"))).collect()]
    assert got == [(2.0, 1.0), (2.5, 1.5), (None, None), (5.0, 0.0)]
