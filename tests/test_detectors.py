import dataclasses
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.operators import detectors, ensemble
from tallywatch.operators.detectors import build_matrix, cblof, hbos, iforest, ocsvm, resolve
from tallywatch.operators.features import FEATURES, build_features
from tallywatch.plans.detect import detect
from tests.series import days, noisy

SPIKE = (4, 40, 20)


@pytest.fixture(scope="module")
def history(spark):
    return noisy(spark, spike=SPIKE)


@pytest.fixture(scope="module")
def matrix(history):
    return build_matrix(build_features(history, "grp"), "grp")


@pytest.fixture(scope="module")
def result(history):
    return detect(history, "grp").cache()


def test_features_are_filled(matrix):
    assert matrix.n_rows == matrix.df.count() == 20 * 39
    assert matrix.df.where(F.exists("x", lambda v: v.isNull()) | (F.size("x") != len(FEATURES))).isEmpty()


@pytest.mark.parametrize("name", ["iforest", "hbos", "copod", "knn", "ocsvm", "cblof"])
def test_spike_ranks_in_the_top_percent(matrix, name):
    scored = resolve(name)[1](matrix)(matrix.df, "s").collect()
    spike = max(scored, key=lambda r: r["job_count"])
    above = sum(r["s"] > spike["s"] for r in scored)
    assert above <= len(scored) / 100


def test_result_shape(result):
    scores = [f"score_{m}" for m in detectors.DEFAULT_MODELS]
    assert result.columns == ["grp", "src", "date", "job_count", *scores, "score_ens", "date_only", "threshold",
                              "is_anomaly"]
    for c in scores:
        lo, hi = result.agg(F.min(c), F.max(c)).first()
        assert (lo, hi) == (0.0, 1.0)


def test_every_segment_alerts(result, history):
    per_segment = result.groupBy("grp").agg(F.sum("is_anomaly").alias("n")).collect()
    assert len(per_segment) == 20 and all(r["n"] >= 1 for r in per_segment)


def test_spike_is_flagged(result):
    top = result.orderBy(F.desc("score_ens")).first()
    assert top["grp"] == f"G{SPIKE[0]}" and top["is_anomaly"] == 1


def test_kept_alerts_are_apart(result):
    by_segment = {}
    for r in result.where("is_anomaly = 1").orderBy("grp", "date").collect():
        by_segment.setdefault(r["grp"], []).append(r["date"])
    for found in by_segment.values():
        assert all((b - a).days > 1 for a, b in zip(found, found[1:]))


def test_ensemble_is_the_mean(result):
    scores = [F.col(f"score_{m}") for m in detectors.DEFAULT_MODELS]
    gap = F.abs(sum(scores[1:], scores[0]) / len(scores) - F.col("score_ens"))
    assert result.agg(F.max(gap)).first()[0] < 1e-8


def test_same_seed_same_scores(matrix):
    for fit in (iforest.fit, ocsvm.fit, cblof.fit):
        a, b = (sorted(r["s"] for r in fit(matrix)(matrix.df, "s").collect()) for _ in range(2))
        assert np.allclose(a, b)


def test_hbos_equals_numpy(matrix):
    rows = hbos.fit(matrix)(matrix.df, "s").collect()
    x = np.array([r["x"] for r in rows])
    want = np.zeros(len(x))
    for i in range(x.shape[1]):
        if x[:, i].max() > x[:, i].min():
            heights, edges = np.histogram(x[:, i], bins=10, density=True)
            slot = np.clip(np.digitize(x[:, i], edges) - 1, 0, 9)
            want -= np.log2(heights[slot] + 0.1)
    got = np.array([r["s"] for r in rows])
    # Values on an edge may fall to either side of it.
    assert np.mean(np.isclose(got, want)) > 0.99


def test_large_clusters():
    assert cblof.large_clusters([50, 45, 3, 2]) == [0, 1]
    assert cblof.large_clusters([10, 60, 30], alpha=0.99, beta=5) == [1, 2, 0]
    assert cblof.large_clusters([4, 60, 30], alpha=0.99, beta=5) == [1, 2]
    assert cblof.large_clusters([0, 7]) == [1]


def test_path_length():
    assert iforest.expected_path(1) == 0.0 and iforest.expected_path(2) == 1.0
    assert iforest.expected_path(256) == pytest.approx(10.2447, abs=1e-3)


def test_ocsvm_splits_about_nu(matrix):
    for nu in (0.05, 0.2, 0.5):
        outside = ocsvm.fit(matrix, nu=nu)(matrix.df, "s").where("s > 0").count() / matrix.n_rows
        assert abs(outside - nu) < 0.02


def test_ocsvm_names_its_gap_when_steps_run_out(matrix):
    with pytest.warns(UserWarning, match="duality gap"):
        scorer = ocsvm.fit(matrix, nu=0.02, steps=1, tolerance=1e-9)
    assert scorer(matrix.df, "s").where("s IS NULL").isEmpty()


def points_of(matrix):
    return np.array([r["x"] for r in matrix.df.select("x").collect()])


def cost(x, centres):
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def full_lloyd(x, k, starts=10):
    best = np.inf
    for seed in range(starts):
        centres = cblof._seeded(x, np.ones(len(x)), k, np.random.default_rng(seed))
        for _ in range(300):
            near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            after = np.array([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
            if np.abs(after - centres).max() < 1e-9:
                break
            centres = after
        best = min(best, cost(x, centres))
    return best


def test_coreset_clusters_cost_about_as_little_as_full_steps(matrix):
    x = points_of(matrix)
    # Leaves of 50 rows, four at a time: three levels of the tree.
    points, weights = cblof.coreset(matrix, leaf=50, points=40, fan=4)
    assert len(points) <= 160 and weights.sum() == pytest.approx(matrix.n_rows)
    centres, sizes = cblof.lloyd(matrix, cblof.settled(points, weights, 4))
    assert cost(x, centres) <= 1.02 * full_lloyd(x, 4) and sum(sizes) == matrix.n_rows


def test_clusters_do_not_depend_on_partitions(matrix):
    again = dataclasses.replace(matrix, df=matrix.df.repartition(7, "date"))
    for a, b in zip(cblof.coreset(matrix, leaf=100, points=30, fan=3), cblof.coreset(again, leaf=100, points=30, fan=3)):
        assert (a == b).all()


def test_equal_points_make_one_cluster():
    x = np.zeros((50, 3))
    points, weights = cblof.reduced(x, np.ones(50), 10, [1])
    assert len(points) == 1 and weights.tolist() == [50.0]
    assert len(cblof.settled(points, weights, 8)) == 1


def test_trees_do_not_depend_on_partitions(matrix):
    again = dataclasses.replace(matrix, df=matrix.df.repartition(5, "date"))
    a, b = (sorted(iforest.grow(iforest.subsamples(m, trees=5), m.width, 8)[3][4].tolist()) for m in (matrix, again))
    assert a == b and len(a) > 5


def slow_fit(seconds):
    def fit(m):
        def nap(batches):
            time.sleep(seconds)
            yield from batches

        m.df.select("job_count").coalesce(1).mapInArrow(nap, "job_count long").count()
        return lambda df, name: df.withColumn(name, F.lit(1.0))

    return fit


def test_fits_run_at_the_same_time(matrix):
    start = time.perf_counter()
    outcome = ensemble.fit_together(matrix, {f"nap{i}": slow_fit(4) for i in range(3)})
    assert time.perf_counter() - start < 11 and len(outcome) == 3


def test_data_errors_leave_a_detector_out_and_others_end_the_run(matrix):
    def unfit(m):
        raise detectors.DetectorDataError("too few rows")

    def unscored(m):
        def score(df, name):
            raise detectors.DetectorDataError("no such column")
        return score

    def broken(m):
        m.df.select(F.raise_error(F.lit("executor lost"))).collect()

    for name, fit in (("unfit", unfit), ("unscored", unscored), ("broken", broken), ("long", slow_fit(120))):
        detectors.register(name, fit)
    with pytest.warns(UserWarning, match="too few rows|no such column"):
        scored, columns = ensemble.raw_scores(matrix, ["unfit", "unscored", "hbos"])
    assert columns == ["score_unscored", "score_hbos"]
    assert scored.where("score_unscored <> 0").isEmpty()
    start = time.perf_counter()
    with pytest.raises(Exception, match="executor lost"):
        ensemble.raw_scores(matrix, ["long", "broken", "hbos"])
    # The other detectors' jobs were cancelled.
    assert time.perf_counter() - start < 60


def test_two_names_of_one_detector_are_fitted_once(matrix):
    calls = []

    def fit(m):
        calls.append(1)
        return lambda df, name: df.withColumn(name, F.lit(2.0))

    detectors.register("one", fit)
    detectors.register("two", fit)
    scored, columns = ensemble.raw_scores(matrix, ["one", "two", "ONE"])
    assert columns == ["score_one", "score_two"] and len(calls) == 1
    assert scored.where("score_two <> 2").isEmpty()


def test_unknown_detector(history):
    with pytest.raises(ValueError, match="magic"):
        detect(history, "grp", models=["magic"])


def test_alias(spark, history):
    out = detect(history, "grp", models=["OneClassSVM", "hbos"])
    assert "score_ocsvm" in out.columns


def test_user_detector(history):
    def fit(m):
        top = m.df.agg(F.max("job_count")).first()[0]
        return lambda df, name: df.withColumn(name, F.col("job_count") / F.lit(top))

    detectors.register("share", fit)
    out = detect(history, "grp", models=["share"], cooldown_days=0)
    assert out.agg(F.max("score_share")).first()[0] == 1.0


def test_too_little_history(spark):
    out = detect(days(spark, [1, 2, 3]), "grp", models=["hbos"])
    assert out.count() == 0 and "score_hbos" in out.columns and "is_anomaly" in out.columns


def test_options(history):
    every = detect(history, "grp", models=["hbos"], cooldown_days=0, quantile_bounds=(0.5, 0.9))
    few = detect(history, "grp", models=["hbos"], cooldown_days=0, quantile_bounds=(0.5, 0.9), weekly_alerts=1)
    assert every.where("is_anomaly = 1").count() > few.where("is_anomaly = 1").count() > 0
    extra = detect(history, "grp", models=["hbos"], extra_features={"season": F.quarter("date")}, dense_calendar=True)
    assert extra.count() == 20 * 39
