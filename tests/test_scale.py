"""The paths taken by large or skewed tables, forced on small ones and compared with brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.functions import joins, ranks
from tallywatch.operators.detectors import build_matrix, cblof, copod, hbos, iforest, knn, ocsvm
from tallywatch.operators.detectors.matrix import Matrix
from tallywatch.operators.features import build_features
from tests.series import START, noisy


def table(spark, values):
    return spark.createDataFrame([(float(a), None if b is None else float(b)) for a, b in values], "a double, b double")


@pytest.mark.parametrize("range_rows", [1_000_000, 50, 7])
def test_exact_quantiles(spark, range_rows):
    rng = np.random.default_rng(1)
    # A third of all rows hold one value.
    a = np.where(rng.random(900) < 0.34, 5.0, rng.integers(0, 200, 900))
    b = [None if i % 10 == 0 else v for i, v in enumerate(rng.normal(size=900))]
    df = table(spark, list(zip(a, b)))
    for q in (0.0, 0.5, 0.95, 1.0):
        got = ranks.exact_quantiles(df, ["a", "b"], q, 900, range_rows).first()
        assert got["a"] == pytest.approx(np.quantile(a, q))
        assert got["b"] == pytest.approx(np.quantile([v for v in b if v is not None], q))


@pytest.mark.parametrize("range_rows", [1_000_000, 40])
def test_running_counts(spark, range_rows):
    rng = np.random.default_rng(2)
    a = np.where(rng.random(600) < 0.34, 3.0, rng.normal(size=600).round(2))
    counts = ranks.value_counts(ranks.stack_columns(table(spark, [(v, v) for v in a]), ["a", "b"]))
    out = ranks.running_counts(counts, 600, range_rows).collect()
    assert all(r["upto"] == int((a <= r["value"]).sum()) and r["n"] == int((a == r["value"]).sum()) for r in out)
    assert len(out) == 2 * len(set(a))


def test_hot_keys_join_once(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    keys = facts.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    for max_rows in (10_000, 10):
        out = joins.join_frequent_apart(facts, keys, ["k"], "n", 3000, max_rows)
        assert out.count() == 3000 and out.where("v = 2 * k").count() == 3000


@pytest.mark.parametrize("limit", [100, 1])
def test_lookup_keeps_every_row(spark, limit):
    facts = spark.createDataFrame([("a",)] * 500 + [(None,)] * 500 + [("z",)], "k string")
    keys = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = joins.lookup(facts, "k", keys, limit)
    assert out.count() == 1001 and out.where("v = 1").count() == 500


def matrix_of(spark, x):
    rows = [("A", "x", START.toordinal() + i, p.tolist()) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "grp string, src string, date int, x array<double>")
    return Matrix(df.withColumn("job_count", F.lit(0).cast("long")), "grp", tuple("abc"), len(x))


@pytest.mark.parametrize("cell_points, broadcast_rows", [(10_000, 10_000), (60, 10), (9, 10)])
def test_knn_equals_brute_force(spark, cell_points, broadcast_rows, monkeypatch):
    monkeypatch.setattr(knn, "MAX_VISITORS", 20)
    rng = np.random.default_rng(3)
    x = np.concatenate([
        rng.normal(size=(250, 3)) * [100, 1, 10],
        np.tile([1.0, 2.0, 3.0], (150, 1)),
        np.tile([500.0, 0.0, 0.0], (3, 1)),
        rng.integers(0, 3, size=(60, 3)).astype(float),
    ])
    out = knn.fit(matrix_of(spark, x), 5, cell_points, broadcast_rows)(matrix_of(spark, x).df, "d").collect()
    assert len(out) == len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, 4]
    for r in out:
        assert r["d"] == pytest.approx(want[r["date"] - START.toordinal()])


def test_knn_with_few_rows(spark):
    x = np.array([[0.0, 0, 0], [3.0, 4, 0]])
    out = knn.fit(matrix_of(spark, x))(matrix_of(spark, x).df, "d").collect()
    assert [r["d"] for r in out] == [5.0, 5.0]
    single = np.array([[1.0, 1, 1]])
    assert knn.fit(matrix_of(spark, single))(matrix_of(spark, single).df, "d").first()["d"] == 0.0


@pytest.mark.parametrize("range_rows, broadcast_rows", [(1_000_000, 1_000_000), (30, 1)])
def test_copod_equals_brute_force(spark, range_rows, broadcast_rows):
    rng = np.random.default_rng(4)
    x = np.stack([
        np.where(rng.random(300) < 0.34, 0.0, rng.exponential(size=300).round(2)),
        -rng.exponential(size=300).round(2), np.full(300, 7.0),
    ], axis=1)
    m = matrix_of(spark, x)
    out = copod.fit(m, range_rows, broadcast_rows)(m.df, "s").collect()
    left = -np.log((x[:, None, :] >= x[None]).mean(axis=1))
    right = -np.log((x[:, None, :] <= x[None]).mean(axis=1))
    skew = ((x - x.mean(axis=0)) ** 3).sum(axis=0)
    by_skew = np.where(skew < -1e-9, left, right)
    want = np.max([left.sum(axis=1), right.sum(axis=1), by_skew.sum(axis=1)], axis=0)
    assert len(out) == 300
    for r in out:
        assert r["s"] == pytest.approx(want[r["date"] - START.toordinal()])


def test_partitioning_does_not_change_scores(spark):
    history = noisy(spark, segments=6)
    one = build_matrix(build_features(history.coalesce(1), "grp"), "grp")
    many = build_matrix(build_features(history.repartition(7), "grp"), "grp")
    for fit in (iforest.fit, knn.fit, copod.fit, hbos.fit, cblof.fit, ocsvm.fit):
        a = {(r["grp"], r["date"]): r["s"] for r in fit(one)(one.df, "s").collect()}
        b = {(r["grp"], r["date"]): r["s"] for r in fit(many)(many.df, "s").collect()}
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k]) for k in a)
