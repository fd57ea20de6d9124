"""Queries on detector scores and the ensemble."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.ranks import exact_quantiles
from tallywatch.operators import ensemble, features
from tallywatch.operators.detectors import build_matrix, resolve
from tallywatch.plans.detect import detect
from tallywatch.sources.scratch import spread
from workload.fixed import FEATURES
from workload.series import EVENT_FEATURES, FLAG_OUT, G, KEYS, _flag_select
from workload.tables import day, events_daily, orders_daily, r6

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


MATRIX = EVENT_FEATURES + f""",
cells AS (
  SELECT grp, src, date, unnest([{', '.join(f'round(CAST({c} AS DOUBLE), 9)' for c in FEATURES)}]) AS v0,
         unnest(range({len(FEATURES)})) AS f FROM feat),
medians AS (SELECT f, quantile_cont(v0, 0.5) AS m FROM cells GROUP BY f),
x AS (SELECT c.grp, c.src, c.date, c.f, coalesce(c.v0, m.m, 0.0) AS v FROM cells c JOIN medians m ON m.f = c.f),
total AS (SELECT count(*) AS n FROM feat)"""

HBOS = """
ranges AS (SELECT f, min(v) AS lo, max(v) AS hi FROM x GROUP BY f),
binned AS (
  SELECT x.grp, x.src, x.date, x.f, r.lo, r.hi,
         CASE WHEN r.hi > r.lo THEN least(floor((x.v - r.lo) / ((r.hi - r.lo) / 10)), 9) ELSE 0 END AS b
  FROM x JOIN ranges r ON r.f = x.f),
filled AS (SELECT f, b, count(*) AS n FROM binned GROUP BY f, b),
hbos AS (
  SELECT grp, src, date, sum(CASE WHEN hi > lo
    THEN -log2(c.n / CAST(t.n AS DOUBLE) / ((hi - lo) / 10) + 0.1) ELSE 0.0 END) AS score_hbos
  FROM binned JOIN filled c ON c.f = binned.f AND c.b = binned.b, total t GROUP BY grp, src, date)"""

COPOD = """
skews AS (SELECT f, CASE WHEN max(v) > min(v) THEN skewness(v) END AS s FROM x GROUP BY f),
tails AS (
  SELECT x.grp, x.src, x.date, x.f, s.s,
         -ln(cume_dist() OVER (PARTITION BY x.f ORDER BY x.v)) AS l,
         -ln(cume_dist() OVER (PARTITION BY x.f ORDER BY x.v DESC)) AS r
  FROM x JOIN skews s ON s.f = x.f),
copod AS (
  SELECT grp, src, date, greatest(sum(l), sum(r), sum(CASE WHEN coalesce(s, 0) < 0 THEN l ELSE r END)) AS score_copod
  FROM tails GROUP BY grp, src, date)"""

KNN = """
points AS (SELECT grp, src, date, list(v ORDER BY f) AS p FROM x GROUP BY grp, src, date),
pairs AS (
  SELECT a.grp, a.src, a.date, list_distance(a.p, b.p) AS d FROM points a JOIN points b
  ON NOT (a.grp = b.grp AND a.src = b.src AND a.date = b.date)),
knn AS (SELECT grp, src, date, list_sort(list(d))[5] AS score_knn FROM pairs GROUP BY grp, src, date)"""


def _drawn(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


def _path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2 * (ln({n} - 1) + 0.5772156649015329) - 2.0 * ({n} - 1) / {n} END"


def _forest(limit: int = 8, trees: int = 100, subsample: int = 256) -> str:
    """The trees level by level, and every row's way through them."""
    key = "CAST(grp AS VARCHAR), CAST(src AS VARCHAR), CAST(date AS VARCHAR)"
    ctes = [f"""
deepest AS (SELECT least(n, {subsample}) AS size, CAST(ceil(log2(greatest(least(n, {subsample}), 2))) AS INTEGER) AS depth FROM total),
m0 AS (
  SELECT tree, grp, src, date, CAST(1 AS BIGINT) AS node FROM feat, range({trees}) AS t(tree)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {_drawn("'42'", 'CAST(tree AS VARCHAR)', key)}, {key}) <= {subsample}),
w0 AS (SELECT tree, grp, src, date, CAST(1 AS BIGINT) AS node, CAST(NULL AS DOUBLE) AS length FROM feat, range({trees}) AS t(tree))"""]
    for k in range(limit + 1):
        ctes.append(f"""
n{k} AS (SELECT tree, node, count(*) AS n FROM m{k} GROUP BY tree, node),
f{k} AS (
  SELECT tree, node, f, min(v) AS lo, max(v) AS hi FROM m{k} JOIN x USING (grp, src, date) GROUP BY tree, node, f HAVING max(v) > min(v)),
s{k} AS (
  SELECT tree, node, f, lo + {_drawn("'42'", 'CAST(tree AS VARCHAR)', 'CAST(node AS VARCHAR)', "'cut'")} / 4294967296.0::DOUBLE * (hi - lo) AS cut
  FROM f{k}, deepest WHERE {k} < deepest.depth
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY f) = 1 +
    ({_drawn("'42'", 'CAST(tree AS VARCHAR)', 'CAST(node AS VARCHAR)', "'feature'")} * count(*) OVER (PARTITION BY tree, node)) // 4294967296),
m{k + 1} AS (
  SELECT m.tree, m.grp, m.src, m.date, 2 * m.node + CASE WHEN x.v >= s.cut THEN 1 ELSE 0 END AS node
  FROM m{k} m JOIN s{k} s ON s.tree = m.tree AND s.node = m.node
  JOIN x ON x.grp = m.grp AND x.src = m.src AND x.date = m.date AND x.f = s.f),
w{k + 1} AS (
  SELECT w.tree, w.grp, w.src, w.date,
         CASE WHEN s.f IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN x.v >= s.cut THEN 1 ELSE 0 END END AS node,
         CASE WHEN w.length IS NULL AND s.f IS NULL THEN {k} + {_path('coalesce(n.n, 0)')} ELSE w.length END AS length
  FROM w{k} w LEFT JOIN s{k} s ON s.tree = w.tree AND s.node = w.node AND w.length IS NULL
  LEFT JOIN n{k} n ON n.tree = w.tree AND n.node = w.node
  LEFT JOIN x ON x.grp = w.grp AND x.src = w.src AND x.date = w.date AND x.f = s.f)""")
    ctes.append(f"""
iforest AS (
  SELECT grp, src, date, pow(2.0, -sum(length) / {trees} / max(CASE WHEN size <= 1 THEN 1.0 ELSE {_path('size')} END)) AS score_iforest
  FROM w{limit + 1}, deepest GROUP BY grp, src, date)""")
    return ",".join(ctes)


IFOREST = _forest()


def _matrix(spark, sf):
    return build_matrix(features.build_features(spread(events_daily(spark, sf), G, "src"), G), G)


def _score(spark, sf, name: str):
    m = _matrix(spark, sf)
    column = f"score_{name}"
    scored = resolve(name)[1](m)(m.df, column)
    return day(scored.select(*KEYS, r6(column).alias(column)))


def _score_query(name: str):
    return lambda spark, sf: _score(spark, sf, name)


for _name, _sql in {
    "hbos": HBOS, "copod": COPOD, "knn": KNN, "iforest": IFOREST,
    # No SQL for these: clusters and random features.
    "cblof": None, "ocsvm": None, "svm": None,
}.items():
    query(f"score_{_name}", None if _sql is None else f"""WITH {MATRIX}, {_sql}
SELECT grp, src, CAST(date AS VARCHAR) AS date, round(score_{_name}, 6) + 0.0 AS score_{_name} FROM {_name}""")(
        _score_query(_name))


@query("medians", f"WITH {EVENT_FEATURES} SELECT " + ", ".join(
    f"round(quantile_cont({c}, 0.5), 6) + 0.0 AS {c}" for c in FEATURES) + " FROM feat")
def medians(spark, sf):
    feat = features.build_features(events_daily(spark, sf), G)
    values = exact_quantiles(feat, list(FEATURES), 0.5, feat.count())
    return values.select(*[r6(c).alias(c) for c in FEATURES])


SCALED = ("z_28", "mean_7", "month", "pct_chg_7")


@query("minmax_scores", f"WITH {EVENT_FEATURES} SELECT grp, src, CAST(date AS VARCHAR) AS date, " + ", ".join(
    f"""round(CASE WHEN max({c}) OVER () > min({c}) OVER () THEN
    (coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM feat)) - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())
    ELSE 0.0 END, 6) + 0.0 AS {c}""" for c in SCALED) + " FROM feat")
def minmax_scores(spark, sf):
    feat = features.build_features(events_daily(spark, sf), G).select(*KEYS, *SCALED)
    scaled = ensemble.minmax(ensemble.fill_scores(feat, list(SCALED), feat.count()), list(SCALED))
    return day(scaled).select(*KEYS, *[r6(c).alias(c) for c in SCALED])


@query("aligned_score", f"""WITH {EVENT_FEATURES},
labelled AS (SELECT grp, src, date, -abs(z_28) AS s, CASE WHEN job_count > mean_28 + std_28 THEN 1 ELSE 0 END AS label
             FROM feat)
SELECT grp, src, CAST(date AS VARCHAR) AS date, round(CASE WHEN
  (SELECT avg(s) FROM labelled WHERE label = 1) < (SELECT avg(s) FROM labelled WHERE label = 0)
  THEN -s ELSE s END, 6) + 0.0 AS s FROM labelled""")
def aligned_score(spark, sf):
    feat = features.build_features(events_daily(spark, sf), G)
    labelled = feat.select(
        *KEYS, (-F.abs("z_28")).alias("s"),
        (F.col("job_count") > F.col("mean_28") + F.col("std_28")).cast("int").alias("label"),
    )
    return day(ensemble.align_direction(labelled, "s", "label")).select(*KEYS, r6("s").alias("s"))


def _unit(score: str) -> str:
    return f"""CASE WHEN max({score}) OVER () > min({score}) OVER ()
    THEN ({score} - min({score}) OVER ()) / (max({score}) OVER () - min({score}) OVER ()) ELSE 0.0 END"""


THREE = MATRIX + "," + HBOS + "," + COPOD + "," + KNN + f""",
unit AS (
  SELECT h.grp, h.src, h.date, {_unit('score_hbos')} AS score_hbos, {_unit('score_copod')} AS score_copod,
         {_unit('score_knn')} AS score_knn
  FROM hbos h JOIN copod c ON c.grp = h.grp AND c.src = h.src AND c.date = h.date
  JOIN knn k ON k.grp = h.grp AND k.src = h.src AND k.date = h.date),
bounded AS (
  SELECT u.*, f.job_count, round((score_hbos + score_copod + score_knn) / 3, 9) AS score_ens
  FROM unit u JOIN feat f ON f.grp = u.grp AND f.src = u.src AND f.date = u.date),
flagged AS (
  SELECT *, CASE WHEN score_ens >= threshold THEN 1 ELSE 0 END AS is_anomaly FROM (
    SELECT *, quantile_cont(score_ens, 0.95) OVER (PARTITION BY grp, src) AS threshold FROM bounded)),
runs AS (
  SELECT grp, src, date, date - CAST(row_number() OVER (PARTITION BY grp, src ORDER BY date) AS INTEGER) AS island
  FROM flagged WHERE is_anomaly = 1),
kept AS (
  SELECT grp, src, date FROM (
    SELECT *, row_number() OVER (PARTITION BY grp, src, island ORDER BY date) AS place FROM runs)
  WHERE place % 2 = 1),
cooled AS (
  SELECT f.* EXCLUDE (is_anomaly), CASE WHEN k.date IS NULL THEN 0 ELSE 1 END AS is_anomaly
  FROM flagged f LEFT JOIN kept k ON f.grp = k.grp AND f.src = k.src AND f.date = k.date)"""


@query("ensemble_three", f"WITH {THREE} {FLAG_OUT} cooled")
def ensemble_three(spark, sf):
    """The detection run with the three detectors that SQL can follow."""
    return _flag_select(detect(events_daily(spark, sf), G, models=("hbos", "copod", "knn")))


@query("ensemble_flags")
def ensemble_flags(spark, sf):
    """The detection run with all seven detectors."""
    result = detect(events_daily(spark, sf), G)
    scores = [c for c in result.columns if c.startswith("score_")]
    return day(result, "date", "date_only").withColumns({c: r6(c) for c in (*scores, "threshold")})


@query("ensemble_flags_orders")
def ensemble_flags_orders(spark, sf):
    """The same on the long order series, some twenty times as many segment-days."""
    result = detect(orders_daily(spark, sf), G)
    scores = [c for c in result.columns if c.startswith("score_")]
    return day(result, "date", "date_only").withColumns({c: r6(c) for c in (*scores, "threshold")})
