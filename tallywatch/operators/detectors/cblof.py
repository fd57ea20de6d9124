"""Cluster-based local outlier factor (He, Xu and Deng 2003).

Clusters are ordered by size; the large ones are those before the first place where
they hold the share ``alpha`` of all rows or the next one is ``beta`` times smaller.
A row's score is its distance to the centre of its own cluster if that is large,
else to the nearest large one. Either way that is the nearest large centre.

The clusters come from a coreset, in a number of passes that does not depend on the data.
Rows are dealt by a hash of their key into leaves of about ``LEAF`` rows. Each leaf is reduced to
``POINTS`` weighted points: centres drawn as in k-means++, each then moved to the mean of
the rows nearest to it and weighted with their number. ``FAN`` leaves at a time are put together and reduced
again until one set is left, on which Lloyd's steps run until they settle, from several
starts. ``PASSES`` Lloyd steps over all rows, one aggregation each with exact decimal sums,
follow. A row always falls into the same leaf, and draws are seeded by the leaf's number,
so nothing depends on how rows are partitioned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.arrays import squared_distance
from tallywatch.operators.detectors.matrix import DetectorDataError, Matrix
from tallywatch.sources.scratch import materialise, spread

CLUSTERS = 8
ALPHA = 0.9
BETA = 5.0
LEAF = 8192
POINTS = 256
FAN = 16
STARTS = 8
PASSES = 2
SEED = 42


def large_clusters(sizes: list[int], alpha: float = ALPHA, beta: float = BETA) -> list[int]:
    """Indices of the large clusters."""
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    total, held = sum(sizes), 0
    for place, i in enumerate(order):
        held += sizes[i]
        last = place + 1 == len(order)
        if last or held >= alpha * total or sizes[i] >= beta * sizes[order[place + 1]]:
            return order[: place + 1]
    return order


def _nearest(centres: np.ndarray) -> Column:
    """Index of the nearest centre, the first of equals."""
    distances = F.array(*[squared_distance(F.col("x"), c.tolist()) for c in centres])
    return F.array_position(distances, F.array_min(distances)) - 1


def _seeded(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` different points, or all there are, each drawn by its weighted squared distance to those before."""
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    near = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = near * weight
        total = mass.sum()
        if not total > 0:
            break
        chosen.append(int(rng.choice(len(x), p=mass / total)))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _assigned(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, squared distance) of every point."""
    near, index = np.full(len(x), np.inf), np.zeros(len(x), dtype=np.int64)
    for k, centre in enumerate(centres):
        d = ((x - centre) ** 2).sum(axis=1)
        closer = d < near
        near[closer], index[closer] = d[closer], k
    return index, near


def _means(x: np.ndarray, weight: np.ndarray, index: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weighted mean and the weight of each cluster; one without points stays where it is."""
    held = np.bincount(index, weights=weight, minlength=len(centres))
    sums = np.stack([np.bincount(index, weights=weight * x[:, i], minlength=len(centres)) for i in range(x.shape[1])], axis=1)
    return np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres), held


def reduced(x: np.ndarray, weight: np.ndarray, points: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` weighted points in the place of more; fewer stay as they are."""
    if len(x) <= points:
        return x, weight
    centres = _seeded(x, weight, points, np.random.default_rng(seed))
    means, held = _means(x, weight, _assigned(x, centres)[0], centres)
    return means[held > 0], held[held > 0]


def coreset(m: Matrix, leaf: int = LEAF, points: int = POINTS, fan: int = FAN, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(points, weights) that stand for all rows; at most ``fan`` x ``points`` reach the driver."""
    leaves = max(1, -(-m.n_rows // leaf))
    level = 0
    rows = m.df.select(
        F.pmod(F.xxhash64(F.lit(seed), *m.keys), F.lit(leaves)).cast("long").alias("leaf"),
        F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in m.keys]).cast("binary")).alias("key"), "x", F.lit(1.0).alias("weight"))

    def step(level: int):
        def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("key")
            number = int(pdf["leaf"].iloc[0])
            x, weight = reduced(np.stack(pdf["x"].to_numpy()), pdf["weight"].to_numpy(), points, [seed, level, number])
            # Zero-padded, so that the points of the next level are ordered by leaf and place.
            keys = [f"{number:020d}-{i:06d}" for i in range(len(x))]
            return pd.DataFrame({"leaf": number // fan, "key": keys, "x": list(x), "weight": weight})

        return reduce

    while True:
        rows = spread(rows, "leaf").groupBy("leaf").applyInPandas(step(level), "leaf long, key string, x array<double>, weight double")
        if leaves <= fan:
            break
        rows = materialise(rows, "coreset")
        leaves, level = -(-leaves // fan), level + 1
    held = rows.orderBy("key").toPandas()
    return np.stack(held["x"].to_numpy()), held["weight"].to_numpy()


def settled(x: np.ndarray, weight: np.ndarray, clusters: int, seed: int = SEED, starts: int = STARTS, steps: int = 300) -> np.ndarray:
    """The centres of the least cost that Lloyd's steps on weighted points reach from several starts."""
    best, least = None, np.inf
    for start in range(starts):
        centres = _seeded(x, weight, clusters, np.random.default_rng([seed, start]))
        before = None
        for _ in range(steps):
            index, near = _assigned(x, centres)
            if before is not None and (index == before).all():
                break
            before = index
            centres, _ = _means(x, weight, index, centres)
        cost = float((weight * _assigned(x, centres)[1]).sum())
        if cost < least:
            best, least = centres, cost
    return best


def lloyd(m: Matrix, centres: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, list[int]]:
    """The centres after so many steps over all rows, and the rows of each in the last one; an empty centre stays."""
    sums = [F.sum(F.col("x")[i].cast("decimal(28,9)")).cast("double").alias(f"s{i}") for i in range(m.width)]
    sizes = [0] * len(centres)
    for _ in range(passes):
        rows = m.df.withColumn("c", _nearest(centres)).groupBy("c").agg(F.count("*").alias("n"), *sums).collect()
        centres, sizes = centres.copy(), [0] * len(centres)
        for r in rows:
            centres[r["c"]] = np.array([r[f"s{i}"] for i in range(m.width)]) / r["n"]
            sizes[r["c"]] = r["n"]
    return centres, sizes


def fit(m: Matrix, clusters: int = CLUSTERS, alpha: float = ALPHA, beta: float = BETA):
    if m.n_rows == 0:
        raise DetectorDataError("no rows to cluster")
    centres, sizes = lloyd(m, settled(*coreset(m), clusters))
    large = large_clusters(sizes, alpha, beta)
    distances = [squared_distance(F.col("x"), centres[i].tolist()) for i in large]

    def score(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.sqrt(F.array_min(F.array(*distances))))

    return score
