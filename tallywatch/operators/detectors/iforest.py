"""Isolation forest (Liu, Ting and Zhou 2008), grown level by level for all trees at once.

A tree takes the ``subsample`` rows whose key has the smallest MD5 together with the tree's
number, a bounded sample that the method prescribes. Node 1 is the root, the children of
node n are 2 n and 2 n + 1. One aggregation per level finds the extremes of every feature
in every open node of all trees. The feature to split on and the place of the cut between its
extremes are drawn by the MD5 of (tree, node), so that nothing depends on how rows are
partitioned, and SQL can grow the same trees. Every row is scored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.operators.detectors.matrix import DetectorDataError, Matrix
from tallywatch.sources.scratch import materialise

TREES = 100
SUBSAMPLE = 256
SEED = 42
#: Draws are whole numbers below this.
DRAWS = 1 << 32


def expected_path(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _draw(*parts: Column) -> Column:
    """A whole number below ``DRAWS`` from the MD5 of the parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def subsamples(m: Matrix, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> DataFrame:
    """(tree, x): the rows of every tree.

    Only rows whose draw is small enough to be among somewhat more than ``subsample``
    are ordered; should a tree get too few of them, all rows are.
    """
    size = min(subsample, m.n_rows)
    all_trees = F.sequence(F.lit(0), F.lit(trees - 1))
    key = [F.col(k) for k in m.keys]

    def chosen(share: float) -> DataFrame:
        mine = F.filter(all_trees, lambda t: _draw(F.lit(seed), t, *key) < F.lit(int(share * DRAWS)))
        drawn = m.df.select(*m.keys, "x", F.explode(mine).alias("tree")).withColumn("draw", _draw(F.lit(seed), F.col("tree"), *key))
        order = Window.partitionBy("tree").orderBy("draw", *[F.col(k).cast("string") for k in m.keys])
        return materialise(drawn.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size).select("tree", "x"), "subsamples")

    share = (size + 6 * size ** 0.5 + 10) / max(1, m.n_rows)
    rows = chosen(min(1.0, share))
    return rows if share >= 1 or rows.count() == trees * size else chosen(1.0)


def _node_draws(seed: int, tree: np.ndarray, node: np.ndarray, use: str) -> np.ndarray:
    """``_draw`` of (seed, tree, node, use) for nodes at hand."""
    texts = (f"{seed}|{t}|{n}|{use}".encode() for t, n in zip(tree.tolist(), node.tolist()))
    return np.array([int(hashlib.md5(text).hexdigest()[:8], 16) for text in texts], dtype=np.int64)


def _splits(level: pa.Table, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, cut) of every node of a level, -1 where no feature has two values."""
    lo = np.stack([level[f"lo{i}"].to_numpy() for i in range(width)], axis=1)
    hi = np.stack([level[f"hi{i}"].to_numpy() for i in range(width)], axis=1)
    tree, node, usable = level["tree"].to_numpy(), level["node"].to_numpy(), hi > lo
    place = _node_draws(seed, tree, node, "feature") * usable.sum(axis=1) // DRAWS
    feature = np.where(usable.any(axis=1), (usable & (usable.cumsum(axis=1) == place[:, None] + 1)).argmax(axis=1), -1)
    rows = np.arange(len(node))
    low, high = lo[rows, feature], hi[rows, feature]
    return feature, low + _node_draws(seed, tree, node, "cut") / DRAWS * (high - low)


def grow(rows: DataFrame, width: int, limit: int, seed: int = SEED) -> list[tuple[np.ndarray, ...]]:
    """Per level, the arrays tree, node, number of rows, feature (-1 for a leaf) and cut.

    One aggregation for all trees; at most ``trees`` x 2 ** level nodes of a level reach the driver.
    """
    spark = rows.sparkSession
    levels = []
    ends = [end(F.col("x")[i]).alias(f"{name}{i}") for i in range(width) for name, end in (("lo", F.min), ("hi", F.max))]
    at = rows.withColumn("node", F.lit(1).cast("long"))
    for depth in range(limit + 1):
        level = at.groupBy("tree", "node").agg(F.count("*").alias("n"), *ends).toArrow()
        tree, node = level["tree"].to_numpy(), level["node"].to_numpy()
        feature, cut = _splits(level, width, seed) if depth < limit else (np.full(len(node), -1), np.zeros(len(node)))
        levels.append((tree, node, level["n"].to_numpy(), feature, cut))
        open_ = feature >= 0
        if not open_.any():
            break
        split = spark.createDataFrame(pa.table({
            "tree": tree[open_], "node": node[open_], "feature": feature[open_].astype(np.int32), "cut": cut[open_]}))
        # Bounded by trees x 2 ** limit rows, whatever the data. Written, so that every level has the same short plan.
        at = materialise(at.join(F.broadcast(split), ["tree", "node"]).select(
            "tree", "x", (F.col("node") * 2 + (F.get("x", F.col("feature")) >= F.col("cut")).cast("long")).alias("node")), "open-nodes")
    return levels


def fit(m: Matrix, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED):
    if m.n_rows == 0:
        raise DetectorDataError("no rows to grow trees from")
    size = min(subsample, m.n_rows)
    limit = int(np.ceil(np.log2(max(size, 2))))
    levels = grow(subsamples(m, trees, subsample, seed), m.width, limit, seed)
    # The model: arrays by tree and node, at most 4 x subsample nodes each. A node without rows has its depth as length.
    nodes = 1 << limit + 1
    feature = np.full((trees, nodes), -1)
    cut = np.zeros((trees, nodes))
    length = np.tile(np.floor(np.log2(np.maximum(np.arange(nodes), 1))), (trees, 1))
    for depth, (tree, node, n, chosen, place) in enumerate(levels):
        leaf = chosen < 0
        length[tree[leaf], node[leaf]] = depth + np.array([expected_path(k) for k in n[leaf].tolist()])
        feature[tree, node], cut[tree, node] = chosen, place
    shared = m.df.sparkSession.sparkContext.broadcast((feature, cut, length))
    scale = expected_path(size) or 1.0

    @F.pandas_udf("double")
    def isolation(x: pd.Series) -> pd.Series:
        feature, cut, length = shared.value
        points = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        rows = np.arange(len(points))
        depth = np.zeros(len(points))
        for tree in range(len(feature)):
            at = np.ones(len(points), dtype=np.int64)
            for _ in range(limit):
                chosen = feature[tree, at]
                above = points[rows, np.maximum(chosen, 0)] >= cut[tree, at]
                at = np.where(chosen >= 0, 2 * at + above, at)
            depth += length[tree, at]
        return pd.Series(np.power(2.0, -depth / len(feature) / scale))

    def score(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, isolation("x"))

    return score
