"""Distance to the k-th nearest neighbour (Ramaswamy et al. 2000), exact, without
comparing all pairs.

Equal points are merged and carry a count. Space is cut into cells of bounded size
by median splits learnt from a sample. Every point first searches its own cell; the
distance found bounds its search, and it then visits only the cells whose bounding
box lies within that distance. The cuts affect the work, never the result. A task
holds one cell and a bounded number of its visitors at a time.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.joins import BROADCAST_ROWS, join_frequent_apart
from tallywatch.operators.detectors.matrix import Matrix
from tallywatch.sources.scratch import materialise, spread

NEIGHBOURS = 5
CELL_POINTS = 500
MAX_CELLS = 32_768
MAX_VISITORS = 8_000
SPLIT_SAMPLE = 20_000
SAMPLE_PER_CELL = 4


def _median_splits(sample: np.ndarray, cells: int) -> dict[str, np.ndarray]:
    """A binary tree of (dimension, cut) nodes with at most ``cells`` leaves.

    Always halves the leaf with most sample points, on its widest dimension.
    """
    dim, cut, left, right = [-1], [0.0], [-1], [-1]
    members = {0: np.arange(len(sample))}
    largest = [(-len(sample), 0)]
    leaves = 1
    while largest and leaves < cells:
        node = heapq.heappop(largest)[1]
        points = sample[members[node]]
        spread_of = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(sample.shape[1])
        if spread_of.max() <= 0:
            continue
        widest = int(spread_of.argmax())
        values = points[:, widest]
        middle = float(np.median(values))
        # At least one point on either side.
        at = middle if (values < middle).any() else float(values[values > middle].min())
        below = values < at
        rows = members.pop(node)
        dim[node], cut[node], left[node], right[node] = widest, at, len(dim), len(dim) + 1
        for part in (rows[below], rows[~below]):
            members[len(dim)] = part
            heapq.heappush(largest, (-len(part), len(dim)))
            dim.append(-1), cut.append(0.0), left.append(-1), right.append(-1)
        leaves += 1
    return {"dim": np.array(dim), "cut": np.array(cut), "left": np.array(left), "right": np.array(right)}


def _leaf_of(tree):
    @F.pandas_udf("int")
    def leaf(x: pd.Series) -> pd.Series:
        points = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        at = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        while True:
            dim = tree["dim"][at]
            inner = dim >= 0
            if not inner.any():
                return pd.Series(at.astype("int32"))
            below = points[rows, np.maximum(dim, 0)] < tree["cut"][at]
            at = np.where(inner, np.where(below, tree["left"][at], tree["right"][at]), at)

    return leaf


# Distances held at once; a block stays in the processor's cache.
BLOCK = 100_000


def _nearest(queries: np.ndarray, points: np.ndarray, copies: np.ndarray, k: int, same: bool) -> np.ndarray:
    """The ``k`` smallest squared distances of each query, points counted with copies.

    Missing neighbours are infinitely far. With ``same`` the queries are the points,
    and each leaves out one copy of itself.
    """
    out = np.full((len(queries), k), np.inf)
    take = min(k + 1, len(points))
    block = max(1, BLOCK // len(points))
    for start in range(0, len(queries), block):
        part = queries[start:start + block]
        d2 = np.zeros((len(part), len(points)))
        for i in range(points.shape[1]):
            step = part[:, i, None] - points[None, :, i]
            d2 += step * step
        closest = np.argpartition(d2, take - 1, axis=1)[:, :take]
        near = np.take_along_axis(d2, closest, axis=1)
        order = np.argsort(near, axis=1, kind="stable")
        closest, near = np.take_along_axis(closest, order, axis=1), np.take_along_axis(near, order, axis=1)
        n = copies[closest]
        if same:
            n = n - (closest == np.arange(start, start + len(part))[:, None])
        reached = n.cumsum(axis=1)
        for j in range(k):
            place = (reached <= j).sum(axis=1)
            there = np.flatnonzero(place < take)
            out[start + there, j] = near[there, place[there]]
    return out


def _cells_within(ids: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    @F.pandas_udf("array<long>")
    def targets(x: pd.Series, cell: pd.Series, reach: pd.Series) -> pd.Series:
        out = []
        step = max(1, 2_000_000 // len(ids))
        for start in range(0, len(x), step):
            points = np.stack(x.iloc[start:start + step].to_numpy())
            gap = np.zeros((len(points), len(ids)))
            for i in range(points.shape[1]):
                v = points[:, i, None]
                outside = np.maximum(np.maximum(lo[None, :, i] - v, v - hi[None, :, i]), 0.0)
                gap += outside * outside
            near = gap < reach.to_numpy()[start:start + step, None]
            near &= ids[None, :] != cell.to_numpy()[start:start + step, None]
            out.extend(ids[row].tolist() for row in near)
        return pd.Series(out, dtype="object")

    return targets


def _stack(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy())


def neighbour_distances(m: Matrix, k: int = NEIGHBOURS, cell_points: int = CELL_POINTS) -> DataFrame:
    """(x, n, distance) for each distinct point; with fewer than ``k`` others, the farthest."""
    points, cells = _in_cells(m, cell_points)

    def own_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _stack(pdf["x"])
        near = _nearest(x, x, pdf["n"].to_numpy(), k, same=True)
        return pd.DataFrame({"pid": pdf["pid"], "near": list(near)})

    near = spread(points, "cell").groupBy("cell").applyInPandas(own_cell, "pid long, near array<double>")
    if cells > 1:
        own = materialise(near, "near")
        near = own.unionByName(_other_cells(points, own, m.width, k))
    real = F.sort_array(F.filter(F.flatten(F.collect_list("near")), lambda d: d < float("inf")))
    kth = near.groupBy("pid").agg(real.alias("near")).select(
        "pid", F.coalesce(F.sqrt(F.get("near", F.least(F.lit(k), F.size("near")) - 1)), F.lit(0.0)).alias("distance")
    )
    return materialise(points.select("pid", "x", "n").join(kth, "pid").drop("pid"), "distances")


def _in_cells(m: Matrix, cell_points: int) -> tuple[DataFrame, int]:
    """(pid, x, n, cell): the distinct points, their number of rows and their cell; and
    the number of cells aimed at."""
    distinct = spread(m.df.groupBy("x").agg(F.count("*").alias("n")), "x")
    points = materialise(distinct.withColumn("pid", F.monotonically_increasing_id()), "points")
    total = points.count()
    cells = min(MAX_CELLS, -(-total // cell_points))
    per_cell = 2 * max(cell_points, -(-total // MAX_CELLS))
    if cells <= 1:
        return points.withColumn("cell", F.lit(0).cast("long")), 1

    every = max(1, total // max(SPLIT_SAMPLE, SAMPLE_PER_CELL * cells))
    rows = points.where(F.pmod(F.xxhash64("x"), F.lit(every)) == 0).select("x").collect()
    tree = _median_splits(np.array([r[0] for r in rows]), cells)
    placed = materialise(points.withColumn("leaf", _leaf_of(tree)("x")), "leaves")
    # A leaf the sample underestimated is divided by hash into cells of the intended
    # size. There are at most MAX_CELLS leaves.
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / per_cell)
    cell = F.col("leaf").cast("long") * MAX_CELLS + F.pmod("pid", parts)
    return placed.join(F.broadcast(sizes), "leaf").select("pid", "x", "n", cell.alias("cell")), cells


def _other_cells(points: DataFrame, own: DataFrame, width: int, k: int) -> DataFrame:
    """(pid, near): neighbours of each point in the cells within its reach, other than its own."""
    x = F.col("x")
    boxes = points.groupBy("cell").agg(
        F.array(*[F.min(x[i]) for i in range(width)]).alias("lo"),
        F.array(*[F.max(x[i]) for i in range(width)]).alias("hi"),
    ).collect()
    ids = np.array([b["cell"] for b in boxes])
    lo, hi = np.array([b["lo"] for b in boxes]), np.array([b["hi"] for b in boxes])

    reaching = points.join(own.select("pid", F.element_at("near", -1).alias("reach")), "pid")
    targets = _cells_within(ids, lo, hi)("x", "cell", "reach")
    visits = materialise(reaching.select("pid", "x", F.explode(targets).alias("target")), "visits")
    # The visitors of a cell are divided by hash into chunks of bounded size, each of
    # which meets a copy of the cell. There are at most as many rows as boxes.
    chunks = F.ceil(F.count("*") / MAX_VISITORS).cast("int").alias("chunks")
    loads = F.broadcast(visits.groupBy("target").agg(chunks))
    queries = visits.join(loads, "target").select(
        "pid", "x", "target", F.pmod(F.xxhash64("pid"), "chunks").cast("int").alias("chunk")
    )
    hosts = points.select(F.col("cell").alias("target"), "x", "n").join(loads, "target").select(
        F.col("target").alias("host"), "x", "n", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part")
    )

    def search(queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        near = _nearest(_stack(queries["x"]), _stack(others["x"]), others["n"].to_numpy(), k, same=False)
        return pd.DataFrame({"pid": queries["pid"], "near": list(near)})

    return (
        spread(queries, "target", "chunk").groupBy("target", "chunk")
        .cogroup(spread(hosts, "host", "part").groupBy("host", "part"))
        .applyInPandas(search, "pid long, near array<double>")
    )


def fit(m: Matrix, k: int = NEIGHBOURS, cell_points: int = CELL_POINTS, broadcast_rows: int = BROADCAST_ROWS):
    distances = neighbour_distances(m, k, cell_points)
    rows = join_frequent_apart(m.df.select(*m.keys, "x"), distances, ["x"], "n", m.n_rows, broadcast_rows).drop("x")

    def score(df: DataFrame, name: str) -> DataFrame:
        return df.join(rows.withColumnRenamed("distance", name), m.keys, "left")

    return score
