"""One-class support vector machine (Schoelkopf et al. 2001) with random Fourier
features (Rahimi and Recht 2007) in place of the kernel.

The kernel needs all pairs; the random features make the model linear. Its weight is the
shortest vector among the weighted means of rows in which no row has more than
1 / (nu n). Each step is one pass over all rows: it finds the nu n rows that score lowest,
from counts and sums in narrow ranges of the score, and their mean. The next weight is the
shortest combination of the means found so far. Steps end when the duality gap is at most
``TOLERANCE`` of the squared length, or after ``STEPS`` of them with a warning that names the gap. The offset is the nu
quantile of the scores. Features are standardised first, because the kernel width is set
for unit scale.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.operators.detectors.matrix import Matrix

NU = 0.5
COMPONENTS = 128
STEPS = 200
TOLERANCE = 0.02
#: Ranges of the score in one pass.
BINS = 512
SEED = 42


def _standardiser(m: Matrix) -> tuple[np.ndarray, np.ndarray]:
    x = F.col("x")
    stats = m.df.agg(
        F.array(*[F.avg(x[i]) for i in range(m.width)]).alias("mean"),
        F.array(*[F.stddev_pop(x[i]) for i in range(m.width)]).alias("std"),
    ).first()
    std = np.array(stats["std"])
    return np.array(stats["mean"]), np.where(std > 0, std, 1.0)


def _lift(width: int, components: int, gamma: float, seed: int, mean, std):
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2.0 * gamma), size=(width, components))
    phase = rng.uniform(0.0, 2.0 * np.pi, size=components)

    def lift(x: pd.Series) -> np.ndarray:
        points = (np.stack(x.to_numpy()) - mean) / std
        return np.sqrt(2.0 / components) * np.cos(points @ weights + phase)

    return lift


def _ranges(m: Matrix, lift, components: int, weight: np.ndarray, lo: float, hi: float,
            with_sums: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Per range of the score between ``lo`` and ``hi``: rows, and sums of the lifted components.

    Scores outside count in the first or last range. At most ``BINS`` rows per task.
    """

    def partial(batches):
        total = np.zeros((BINS, components + 1))
        for batch in batches:
            if len(batch) == 0:
                continue
            lifted = lift(batch["x"])
            at = np.clip(((lifted @ weight - lo) / (hi - lo) * BINS).astype(np.int64), 0, BINS - 1)
            total[:, components] += np.bincount(at, minlength=BINS)
            if with_sums:
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                total[used, :components] += np.add.reduceat(lifted[order], first, axis=0)
        used = np.flatnonzero(total[:, components])
        rows = total[used] if with_sums else total[used, components:]
        yield pd.DataFrame({"bin": used, "part": list(rows)})

    rows = (
        m.df.select("x").mapInPandas(partial, "bin int, part array<double>")
        .select("bin", F.posexplode("part").alias("i", "v"))
        .groupBy("bin", "i").agg(F.sum("v").alias("v")).collect()
    )
    out = np.zeros((BINS, components + 1))
    shift = 0 if with_sums else components
    for row in rows:
        out[row["bin"], row["i"] + shift] = row["v"]
    return out[:, components], out[:, :components]


def _lowest(counts: np.ndarray, sums: np.ndarray, bound: float) -> np.ndarray:
    """The mean of the ``bound`` lowest rows, the last range taken in part."""
    upto = np.cumsum(counts)
    share = np.clip((bound - (upto - counts)) / np.maximum(counts, 1), 0.0, 1.0)
    return share @ sums / bound


def _shortest(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shortest vector in the convex hull of ``points`` and its coefficients, by pairwise exchange."""
    gram = points @ points.T
    c = np.full(len(points), 1.0 / len(points))
    for _ in range(20_000):
        slope = gram @ c
        down = int(slope.argmin())
        up = int(np.where(c > 0, slope, -np.inf).argmax())
        bend = gram[down, down] + gram[up, up] - 2 * gram[down, up]
        if slope[up] - slope[down] <= 1e-9 * abs(slope[down]) or bend <= 0:
            break
        move = min(c[up], (slope[up] - slope[down]) / bend)
        c[down] += move
        c[up] -= move
    return c @ points, c


def _train(m: Matrix, lift, nu: float, components: int, steps: int, tolerance: float) -> tuple[np.ndarray, float]:
    bound = nu * m.n_rows
    # Scores of 0 for the zero weight: one range holds all rows, whose mean is the start.
    counts, sums = _ranges(m, lift, components, np.zeros(components), -1.0, 1.0)
    weight = sums.sum(axis=0) / m.n_rows
    means = weight[None]
    for _ in range(steps):
        reach = max(float(np.sqrt(2.0 * (weight @ weight))), 1e-12)
        counts, sums = _ranges(m, lift, components, weight, -reach, reach)
        lowest = _lowest(counts, sums, bound)
        if weight @ (weight - lowest) <= tolerance * (weight @ weight):
            break
        weight, share = _shortest(np.concatenate([means, lowest[None]]))
        means = np.concatenate([means, lowest[None]])[share > 1e-12]
    else:
        gap = float(1 - (weight @ lowest) / (weight @ weight))
        warnings.warn(f"one-class model used with a duality gap of {gap:.3g} after {steps} steps", stacklevel=3)
    # The nu quantile of the scores, its range divided once more.
    lo, hi = -reach, reach
    for finer in (False, True):
        if finer:
            counts, _ = _ranges(m, lift, components, weight, lo, hi, with_sums=False)
        upto = np.cumsum(counts)
        at = min(int(np.searchsorted(upto, bound)), BINS - 1)
        lo, hi = lo + at * (hi - lo) / BINS, lo + (at + 1) * (hi - lo) / BINS
    return weight, hi


def fit(m: Matrix, nu: float = NU, gamma: float | None = None, components: int = COMPONENTS,
        steps: int = STEPS, seed: int = SEED, tolerance: float = TOLERANCE):
    gamma = 1.0 / m.width if gamma is None else gamma
    mean, std = _standardiser(m)
    lift = _lift(m.width, components, gamma, seed, mean, std)
    final_weight, final_rho = _train(m, lift, nu, components, steps, tolerance)

    @F.pandas_udf("double")
    def outside(x: pd.Series) -> pd.Series:
        return pd.Series(final_rho - lift(x) @ final_weight) if len(x) else pd.Series([], dtype="float64")

    def score(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, outside("x"))

    return score
