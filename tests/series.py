"""Small daily series for tests."""

import datetime as dt

import numpy as np

START = dt.date(2025, 1, 1)


def days(spark, counts, group="A", src="x", start=START):
    """One segment with a count for each day; None leaves the day out."""
    rows = [(start + dt.timedelta(days=i), group, src, int(n)) for i, n in enumerate(counts) if n is not None]
    return spark.createDataFrame(rows, "date date, grp string, src string, job_count long")


def noisy(spark, segments=20, length=45, spike=None, seed=7):
    """Poisson counts; ``spike`` is (segment, day, factor)."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(segments):
        level = 50 + 10 * s
        for d in range(length):
            n = int(rng.poisson(level))
            if spike and spike[:2] == (s, d):
                n = level * spike[2]
            rows.append((START + dt.timedelta(days=d), f"G{s}", "x", n))
    return spark.createDataFrame(rows, "date date, grp string, src string, job_count long")
