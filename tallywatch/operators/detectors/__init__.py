"""Outlier detectors and their registry.

A detector is ``fit(matrix) -> scorer`` and a scorer is ``scorer(frame, name)``,
which adds the column ``name`` to any frame with the matrix's rows. Higher scores
mean more unusual. Fits run in threads of their own (``operators.ensemble``). A fit or a
scorer that finds its data unfit raises ``DetectorDataError``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallywatch.operators.detectors import cblof, copod, hbos, iforest, knn, ocsvm
from tallywatch.operators.detectors.matrix import DetectorDataError, Matrix, build_matrix

Scorer = Callable[[DataFrame, str], DataFrame]
Fit = Callable[[Matrix], Scorer]

# The names under which users ask for a detector.
DEFAULT_MODELS = ("iforest", "hbos", "copod", "knn", "svm", "ocsvm", "cblof")
ALIASES = {"oneclasssvm": "ocsvm"}

_REGISTRY: dict[str, Fit] = {
    "iforest": iforest.fit,
    "hbos": hbos.fit,
    "copod": copod.fit,
    "knn": knn.fit,
    # Both names stand for the same one-class model, which so has twice the weight.
    "svm": ocsvm.fit,
    "ocsvm": ocsvm.fit,
    "cblof": cblof.fit,
}


def register(name: str, fit: Fit) -> None:
    """Add or replace a detector for use by name."""
    _REGISTRY[name.lower()] = fit


def resolve(name: str) -> tuple[str, Fit]:
    """The canonical name and the detector; an unknown name is an error."""
    lowered = str(name).lower()
    canonical = ALIASES.get(lowered, lowered)
    if canonical not in _REGISTRY:
        raise ValueError(f"unknown detector {name!r}; known: {', '.join(sorted(_REGISTRY))}")
    return canonical, _REGISTRY[canonical]


__all__ = ["DEFAULT_MODELS", "DetectorDataError", "Fit", "Matrix", "Scorer", "build_matrix", "register", "resolve"]
