"""Distances between two arrays of coordinates, as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Metric names and the precision of a reported distance.
EUCLIDEAN = "euclidian"
MANHATTAN = "manhattan"
SQUARED = "fast-euclidian"
METRICS = (EUCLIDEAN, MANHATTAN, SQUARED)
DISTANCE_DIGITS = 5


def _gaps(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))


def exact_distance(a: Column, b: Column, metric: str = EUCLIDEAN) -> Column:
    """Unrounded distance; the squared metric skips the square root."""
    if metric == MANHATTAN:
        return F.aggregate(_gaps(a, b), F.lit(0.0), lambda s, g: s + F.abs(g))
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
    squares = F.aggregate(_gaps(a, b), F.lit(0.0), lambda s, g: s + g * g)
    return squares if metric == SQUARED else F.sqrt(squares)


def distance(a: Column, b: Column, metric: str = EUCLIDEAN) -> Column:
    return F.round(exact_distance(a, b, metric), DISTANCE_DIGITS)


def radius(eps: float, metric: str) -> float:
    """The neighbourhood limit on the scale that ``exact_distance`` uses."""
    return eps * eps if metric == SQUARED else eps
