"""Polygon centroids from rings, within the row and without a shuffle.

A polygon is ``array<array<struct<x: double, y: double>>>``: rings of vertices,
closed or not, holes wound against their outer ring. Several outer rings make a
multi-polygon.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring(*points: tuple[Column, Column]) -> Column:
    """A ring from coordinate columns."""
    return F.array(*[_point(x.cast("double"), y.cast("double")) for x, y in points])


def centroid(rings: Column) -> Column:
    """Area-weighted centroid as ``struct<longitude, latitude>``.

    Without area it is the length-weighted middle of the edges, and of a single
    point the point itself; NULL where the first ring has no vertex.
    """
    return _bound(rings, _centroid)


def _centroid(rings: Column) -> Column:
    origin = F.get(F.get(rings, F.lit(0)), F.lit(0))

    def place(middle: Column) -> Column:
        return F.struct(
            (origin["x"] + middle["x"]).alias("longitude"),
            (origin["y"] + middle["y"]).alias("latitude"),
        )

    # Relative to the first vertex: far-off coordinates lose no digits.
    local = F.transform(
        rings,
        lambda r: F.transform(r, lambda p: _point(p["x"] - origin["x"], p["y"] - origin["y"])),
    )
    # The later forms are evaluated only where the earlier ones are NULL.
    middle = F.coalesce(
        _middle(local, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"], 3),
        _middle(local, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]), 2),
        _point(F.lit(0.0), F.lit(0.0)),
    )
    return F.when(origin.isNotNull(), _bound(middle, place))


def _middle(rings: Column, weight: Callable[[Column, Column], Column], parts: int) -> Column:
    """The weighted mean of the edges' end point sums, divided by ``parts``;
    NULL where the weights add up to zero."""

    def edge(a: Column, b: Column) -> Column:
        return F.struct(
            weight(a, b).alias("w"), (a["x"] + b["x"]).alias("x"), (a["y"] + b["y"]).alias("y")
        )

    def edges(r: Column) -> Column:
        # Each vertex with its successor; the last is followed by the first.
        return F.zip_with(r, F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)), edge)

    def add(total: Column, e: Column) -> Column:
        return F.struct(
            (total["w"] + e["w"]).alias("w"),
            (total["x"] + e["x"] * e["w"]).alias("x"),
            (total["y"] + e["y"] * e["w"]).alias("y"),
        )

    def mean(total: Column) -> Column:
        share = total["w"] * parts
        return F.when(share != 0, _point(total["x"] / share, total["y"] / share))

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("w", "x", "y")])
    return F.aggregate(F.flatten(F.transform(rings, edges)), zero, add, mean)


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
