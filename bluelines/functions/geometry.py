"""Planar linear referencing on ``array<struct<x,y,m>>`` lines, as column expressions.

A line of several parts is an array of such arrays, in measure order; between two parts the measures may
jump, and nothing lies in that gap. The functions that end in ``_parts`` take such lines.

Coordinates are planar metres, so plain Euclidean arithmetic is right. Every function
works on one row's arrays with higher-order functions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(geom: Column) -> Column:
    """Consecutive vertex pairs with their index and planar length."""
    return F.transform(
        F.sequence(F.lit(0), F.size(geom) - 2),
        lambda i: F.struct(i.alias("i"), F.get(geom, i).alias("a"), F.get(geom, i + 1).alias("b")))


def closest_point(geom: Column, px: Column, py: Column) -> Column:
    """Distance from a point to a line, and where along the line the closest point lies.

    Returns ``struct(dist, along, total, x, y)``: ``along`` is the planar length from the
    start to the closest point, ``total`` the planar length of the line, so
    ``along / total`` is the fraction along the line. The first closest vertex pair wins ties.
    Lines of length 0 give fraction 0 (guarded by the caller through ``total``).
    """
    def per_pair(p):
        dx = p["b"]["x"] - p["a"]["x"]
        dy = p["b"]["y"] - p["a"]["y"]
        l2 = dx * dx + dy * dy
        t_raw = ((px - p["a"]["x"]) * dx + (py - p["a"]["y"]) * dy) / l2
        t = F.when(l2 == 0, F.lit(0.0)).otherwise(F.least(F.greatest(t_raw, F.lit(0.0)), F.lit(1.0)))
        qx = p["a"]["x"] + t * dx
        qy = p["a"]["y"] + t * dy
        d = F.sqrt((px - qx) ** 2 + (py - qy) ** 2)
        return F.struct(d.alias("dist"), p["i"].alias("i"), t.alias("t"), F.sqrt(l2).alias("len"),
                        qx.alias("x"), qy.alias("y"))

    cand = F.transform(_pairs(geom), per_pair)
    best = F.array_min(cand)  # smallest distance, then the first pair
    before = F.aggregate(F.filter(cand, lambda c: c["i"] < best["i"]), F.lit(0.0), lambda acc, c: acc + c["len"])
    total = F.aggregate(cand, F.lit(0.0), lambda acc, c: acc + c["len"])
    return F.struct(best["dist"].alias("dist"), (before + best["t"] * best["len"]).alias("along"),
                    total.alias("total"), best["x"].alias("x"), best["y"].alias("y"))


def _interpolate(a: Column, b: Column, m: Column) -> Column:
    """The point at measure ``m`` on the vertex pair ``a``-``b`` (``a`` itself when they share m)."""
    dm = b["m"] - a["m"]
    t = F.when(dm == 0, F.lit(0.0)).otherwise((m - a["m"]) / dm)
    return F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"),
                    (a["y"] + t * (b["y"] - a["y"])).alias("y"),
                    m.alias("m"))


def first_pair_holding(geom: Column, m: Column) -> Column:
    """Index of the first vertex pair ``i, i+1`` with ``m_i <= m <= m_i+1``; NULL when none does.
    One lambda over indices (no pair structs are built)."""
    idx = F.filter(F.sequence(F.lit(0), F.size(geom) - 2),
                   lambda i: (F.get(geom, i)["m"] <= m) & (m <= F.get(geom, i + 1)["m"]))
    return F.get(idx, 0)


def point_on_pair(geom: Column, i: Column, m: Column) -> Column:
    """The point at measure ``m`` on the vertex pair ``i, i+1``; NULL where ``i`` is."""
    return F.when(i.isNotNull(), _interpolate(F.get(geom, i), F.get(geom, i + 1), m))


def point_at_measure(geom: Column, m: Column) -> Column:
    """The point of a measured line at measure ``m`` (first vertex pair whose range holds it); NULL outside."""
    return point_on_pair(geom, first_pair_holding(geom, m), m)


def between_points(geom: Column, start: Column, end: Column, m0: Column, m1: Column) -> Column:
    """``between_measures`` from its two end points (NULL: outside)."""
    inner = F.filter(geom, lambda p: (p["m"] > m0) & (p["m"] < m1))
    none = F.slice(geom, 1, 0)  # an empty array of the vertex type
    return F.concat(F.when(start.isNull(), none).otherwise(F.array(start)), inner,
                    F.when(end.isNull(), none).otherwise(F.array(end)))


def between_measures(geom: Column, m0: Column, m1: Column) -> Column:
    """The part of a measured line between measures ``m0 <= m1``, end points interpolated.

    Vertices strictly inside the range are kept; the ends are interpolated on the vertex pair that
    holds them. An empty array when the range misses the line.
    """
    return between_points(geom, point_at_measure(geom, m0), point_at_measure(geom, m1), m0, m1)


def closest_point_parts(parts: Column, px: Column, py: Column) -> Column:
    """``closest_point`` over the parts of a line; ``along`` and ``total`` run over all of them, gaps count nothing.
    The first of equally close parts wins."""
    found = F.transform(parts, lambda p, i: F.struct(closest_point(p, px, py).alias("c"), i.alias("i")))
    best = F.array_min(F.transform(found, lambda f: F.struct(f["c"]["dist"].alias("dist"), f["i"].alias("i"), f["c"].alias("c"))))
    before = F.aggregate(F.filter(found, lambda f: f["i"] < best["i"]), F.lit(0.0), lambda acc, f: acc + f["c"]["total"])
    total = F.aggregate(found, F.lit(0.0), lambda acc, f: acc + f["c"]["total"])
    return F.struct(best["dist"].alias("dist"), (before + best["c"]["along"]).alias("along"), total.alias("total"),
                    best["c"]["x"].alias("x"), best["c"]["y"].alias("y"))


def point_at_measure_parts(parts: Column, m: Column) -> Column:
    """The point at measure ``m`` on the first part that holds it; NULL in a gap and outside."""
    return F.get(F.filter(F.transform(parts, lambda p: point_at_measure(p, m)), lambda q: q.isNotNull()), 0)


def covered_range(part: Column, m0: Column, m1: Column) -> tuple[Column, Column]:
    """The measures between which the range ``m0 <= m1`` covers a part."""
    return F.greatest(m0, F.get(part, 0)["m"]), F.least(m1, F.element_at(part, -1)["m"])


def covered_parts(parts: Column, m0: Column, m1: Column) -> Column:
    """The parts of a line, whole and in order, that the range covers for more than a point (a range of one measure: the
    part that holds it)."""
    def covered(p):
        low, high = covered_range(p, m0, m1)
        return (F.size(p) > 0) & ((low < high) | ((low == high) & (m0 == m1)))

    return F.filter(parts, covered)


def between_measures_parts(parts: Column, m0: Column, m1: Column) -> Column:
    """The parts of a line between measures ``m0 <= m1``, in order: one per part that the range covers for
    more than a point (a range of one measure: the part that holds it). No part where the range lies in a gap."""
    return F.transform(covered_parts(parts, m0, m1), lambda p: between_measures(p, *covered_range(p, m0, m1)))


def force2d(p: Column) -> Column:
    """Drop the measure of a point."""
    return F.struct(p["x"].alias("x"), p["y"].alias("y"))
