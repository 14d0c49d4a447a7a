"""Polygons as arrays of points. A ring is array<struct<x double, y double>>, closed or not."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import col

RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def point(x, y) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def rectangle(x0, y0, x1, y1) -> Column:
    """A closed ring of five points."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def _turns(ring) -> Column:
    """Each point with the next one; the last with the first."""
    ring = col(ring)
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _sum(ring, term) -> Column:
    return F.aggregate(_turns(ring), F.lit(0.0), lambda s, t: s + term(t["p"], t["q"]))


def signed_area(ring) -> Column:
    return _sum(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]) / 2.0


def area(ring) -> Column:
    return F.abs(signed_area(ring))


def centroid(ring) -> Column:
    """Area-weighted; null without area."""
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    six = signed_area(ring) * 6.0
    x = _sum(ring, lambda p, q: (p["x"] + q["x"]) * cross(p, q)) / six
    y = _sum(ring, lambda p, q: (p["y"] + q["y"]) * cross(p, q)) / six
    return F.when(six != 0, F.struct(x.alias("x"), y.alias("y")))


def move(ring, x, y) -> Column:
    return F.transform(col(ring), lambda p: point(p["x"] + col(x), p["y"] + col(y)))


def scale(ring, fx, fy, x0=0.0, y0=0.0) -> Column:
    """About the point (x0, y0)."""
    fx, fy, x0, y0 = (F.lit(v) if isinstance(v, (int, float)) else col(v) for v in (fx, fy, x0, y0))
    return F.transform(col(ring), lambda p: point((p["x"] - x0) * fx + x0, (p["y"] - y0) * fy + y0))


def quarter_turn(ring) -> Column:
    """By -90 degrees about the origin: (x, y) becomes (y, -x)."""
    return F.transform(col(ring), lambda p: point(p["y"], -p["x"]))


def flip_y(ring) -> Column:
    return F.transform(col(ring), lambda p: point(p["x"], -p["y"]))


def clip(ring, x0, y0, x1, y1) -> Column:
    """Every vertex held within bounds."""
    x0, y0, x1, y1 = (F.lit(float(v)) if isinstance(v, (int, float)) else col(v) for v in (x0, y0, x1, y1))
    return F.transform(col(ring), lambda p: point(F.least(F.greatest(p["x"], x0), x1), F.least(F.greatest(p["y"], y0), y1)))


def bounds(ring) -> Column:
    xs, ys = F.transform(col(ring), lambda p: p["x"]), F.transform(col(ring), lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def hull(points: np.ndarray) -> np.ndarray:
    """The convex hull, counter-clockwise, by monotone chains."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq):
        out: list = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def rotated_sides(points: np.ndarray) -> tuple[float, float]:
    """Sides, shorter first, of the least-area rectangle around the points; (0, 0) of none."""
    pts = hull(points.reshape(-1, 2)) if len(points) else points
    if len(pts) == 0:
        return 0.0, 0.0
    if len(pts) < 3:
        return 0.0, float(np.hypot(*(pts[-1] - pts[0])))
    edge = np.roll(pts, -1, axis=0) - pts
    edge = edge / np.hypot(edge[:, 0], edge[:, 1])[:, None]
    along, across = pts @ edge.T, pts @ np.stack([-edge[:, 1], edge[:, 0]])
    w, h = np.ptp(along, axis=0), np.ptp(across, axis=0)
    k = int(np.argmin(w * h))
    return float(min(w[k], h[k])), float(max(w[k], h[k]))


def _points(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], dtype=float).reshape(-1, 2) if ring is not None else np.zeros((0, 2))


def rotated_dimensions(ring) -> Column:
    """min_dim, max_dim: sides of the least rotated rectangle of a ring; the longer one is the diameter."""

    def run(rings: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([rotated_sides(_points(r)) for r in rings], columns=["min_dim", "max_dim"])

    kind = T.StructType([T.StructField("min_dim", T.DoubleType()), T.StructField("max_dim", T.DoubleType())])
    return F.pandas_udf(run, kind)(col(ring))


def _slabs(a: list[list[np.ndarray]], b: list[list[np.ndarray]]):
    """(y0, y1, edges at both heights, their owners) of every slab; see slab_areas."""
    edges, owner = [], []
    for side, polygons in enumerate((a, b)):
        for k, rings in enumerate(polygons):
            for ring in rings:
                p, q = ring, np.roll(ring, -1, axis=0)
                keep = p[:, 1] != q[:, 1]
                edges.append(np.hstack([p[keep], q[keep]]))
                owner += [(side, k)] * int(keep.sum())
    if not owner:
        return
    e = np.vstack(edges)
    cuts = [e[:, 1], e[:, 3]]
    d = e[:, 2:] - e[:, :2]
    for i in range(len(e) - 1):
        den = d[i, 0] * d[i + 1 :, 1] - d[i, 1] * d[i + 1 :, 0]
        off = e[i + 1 :, :2] - e[i, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (off[:, 0] * d[i + 1 :, 1] - off[:, 1] * d[i + 1 :, 0]) / den
            u = (off[:, 0] * d[i, 1] - off[:, 1] * d[i, 0]) / den
        ok = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        cuts.append(e[i, 1] + t[ok] * d[i, 1])
    ys = np.unique(np.concatenate(cuts))
    low, high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    for y0, y1 in zip(ys[:-1], ys[1:]):
        mid = (y0 + y1) / 2
        some = np.flatnonzero((low <= y0) & (high >= y1) & (low < mid) & (high > mid))
        at = lambda y: e[some, 0] + (y - e[some, 1]) / d[some, 1] * d[some, 0]
        order = np.argsort(at(mid), kind="stable")
        yield y0, y1, at(y0)[order], at(y1)[order], [owner[k] for k in some[order].tolist()]


def _stretches(owners: list[tuple[int, int]]):
    """(k, in A, in B): what holds between the edges k - 1 and k of a slab."""
    inside: dict = {}
    depth = [0, 0]
    for k, who in enumerate(owners):
        yield k, depth[0] > 0, depth[1] > 0
        inside[who] = not inside.get(who, False)
        depth[who[0]] += 1 if inside[who] else -1


def slab_areas(a: list[list[np.ndarray]], b: list[list[np.ndarray]]) -> tuple[float, float, float]:
    """Areas of A, of B and of both, of regions given by rings under the non-zero union of even-odd polygons.

    The plane is cut at every vertex and crossing height; between two cuts every region is a
    set of trapezoids. a, b: lists of polygons, each a list of rings (outer and holes).
    """
    total = [0.0, 0.0, 0.0]
    for y0, y1, x0, x1, owners in _slabs(a, b):
        x = (x0 + x1) / 2
        for k, in_a, in_b in _stretches(owners):
            width = (x[k] - x[k - 1]) * (y1 - y0) if k else 0.0
            for place, hit in enumerate((in_a, in_b, in_a and in_b)):
                total[place] += width if hit else 0.0
    return total[0], total[1], total[2]


def slab_rings(a: list[list[np.ndarray]], b: list[list[np.ndarray]], keep) -> list[np.ndarray]:
    """Outlines of where keep(in A, in B) holds: outer rings counter-clockwise, holes clockwise.

    The trapezoids of a slab give its slanted sides; where slabs meet, the parts of their
    horizontal sides that only one of them has remain. Sides are then linked, turning left as
    far as possible where several go on, so that rings that touch in a point stay apart.
    """
    near = lambda v: round(float(v), 9) + 0.0
    sides: list[tuple[tuple[float, float], tuple[float, float]]] = []
    flat: dict[float, dict[float, int]] = {}
    for y0, y1, x0, x1, owners in _slabs(a, b):
        begun = None
        held = [keep(in_a, in_b) for _, in_a, in_b in _stretches(owners)] + [False]
        low, high = near(y0), near(y1)
        spans: list[tuple[tuple[float, float], tuple[float, float]]] = []
        for k in range(len(owners)):
            at = (near(x0[k]), near(x1[k]))
            if held[k + 1] and not held[k]:
                begun = at
            elif held[k] and not held[k + 1] and at != begun:
                # What ends where the next begins is one: no outline runs between them.
                spans[-1:] = [(spans[-1][0], at)] if spans and spans[-1][1] == begun else [*spans[-1:], (begun, at)]
        for (l0, l1), (r0, r1) in spans:
            sides += [((r0, low), (r1, high)), ((l1, high), (l0, low))]
            for y, x, turn in ((low, l0, 1), (low, r0, -1), (high, l1, -1), (high, r1, 1)):
                flat.setdefault(y, {}).setdefault(x, 0)
                flat[y][x] += turn
    for y, turns in flat.items():
        xs, depth = sorted(turns), 0
        for p, q in zip(xs[:-1], xs[1:]):
            depth += turns[p]
            if depth:
                sides.append(((p, y), (q, y)) if depth > 0 else ((q, y), (p, y)))
    after: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for p, q in sides:
        if p != q:
            after.setdefault(p, []).append(q)
    rings = []
    for start in list(after):
        while after.get(start):
            ring, here = [start], after[start].pop()
            while here != start and after.get(here):
                back = np.arctan2(ring[-1][1] - here[1], ring[-1][0] - here[0])
                turn = [(np.arctan2(q[1] - here[1], q[0] - here[0]) - back) % (2 * np.pi) for q in after[here]]
                ring.append(here)
                here = after[here].pop(int(np.argmax(turn)))
            rings.append(np.array(_straight(ring)))
    return [r for r in rings if len(r) > 2]


def _straight(ring: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Without the points on a straight line between their neighbours."""
    n = len(ring)
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - q[1]) - (q[1] - p[1]) * (r[0] - q[0])
    return [ring[k] for k in range(n) if abs(turn(ring[k - 1], ring[k], ring[(k + 1) % n])) > 1e-12]


def clip_ring(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """The part of a polygon within a box, one side after another; parts may be joined by edges without area."""
    for axis, bound, sign in ((0, x0, 1.0), (0, x1, -1.0), (1, y0, 1.0), (1, y1, -1.0)):
        if not len(ring):
            break
        nxt = np.roll(ring, -1, axis=0)
        here, there = sign * (ring[:, axis] - bound), sign * (nxt[:, axis] - bound)
        out = []
        for p, q, a, b in zip(ring, nxt, here, there):
            if a >= 0:
                out.append(p)
            if (a >= 0) != (b >= 0):
                cut = p + (q - p) * (a / (a - b))
                cut[axis] = bound
                out.append(cut)
        ring = np.array(out).reshape(-1, 2)
    return ring
