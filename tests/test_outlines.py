"""Whole outlines against unit squares, closed forms and plain tests."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry as G
from tilewright.operators import outlines

KIND = "k string, annotated boolean, polygon_id long, ring array<struct<x: double, y: double>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def signed(r):
    p = [(q["x"], q["y"]) for q in r]
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p[:-1], p[1:])) / 2


def counts(rows):
    out = Counter()
    for r in rows:
        s = signed(r["ring"])
        assert r["ring"][0] == r["ring"][-1]
        out[r["k"], s > 0] += 1
    return out


@pytest.mark.parametrize("cell", [4.0, 7.0, 100.0])
def test_dissolved_boxes(spark, cell):
    rng = np.random.default_rng(int(cell))
    shapes = {"a": [tuple(int(v) for v in (x, y, x + w, y + h)) for x, y, w, h in zip(rng.integers(0, 40, 60), rng.integers(0, 40, 60), rng.integers(1, 9, 60), rng.integers(1, 9, 60))]}
    shapes["frame"] = [(0, 0, 20, 2), (0, 18, 20, 20), (0, 0, 2, 20), (18, 0, 20, 20), (8, 8, 12, 12)]  # a hole with an island
    shapes["corner"] = [(0, 0, 8, 8), (8, 8, 16, 16)]  # touch in a cell corner: two rings
    shapes["apart"] = [(0, 0, 1, 1), (50, 50, 51, 51)]
    rows = [(k, False, n, box(*b)) for k, bs in shapes.items() for n, b in enumerate(bs)]
    out = outlines.dissolved(spark.createDataFrame(rows, KIND), "k", cell).collect()
    for k, bs in shapes.items():
        cells = {(x, y) for x0, y0, x1, y1 in bs for x in range(x0, x1) for y in range(y0, y1)}
        own = [r for r in out if r["k"] == k]
        assert abs(sum(signed(r["ring"]) for r in own) - len(cells)) < 1e-6
        assert sum(signed(r["ring"]) > 0 for r in own) == parts(cells, False)
        space = {(x, y) for x in range(-1, 60) for y in range(-1, 60)} - cells
        assert sum(signed(r["ring"]) < 0 for r in own) == parts(space, True) - 1
    assert counts(out)["frame", True] == 2 and counts(out)["frame", False] == 1 and counts(out)["corner", True] == 2


def parts(cells, corners):
    near = [(0, 1), (1, 0), (0, -1), (-1, 0)] + [(1, 1), (1, -1), (-1, 1), (-1, -1)] * corners
    left, n = set(cells), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            x, y = todo.pop()
            for dx, dy in near:
                if (x + dx, y + dy) in left:
                    left.remove((x + dx, y + dy))
                    todo.append((x + dx, y + dy))
    return n


def test_dissolved_slanted(spark):
    """Stars over many cells: as many rings and the same area in one cell as in small ones."""
    rng = np.random.default_rng(3)
    rows = []
    for n in range(12):
        x, y = rng.random(2) * 30
        angles = np.sort(rng.random(9)) * 2 * math.pi
        rows.append(("s", n % 4 == 3, n, ring(*[(x + r * math.cos(a), y + r * math.sin(a)) for a, r in zip(angles, 3 + 7 * rng.random(9))])))
    polygons = spark.createDataFrame(rows, KIND)
    for kind in ("union", "intersection", "difference"):
        whole, cut = (outlines.dissolved(polygons, "k", c, kind).collect() for c in (1000.0, 6.0))
        assert counts(whole) == counts(cut) and len(whole) > 0
        assert np.allclose(sorted(signed(r["ring"]) for r in whole), sorted(signed(r["ring"]) for r in cut), atol=1e-5)


def test_offsets(spark):
    """Areas in closed form: convex rings and an L grown, shrunk and closed."""
    shapes = {"box": box(0, 0, 10, 6), "l": ring((0, 0), (12, 0), (12, 4), (5, 4), (5, 11), (0, 11)), "tri": ring((0, 0), (9, 0), (0, 12))}
    rows = spark.createDataFrame(list(shapes.items()), "k string, ring array<struct<x: double, y: double>>")
    areas = lambda df: {k: sum(signed(r["ring"]) for r in df if r["k"] == k) for k in shapes}
    quarter, d = 8, 1.5
    disc = 2 * quarter * d * d * math.sin(math.pi / 2 / quarter)
    grown = areas(outlines.buffered(rows, "k", d, 5.0, quarter).collect())
    assert abs(grown["box"] - (60 + d * 32 + disc)) < 1e-6
    assert abs(grown["tri"] - 54 - d * 36 - math.pi * d * d) < 0.1
    assert abs(grown["l"] - (83 + d * 46 - d * d + 5 / 4 * disc)) < 1e-6  # five corners out, one in
    shrunk = areas(outlines.buffered(rows, "k", -d, 5.0, quarter).collect())
    assert abs(shrunk["box"] - 7 * 3) < 1e-6 and abs(shrunk["l"] - (9 * 1 + 2 * 7 + d * d - disc / 4)) < 1e-6
    inner = (9 + 12 - 15) / 2
    assert abs(shrunk["tri"] - 54 * ((inner - d) / inner) ** 2) < 1e-6
    closed = areas(outlines.closed(rows, "k", d, 5.0, quarter).collect())
    assert abs(closed["box"] - 60) < 0.05 and abs(closed["tri"] - 54) < 0.05 and 83 < closed["l"] < 84
    gone = outlines.buffered(rows.where("k = 'box'"), "k", -4.0, 5.0).collect()
    assert gone == []


def test_closing_fills_gaps_and_repair(spark):
    rows = spark.createDataFrame([("two", box(0, 0, 5, 5)), ("two", box(6, 0, 11, 5)), ("bow", ring((0, 0), (4, 4), (4, 0), (0, 4)))], "k string, ring array<struct<x: double, y: double>>")
    closed = [r for r in outlines.closed(rows, "k", 2.0, 4.0).collect() if r["k"] == "two"]
    assert len(closed) == 1 and 50 < signed(closed[0]["ring"]) < 55.1
    repaired = outlines.buffered(rows, "k", 0.0, 3.0).where("k = 'bow'").collect()
    assert sorted(round(signed(r["ring"]), 6) for r in repaired) == [4.0, 4.0]


def test_rings_that_meet(spark):
    shapes = {1: box(0, 0, 10, 10), 2: box(3, 3, 5, 5), 3: ring((20, 0), (30, 0), (20, 10)), 4: box(28, 8, 31, 11), 5: box(10, 4, 12, 6), 6: ring((20, 10), (19, 12), (21, 12)), 7: box(100, 100, 101, 101), 8: ring((0, 20), (9, 20), (9, 29), (8, 29), (8, 21), (0, 21)), 9: box(2, 23, 6, 27)}
    rows = spark.createDataFrame(list(shapes.items()), "k long, ring array<struct<x: double, y: double>>")
    want = {(1, 2), (1, 5), (3, 6)}
    for cell in (2.0, 16.0):
        found = outlines.meeting(rows, rows, "k", cell).where("l < r").collect()
        assert {(r["l"], r["r"]) for r in found} == want and len(found) == len(want)
    own = {r["k"]: (r["partners"], r["others"]) for r in outlines.meeting_self(rows, "k", 4.0).collect()}
    assert own[1] == (2, [2, 5]) and own[4] == (0, []) and own[6] == (1, [3])
    inside = rows.select(outlines.holds_point("ring", F.lit(4.0), F.lit(4.0)).alias("h"), "k").where("h").collect()
    assert {r["k"] for r in inside} == {1, 2}
    assert rows.select(G.area("ring")).count() == 9
