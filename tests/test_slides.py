"""Whole slides cut into tiles against the same slides in one piece."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import graph, morphology, slides


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(4)
    noise = rng.random((23, 31))
    spiral = np.zeros((29, 29))  # one component through many tiles, with holes in holes
    for k in range(0, 14, 2):
        spiral[k, k : 29 - k] = spiral[28 - k, k : 29 - k] = spiral[k : 29 - k, k] = spiral[k : 29 - k, 28 - k] = 1.0
    spiral[14, 1:28:1] = 1.0
    return {1: noise, 2: spiral, 3: np.full((9, 9), 2.0), 4: np.zeros((5, 7))}


@pytest.fixture(scope="module")
def pixels(spark, images):
    rows = [(k, y, x, float(v)) for k, im in images.items() for (y, x), v in np.ndenumerate(im)]
    return spark.createDataFrame(rows, "slide long, Y long, X long, v double").repartition(3).cache()


@pytest.mark.parametrize("tile,corners", [(4, True), (4, False), (7, True), (64, False)])
def test_components(pixels, images, tile, corners):
    out = slides.components(pixels.where("v >= 0.55").select("slide", "Y", "X"), tile, ["slide"], corners).collect()
    want = set()
    for k, im in images.items():
        y, x = np.nonzero(im >= 0.55)
        if len(y):
            label = morphology.label_image(y, x, corners)
            first = {n: min((int(a) << 32) + int(b) for a, b, m in zip(y, x, label) if m == n) for n in set(label.tolist())}
            want |= {(k, int(a), int(b), first[n]) for a, b, n in zip(y, x, label.tolist())}
    assert {tuple(r) for r in out} == want and len(out) == len(want)


@pytest.mark.parametrize("tile", [3, 8, 64])
def test_contours(pixels, images, tile, monkeypatch):
    out = slides.contours(pixels, 0.55, tile, ["slide"], pad=-1.0).collect()
    for k, im in images.items():
        own = [r for r in out if r["slide"] == k]
        rings = morphology.trace(np.pad(im, 1, constant_values=-1.0), 0.55)
        points = lambda ring: frozenset((round(a, 9), round(b, 9)) for a, b in ring)
        want = sorted((sorted(points((x - 1, y - 1) for y, x in r)), len(r)) for r in rings)
        assert sorted((sorted(points((p["x"], p["y"]) for p in r["ring"])), len(r["ring"])) for r in own) == want
        assert all(r["ring"][0] == r["ring"][-1] for r in own)
        # A hole's parent is an outer ring that contains it, with none between.
        outer = {r["ring_id"]: r for r in own if not r["is_hole"]}
        for r in own:
            assert (r["parent"] in outer) if r["is_hole"] else r["parent"] is None
            if r["is_hole"]:
                around = [o for o in outer.values() if o["area"] > r["area"] and inside(r["ring"][0], o["ring"])]
                assert min(around, key=lambda o: o["area"])["ring_id"] == r["parent"]
    assert sum(r["is_hole"] for r in out) > 10
    if tile == 3:
        ids = {(r["slide"], r["ring_id"], r["parent"], r["label"]) for r in out}
        monkeypatch.setattr(graph, "SMALL", 5)
        assert ids == {(r["slide"], r["ring_id"], r["parent"], r["label"]) for r in slides.contours(pixels, 0.55, 4, ["slide"], pad=-1.0).collect()}
    ids = {(r["slide"], r["ring_id"]) for r in out}
    assert len(ids) == len(out) and ids == {(r["slide"], r["ring_id"]) for r in slides.contours(pixels, 0.55, 5, ["slide"], pad=-1.0).collect()}


def inside(p, ring):
    n = 0
    for a, b in zip(ring[:-1], ring[1:]):
        if (a["y"] > p["y"]) != (b["y"] > p["y"]) and p["x"] < a["x"] + (p["y"] - a["y"]) / (b["y"] - a["y"]) * (b["x"] - a["x"]):
            n += 1
    return n % 2 == 1


@pytest.mark.parametrize("small", [0, 100, 10**6])
def test_graph_of_chains_and_cycles(spark, monkeypatch, small):
    """All groups by joins, some by joins, each in a task."""
    monkeypatch.setattr(graph, "SMALL", small)
    n = 200
    chain = [("a", k, k + 1) for k in range(n)] + [("b", 5, 9), ("b", 9, 5), ("b", 3, 3), ("b", 700, 9), (None, 8, 2)]
    out = {(r["g"], r["id"]): r["component"] for r in graph.components(spark.createDataFrame(chain, "g string, a long, b long"), ["g"]).collect()}
    assert out == {("a", k): 0 for k in range(n + 1)} | {("b", 5): 5, ("b", 9): 5, ("b", 700): 5, (None, 8): 2, (None, 2): 2}
    order = np.random.default_rng(1).permutation(90).tolist()
    cycles = [("a", order[k], order[(k + 1) % 60]) for k in range(60)] + [("a", order[60 + k], order[60 + (k + 1) % 30]) for k in range(30)] + [("b", 4, 4)]
    found = graph.rings(spark.createDataFrame(cycles, "g string, id long, next long"), ["g"]).collect()
    for part in (order[:60], order[60:]):
        at = part.index(min(part))
        ring = part[at:] + part[:at]
        assert [r["id"] for r in sorted((r for r in found if r["g"] == "a" and r["ring"] == ring[0]), key=lambda r: -r["left"])] == ring
    assert [(r["id"], r["ring"], r["left"]) for r in found if r["g"] == "b"] == [(4, 4, 1)]
