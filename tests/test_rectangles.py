"""Regions of upright rectangles, solved together, against slabs and unit squares."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tilewright.functions import geometry as G
from tilewright.functions import rectangles
from tilewright.operators import outlines, spatial

KIND = "k long, ring array<struct<x: double, y: double>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))


def area(x, y):
    return round(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2, 4) + 0.0


@pytest.mark.parametrize("places", [1 << 20, 60])
def test_rectangles_like_slabs(monkeypatch, places):
    monkeypatch.setattr(rectangles, "PLACES", places)  # the smaller one halves nearly every group, several times
    rng = np.random.default_rng(places)
    group = np.sort(rng.integers(0, 12, 200))
    low = rng.integers(0, 14, (200, 2)) + (rng.random((200, 2)) / 4).round(2) * (group % 2)[:, None]
    boxes = np.hstack([low, low + rng.integers(1, 7, (200, 2))]).round(2)
    side = rng.random(200) < 0.5
    keeps = [lambda p, a: p, lambda p, a: p & a, lambda p, a: p & ~a]
    which, own, _, length, x, y = rectangles.outlines(group, boxes, [~side * 1.0, side * 1.0], lambda p, a: [np.where(k(p > 0, a > 0), 0, -1) for k in keeps])
    ends = np.cumsum(length)
    rings = [(x[e - n : e], y[e - n : e]) for n, e in zip(length, ends)]
    for g in range(12):
        sides = [[[np.array([(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3])])] for b in boxes[(group == g) & (side == s)]] for s in (False, True)]
        for k, keep in enumerate(keeps):
            want = G.slab_rings(*sides, lambda p, a: keep(np.bool_(p), np.bool_(a)))
            got = [r for r, w, o in zip(rings, which, own) if (w, o) == (k, g)]
            assert sorted((len(r), area(r[:, 0], r[:, 1])) for r in want) == sorted((len(r[0]), area(*r)) for r in got)


def less(rows):
    """Unit squares that only one of the boxes covers, counted by its key."""
    cover = {}
    for k, (x0, y0, x1, y1) in rows:
        for x in range(x0, x1):
            for y in range(y0, y1):
                cover.setdefault((x, y), []).append(k)
    out = {}
    for ks in cover.values():
        if len(ks) == 1:
            out[ks[0]] = out.get(ks[0], 0) + 1
    return out


@pytest.mark.parametrize("cell", [5.0, 64.0])
def test_less_others(spark, cell):
    rng = np.random.default_rng(3)
    rows = [(k, tuple(int(v) for v in (x, y, x + w, y + h))) for k, (x, y, w, h) in enumerate(zip(rng.integers(-20, 20, 150), rng.integers(-20, 20, 150), rng.integers(1, 9, 150), rng.integers(1, 9, 150)))]
    rows += [(200 + k, (30, 30, 34, 36)) for k in range(5)] + [(300, (32, 30, 36, 33))]  # copies leave each other nothing
    polygons = spark.createDataFrame([(k, box(*b)) for k, b in rows], KIND)
    found = spatial.less_others(polygons, "k", cell).groupBy("k").agg(F.sum(G.signed_area("ring"))).collect()
    assert {k: round(a, 6) for k, a in found if round(a, 6)} == less(rows)


def test_less_others_slanted(spark):
    """A cell with other polygons than upright rectangles, and one key of two rings."""
    rows = [(1, ring((0, 0), (8, 0), (0, 8))), (2, box(0, 0, 2, 2)), (3, box(20, 0, 30, 10)), (3, box(22, 2, 28, 8)), (4, box(24, 4, 26, 12))]
    found = spatial.less_others(spark.createDataFrame(rows, KIND), "k", 64.0).groupBy("k").agg(F.round(F.sum(G.signed_area("ring")), 6)).collect()
    assert dict(map(tuple, found)) == {1: 28.0, 3: 100.0 - 36.0 - 4.0, 4: 2.0 * 8 - 4.0}


def test_boxes_less_partners_makes_no_pairs(spark, tmp_path):
    """Thousands of boxes in one place: their pairs would be millions of rows."""
    places = [(n, "a", 7, 5.0) for n in range(6000)] + [(9000, "b", 8, 9.0), (9001, "a", 40, 5.0)]
    spark.createDataFrame(places, "event_id long, event_type string, user_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    rows = entry.queries()["boxes_less_partners"](spark, str(tmp_path))
    assert "Join" not in rows._jdf.queryExecution().toString()
    assert dict(map(tuple, rows.collect())) == {9000: 24.0 - 2.0, 9001: 24.0}


def test_linked_sends_few_rows_across_the_plane(spark, monkeypatch):
    """A ring of 40,004 sides: only chains of blocks are linked by joins, not sides."""
    n = 10_000
    side = lambda *c: F.struct(*[F.expr(e).cast("double").alias(a) for a, e in zip(("x0", "y0", "x1", "y1"), c)])
    lower = (side("id", "id", "id + 1", "id"), side("id + 1", "id", "id + 1", "id + 1"))
    upper = (side("id + 1", "id + 4", "id", "id + 4"), side("id", "id + 4", "id", "id + 3"))
    ends = F.explode(F.array(side(f"{n}", f"{n}", f"{n}", f"{n + 3}"), side("0", "3", "0", "0"))).alias("s")
    sides = spark.range(n).select(F.explode(F.array(*lower, *upper)).alias("s")).union(spark.range(1).select(ends)).select(F.lit("a").alias("k"), "s.*")
    rows, rings = [], outlines.graph.rings
    monkeypatch.setattr(outlines.graph, "rings", lambda parts, by: rows.append(parts.count()) or rings(parts, by))
    out = outlines.linked(sides, ["k"], 8.0).collect()
    assert len(out) == 1 and len(out[0]["ring"]) == 4 * n + 1 and rows[0] < 2000


def test_chains_of_batches(monkeypatch):
    """Sides at hand together become chains; whole rings are closed, ends name the side that follows."""
    monkeypatch.setattr(outlines, "CHAINED", 6)
    to = {1: 2, 2: 3, 3: 1, 4: 5, 5: 6, 6: 7, 7: 8, 8: 4}
    batches = [pa.RecordBatch.from_pydict({"k": ["a"] * len(ids), "id": ids, "next": [to[i] for i in ids], "x0": [i * 1.0 for i in ids], "y0": [0.0] * len(ids)}) for ids in ([1, 2, 3], [], [5, 4, 6], [8, 7])]
    found = pa.Table.from_batches(outlines._chains(iter(batches), ["k"])).to_pylist()
    assert {(r["id"], r["next"], tuple(p["x"] for p in r["points"])) for r in found} == {(1, None, (1, 2, 3)), (4, 7, (4, 5, 6)), (7, 4, (7, 8))}


def test_all_dissolved_in_small_blocks(spark, monkeypatch):
    """Kinds found together are those found one by one, by chains of one cell each."""
    monkeypatch.setattr(outlines, "BLOCK", 1)
    rng = np.random.default_rng(8)
    rows = [("ab"[n % 2], bool(rng.random() < 0.4), n, box(x, y, x + w, y + h)) for n, (x, y, w, h) in enumerate(zip(*(rng.integers(lo, hi, 160).tolist() for lo, hi in ((0, 40), (0, 40), (1, 9), (1, 9)))))]
    polygons = spark.createDataFrame(rows, "k string, annotated boolean, polygon_id long, ring array<struct<x: double, y: double>>")
    shape = lambda found: {(r["k"], r["kind"]): (r["n"], r["a"], r["c"]) for r in found.groupBy("k", "kind").agg(F.count("*").alias("n"), F.round(F.sum(G.signed_area("ring")), 6).alias("a"), F.sum(F.size("ring")).alias("c")).collect()}
    kinds = ["union", "intersection", "difference"]
    together, apart = shape(outlines.all_dissolved(polygons, "k", 5.0, kinds)), {}
    for kind in kinds:
        apart |= shape(outlines.dissolved(polygons, "k", 1000.0, kind).withColumn("kind", F.lit(kind)))
    assert len(together) == 6 and together == apart


def test_region_outlines_in_one_pass(spark, tmp_path):
    """All kinds from one pass over the cells; a type with annotated boxes alone has areas of 0."""
    rng = np.random.default_rng(5)
    rows = [(n, "ab"[n % 3 % 2], int(u), float(v)) for n, (u, v) in enumerate(zip(rng.integers(0, 40, 400), rng.integers(0, 120, 400)))] + [(1001, "c", 3, 4.0), (1003, None, 3, 4.0), (1004, None, 3, 7.0)]
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    cover = {}
    for n, kind, u, v in rows:
        for x in range(u * 3, u * 3 + 4):
            for y in range(int(v), int(v) + 6):
                cover.setdefault(kind, {}).setdefault((x, y), set()).add(n % 2)
    want = {kind: (sum(0 in s for s in places.values()), sum(len(s) == 2 for s in places.values()), sum(s == {0} for s in places.values())) for kind, places in cover.items()}
    out = entry.queries()["region_outlines"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InArrow") + plan.count("InPandas") == 1
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want
