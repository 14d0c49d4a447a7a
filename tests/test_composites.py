"""Canny edges, fingerprints, blocks of masks, kept states and polygons of slides, against plain implementations."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import fingerprint
from tilewright.operators import canny, composites, morphology, scoring, serving, stats


def test_fingerprints(spark):
    """Published values, and another implementation on every kind of length."""
    known = {"test": 8581389452482819506, "test" * 8: -4196240717365766262, "test" * 64: 3500507768004279527, "1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}
    assert fingerprint.fingerprints([k.encode() for k in known]).tolist() == list(known.values())
    other = spark._jvm.com.google.common.hash.Hashing.farmHashFingerprint64()
    rng = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in rng.integers(32, 1000, n)) for n in [*range(0, 70), 100, 127, 128, 129, 500, 5000]]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(-1, None)], "k long, t string")
    found = {r["k"]: (r["f"], r["p"]) for r in rows.select("k", fingerprint.fingerprint64("t").alias("f"), fingerprint.partition_number("t").alias("p")).collect()}
    assert found[-1] == (None, None)
    for k, t in enumerate(texts):
        want = other.hashBytes(bytearray(t.encode())).asLong()
        assert found[k] == (want, abs(want) % 4000)


def plain_canny(image, low, high):
    v = np.pad(image.astype(float), 1, mode="edge")
    h, w = image.shape
    gx, gy = np.zeros((h, w)), np.zeros((h, w))
    for a, k in ((0, 1), (1, 2), (2, 1)):
        gx += k * (v[a : a + h, 2:] - v[a : a + h, :-2])
        gy += k * (v[2:, a : a + w] - v[:-2, a : a + w])
    m = np.pad(abs(gx) + abs(gy), 1)
    state = np.zeros((h, w), int)
    for y in range(h):
        for x in range(w):
            own, dx, dy = m[y + 1, x + 1], abs(gx[y, x]), abs(gy[y, x])
            n = m[y : y + 3, x : x + 3]
            if dy * 32768 < dx * 13573:
                top = own > n[1, 0] and own >= n[1, 2]
            elif dy * 32768 > dx * (13573 + 65536):
                top = own > n[0, 1] and own >= n[2, 1]
            elif (gx[y, x] < 0) == (gy[y, x] < 0):
                top = own > n[0, 0] and own > n[2, 2]
            else:
                top = own > n[0, 2] and own > n[2, 0]
            state[y, x] = (1 + (own > high)) if top and own > low else 0
    todo = list(zip(*np.nonzero(state == 2)))
    out = set()
    while todo:
        y, x = todo.pop()
        if (y, x) not in out and 0 <= y < h and 0 <= x < w and state[y, x]:
            out.add((int(y), int(x)))
            todo += [(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    return out


def rows_of(spark, images, kind="s long, Y long, X long, v double"):
    return spark.createDataFrame([(k, y, x, float(v)) for k, im in images.items() for (y, x), v in np.ndenumerate(im)], kind)


@pytest.mark.parametrize("tile", [4, 64])
def test_canny(spark, tile):
    rng = np.random.default_rng(8)
    y, x = np.mgrid[:26, :31]
    disc = 200.0 * (np.hypot(y - 12, x - 14) < 9)
    images = {1: np.round(disc + rng.random((26, 31)) * 60), 2: rng.integers(0, 256, (9, 12)), 3: np.full((5, 5), 7), 4: np.tile(np.arange(8) * 20, (6, 1))}
    found = canny.edges(rows_of(spark, images), 150.0, 450.0, tile, ["s"]).collect()
    for k, image in images.items():
        assert {(r["Y"], r["X"]) for r in found if r["s"] == k} == plain_canny(image, 150.0, 450.0)
    assert len(found) == len(set(found)) > 50 and not [r for r in found if r["s"] == 3]
    assert canny.edges(rows_of(spark, images).limit(0), 1.0, 2.0, tile, ["s"]).collect() == []


def test_edges_of_cells(spark):
    """Each cell by itself: those that touch, and those at the border."""
    image = np.zeros((14, 17), int)
    image[0:4, 0:5], image[5:9, 3:8], image[5:9, 8:12], image[10:14, 13:17], image[11, 2] = 1, 2, 3, 4, 5
    rows = spark.createDataFrame([("a", int(y), int(x), int(image[y, x])) for y, x in zip(*np.nonzero(image))], "s string, Y long, X long, label long")
    found = {(r["Y"], r["X"]) for r in canny.cell_edges(rows, 5, F.lit(14), F.lit(17), ["s"]).collect()}
    want = set()
    for k in range(1, 6):
        y, x = np.nonzero(image == k)
        mask = np.zeros(image.shape)
        for a, b in zip(y, x):
            mask[max(a - 1, 0) : a + 2, max(b - 1, 0) : b + 2] = 1
        want |= plain_canny(mask, 2, 5)
    assert found == want and want


def test_blocks_shuffled(spark):
    rng = np.random.default_rng(2)
    image = rng.permutation(64).reshape(8, 8)
    pixels = rows_of(spark, {1: image}, "tile_id long, y int, x int, v double")
    rects = spark.createDataFrame([(1, 0, 0, 0, 4, 5), (1, 1, 3, 3, 4, 4), (1, 2, 7, 0, 1, 1)], "tile_id long, block int, y0 int, x0 int, h int, w int")
    rows = {(r["y"], r["x"]): r for r in scoring.masked_images(pixels, rects, shuffle=True).collect()}
    assert len(rows) == 64
    blocks = [{(y, x) for y in range(y0, y0 + h) for x in range(x0, x0 + w)} for _, _, y0, x0, h, w in rects.collect()]
    for (y, x), r in rows.items():
        own = [b for b in blocks if (y, x) in b]
        assert r["covers"] == len(own) and r["masked"] == (len(own) == 1)
        assert r["v"] in {image[p] for p in own[0]} if len(own) == 1 else r["v"] == image[y, x]
    alone = [p for p in blocks[0] if p not in blocks[1]]
    assert len({rows[p]["v"] for p in alone}) == len(alone)  # a permutation of the block, each value once
    assert any(rows[p]["v"] != image[p] for p in alone)


def test_areas_shift(spark):
    tiles = spark.range(300).select(F.col("id").alias("tile_id"))
    rows = serving.random_rectangles(tiles, 8, [12, 1], shift=3).collect()
    areas = {k: {r["h"] * r["w"] for r in rows if r["block"] == k} for k in (0, 1)}
    assert areas[0] == {9, 12} and min(areas[1]) >= 1  # three rows of 9 to 14 pixels
    assert sum(r["block"] == 1 for r in rows) < 300 == sum(r["block"] == 0 for r in rows)  # an area of 1 may go
    assert all(r["y0"] >= 0 and r["y0"] + r["h"] <= 8 and r["x0"] >= 0 and r["x0"] + r["w"] <= 8 for r in rows)
    plain = serving.random_rectangles(tiles, 8, [12, 1]).collect()
    assert {(r["block"], r["h"], r["w"]) for r in plain} == {(0, 3, 4), (1, 1, 1)}


def test_states_stay_few(spark, sf_dir, tmp_path):
    """Restarted over more files: the moments of all rows, and no more states than asked for."""
    from tilewright.streaming import moments

    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "value", F.col("user_id").cast("double").alias("u"))
    source, states, check = (str(tmp_path / n) for n in ("in", "states", "ck"))
    parts = e.randomSplit([1.0, 1.0], 3)
    for part in parts:
        part.repartition(4).write.mode("append").parquet(source)
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(source)
        moments.keep(stream, ["value", "u"], ["event_type"], states, check, max_to_keep=3).awaitTermination()
        assert len([f for f in os.listdir(states) if f.startswith("batch=")]) == 3
    got = {r["event_type"]: r for r in moments.current(spark, ["value", "u"], ["event_type"], states).collect()}
    want = stats.moments(e, ["value", "u"], ["event_type"]).collect()
    assert len(want) == len(got)
    for r in want:
        assert [got[r["event_type"]][c] for c in r.asDict() if c != "event_type"] == pytest.approx([r[c] for c in r.asDict() if c != "event_type"])
    with pytest.raises(ValueError):
        moments.keep(stream, ["value"], ["event_type"], states, check, max_to_keep=1)


def plain_area(ring):
    return sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring[:-1], ring[1:])) / 2


def test_anomaly_outlines(spark):
    """A ring-shaped and a solid anomaly and specks, against the contours of the whole image."""
    h, w = 70, 90
    flags = np.zeros((h, w), int)
    flags[8:50, 10:48] = 1
    flags[20:36, 22:36] = 0  # a hole
    flags[15:40, 60:82] = 1
    flags[60, 5] = flags[62, 40] = 1
    rows = spark.createDataFrame([("a", int(y), int(x), h, w) for y, x in zip(*np.nonzero(flags))] + [("b", 3, 3, 9, 9)], "s string, Y int, X int, height int, width int")
    big = np.zeros((h, w))
    for y, x in zip(*np.nonzero(flags)):
        big[max(y - 1, 0) : y + 3, max(x - 1, 0) : x + 3] = 1
    mean = np.array([[big[max(y - 4, 0) : y + 4, max(x - 4, 0) : x + 4].mean() for x in range(w)] for y in range(h)])
    blurred = composites.sparse_mean(composites.grown(rows, 4, ["s"]), 8, ["s"])
    found = {(r["Y"], r["X"]): r["v"] for r in blurred.where("s = 'a'").collect()}
    assert found == {(y, x): pytest.approx(mean[y, x]) for y, x in zip(*(k.tolist() for k in np.nonzero(mean)))}
    areas = sorted(abs(sum(a[1] * b[0] - b[1] * a[0] for a, b in zip(r[:-1], r[1:])) / 2) for r in morphology.trace(mean, 0.9))
    assert len(areas) == 3
    hole, solid, outer = areas
    out = composites.anomaly_outlines(rows, ["s"], tile=32, cell=24.0, least_area=50.0, share=0.0, smooth=0.0, factor=2.0).collect()
    assert {r["s"] for r in out} == {"a"}
    by_area = {}
    for r in out:
        by_area.setdefault(r["ring_id"], []).append(r)
    assert sorted(len(v) for v in by_area.values()) == [1, 2]  # the hole alone is covered by the ring around it
    (ring,) = (v for v in by_area.values() if len(v) == 2)
    assert sum(plain_area(r["ring"]) for r in ring) == pytest.approx(4 * (outer - hole), abs=1e-4) and ring[0]["area"] == pytest.approx(4 * (outer - hole), abs=1e-4)
    (one,) = (v for v in by_area.values() if len(v) == 1)
    assert one[0]["area"] == pytest.approx(4 * solid, abs=1e-4)
    assert all(p["y"] <= 0 <= p["x"] for r in out for p in r["ring"])  # turned by -90 degrees
    smooth = composites.anomaly_outlines(rows, ["s"], tile=32, cell=24.0, least_area=50.0, share=0.0, smooth=2.0, sizes=(one[0]["min_dim"] + 1.0,) * 2).collect()
    assert {r["ring_id"] for r in smooth} == {ring[0]["ring_id"]} and smooth[0]["area"] == pytest.approx(outer - hole, rel=0.02)
    high = composites.anomaly_outlines(rows, ["s"], tile=32, cell=24.0, least_area=50.0, share=0.9, smooth=0.0).collect()
    assert {r["ring_id"] for r in high} == {ring[0]["ring_id"]} and len(high) == 1  # its hole went with the small ones


def test_prediction_outlines(spark):
    h, w = 40, 50
    v = np.zeros((h, w))
    v[5:15, 5:15] = 0.9
    v[8:12, 8:12] = 0.1  # enclosed, so part of it
    v[20:30, 30:50] = 0.8
    v[35, 20] = 0.4
    pixels = rows_of(spark, {7: v}, "s long, Y long, X long, v double").withColumns({"height": F.lit(h), "width": F.lit(w)})
    area = lambda df: sum(plain_area(r["ring"]) for r in df.collect())
    own = lambda a, b: a * b - 0.5  # noqa: E731  a box of pixels, its outline half a pixel outside the centres, corners cut
    plain = composites.prediction_outlines(pixels, "s", 0.5, tile=16, cell=16.0)
    assert area(plain) == pytest.approx(own(10, 10) + own(10, 20), abs=0.6)
    assert plain.count() == 2
    double = composites.prediction_outlines(pixels, "s", 0.5, factor=2.0, tile=16, cell=16.0)
    # 20 by 20 about (9.5, 9.5), held at 0: 19.5 by 19.5 less its corners; 40 by 20 about (39.5, 24.5), held at 50; they share a side.
    (both,) = double.collect()
    assert plain_area(both["ring"]) == pytest.approx(19.5 * 19.5 - 0.125 - 0.25 - 0.25 - 0.5 + 30.5 * 20 - 2 * 0.5, abs=1e-6)
    patches = spark.createDataFrame([(7, [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}, {"x": 0.0, "y": 10.0}])], "s long, ring array<struct<x: double, y: double>>")
    met = composites.prediction_outlines(pixels, "s", 0.5, patches=patches, tile=16, cell=16.0)
    assert area(met) == pytest.approx(5.5 * 5.5 - 0.125, abs=1e-6) and met.count() == 1
    round_ = composites.prediction_outlines(pixels, "s", 0.5, factor=1.0, about="centroid", tile=16, cell=16.0)
    assert area(round_) == pytest.approx(area(plain), abs=1e-6)
    assert composites.prediction_outlines(pixels, "s", 0.95, tile=16).count() == 0
