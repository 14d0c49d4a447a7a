"""Library operators on hand-made inputs, properties, and every catalogued query against its SQL."""

import datetime as dt
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry as G
from tilewright.functions import scalars as S
from tilewright.operators import morphology, order, scoring, serving, spatial, stats, store, tiles
from tilewright.plans import catalog
from tilewright.sources import coordinates, logs, png, tfrecord

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, db, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = [tuple(map(plain, r)) for r in df.collect()]
    assert rows
    if name in catalog.SQL:
        columns = ", ".join(f'"{c}"' for c in df.columns)
        want = db.execute(f"SELECT {columns} FROM ({catalog.SQL[name]})").fetchall()
        key = lambda r: tuple(str(round(x, 9)) if isinstance(x, float) else str(x) for x in r)
        rows, want = sorted(rows, key=key), sorted(want, key=key)
        assert len(rows) == len(want)
        for a, b in zip(rows, want):
            assert all(x == pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b)), (a, b)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_golden_cases(spark):
    r = one(spark, S.slide_depth(F.lit(86000), F.lit(112000), 1024, 1024), S.level_of_size(F.lit(1024)), S.level_of_size(F.lit(4)), S.tree_depth(F.lit(1)), S.tree_depth(F.lit(128)), S.tree_depth(F.lit(129)), S.divide_no_nan(F.lit(3.0), F.lit(0.0)))
    assert tuple(r) == (7, 0, 8, 0, 7, 8, 0.0)
    assert scoring.mask_blocks(52) == [26, 13, 6, 3, 2, 1, 1]
    assert one(spark, S.resize_factor(F.lit(110), F.lit(1024), F.lit(4096), F.lit(128), F.lit(7))).asDict().popitem()[1] == pytest.approx(110 * 1024 / 4096)


def test_settings_are_replaced_by_name():
    own = {"a": {"b": 1, "c": {"d": 2}}, "e": 3}
    assert serving.overridden(own, {"a": {"c": {"d": 5, "x": 6}}, "e": 4}) == {"a": {"b": 1, "c": {"d": 5, "x": 6}}, "e": 4}
    assert serving.overridden(own, {"a": {"c": {"d": 5, "x": 6}}, "y": 4}, known_only=True) == {"a": {"b": 1, "c": {"d": 5}}, "e": 3}
    assert own == {"a": {"b": 1, "c": {"d": 2}}, "e": 3}


def test_mirror_of_images_smaller_than_a_window(spark):
    image = np.arange(6).reshape(2, 3)
    rows = spark.createDataFrame([(0, y, x, float(image[y, x])) for y in range(2) for x in range(3)], "tile_id int, y int, x int, v double")
    made, height, width = tiles.mirrored(rows, 2, 3, 9, 2)
    out = np.full((height, width), -1.0)
    for r in made.collect():
        assert out[r.y, r.x] == -1.0
        out[r.y, r.x] = r.v
    assert (height, width) == (9, 9) and (out == np.pad(image, ((0, 7), (0, 6)), mode="symmetric")).all()


def test_morton_round_trip(spark):
    g = spark.range(64).select((F.col("id") / 8).cast("int").alias("r"), (F.col("id") % 8).cast("int").alias("c")).withColumn("code", S.morton("r", "c", 3))
    row, column = S.unmorton("code", 3)
    rows = g.withColumns({"r2": row, "c2": column}).collect()
    assert sorted(r["code"] for r in rows) == list(range(64)) and all((r["r"], r["c"]) == (r["r2"], r["c2"]) for r in rows)


def test_merged_covariance_is_exact(spark):
    v = np.random.default_rng(0).normal(size=(37, 2))
    df = spark.createDataFrame([(int(k), float(a), float(b)) for k, (a, b) in enumerate(v)], "k int, a double, b double")
    for batch in (F.lit(0), F.col("k") % 5, F.col("k")):
        m = stats.merge_moments(stats.moments(df.withColumn("g", batch), ["a", "b"], ["g"]), ["a", "b"]).first()
        assert m["n"] == 37 and [m["cov_a_a"], m["cov_a_b"], m["cov_b_b"]] == pytest.approx(np.cov(v.T)[[0, 0, 1], [0, 1, 1]])


def test_distances(spark):
    v = np.random.default_rng(1).normal(size=(50, 3)) @ np.array([[2, 0.3, 0], [0, 1, 0.5], [0, 0, 0.7]])
    cov, mean = np.cov(v.T), v.mean(axis=0)
    want = np.einsum("ni,ij,nj->n", v - mean, np.linalg.inv(cov), v - mean)
    df = spark.createDataFrame([(int(k), *map(float, x), list(map(float, x))) for k, x in enumerate(v)], "k int, a double, b double, c double, v array<double>")
    scored = df.crossJoin(F.broadcast(stats.moments(df, ["a", "b", "c"]))).select("k", stats.squared_distance3(["a", "b", "c"]).alias("d"), stats.squared_distance("v", mean, stats.whitening(cov)).alias("w")).orderBy("k").collect()
    assert [r["d"] for r in scored] == pytest.approx(want) and [r["w"] for r in scored] == pytest.approx(want) and min(want) >= 0


def test_rolling_mean_of_a_constant(spark):
    df = spark.range(20).select("id", F.lit(3.0).alias("v"))
    assert {r["smooth"] for r in stats.centred_mean(df, "v", ["id"], 6).collect()} == {3.0}


@pytest.mark.parametrize("size", [1, 9, 64])
def test_running_results_by_bucket(spark, monkeypatch, size):
    monkeypatch.setattr(stats, "BLOCK", size)
    r = np.random.default_rng(size)
    rows = [(k, None if k % 50 == 7 else int(x), ("a", "b", None)[k % 7 % 3], None if k % 11 == 0 else int(y)) for k, (x, y) in enumerate(zip(r.integers(0, 60, 300), r.integers(0, 9, 300)))]
    df = spark.createDataFrame(rows, "id long, at int, kind string, v int")
    bucket = F.floor(F.col("at") / 7)
    places, before, smooth = {}, {}, {}
    for kind in ("a", "b", None):
        own = sorted((x for x in rows if x[2] == kind), key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
        for k, x in enumerate(own):
            near = [y[3] for y in own[max(k - 4, 0) : k + 5] if y[3] is not None]
            places[x[0]], before[x[0]], smooth[x[0]] = k, own[k - 1][3] if k else None, sum(near) / len(near) if near else None
    assert {x["id"]: x["k"] for x in order.positions(df, ["at", "id"], ["kind"], bucket, "k").collect()} == places
    assert {x["id"]: x["w"] for x in order.row_before(df, F.col("v"), ["at", "id"], ["kind"], bucket, "w").collect()} == before
    out = {x["id"]: x["smooth"] for x in stats.centred_mean(df, "v", ["at", "id"], 9, ["kind"], bucket).collect()}
    assert out == pytest.approx(smooth)
    assert order.positions(df.where("id < 0"), ["at", "id"], [], bucket, "k").count() == 0


def test_pca(spark):
    v = np.random.default_rng(2).normal(size=(60, 4)) * [1, 2, 3, 4] + 1
    v[:, 3] += v[:, 0]
    df = spark.createDataFrame([(int(k), list(map(float, x))) for k, x in enumerate(v)], "k int, v array<double>")
    scored, ratio = stats.pca(df, "v", 2)
    z = (v - v.mean(axis=0)) / v.std(axis=0)
    values = np.linalg.svd(z, compute_uv=False) ** 2
    assert ratio == pytest.approx((values / values.sum())[:2])
    s = np.array([r["scores"] for r in scored.orderBy("k").collect()])
    assert s.var(axis=0, ddof=1) * 59 == pytest.approx(values[:2])
    assert stats.top_share(df.select("k", F.col("v")[0].alias("s")), "s", 0.001, ["k"]).count() == 0


def disk(h, w, cy, cx, r):
    y, x = np.mgrid[:h, :w]
    return (y - cy) ** 2 + (x - cx) ** 2 <= r * r


def pixel_rows(spark, image, tile=1):
    return spark.createDataFrame([(tile, int(y), int(x), float(v)) for (y, x), v in np.ndenumerate(image)], "tile_id long, y int, x int, v double")


def test_morphology(spark):
    image = np.random.default_rng(3).random((9, 11)) > 0.6
    flags = morphology.run_flags(pixel_rows(spark, image), F.col("v") > 0.5)
    padded = np.pad(image, 2)
    for size in (2, 3, 4):
        a, b = morphology.square(size)
        want = np.zeros_like(image)
        for dy in range(-a, b + 1):
            for dx in range(-a, b + 1):
                want |= padded[2 + dy : 11 + dy, 2 + dx : 13 + dx]
        assert {(r["y"], r["x"]) for r in morphology.dilate(flags, size, 9, 11).collect()} == set(zip(*map(lambda z: z.tolist(), np.nonzero(want))))
        full = np.ones_like(image)
        solid = np.pad(image, 2, constant_values=True)
        for dy in range(-a, b + 1):
            for dx in range(-a, b + 1):
                full &= solid[2 + dy : 11 + dy, 2 + dx : 13 + dx]
        assert {(r["y"], r["x"]) for r in morphology.erode(flags, size, 9, 11).collect()} == set(zip(*map(lambda z: z.tolist(), np.nonzero(full))))
    v = pixel_rows(spark, np.arange(16.0).reshape(4, 4))
    assert {(r["y"], r["x"]): r["v"] for r in morphology.box_mean(v, 3).collect()}[(1, 1)] == 5.0
    assert {(r["y"], r["x"]): r["v"] for r in morphology.median(v, 3, 4, 4).collect()}[(0, 0)] == 2.5


def test_components_by_flooding(spark):
    image = np.random.default_rng(4).random((20, 20)) > 0.62
    label = {(r["y"], r["x"]): r["label"] for r in morphology.components(morphology.run_flags(pixel_rows(spark, image), F.col("v") > 0.5)).collect()}
    left, want = set(label), {}
    for k, start in enumerate(sorted(label)):
        if start in left:
            stack = [start]
            left.discard(start)
            while stack:
                y, x = stack.pop()
                want[(y, x)] = k
                near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
                left -= near
                stack += near
    pairs = {(label[p], want[p]) for p in label}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_contours(spark):
    image = disk(30, 30, 14, 15, 10).astype(float) - disk(30, 30, 14, 15, 4)
    rings = morphology.contours(pixel_rows(spark, image), 0.5).collect()
    assert sorted(r["is_hole"] for r in rings) == [False, True]
    outer, hole = sorted(rings, key=lambda r: r["is_hole"])
    assert outer["area"] == pytest.approx(disk(30, 30, 14, 15, 10).sum(), rel=0.06) and hole["area"] == pytest.approx(disk(30, 30, 14, 15, 4).sum(), rel=0.2)
    assert all(r["ring"][0] == r["ring"][-1] for r in rings)


def test_polygons(spark):
    ring = F.array(G.point(F.lit(0.0), F.lit(0.0)), G.point(F.lit(4.0), F.lit(0.0)), G.point(F.lit(4.0), F.lit(2.0)), G.point(F.lit(0.0), F.lit(2.0)))
    turned = F.transform(ring, lambda p: G.point((p["x"] - p["y"]) / 2**0.5, (p["x"] + p["y"]) / 2**0.5))
    r = one(spark, G.area(ring).alias("a"), G.area(G.quarter_turn(ring)).alias("b"), G.centroid(ring).alias("c"), G.bounds(G.move(ring, F.lit(1.0), F.lit(2.0))).alias("m"), G.rotated_dimensions(turned).alias("d"), G.area(G.scale(ring, 2, 3)).alias("s"))
    assert (r["a"], r["b"], tuple(r["c"]), tuple(r["m"]), r["s"]) == (8.0, 8.0, (2.0, 1.0), (1.0, 2.0, 5.0, 4.0), 48.0)
    assert tuple(r["d"]) == pytest.approx((2, 4))
    assert G.rotated_sides(np.zeros((0, 2))) == (0.0, 0.0)


def test_region_areas(spark):
    rng = np.random.default_rng(5)
    a = [[np.round(rng.random((3, 2)) * 8, 2)] for _ in range(6)]
    b = [[np.array([[1.0, 1], [7, 1], [7, 7], [1, 7]]), np.array([[3.0, 3], [5, 3], [5, 5], [3, 5]])]]
    got = G.slab_areas(a, b)
    y, x = np.mgrid[0:8:1200j, 0:8:1200j]

    def inside(polygons):
        out = np.zeros(y.shape, bool)
        for rings in polygons:
            odd = np.zeros(y.shape, bool)
            for ring in rings:
                for (x0, y0), (x1, y1) in zip(ring, np.roll(ring, -1, axis=0)):
                    if y0 != y1:
                        odd ^= ((y0 <= y) != (y1 <= y)) & (x < x0 + (y - y0) / (y1 - y0) * (x1 - x0))
            out |= odd
        return out

    p, q = inside(a), inside(b)
    assert got == pytest.approx([m.mean() * 64 for m in (p, q, p & q)], rel=5e-3)
    df = spark.createDataFrame([("s", f, k, [tuple(map(float, pt)) for pt in ring]) for f, polys in ((False, a), (True, b)) for k, rings in enumerate(polys) for ring in rings], "slide string, annotated boolean, polygon_id int, ring array<struct<x double, y double>>")
    r = scoring.derived_metrics(scoring.area_confusion(spatial.region_areas(df, "slide", 3.0).withColumn("slide_area", F.lit(64.0)), "common", "predicted", "annotated", "slide_area")).first()
    assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == pytest.approx(64) and r["iou"] == pytest.approx(got[2] / (got[0] + got[1] - got[2]))


def test_spatial_join_and_merge(spark):
    rng = np.random.default_rng(6)
    boxes = [(k, *map(int, (x, y, x + rng.integers(0, 30), y + rng.integers(0, 30)))) for k, (x, y) in enumerate(rng.integers(-50, 200, (150, 2)))]
    df = spark.createDataFrame(boxes, "id long, x0 long, y0 long, x1 long, y1 long")
    want = {(a[0], b[0]) for a in boxes for b in boxes if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]}
    rows = spatial.touching(df, df, 16).select("l_id", "r_id").collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    comp = {r["id"]: r["component"] for r in spatial.merge_touching(df.withColumn("image", F.lit(1)), "id", 16, ["image"]).collect()}
    assert all(comp[a] == comp[b] for a, b in want)


def test_tiles(spark):
    image = np.random.default_rng(7).random((8, 8))
    p = pixel_rows(spark, image)
    assert [r[0] for r in tiles.bilinear(p, 8, 8, 8, 8).orderBy("y", "x").select("v").collect()] == pytest.approx(image.ravel().tolist())
    win = tiles.windows(p, 8, 8, 4, 3)
    assert {(r["wy"], r["wx"]) for r in win.select("wy", "wx").distinct().collect()} == {(a, b) for a in range(3) for b in range(3)}
    back = tiles.overlap_mean(win)
    assert {(r["y"], r["x"]): r["v"] for r in back.collect()} == pytest.approx({k: v for k, v in np.ndenumerate(image)})
    turned = tiles.half_turn(tiles.half_turn(p, 8, 8), 8, 8)
    assert turned.exceptAll(p).count() == 0
    mask = spark.createDataFrame([(0, 0), (4, 4), (5, 5)], "y int, x int")
    got = {(r["row"], r["col"]): r["flagged"] for r in tiles.thumbnail_tiles(mask, 8, 8, 16, 4, 0.0).collect()}
    assert got == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_masks(spark):
    p = pixel_rows(spark, np.arange(16.0).reshape(4, 4)).withColumn("masked", F.col("y") < 2)
    a, b = scoring.shuffle_mask(p).collect(), scoring.shuffle_mask(p).collect()
    assert sorted(a) == sorted(b) and sorted(r["v"] for r in a) == list(map(float, range(16))) and all(r["v"] == 4 * r["y"] + r["x"] for r in a if not r["masked"])


def test_store(spark, tmp_path):
    path = str(tmp_path / "slides")
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "slide_uuid string, v int")
    for _ in range(2):
        store.replace_slides(new, path)
    store.replace_slides(spark.createDataFrame([("a", 9)], "slide_uuid string, v int"), path)
    assert sorted((r["slide_uuid"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]
    spark.sql("CREATE DATABASE IF NOT EXISTS wsi")
    for drop in (False, False, True):
        made = store.create_tables(spark, "wsi", drop)
    assert made == ["wsi.slides", "wsi.anomaly_polygons", "wsi.nuclear_polygons"] and spark.table(made[1]).columns[-1] == "partition_number"
    nuclei = spark.createDataFrame([("s", [(0.0, 0.0), (20.0, 0.0), (20.0, 10.0), (0.0, 10.0)]), ("s", [(0.0, 0.0), (5.0, 0.0), (5.0, 5.0)])], "slide_uuid string, ring array<struct<x double, y double>>")
    assert sorted(r["is_tumor"] for r in store.nuclei_rows(nuclei, 0.5).collect()) == [False, True]


def test_png_round_trip(spark, tmp_path):
    import zlib

    rng = np.random.default_rng(8)
    for shape in ((5, 7), (4, 6, 3), (3, 2, 4)):
        image = rng.integers(0, 256, shape).astype(np.uint8)
        data = png.encode(image)
        assert (png.decode(data).reshape(shape) == image).all()
        (tmp_path / f"{len(shape)}_{shape[0]}.png").write_bytes(data)
    assert png.read(spark, str(tmp_path)).count() == 35 + 24 + 6
    image = rng.integers(0, 256, (5, 4, 3)).astype(np.uint8)
    rows, above = [], np.zeros((4, 3), int)
    for y, kind in enumerate(range(5)):
        row = [kind]
        for x in range(4):
            left = image[y, x - 1].astype(int) if x else np.zeros(3, int)
            up, corner = above[x], above[x - 1] if x else np.zeros(3, int)
            p = left + up - corner
            near = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
            row += ((image[y, x].astype(int) - (0, left, up, (left + up) // 2, near)[kind]) % 256).tolist()
        rows.append(bytes(row))
        above = image[y].astype(int)
    plain_file = png.encode(image)
    at = plain_file.index(b"IDAT") - 4
    body = zlib.compress(b"".join(rows))
    made = plain_file[:at] + len(body).to_bytes(4, "big") + b"IDAT" + body + zlib.crc32(b"IDAT" + body).to_bytes(4, "big") + plain_file[-12:]
    assert (png.decode(made) == image).all()
    packed = png.pack(pixel_rows(spark, np.arange(6.0).reshape(2, 3)).withColumn("gray", F.col("v").cast("int")), ["tile_id"]).first()
    assert png.decode(bytes(packed["png"])).ravel().tolist() == list(range(6))


def test_tfrecord(spark, tmp_path):
    assert tfrecord.crc32c(b"123456789") == 0xE3069283 and tfrecord.crc32c(b"") == 0 and tfrecord.crc32c(b"\x00" * 32) == 0x8A9136AA
    spark.dataSource.register(tfrecord.TFRecord)
    rows = spark.createDataFrame([("a", b"\x00\x01", -5, [1.5, 2.0]), ("é", None, 1 << 40, None)], "`image/name` string, `image/encoded` binary, `image/width` long, f array<double>")
    path = str(tmp_path / "tiles")
    rows.write.format("tfrecord").mode("append").save(path)
    back = spark.read.format("tfrecord").schema(rows.schema).option("verify", "true").load(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    name = max((f for f in os.listdir(path) if f.endswith(".tfrecords")), key=lambda f: os.path.getsize(f"{path}/{f}"))
    data = bytearray((tmp_path / "tiles" / name).read_bytes())
    data[-6] ^= 1
    with pytest.raises(ValueError):
        list(tfrecord.frames(bytes(data), True))


def test_geojson_and_logs(spark, tmp_path):
    import json

    square = [[[0, 0], [2, 0], [2, 2], [0, 0]]]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square}}, {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}}]}))
    rows = coordinates.read_geojson(spark, str(tmp_path / "a.geojson"), annotated=True)
    assert rows.count() == 3 and {p["y"] for r in rows.collect() for p in r["ring"]} == {0.0, -2.0}
    coordinates.write_geojson(rows, str(tmp_path / "lines"))
    assert coordinates.read_geojson(spark, str(tmp_path / "a.geojson")).count() == 3
    step = lambda n: {"global_step": str(n), "growth_step": "1", "epoch_step": "1", "steps/sec": "2.5", "losses": {"total": str(n / 2), "bad": "x"}}
    (tmp_path / "logs").mkdir()
    for growth, file_step in ((10, 1), (2, 20), (2, 3)):
        (tmp_path / "logs" / f"loss_logs_growth_{growth}_epoch_0_epoch_step_{file_step}.json").write_text(json.dumps([step(file_step), step(file_step + 1)]))
    flat = logs.flatten(logs.read(spark, str(tmp_path / "logs")), ["total", "bad", "none"]).collect()
    assert [(r["growth"], r["file_step"]) for r in flat] == [(2, 3), (2, 3), (2, 20), (2, 20), (10, 1), (10, 1)] and flat[0]["total"] == 1.5 and flat[0]["bad"] is None and flat[0]["none"] is None
    logs.write(spark.range(10).select(F.col("id").alias("global_step"), (F.col("id") / 2).alias("total")), str(tmp_path / "out"), 5)
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    from tilewright.streaming import moments

    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "value", F.col("user_id").cast("double").alias("u"))
    source = str(tmp_path / "in")
    e.repartition(5).write.parquet(source)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(source)
    moments.keep(stream, ["value", "u"], ["event_type"], str(tmp_path / "states"), str(tmp_path / "ck")).awaitTermination()
    got = {r["event_type"]: r for r in moments.current(spark, ["value", "u"], ["event_type"], str(tmp_path / "states")).collect()}
    for r in stats.moments(e, ["value", "u"], ["event_type"]).collect():
        assert [got[r["event_type"]][c] for c in r.asDict() if c != "event_type"] == pytest.approx([r[c] for c in r.asDict() if c != "event_type"])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 500
    assert set(entry.oracle_sql()) <= set(entry.queries())


def ring_area(r):
    x, y = r[:, 0], r[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def test_outlines_of_combined_polygons():
    box = lambda x, y, w, h: [np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], dtype=float)]
    union, both, less = (lambda p, a: p), (lambda p, a: p and a), (lambda p, a: p and not a)
    out = G.slab_rings([box(0, 0, 4, 4)], [box(1, 1, 2, 2)], less)  # a hole
    assert sorted(map(ring_area, out)) == [-4.0, 16.0]
    out = G.slab_rings([box(0, 0, 2, 2), box(2, 2, 2, 2)], [], union)  # meet in a point
    assert sorted(map(ring_area, out)) == [4.0, 4.0] and all(len(r) == 4 for r in out)
    out = G.slab_rings([box(0, 0, 2, 2), box(1, 0, 3, 2)], [], union)
    assert len(out) == 1 and len(out[0]) == 4 and ring_area(out[0]) == 8.0
    assert G.slab_rings([box(0, 0, 1, 1)], [box(5, 5, 1, 1)], both) == []
    r = np.random.default_rng(4)
    for _ in range(40):
        sides = []
        for _ in range(2):
            polygons = []
            for _ in range(3):
                turn = np.sort(r.uniform(0, 2 * np.pi, 7))
                polygons.append([np.stack([np.cos(turn), np.sin(turn)], axis=1) * r.uniform(0.3, 2, (7, 1)) + r.uniform(-1, 1, 2)])
            sides.append(polygons)
        a, b, common = G.slab_areas(*sides)
        for keep, want in ((union, a), (both, common), (less, a - common)):
            assert sum(map(ring_area, G.slab_rings(*sides, keep))) == pytest.approx(want, abs=1e-6)


def test_order_values(spark, monkeypatch):
    monkeypatch.setattr(stats, "BINS", 4)
    r = np.random.default_rng(5)
    values = [*r.normal(size=200).tolist(), *[0.25] * 90, 1e9, -1e9, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    real = np.sort([v for v in values if v is not None and v == v])
    assert stats.order_values(df, "v", [0, 1, 100, 150, 291, 5]) == [real[k] for k in (0, 1, 100, 150, 291, 5)]
    assert stats.exact_quantiles(df, "v", [0.1, 0.5, 0.9]) == pytest.approx(np.percentile(real, [10, 50, 90]).tolist())
    assert stats.quantile_filter(df.limit(0), "v", 0.1, 0.9).count() == stats.large_area_filter(df.limit(0), "v").count() == 0
    top = stats.top_share(spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k long, v double").where("not isnan(v) or v is null"), "v", 0.2, ["k"]).collect()
    assert sorted((x["v"] for x in top), reverse=True) == sorted(real, reverse=True)[:58]


def test_vector_moments_by_group(spark):
    r = np.random.default_rng(6)
    x, g = r.normal(size=(300, 4)) + 100, r.integers(0, 3, 300)
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(g, x)], "g long, v array<double>").repartition(5)
    for row in stats.vector_moments(df, "v", ["g"]).collect():
        own = x[g == row["g"]]
        assert row["n"] == len(own) and row["cov"] == pytest.approx(np.cov(own.T)[row["i"], row["j"]]) and row["mean_j"] == pytest.approx(own[:, row["j"]].mean())
