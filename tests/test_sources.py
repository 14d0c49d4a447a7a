"""Record files in ranges, compressed and under wildcards; GeoJSON written and read back."""

from __future__ import annotations

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.sources import tfrecord


def bodies(seed: int = 0, n: int = 60) -> list[bytes]:
    rng = np.random.default_rng(seed)
    return [tfrecord.example({"id": k, "image": rng.bytes(int(rng.integers(0, 400))), "w": [float(k), 0.5]}) for k in range(n)]


@pytest.mark.parametrize("split", [1, 7, 64, 301, 5000])
def test_every_record_is_in_one_range(spark, tmp_path, split):
    """Also ranges shorter than a record, and a record that holds records."""
    inside = b"".join(map(tfrecord.frame, bodies(1, 3)))
    made = [*bodies(), tfrecord.example({"id": 60, "image": inside}), tfrecord.example({"id": 61})]
    data = b"".join(map(tfrecord.frame, made))
    if split <= len(inside):  # a range within the inner records would be misled, as stated
        data = b"".join(map(tfrecord.frame, made[:-2] + made[-1:]))
        made = made[:-2] + made[-1:]
    out = []
    for start in range(0, len(data), split):
        end = min(start + split, len(data))
        at = 0 if start == 0 else tfrecord.first_record(data[start : min(end + 11, len(data))], end - start, len(data) - start, lambda n, p: data[start + p : start + p + n])
        if at is not None:
            rest = memoryview(data)[start + at :].tobytes()
            out += list(tfrecord.records(lambda n: b"", rest, end - start - at, True))
    assert out == made


def test_ranges_compression_and_wildcards(spark, tmp_path):
    spark.dataSource.register(tfrecord.TFRecord)
    for k in range(3):
        (tmp_path / "a").mkdir(exist_ok=True)
        data = b"".join(map(tfrecord.frame, bodies(k)))
        (tmp_path / "a" / f"x{k}.tfrecord").write_bytes(data)
        (tmp_path / "z").mkdir(exist_ok=True)
        half = len(data) // 2
        (tmp_path / "z" / f"x{k}.tfrecords.gz").write_bytes(gzip.compress(data[:half]) + gzip.compress(data[half:]))
    (tmp_path / "a" / "empty.tfrecord").write_bytes(b"")
    (tmp_path / "a" / "notes.txt").write_bytes(b"x")
    schema = "id long, w array<double>, image binary"
    expected = sorted((k, [float(k), 0.5]) for k in range(60) for _ in range(3))
    read = spark.read.format("tfrecord").schema(schema)
    found = read.option("split", 500).option("verify", True).load(str(tmp_path / "a"))
    assert found.rdd.getNumPartitions() > 20 and sorted((r["id"], r["w"]) for r in found.collect()) == expected
    for path in (str(tmp_path / "z"), str(tmp_path / "a" / "x*.tfrecord"), f"file://{tmp_path}/*/x?.tfrecord", str(tmp_path / "z" / "*.gz")):
        assert sorted((r["id"], r["w"]) for r in read.load(path).collect()) == expected
    assert read.load(str(tmp_path / "a" / "x0.tfrecord")).count() == 60
    assert read.load(str(tmp_path / "a" / "none*")).count() == 0
    rows = read.load(str(tmp_path / "a"))
    rows.write.format("tfrecord").option("compression", "gzip").mode("overwrite").save(str(tmp_path / "out"))
    rows.where("id < 10").write.format("tfrecord").option("compression", "gzip").mode("overwrite").save(str(tmp_path / "out2"))
    assert sorted(map(str, read.load(str(tmp_path / "out")).collect())) == sorted(map(str, rows.collect()))
    rows.write.format("tfrecord").mode("overwrite").save(str(tmp_path / "out2"))
    assert read.load(str(tmp_path / "out2")).count() == 180


def test_damage_is_found_and_unasked_features_are_not_decoded(spark, tmp_path):
    spark.dataSource.register(tfrecord.TFRecord)
    data = bytearray(b"".join(map(tfrecord.frame, bodies())))
    data[2] ^= 1  # the first length
    (tmp_path / "x.tfrecord").write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        spark.read.format("tfrecord").schema("id long").load(str(tmp_path / "x.tfrecord")).collect()
    bad = tfrecord.example({"id": 1, "note": b"\xff"})
    assert tfrecord.parse(bad, {"id"}) == {"id": [1]} and tfrecord.parse(bad)["note"] == [b"\xff"]


RING = "ring array<struct<x double, y double>>"


def square(x, y, w, turn=1):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)][::turn]


def test_geojson_is_read_as_written(spark, tmp_path):
    from tilewright.sources import coordinates, geojson

    rows = [("a", 1, 7, 0, square(0.0, 0.0, 9.0)), ("a", 1, 7, 1, square(1.0, 1.0, 2.0, -1)), ("a", 1, 8, 0, square(20.5, 0.0, 4.0)), ("a", 2, 9, 0, square(30.0, 1.25, 1.0)[:-1]),
            ("b, ]}", 3, 1, 0, square(-4.0, 0.0, 1.0)), ("b, ]}", 4, 1, 0, None), ("b, ]}", 5, 1, 0, [])]
    df = spark.createDataFrame(rows, f"slide string, feature int, polygon_id int, ring_id int, {RING}").withColumn("extra", F.lit(1))
    shapes = geojson.geometries(df, ["slide", "feature"], "polygon_id").withColumnRenamed("feature", "number")
    texts = {(r["slide"], r["number"]): json.loads(r["geometry"]) for r in shapes.collect()}
    assert set(texts) == {("a", 1), ("a", 2), ("b, ]}", 3)} and texts["a", 1]["type"] == "MultiPolygon" and texts["a", 2]["type"] == "Polygon"
    assert [len(p) for p in texts["a", 1]["coordinates"]] == [2, 1] and texts["a", 2]["coordinates"][0][0] == texts["a", 2]["coordinates"][0][-1]
    features = shapes.withColumn("note", F.when(F.col("number") == 1, F.lit("}]}"))).withColumn("feature", geojson.feature("geometry", ["number", "note"]))
    path = str(tmp_path / "slides")
    geojson.write_collections(features, "slide", ["number"], path)
    files = [f for f in (tmp_path / "slides").rglob("*.txt")]
    assert len(files) == 2 and all(json.loads(f.read_text())["type"] == "FeatureCollection" for f in files)
    key = lambda rows: sorted((r["ring_id"], [tuple(p) for p in r["ring"]]) for r in rows)
    closed = [(r[3], r[4] if r[4][0] == r[4][-1] else r[4] + r[4][:1]) for r in rows if r[4]]
    back = geojson.read_lines(spark, path)
    assert key(back.collect()) == sorted(closed)
    assert {json.loads(r["properties"])["number"]: r["slide"] for r in back.collect()} == {1: "a", 2: "a", 3: "b, ]}"}
    assert back.groupBy("polygon_id").count().count() == 4
    assert {p["y"] for r in geojson.read_lines(spark, path, annotated=True).collect() for p in r["ring"]} == {-p[1] for _, r in closed for p in r}
    assert key(coordinates.read_geojson(spark, str(files[0])).collect() + coordinates.read_geojson(spark, str(files[1])).collect()) == sorted(closed)
    geojson.write_geometries(shapes, str(tmp_path / "lines"), one_file=True)
    assert len([f for f in (tmp_path / "lines").glob("part*")]) == 1 and key(geojson.read_lines(spark, str(tmp_path / "lines")).collect()) == sorted(closed)
    assert geojson.collection_lines(features.where("false"), "slide", ["number"]).count() == 0


def test_single_images_are_scored(spark, tmp_path):
    from tilewright.operators import serving
    from tilewright.sources import png

    for k in range(3):
        (tmp_path / f"tile_{k}_4.png").write_bytes(png.encode(np.arange(24, dtype=np.uint8).reshape(4, 6) + k))
    (tmp_path / "other.png").write_bytes(png.encode(np.zeros((2, 2), np.uint8)))
    load = lambda: lambda x: {"same": x, "twice": 2 * x}
    rows = serving.score_files(spark, str(tmp_path), load, ["same", "twice"], 2, 3, ("twice",)).collect()
    assert sorted((r["x"], r["y"]) for r in rows if r["x"] is not None) == [(0, 4), (1, 4), (2, 4)] and len(rows) == 4
    one = next(r for r in rows if r["x"] == 1)
    assert one["same"] == [1, 3, 5, 13, 15, 17] and one["twice"] == [26, 30, 34, 2, 6, 10]


def test_rows_that_break_rules_are_not_written(spark, tmp_path):
    from tilewright.operators import store

    good = ("s", 1, square(0.0, 0.0, 1.0))
    kind = f"slide_uuid string, partition_number long, {RING.replace('ring', 'segment', 1)}"
    rules = store.polygon_rules(store.ANOMALY_POLYGONS)
    store.checked(spark.createDataFrame([good], kind), rules).write.parquet(str(tmp_path / "good"))
    for n, bad in enumerate([(None, 1, good[2]), ("s", 1, [(0.0, 0.0)]), ("s", 1, None), ("s", 1, square(float("nan"), 0.0, 1.0))]):
        with pytest.raises(Exception, match="breaks"):
            store.checked(spark.createDataFrame([good, bad], kind), rules).write.parquet(str(tmp_path / f"bad{n}"))
        assert not list((tmp_path / f"bad{n}").glob("part*")) if (tmp_path / f"bad{n}").exists() else True
    target = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    source = spark.createDataFrame([(1, "a"), (2, "c"), (2, "b"), (None, "z")], "k int, v string")
    assert sorted(map(tuple, store.insert_absent(target, source, "k").collect()), key=str) == [(1, "x"), (2, "b"), (None, "y")]
    assert sorted(map(tuple, store.insert_absent(target.where("k = 1"), source.union(source), "k").collect()), key=str) == [(1, "x"), (2, "b"), (None, "z")]


def test_slots_of_batches(spark):
    from tilewright.operators import scoring

    rows = spark.createDataFrame([(n, p) for n in (2, 4, 6, 8) for p in range(n)], "n int, p int")
    slots = {}
    for r in rows.withColumn("slot", scoring.minibatch_slot("p", "n")).collect():
        slots.setdefault(r["n"], []).append(r["slot"])
    assert slots == {2: [0, 0], 4: [0] * 4, 6: [0] * 6, 8: [0, 1] * 4}


def test_codes_of_far_tiles(spark):
    from tilewright.functions import scalars as S

    rows = spark.createDataFrame([(1 << 15, 0)], "r int, c int")
    assert rows.select(S.morton("r", "c", 31).alias("m")).first()["m"] == 2 << 30
    with pytest.raises(Exception, match="more than 15 bits"):
        rows.select(S.morton("r", "c").alias("m")).collect()
    assert spark.createDataFrame([(None, 1)], "r int, c int").select(S.morton("r", "c").alias("m")).first()["m"] is None
