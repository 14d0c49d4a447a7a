"""Coordinate lists, prediction names, exports and GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import flip_y

GEOMETRY = "struct<type:string, coordinates:string>"


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """x, y of a CSV file without a header; empty lines are no rows."""
    return spark.read.schema("x long, y long").csv(path)


def patch_lines(rows: DataFrame) -> DataFrame:
    """line: x,y of rows that have coordinates."""
    return rows.where("x is not null and y is not null").select(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string")).alias("line"))


def confusion_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ("filename", "threshold", "tp", "fp", "fn", "tn")]).alias("line"))


def last_keys(rows: DataFrame, json: str, order: str, kind: str) -> DataFrame:
    """name, value of JSON objects merged in order; of equal names the last one stays."""
    each = rows.select(F.col(order).alias("_o"), F.explode(F.from_json(json, f"map<string,{kind}>")).alias("name", "_v"))
    return each.groupBy("name").agg(F.max_by("_v", "_o").alias("value"))


def prediction_names(rows: DataFrame, key: str) -> DataFrame:
    """name (without graph prefix and output number) and growth (its last number)."""
    name = F.regexp_replace(F.regexp_replace(key, r"^[A-Za-z]+:", ""), r":\d+$", "")
    return rows.withColumn("name", name).withColumn("growth", F.regexp_extract("name", r"_(\d+)$", 1).cast("int"))


def first_seen(rows: DataFrame, path: str, part: int, order: str) -> DataFrame:
    """prefix (a part of the path, from 1) and first_seen, in order of it."""
    return rows.groupBy(F.split_part(F.col(path), F.lit("/"), F.lit(part)).alias("prefix")).agg(F.min(order).alias("first_seen")).orderBy("first_seen")


def _rings(geometry: str):
    """Coordinates of a Polygon or MultiPolygon as array of polygons, each an array of rings of [x, y]."""
    kind, text = F.col(f"{geometry}.type"), F.col(f"{geometry}.coordinates")
    many, one = "array<array<array<array<double>>>>", "array<array<array<double>>>"
    return F.when(kind == "MultiPolygon", F.from_json(text, many)).when(kind == "Polygon", F.array(F.from_json(text, one)))


def read_geojson(spark: SparkSession, path: str, annotated: bool = False) -> DataFrame:
    """file, polygon_id, ring_id (0: outer), ring of every polygon of a feature collection; annotations have y flipped.

    A feature list may also be a bare array of features, and a geometry may stand alone.
    """
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    feature = f"array<struct<geometry:{GEOMETRY}>>"
    features = F.coalesce(F.from_json("value", f"struct<features:{feature}>")["features"], F.from_json("value", feature), F.when(F.get_json_object("value", "$.coordinates").isNotNull(), F.array(F.struct(F.from_json("value", GEOMETRY).alias("geometry")))))
    rows = text.select("file", F.explode(features).alias("f")).select("file", F.col("f.geometry").alias("g"))
    rows = rows.select("file", F.explode(_rings("g")).alias("p")).withColumn("polygon_id", F.monotonically_increasing_id())
    rows = rows.select("file", "polygon_id", F.posexplode("p").alias("ring_id", "r"))
    rows = rows.withColumn("ring", F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))).drop("r")
    return rows.withColumn("ring", flip_y("ring")) if annotated else rows


def geojson_lines(rows: DataFrame, ring: str = "ring") -> DataFrame:
    """line: a Polygon of each row's outer ring."""
    points = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    return rows.select(F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(points).alias("coordinates"))).alias("line"))


def write_geojson(rows: DataFrame, path: str, ring: str = "ring") -> None:
    """One geometry for each line, in as many files as there are partitions."""
    geojson_lines(rows, ring).write.mode("overwrite").text(path)
