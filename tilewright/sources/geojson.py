"""Polygons with holes as GeoJSON: geometries or features one a line, and a FeatureCollection for each slide.

A collection is written with its features on lines of their own, so that it is made by a
stream over sorted rows and read in splits; no task holds a slide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import flip_y
from .coordinates import GEOMETRY, _rings

HEAD, TAIL = '{"type":"FeatureCollection","features":[', "]}"


def _points(ring: str) -> Column:
    """[x, y] of a ring's points, the last equal to the first."""
    points = F.transform(ring, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))
    return F.when((F.size(points) == 0) | (points[0] == F.element_at(points, -1)), points).otherwise(F.concat(points, F.slice(points, 1, 1)))


def geometries(rings: DataFrame, by: list[str], polygon: str | None = None, ring: str = "ring", ring_id: str = "ring_id") -> DataFrame:
    """`by`, geometry: the text of a Polygon, or of a MultiPolygon where a value of `by` has several values of `polygon`.

    A polygon's ring of the least `ring_id` is its outer one, the others are holes. Open rings are
    closed; null and empty ones are left out.
    """
    part = F.col(polygon) if polygon else F.lit(0)
    rows = rings.where(F.size(ring) > 0).select(*by, part.alias("_part"), F.struct(F.col(ring_id).alias("k"), _points(ring).alias("r")).alias("_ring"))
    one = rows.groupBy(*by, "_part").agg(F.transform(F.array_sort(F.collect_list("_ring")), lambda s: s["r"]).alias("r"))
    whole = one.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_part", "r"))), lambda s: s["r"]).alias("r"))
    text = lambda kind, coordinates: F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))
    return whole.select(*by, F.when(F.size("r") == 1, text("Polygon", F.col("r")[0])).otherwise(text("MultiPolygon", F.col("r"))).alias("geometry"))


def feature(geometry: str, properties: list[str] = []) -> Column:
    """A Feature of a geometry's text; null properties are written."""
    own = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}) if properties else F.lit("{}")
    return F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null")), F.lit(',"properties":'), own, F.lit("}"))


def collection_lines(features: DataFrame, slide: str, order: list[str], line: str = "feature") -> DataFrame:
    """slide, n (from 1), line: each slide's lines, in order of `order`, make its FeatureCollection; a null feature is none."""
    lines = Window.partitionBy(slide).orderBy(*order)
    n, last = F.row_number().over(lines), F.lead(F.lit(1)).over(lines).isNull()
    rows = features.where(F.col(line).isNotNull()).select(slide, n.alias("n"), last.alias("_last"), line)
    return rows.select(slide, "n", F.concat(F.when(F.col("n") == 1, HEAD).otherwise(","), line, F.when(F.col("_last"), TAIL).otherwise("")).alias("line"))


def write_collections(features: DataFrame, slide: str, order: list[str], path: str, line: str = "feature") -> None:
    """One file for each slide, in the folder slide=...; a file is what one task writes."""
    collection_lines(features, slide, order, line).select(slide, "line").write.mode("overwrite").partitionBy(slide).text(path)


def write_geometries(rows: DataFrame, path: str, geometry: str = "geometry", one_file: bool = False) -> None:
    """A geometry a line; one_file: through one task that only writes."""
    lines = rows.where(F.col(geometry).isNotNull()).select(geometry)
    (lines.repartition(1) if one_file else lines).write.mode("overwrite").text(path)


def rings_of(lines: DataFrame, line: str = "line", annotated: bool = False) -> DataFrame:
    """`lines` with polygon_id, ring_id (0: outer), ring and properties (text) in place of `line`: the rings of each line's feature or geometry.

    Lines are those of geometries, of features or of collections with one feature a line; others
    give no rows. Polygons get numbers that are theirs alone, in the order of the lines of a
    partition. annotated: y is flipped.
    """
    kept = [c for c in lines.columns if c != line]
    bare = F.regexp_replace(F.regexp_replace(F.trim(line), r'^(\{"type"\s*:\s*"FeatureCollection"\s*,\s*"features"\s*:\s*\[)?\s*,?', ""), r"\}\s*(\]\s*\}|,)$", "}")
    rows = lines.withColumn("_t", bare).withColumn("_f", F.from_json("_t", f"struct<geometry:{GEOMETRY}, properties:string>"))
    rows = rows.withColumn("_g", F.coalesce("_f.geometry", F.from_json("_t", GEOMETRY)))
    rows = rows.select(*kept, F.col("_f.properties").alias("properties"), F.explode(_rings("_g")).alias("_p")).withColumn("polygon_id", F.monotonically_increasing_id())
    rows = rows.select(*kept, "polygon_id", "properties", F.posexplode("_p").alias("ring_id", "_r"))
    rows = rows.withColumn("ring", F.transform("_r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return rows.select(*kept, "polygon_id", "ring_id", flip_y("ring").alias("ring") if annotated else "ring", "properties")


def read_lines(spark: SparkSession, path: str, annotated: bool = False) -> DataFrame:
    """rings_of() the lines of files, split as Spark splits text; a folder slide=... gives the column slide."""
    return rings_of(spark.read.text(path), "value", annotated)
