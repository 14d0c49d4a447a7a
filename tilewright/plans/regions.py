"""Queries on polygon regions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import outlines, serving
from ..sources import geojson
from . import domain as D
from .tiling import _star

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: Unit squares that boxes of either kind cover; shapes of regions follow from how these meet.
_SQUARES = f"""WITH {D.BOXES}, covered AS (SELECT event_type, x, y, bool_or(event_id % 2 = 0) AS p, bool_or(event_id % 2 = 1) AS t
  FROM (SELECT event_type, event_id, y0, y1, unnest(range(x0, x1)) AS x FROM boxes), LATERAL (SELECT unnest(range(y0, y1)) AS y) GROUP BY ALL),
kinds(kind) AS (VALUES ('union'), ('intersection'), ('difference')),
c AS MATERIALIZED (SELECT kind, event_type, x, y FROM covered, kinds WHERE CASE kind WHEN 'union' THEN p WHEN 'intersection' THEN p AND t ELSE p AND NOT t END)"""


@query("dissolved_regions", _SQUARES + """, near AS (SELECT c.*, e.x IS NOT NULL AS east, n.x IS NOT NULL AS north, b.x IS NOT NULL AS beyond FROM c LEFT JOIN c e ON e.kind = c.kind AND e.event_type = c.event_type AND e.x = c.x + 1 AND e.y = c.y
  LEFT JOIN c n ON n.kind = c.kind AND n.event_type = c.event_type AND n.x = c.x AND n.y = c.y + 1 LEFT JOIN c b ON b.kind = c.kind AND b.event_type = c.event_type AND b.x = c.x + 1 AND b.y = c.y + 1),
vertices AS (SELECT kind, event_type, x + dx AS vx, y + dy AS vy, sum(1 << (2 * dx + dy)) AS mask FROM c, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dx, dy) GROUP BY ALL),
corners AS (SELECT kind, event_type, sum(CASE WHEN mask IN (6, 9) THEN 2 WHEN bit_count(mask::BIGINT) IN (1, 3) THEN 1 ELSE 0 END)::BIGINT AS corners FROM vertices GROUP BY ALL)
SELECT kind, event_type, count(*)::DOUBLE AS area, (4 * count(*) - 2 * count(*) FILTER (east) - 2 * count(*) FILTER (north))::DOUBLE AS outline,
  (count(*) - count(*) FILTER (east) - count(*) FILTER (north) + count(*) FILTER (east AND north AND beyond))::BIGINT AS rings_less_holes, any_value(corners) AS corners FROM near JOIN corners USING (kind, event_type) GROUP BY kind, event_type""")
def dissolved_regions(spark, d):
    """Whole outlines of unions, intersections and differences: area, length, outer rings less holes, corners."""
    b = D.boxes(spark, d)
    rings = b.select("event_type", (F.col("event_id") % 2 == 1).alias("annotated"), F.col("event_id").alias("polygon_id"), G.rectangle("x0", "y0", "x1", "y1").alias("ring"))
    length = G._sum("ring", lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"]))
    found = outlines.all_dissolved(rings, "event_type", 16.0, ["union", "intersection", "difference"])
    return found.groupBy("kind", "event_type").agg(
        F.round(F.sum(G.signed_area("ring")), 6).alias("area"), F.round(F.sum(length), 6).alias("outline"), F.sum(F.signum(G.signed_area("ring"))).cast("long").alias("rings_less_holes"), F.sum(F.size("ring") - 1).cast("long").alias("corners"))


@query("polygon_self_join", f"""WITH {D.BOXES}, r AS (SELECT event_id, [x0, x1 + event_id % 5, x1, x0 + 2, x0 - 1]::DOUBLE[] AS xs, [y0, y0 + 1, y1, y1 - 2, y1 + event_id % 5]::DOUBLE[] AS ys FROM boxes),
b AS (SELECT *, list_min(xs) AS lx, list_max(xs) AS hx, list_min(ys) AS ly, list_max(ys) AS hy FROM r),
pairs AS MATERIALIZED (SELECT l.event_id AS l, r.event_id AS r, l.xs AS ax, l.ys AS ay, r.xs AS bx, r.ys AS bz FROM b l JOIN b r ON l.lx <= r.hx AND r.lx <= l.hx AND l.ly <= r.hy AND r.ly <= l.hy AND l.event_id < r.event_id),
s AS (SELECT l, r, ax[i] AS px, ay[i] AS py, ax[i % 5 + 1] AS qx, ay[i % 5 + 1] AS qy, bx[j] AS ux, bz[j] AS uy, bx[j % 5 + 1] AS vx, bz[j % 5 + 1] AS vy FROM pairs, (SELECT unnest(range(1, 6)) AS i) i, (SELECT unnest(range(1, 6)) AS j) j),
hits AS (SELECT DISTINCT l, r FROM s WHERE sign((qx - px) * (uy - py) - (qy - py) * (ux - px)) * sign((qx - px) * (vy - py) - (qy - py) * (vx - px)) <= 0
  AND sign((vx - ux) * (py - uy) - (vy - uy) * (px - ux)) * sign((vx - ux) * (qy - uy) - (vy - uy) * (qx - ux)) <= 0
  AND least(px, qx) <= greatest(ux, vx) AND least(ux, vx) <= greatest(px, qx) AND least(py, qy) <= greatest(uy, vy) AND least(uy, vy) <= greatest(py, qy)),
found AS (SELECT l, r FROM hits UNION SELECT l, r FROM pairs WHERE list_sum([CASE WHEN (ay[i] > bz[1]) <> (ay[i % 5 + 1] > bz[1]) AND bx[1] < ax[i] + (bz[1] - ay[i]) / (ay[i % 5 + 1] - ay[i]) * (ax[i % 5 + 1] - ax[i]) THEN 1 ELSE 0 END FOR i IN range(1, 6)]) % 2 = 1
  UNION SELECT l, r FROM pairs WHERE list_sum([CASE WHEN (bz[i] > ay[1]) <> (bz[i % 5 + 1] > ay[1]) AND ax[1] < bx[i] + (ay[1] - bz[i]) / (bz[i % 5 + 1] - bz[i]) * (bx[i % 5 + 1] - bx[i]) THEN 1 ELSE 0 END FOR i IN range(1, 6)]) % 2 = 1),
both_ AS (SELECT l AS event_id, r AS other FROM found UNION ALL SELECT r, l FROM found)
SELECT event_id, count(other)::BIGINT AS partners, min(other) AS least FROM boxes LEFT JOIN both_ USING (event_id) GROUP BY event_id""")
def polygon_self_join(spark, d):
    """How many other polygons share a point with each, not only with its box."""
    own = outlines.meeting_self(_star(spark, d), "event_id", 16.0)
    return own.select("event_id", F.col("partners").cast("long").alias("partners"), F.array_min("others").alias("least"))


_SITES = "s AS (SELECT s_suppkey, (2 + s_suppkey % 7)::DOUBLE AS w, (2 + s_nationkey % 5)::DOUBLE AS h FROM supplier)"


@query("polygon_offsets", f"WITH {_SITES} SELECT s_suppkey, round(w * h + 1.5 * 2 * (w + h) + 8 * 1.5 * 1.5 * sin(pi() / 8), 6) AS grown, round(greatest(w - 3, 0) * greatest(h - 3, 0), 6) AS shrunk FROM s")
def polygon_offsets(spark, d):
    """Areas of a rectangle for each supplier, grown and shrunk by 1.5, with circles of 16 corners."""
    key = F.col("s_suppkey")
    x, y = (key % 100) * 20, F.floor(key / 100) * 20
    rings = D.table(spark, d, "supplier").select(key, G.rectangle(x, y, x + 2 + key % 7, y + 2 + F.col("s_nationkey") % 5).alias("ring"))
    area = lambda distance, name: outlines.buffered(rings, "s_suppkey", distance, 64.0, 4, clean=True).groupBy("s_suppkey").agg(F.sum(G.signed_area("ring")).alias(name))
    both = rings.select("s_suppkey").join(area(1.5, "grown"), "s_suppkey", "left").join(area(-1.5, "shrunk"), "s_suppkey", "left")
    return both.select("s_suppkey", *[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in ("grown", "shrunk")])


def _frames(spark, d):
    """Boxes with a hole, both rings of each on a row of its own."""
    b = D.boxes(spark, d).withColumn("user", F.col("x0").cast("long"))
    hole = F.reverse(G.rectangle(F.col("x0") + 1, F.col("y0") + 1, F.col("x1") - 1, F.col("y1") - 1))
    return b.select("event_type", "user", "event_id", F.posexplode(F.array(G.rectangle("x0", "y0", "x1", "y1"), hole)).alias("ring_id", "ring"))


def _collections(spark, d):
    shapes = geojson.geometries(_frames(spark, d), ["event_type", "user"], "event_id")
    features = shapes.withColumn("feature", geojson.feature("geometry", ["user"]))
    return geojson.collection_lines(features, "event_type", ["user"])


@query("slide_collections", f"""WITH {D.BOXES}, p AS (SELECT event_type, x0 AS "user", count(*) AS n, string_agg('[' || ring || ',' || hole || ']', ',' ORDER BY event_id) AS rings FROM (
  SELECT event_type, event_id, x0, printf('[[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0]]', x0, y0, x1, y0, x1, y1, x0, y1, x0, y0) AS ring,
    printf('[[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0],[%d.0,%d.0]]', x0 + 1, y0 + 1, x0 + 1, y1 - 1, x1 - 1, y1 - 1, x1 - 1, y0 + 1, x0 + 1, y0 + 1) AS hole FROM boxes) GROUP BY ALL),
f AS (SELECT event_type, "user", '{{"type":"Feature","geometry":{{"type":"' || CASE WHEN n = 1 THEN 'Polygon","coordinates":' || rings ELSE 'MultiPolygon","coordinates":[' || rings || ']' END || '}},"properties":{{"user":' || "user" || '}}}}' AS feature FROM p),
k AS (SELECT *, row_number() OVER w AS n, lead(1) OVER w IS NULL AS last FROM f WINDOW w AS (PARTITION BY event_type ORDER BY "user"))
SELECT event_type, n::INTEGER AS n, CASE WHEN n = 1 THEN '{geojson.HEAD}' ELSE ',' END || feature || CASE WHEN last THEN ']}}' ELSE '' END AS line FROM k""")
def slide_collections(spark, d):
    """Lines of a FeatureCollection for each event type: polygons with holes, several of a user as one MultiPolygon."""
    return _collections(spark, d)


@query("collection_rings", f"WITH {D.BOXES} SELECT event_type, count(*)::BIGINT AS polygons, count(*)::BIGINT AS holes, (16 * count(*))::DOUBLE AS area, sum(x0)::BIGINT AS users FROM boxes GROUP BY event_type")
def collection_rings(spark, d):
    """Polygons, holes and areas of the collections, read back from their lines."""
    rings = geojson.rings_of(_collections(spark, d).drop("n"))
    outer = F.col("ring_id") == 0
    return rings.groupBy("event_type").agg(F.sum(outer.cast("long")).alias("polygons"), F.sum((~outer).cast("long")).alias("holes"), F.round(F.sum(G.signed_area("ring")), 4).alias("area"),
        F.sum(F.when(outer, F.get_json_object("properties", "$.user").cast("long"))).alias("users"))


@query("cells_by_tile", f"""WITH {D.BOXES}, t AS (SELECT x0 // 64 AS x, y0 // 64 AS y, * FROM boxes)
SELECT x, y, '(' || x || ', ' || y || ')' AS place, count(*)::BIGINT AS cells, string_agg('[' || (x0 + 2)::DOUBLE || ',' || (y0 + 3)::DOUBLE || ']', ' ' ORDER BY event_id) AS centroids FROM t GROUP BY x, y""")
def cells_by_tile(spark, d):
    """Boxes as the cells of tiles of 64: a record for each tile under its place's name."""
    b = D.boxes(spark, d)
    rings = b.select(F.floor(F.col("x0") / 64).alias("x"), F.floor(F.col("y0") / 64).alias("y"), F.col("event_id").alias("ring_id"), G.rectangle("x0", "y0", "x1", "y1").alias("ring"))
    rows = serving.keyed_cells(rings).select("x", "y", F.explode("cells").alias("place", "c"))
    centroids = F.transform("c", lambda c: F.to_json(F.transform(c["centroid"], lambda v: F.round(v, 6))))
    return rows.select("x", "y", "place", F.size("c").cast("long").alias("cells"), F.array_join(centroids, " ").alias("centroids"))
