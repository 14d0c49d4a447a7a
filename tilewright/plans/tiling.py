"""Queries on grids, rasters, boxes, polygons and tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import morphology, scoring, spatial, store, tiles
from ..sources import coordinates
from . import domain as D

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _bits(row: str, col: str, n: int = 15) -> str:
    return " | ".join(f"((({col} >> {k}) & 1) << {2 * k}) | ((({row} >> {k}) & 1) << {2 * k + 1})" for k in range(n))


@query("morton_tile_codes", f'WITH {D.TILES} SELECT tile_id, ({_bits(chr(34) + "row" + chr(34), "col")})::BIGINT AS code FROM tiles')
def morton_tile_codes(spark, d):
    return D.tiles(spark, d).select("tile_id", S.morton("row", "col").alias("code"))


@query("grid_index_stacks", f'WITH {D.TILES}, c AS (SELECT tile_id, ({_bits(chr(34) + "row" + chr(34), "col")})::BIGINT AS code FROM tiles) SELECT tile_id, (code >> 8)::BIGINT AS g0, (code >> 6)::BIGINT AS g1, ((code >> 8) & 3)::BIGINT AS l0, ((code >> 2) & 3)::BIGINT AS l3 FROM c')
def grid_index_stacks(spark, d):
    c = D.tiles(spark, d).withColumn("code", S.morton("row", "col"))
    g, own = tiles.index_stacks(5)
    return c.select("tile_id", g[0].alias("g0"), g[1].alias("g1"), own[0].alias("l0"), own[3].alias("l3"))


@query("full_grid", f"""WITH {D.TILES}, s AS (SELECT (1 << ceil(log2(greatest(max("row"), max(col)) + 1))::INTEGER)::BIGINT AS side FROM tiles),
g AS (SELECT r.i AS "row", c.i AS col FROM s, LATERAL (SELECT unnest(range(0, side)) AS i) r, LATERAL (SELECT unnest(range(0, side)) AS i) c)
SELECT g."row", g.col, t.tile_id, ({_bits('g."row"', "g.col")})::BIGINT AS code FROM g LEFT JOIN tiles t ON t."row" = g."row" AND t.col = g.col""")
def full_grid(spark, d):
    return tiles.full_grid(D.tiles(spark, d).select("tile_id", "row", "col")).select("row", "col", "tile_id", "code")


@query("quadtree_parent_pivot", f'WITH {D.TILES}, c AS (SELECT label, ({_bits(chr(34) + "row" + chr(34), "col")})::BIGINT AS code FROM tiles) SELECT code >> 2 AS parent, max(label) FILTER (code & 3 = 0) AS c0, max(label) FILTER (code & 3 = 1) AS c1, max(label) FILTER (code & 3 = 2) AS c2, max(label) FILTER (code & 3 = 3) AS c3 FROM c GROUP BY code >> 2')
def quadtree_parent_pivot(spark, d):
    return tiles.siblings(D.tiles(spark, d).withColumn("code", S.morton("row", "col")), "code", "label")


@query("stitch_placement", f"""WITH {D.PIXELS}, s AS (SELECT (1 << ceil(log2(greatest(max("row"), max(col)) + 1))::INTEGER)::BIGINT AS side FROM pixels),
g AS (SELECT r.i AS "Y", c.i AS "X" FROM s, LATERAL (SELECT unnest(range(0, side * 8)) AS i) r, LATERAL (SELECT unnest(range(0, side * 8)) AS i) c),
p AS (SELECT "row" * 8 + y AS "Y", col * 8 + x AS "X", v FROM pixels) SELECT "Y", "X", coalesce(v, 1.0::DOUBLE) AS v FROM g LEFT JOIN p USING ("Y", "X")""")
def stitch_placement(spark, d):
    return tiles.stitch(D.pixels(spark, d), D.SIDE, D.SIDE)


@query("pyramid_level", f'WITH {D.PIXELS}, p AS (SELECT "row" * 8 + y AS "Y", col * 8 + x AS "X", v FROM pixels) SELECT "Y" // 2 AS "Y", "X" // 2 AS "X", round(avg(v), 8) AS v FROM p GROUP BY ALL')
def pyramid_level(spark, d):
    up = tiles.halve(tiles.place(D.pixels(spark, d), D.SIDE, D.SIDE), [])
    return up.select("Y", "X", F.round("v", 8).alias("v"))


@query("tile_tissue_fraction", f"WITH {D.PIXELS} SELECT tile_id, (sum(CASE WHEN v > 0.05 THEN 1 ELSE 0 END))::BIGINT AS tissue, (sum(CASE WHEN v > 0.05 THEN 1 ELSE 0 END))::DOUBLE / 64 AS share FROM pixels GROUP BY tile_id HAVING (sum(CASE WHEN v > 0.05 THEN 1 ELSE 0 END))::DOUBLE / 64 > 0.3")
def tile_tissue_fraction(spark, d):
    return tiles.tissue_share(D.pixels(spark, d), F.col("v") > 0.05, D.SIDE * D.SIDE).where("share > 0.3")


_BATCH = f"""{D.PIXELS}, t AS (SELECT tile_id, any_value("row") AS "row", any_value(col) AS col, sum(CASE WHEN v > 0.05 THEN 1 ELSE 0 END) > 19 AS tissue FROM pixels GROUP BY tile_id),
k AS (SELECT *, (row_number() OVER (PARTITION BY tissue ORDER BY "row", col) - 1) // 16 AS b FROM t), a AS (SELECT tile_id, tissue, (CASE WHEN tissue THEN b ELSE -(b + 1) END)::BIGINT AS batch_idx FROM k)"""


def _batched(spark, d):
    p = D.pixels(spark, d)
    t = p.groupBy("tile_id", "row", "col").agg((F.count_if(F.col("v") > 0.05) > 19).alias("tissue"))
    return tiles.batches(t, "tissue", 16)


@query("batch_assignment", f"WITH {_BATCH} SELECT * FROM a")
def batch_assignment(spark, d):
    return _batched(spark, d).select("tile_id", "tissue", "batch_idx")


@query("batch_drop_remainder", f"WITH {_BATCH} SELECT tile_id, batch_idx FROM a QUALIFY count(*) OVER (PARTITION BY batch_idx) = 16")
def batch_drop_remainder(spark, d):
    return tiles.drop_remainder(_batched(spark, d), 16).select("tile_id", "batch_idx")


@query("sliding_window_overlap_avg", f"""WITH {D.PIXELS}, w AS (SELECT tile_id, y, x, v, wy, wx FROM pixels, (SELECT unnest(range(0, 4)) AS wy), (SELECT unnest(range(0, 4)) AS wx) WHERE y BETWEEN wy * 2 AND wy * 2 + 2 AND x BETWEEN wx * 2 AND wx * 2 + 2),
m AS (SELECT tile_id, wy, wx, max(v) AS s FROM w GROUP BY ALL) SELECT tile_id, y, x, round(avg(s), 8) AS v, count(*)::BIGINT AS covers FROM w JOIN m USING (tile_id, wy, wx) GROUP BY tile_id, y, x""")
def sliding_window_overlap_avg(spark, d):
    w = tiles.windows(D.pixels(spark, d).select("tile_id", "y", "x", "v"), D.SIDE, D.SIDE, 3, 2)
    score = w.groupBy("tile_id", "wy", "wx").agg(F.max("v").alias("v"))
    return tiles.overlap_mean(w.drop("v").join(score, ["tile_id", "wy", "wx"])).withColumn("v", F.round("v", 8))


@query("mirrored_windows", f"""WITH {D.PIXELS}, t AS (SELECT unnest(range(0, 11)) AS t), f AS (SELECT t, CASE WHEN t < 8 THEN t ELSE 15 - t END AS s FROM t),
b AS (SELECT p.tile_id, a.t AS y, c.t AS x, p.v FROM pixels p JOIN f a ON a.s = p.y JOIN f c ON c.s = p.x),
w AS (SELECT b.*, wy, wx FROM b, (SELECT unnest(range(0, 2)) AS wy), (SELECT unnest(range(0, 2)) AS wx) WHERE y BETWEEN wy * 5 AND wy * 5 + 5 AND x BETWEEN wx * 5 AND wx * 5 + 5)
SELECT tile_id, wy::INTEGER AS wy, wx::INTEGER AS wx, count(*)::BIGINT AS n, round(sum(v * (y * 11 + x)), 6) AS total FROM w GROUP BY ALL""")
def mirrored_windows(spark, d):
    p, height, width = tiles.mirrored(D.pixels(spark, d).select("tile_id", "y", "x", "v"), D.SIDE, D.SIDE, 6, 5)
    w = tiles.windows(p, height, width, 6, 5)
    return w.groupBy("tile_id", "wy", "wx").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("v") * (F.col("y") * 11 + F.col("x"))), 6).alias("total"))


@query("nearest_resize", f"WITH {D.PIXELS} SELECT tile_id, i AS y, j AS x, v FROM pixels, (SELECT unnest(range(0, 12)) AS i), (SELECT unnest(range(0, 12)) AS j) WHERE y = i * 8 // 12 AND x = j * 8 // 12")
def nearest_resize(spark, d):
    return tiles.nearest(D.pixels(spark, d).select("tile_id", "y", "x", "v"), D.SIDE, D.SIDE, 12, 12).select("tile_id", "y", "x", "v")


@query("bilinear_halve", f"WITH {D.PIXELS} SELECT tile_id, y // 2 AS y, x // 2 AS x, round(avg(v), 8) AS v FROM pixels GROUP BY tile_id, y // 2, x // 2")
def bilinear_halve(spark, d):
    return tiles.bilinear(D.pixels(spark, d), D.SIDE, D.SIDE, 4, 4).withColumn("v", F.round("v", 8))


@query("half_turn", f"WITH {D.PIXELS} SELECT tile_id, 7 - y AS y, 7 - x AS x, v FROM pixels")
def half_turn(spark, d):
    return tiles.half_turn(D.pixels(spark, d), D.SIDE, D.SIDE).select("tile_id", "y", "x", "v")


@query("pixel_scaling", f"WITH {D.PIXELS} SELECT tile_id, y, x, greatest(0, least(255, floor((v + 1.0) * 127.5)))::INTEGER AS gray, round(greatest(0, least(255, floor((v + 1.0) * 127.5))) * 2.0 / 255.0 - 1.0, 9) AS back FROM pixels")
def pixel_scaling(spark, d):
    p = D.pixels(spark, d).withColumn("gray", S.descale_pixel("v"))
    return p.select("tile_id", "y", "x", "gray", F.round(S.scale_pixel("gray"), 9).alias("back"))


@query("gray_and_stain", """WITH c AS (SELECT event_id, (event_id * 7 % 256)::INTEGER AS r, (event_id * 13 % 256)::INTEGER AS g, (event_id * 29 % 256)::INTEGER AS b FROM events)
SELECT event_id, round(r * 0.299 + g * 0.587 + b * 0.114)::INTEGER AS gray FROM c""")
def gray_and_stain(spark, d):
    e = D.table(spark, d, "events")
    return e.select("event_id", S.luma(F.col("event_id") * 7 % 256, F.col("event_id") * 13 % 256, F.col("event_id") * 29 % 256).alias("gray"))


@query("stain_mask", """
WITH c AS (SELECT event_id, unnest([7, 13, 29]) AS f, unnest([1, 2, 3]) AS k FROM events),
m AS (SELECT *, 0.65 * (e * i - f * h) - 0.70 * (d * i - f * g) + 0.29 * (d * h - e * g) AS det FROM (SELECT 0.07::DOUBLE AS d, 0.99::DOUBLE AS e, 0.11::DOUBLE AS f, 0.27::DOUBLE AS g, 0.57::DOUBLE AS h, 0.78::DOUBLE AS i)),
w AS (SELECT [(0.70 * f - 0.29 * e) / det, (0.29 * d - 0.65 * f) / det, (0.65 * e - 0.70 * d) / det] AS w FROM m),
s AS (SELECT event_id, sum(ln(greatest(event_id * f % 256 / 255.0::DOUBLE, 1e-6::DOUBLE)) / ln(1e-6::DOUBLE) * w[k]) AS dab FROM c, w GROUP BY event_id)
SELECT event_id, round(greatest(dab, 0.0), 6) AS dab, dab > -0.41 AS kept FROM s""")
def stain_mask(spark, d):
    e = D.table(spark, d, "events")
    c = [F.col("event_id") * k % 256 for k in (7, 13, 29)]
    return e.select("event_id", F.round(S.stain(*c), 6).alias("dab"), (S.stain(*c, clamp=False) > -0.41).alias("kept"))


@query("image_bounds", f"WITH {D.PIXELS} SELECT tile_id, max(CASE WHEN v > 0.2 THEN y END) AS max_y, max(CASE WHEN v > 0.2 THEN x END) AS max_x FROM pixels GROUP BY tile_id")
def image_bounds(spark, d):
    return tiles.non_blank_bounds(D.pixels(spark, d), ["tile_id"], F.col("v") <= 0.2)


@query("slide_depths", "SELECT p_partkey, ceil(log2(greatest(ceil(p_size * 2000 / 1024.0), ceil(p_retailprice * 50 / 1024.0))))::INTEGER AS depth FROM part")
def slide_depths(spark, d):
    return D.table(spark, d, "part").select("p_partkey", S.slide_depth(F.col("p_size") * 2000, F.col("p_retailprice") * 50, 1024, 1024).alias("depth"))


@query("thumbnail_sizes", "WITH a AS (SELECT p_partkey, p_size * 2000 AS w, floor(p_retailprice * 50)::BIGINT AS h FROM part), b AS (SELECT *, greatest(w // 5000, 1) AS k FROM a) SELECT p_partkey, (w // k)::BIGINT AS width, (h // k)::BIGINT AS height FROM b")
def thumbnail_sizes(spark, d):
    p = D.table(spark, d, "part").select("p_partkey", (F.col("p_size") * 2000).alias("w"), F.floor(F.col("p_retailprice") * 50).cast("bigint").alias("h"))
    return p.select("p_partkey", S.thumbnail_size("w", "h", 5000).alias("t")).select("p_partkey", "t.width", "t.height")


@query("level_sizes", "SELECT p_partkey, (4 << (p_size % 9))::BIGINT AS size, (8 - p_size % 9)::INTEGER AS level, ((p_size % 17 + 1) // 2)::INTEGER AS block FROM part")
def level_sizes(spark, d):
    """Levels of image sizes and blocks of growths, drawn from the parts' sizes."""
    p = D.table(spark, d, "part").select("p_partkey", F.expr("shiftleft(4L, cast(p_size % 9 as int))").alias("size"), (F.col("p_size") % 17).alias("growth"))
    return p.select("p_partkey", "size", S.level_of_size("size").alias("level"), S.block_of_growth("growth").alias("block"))


@query("filename_parse", """WITH n AS (SELECT event_id, event_id % 100 * 64 + 128 AS x, event_id // 100 * 64 + 64 AS y FROM events), l AS (SELECT min(x) AS lx, min(y) AS ly, max(x) AS hx, max(y) AS hy FROM n)
SELECT event_id, x, y, 64::BIGINT AS width, 64::BIGINT AS height, (x - lx) // 64 AS "row", (y - ly) // 64 AS col, (1 << ceil(log2(greatest((hx - lx) // 64, (hy - ly) // 64) + 1))::INTEGER)::BIGINT AS side FROM n, l""")
def filename_parse(spark, d):
    e = D.table(spark, d, "events").select("event_id", (F.col("event_id") % 100 * 64 + 128).alias("px"), (F.expr("event_id div 100") * 64 + 64).alias("py"))
    return tiles.parse_tile_names(e.select("event_id", tiles.tile_name("s1", "px", "py", 64, 64).alias("name"))).drop("name")


@query("coordinate_csv", f'WITH {D.TILES} SELECT concat((col * 1024)::VARCHAR, \',\', ("row" * 1024)::VARCHAR) AS line FROM tiles WHERE label > 2')
def coordinate_csv(spark, d):
    t = D.tiles(spark, d).select(F.when(F.col("label") > 2, F.col("col") * 1024).alias("x"), (F.col("row") * 1024).alias("y"))
    return coordinates.patch_lines(t)


@query("spatial_self_join", f"WITH {D.BOXES}, p AS (SELECT a.event_id, b.event_id AS o FROM boxes a JOIN boxes b ON a.event_id <> b.event_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1) SELECT b.event_id, count(p.o)::BIGINT AS partners, min(p.o) AS least, coalesce(string_agg(p.o::VARCHAR, ',' ORDER BY p.o), '') AS others FROM boxes b LEFT JOIN p USING (event_id) GROUP BY b.event_id")
def spatial_self_join(spark, d):
    found = spatial.overlapping_self(D.boxes(spark, d), "event_id", 16)
    return found.select("event_id", "partners", "least", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))


@query("boxes_less_partners", f"""WITH {D.BOXES}, c AS (SELECT event_id, cx, cy FROM boxes, LATERAL (SELECT unnest(range(x0, x1)) AS cx) u, LATERAL (SELECT unnest(range(y0, y1)) AS cy) w),
n AS (SELECT cx, cy, count(*) AS k FROM c GROUP BY ALL) SELECT event_id, (count(*))::DOUBLE AS area FROM c JOIN n USING (cx, cy) WHERE k = 1 GROUP BY event_id""")
def boxes_less_partners(spark, d):
    """The area of every box that no other box covers, from its outline less the union of all others."""
    rings = spatial.less_others(D.boxes(spark, d).select("event_id", G.rectangle("x0", "y0", "x1", "y1").alias("ring")), "event_id", 64.0)
    return rings.groupBy("event_id").agg(F.round(F.sum(G.signed_area("ring")), 6).alias("area"))


@query("rect_area_iou", f"""WITH {D.BOXES}, p AS (SELECT a.event_id AS l, b.event_id AS r, ((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)))::DOUBLE AS i FROM boxes a JOIN boxes b ON a.event_id < b.event_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1)
SELECT l, r, i AS inter, 48.0 - i AS "union", i / (48.0 - i) AS iou FROM p""")
def rect_area_iou(spark, d):
    b = D.boxes(spark, d).drop("event_type")
    pairs = spatial.touching(b, b, 16).where("l_event_id < r_event_id")
    return spatial.box_overlap(pairs).select(F.col("l_event_id").alias("l"), F.col("r_event_id").alias("r"), "inter", "union", "iou")


@query("region_area_algebra", f"""WITH {D.BOXES}, f AS (SELECT event_type, event_id % 2 = 1 AS a, x0, y0, x1, y1 FROM boxes),
c AS (SELECT DISTINCT event_type, a, cx, cy FROM f, LATERAL (SELECT unnest(range(x0, x1)) AS cx) u, LATERAL (SELECT unnest(range(y0, y1)) AS cy) w),
s AS (SELECT event_type, cx, cy, bool_or(NOT a) AS p, bool_or(a) AS t FROM c GROUP BY ALL)
SELECT event_type, (count(*) FILTER (p))::DOUBLE AS predicted, (count(*) FILTER (t))::DOUBLE AS annotated, (count(*) FILTER (p AND t))::DOUBLE AS common FROM s GROUP BY event_type""")
def region_area_algebra(spark, d):
    b = D.boxes(spark, d)
    rings = b.select("event_type", (F.col("event_id") % 2 == 1).alias("annotated"), F.col("event_id").alias("polygon_id"), G.rectangle("x0", "y0", "x1", "y1").alias("ring"))
    out = spatial.region_areas(rings, "event_type", 128.0)
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("predicted", "annotated", "common")])


@query("region_outlines", SQL["region_area_algebra"].replace("SELECT event_type, (count(*) FILTER (p))::DOUBLE AS predicted, (count(*) FILTER (t))::DOUBLE AS annotated, (count(*) FILTER (p AND t))::DOUBLE AS common", 'SELECT event_type, (count(*) FILTER (p))::DOUBLE AS "union", (count(*) FILTER (p AND t))::DOUBLE AS intersection, (count(*) FILTER (p AND NOT t))::DOUBLE AS difference'))
def region_outlines(spark, d):
    """Areas within the outlines of unions, intersections and differences."""
    b = D.boxes(spark, d)
    rings = b.select("event_type", (F.col("event_id") % 2 == 1).alias("annotated"), F.col("event_id").alias("polygon_id"), G.rectangle("x0", "y0", "x1", "y1").alias("ring"))
    kinds = ("union", "intersection", "difference")
    parts = spatial.all_rings(rings, "event_type", 64.0, ["union", "intersection", "difference"]).select("event_type", "kind", G.signed_area("ring").alias("area"))
    parts = parts.union(b.select("event_type", F.lit(None), F.lit(0.0)))  # types without a predicted box have areas of 0
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("area"))), F.lit(0.0))
    return parts.groupBy("event_type").agg(*[F.round(of(k), 6).alias(k) for k in ("union", "intersection", "difference")])


def _star(spark, d):
    """Concave pentagons, one of whose corners moves with the box's key."""
    k = F.col("event_id") % 5
    corners = (("x0", "y0"), (F.col("x1") + k, F.col("y0") + 1), ("x1", "y1"), (F.col("x0") + 2, F.col("y1") - 2), (F.col("x0") - 1, F.col("y1") + k))
    return D.boxes(spark, d).select("event_id", F.array(*[G.point(F.col(x) if isinstance(x, str) else x, F.col(y) if isinstance(y, str) else y) for x, y in corners]).alias("ring"))


@query("polygon_shoelace_centroid", f"""WITH {D.BOXES}, r AS (SELECT event_id, [x0, x1 + event_id % 5, x1, x0 + 2, x0 - 1]::DOUBLE[] AS xs, [y0, y0 + 1, y1, y1 - 2, y1 + event_id % 5]::DOUBLE[] AS ys FROM boxes),
e AS (SELECT event_id, xs[i] AS px, ys[i] AS py, xs[i % 5 + 1] AS qx, ys[i % 5 + 1] AS qy FROM r, (SELECT unnest(range(1, 6)) AS i)),
a AS (SELECT event_id, sum(px * qy - qx * py) AS c, sum((px + qx) * (px * qy - qx * py)) AS mx, sum((py + qy) * (px * qy - qx * py)) AS my FROM e GROUP BY event_id)
SELECT event_id, abs(c) / 2.0 AS area, round(mx / (3.0 * c), 4) AS cx, round(my / (3.0 * c), 4) AS cy FROM a""")
def polygon_shoelace_centroid(spark, d):
    b = _star(spark, d)
    c = G.centroid("ring")
    return b.select("event_id", G.area("ring").alias("area"), F.round(c["x"], 4).alias("cx"), F.round(c["y"], 4).alias("cy"))


@query("rotate_scale", f"WITH {D.BOXES} SELECT event_id, (y0 * 2.0)::DOUBLE AS ax, (-x0 * 2.0)::DOUBLE AS ay, least(greatest((y1 * 2.0)::DOUBLE, 0.0), 500.0)::DOUBLE AS bx, least(greatest((-x1 * 2.0)::DOUBLE, -300.0), 0.0)::DOUBLE AS \"by\" FROM boxes")
def rotate_scale(spark, d):
    b = D.boxes(spark, d).select("event_id", G.scale(G.quarter_turn(G.rectangle("x0", "y0", "x1", "y1")), 2.0, 2.0).alias("r"))
    held = b.withColumn("h", G.clip("r", 0, -300, 500, 0))
    return held.select("event_id", F.col("r")[0]["x"].alias("ax"), F.col("r")[0]["y"].alias("ay"), F.col("h")[2]["x"].alias("bx"), F.col("h")[2]["y"].alias("by"))


@query("min_rotated_rectangle", f"WITH {D.BOXES}, r AS (SELECT event_id, (4 + event_id % 5)::DOUBLE AS w, (6 + event_id % 3)::DOUBLE AS h FROM boxes) SELECT event_id, least(w, h) AS min_dim, greatest(w, h) AS max_dim, round(greatest(w, h) * 0.5e-6, 12) AS diameter FROM r")
def min_rotated_rectangle(spark, d):
    """Rectangles turned by a 3-4-5 angle, one side dented inwards."""
    w, h, x, y = F.col("event_id") % 5 + 4, F.col("event_id") % 3 + 6, F.col("x0"), F.col("y0")
    at = lambda a, b: G.point(x + a * 0.6 - b * 0.8, y + a * 0.8 + b * 0.6)
    zero = F.lit(0)
    ring = F.array(at(zero, zero), at(w, zero), at(w * 0.75, h * 0.5), at(w, h), at(zero, h))
    b = D.boxes(spark, d).select("event_id", G.rotated_dimensions(ring).alias("m"))
    return b.select("event_id", F.round("m.min_dim", 6).alias("min_dim"), F.round("m.max_dim", 6).alias("max_dim"), F.round(S.metres(F.round("m.max_dim", 6), F.lit(0.5)), 12).alias("diameter"))


_FLAGS = D.PIXELS + ", flags AS (SELECT tile_id, y, x FROM pixels WHERE v > 0.15)"


def _flags(spark, d):
    return morphology.run_flags(D.pixels(spark, d), F.col("v") > 0.15)


@query("connected_components", f"""WITH RECURSIVE {_FLAGS}, walk AS (SELECT tile_id, y, x, y * 8 + x AS l FROM flags UNION SELECT f.tile_id, f.y, f.x, w.l FROM walk w JOIN flags f ON f.tile_id = w.tile_id AND abs(f.y - w.y) <= 1 AND abs(f.x - w.x) <= 1 AND w.l < f.y * 8 + f.x),
m AS (SELECT tile_id, y, x, min(l) AS l FROM walk GROUP BY ALL) SELECT tile_id, y, x, (dense_rank() OVER (PARTITION BY tile_id ORDER BY l) - 1)::BIGINT AS label FROM m""")
def connected_components(spark, d):
    return morphology.components(_flags(spark, d))


@query("component_centres", SQL["connected_components"].replace("SELECT tile_id, y, x, (dense_rank() OVER (PARTITION BY tile_id ORDER BY l) - 1)::BIGINT AS label FROM m", "SELECT tile_id, l, count(*) AS n, avg(y) AS ay, avg(x) AS ax FROM m GROUP BY ALL").replace("WITH RECURSIVE", "SELECT tile_id, (dense_rank() OVER (PARTITION BY tile_id ORDER BY l) - 1)::BIGINT AS label, n::BIGINT AS size, floor(ay)::BIGINT AS cy, floor(ax)::BIGINT AS cx FROM (WITH RECURSIVE") + ")")
def component_centres(spark, d):
    return morphology.component_centres(morphology.components(_flags(spark, d)))


@query("binary_dilation", f"WITH {_FLAGS} SELECT DISTINCT tile_id, (y + dy)::INTEGER AS y, (x + dx)::INTEGER AS x FROM flags, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx) WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7")
def binary_dilation(spark, d):
    return morphology.dilate(_flags(spark, d), 3, D.SIDE, D.SIDE)


@query("binary_erosion", f"WITH {_FLAGS.replace('0.15', '-0.12')} SELECT tile_id, y, x FROM flags f WHERE (SELECT count(*) FROM flags g WHERE g.tile_id = f.tile_id AND abs(g.y - f.y) <= 1 AND abs(g.x - f.x) <= 1) = (least(f.y + 1, 7) - greatest(f.y - 1, 0) + 1) * (least(f.x + 1, 7) - greatest(f.x - 1, 0) + 1)")
def binary_erosion(spark, d):
    return morphology.erode(morphology.run_flags(D.pixels(spark, d), F.col("v") > -0.12), 3, D.SIDE, D.SIDE)


@query("median_blur3", f"WITH {D.PIXELS} SELECT a.tile_id, a.y, a.x, median(b.v) AS v FROM pixels a JOIN pixels b ON a.tile_id = b.tile_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY a.tile_id, a.y, a.x")
def median_blur3(spark, d):
    return morphology.median(D.pixels(spark, d).select("tile_id", "y", "x", "v"), 3, D.SIDE, D.SIDE)


@query("box_mean", f"WITH {D.PIXELS} SELECT a.tile_id, a.y, a.x, round(avg(b.v), 8) AS v FROM pixels a JOIN pixels b ON a.tile_id = b.tile_id AND b.y - a.y BETWEEN -2 AND 1 AND b.x - a.x BETWEEN -2 AND 1 GROUP BY a.tile_id, a.y, a.x")
def box_mean(spark, d):
    return morphology.box_mean(D.pixels(spark, d).select("tile_id", "y", "x", "v"), 4).withColumn("v", F.round("v", 8))


@query("label_edges", f"WITH {_FLAGS} SELECT tile_id, y, x FROM flags f WHERE (SELECT count(*) FROM flags g WHERE g.tile_id = f.tile_id AND abs(g.y - f.y) + abs(g.x - f.x) = 1) < 4")
def label_edges(spark, d):
    return morphology.edges(_flags(spark, d).withColumn("label", F.lit(1))).select("tile_id", "y", "x")


@query("edge_overlay", f"WITH {D.PIXELS}, f AS (SELECT tile_id, y, x FROM pixels WHERE v > 0.15) SELECT tile_id, y, x, abs(round(v * 100))::BIGINT AS r, CASE WHEN marked THEN 255 ELSE abs(round(v * 100)) END::BIGINT AS g, marked FROM (SELECT p.*, EXISTS (SELECT 1 FROM f WHERE f.tile_id = p.tile_id AND f.y = p.y AND f.x = p.x) AND (SELECT count(*) FROM f WHERE f.tile_id = p.tile_id AND abs(f.y - p.y) + abs(f.x - p.x) = 1) < 4 AS marked FROM pixels p)")
def edge_overlay(spark, d):
    p = D.pixels(spark, d)
    image = p.select("tile_id", "y", "x", *[F.abs(F.round(F.col("v") * 100)).cast("bigint").alias(c) for c in "rg"])
    marks = morphology.edges(p.where("v > 0.15").select("tile_id", "y", "x", F.lit(1).alias("label")))
    return morphology.overlay(image, marks).select("tile_id", "y", "x", "r", F.col("g").cast("bigint").alias("g"), "marked")


@query("contours")
def contours(spark, d):
    c = morphology.contours(D.pixels(spark, d), 0.15)
    return c.select("tile_id", "ring_id", "is_hole", F.round("area", 6).alias("area"), F.size("ring").alias("points"))


@query("anomaly_polygons")
def anomaly_polygons(spark, d):
    """Flags, dilated and smoothed, become rings; small ones go; the rest are turned, measured and stored in metres."""
    p = D.pixels(spark, d)
    grown = morphology.dilate(_flags(spark, d), 2, D.SIDE, D.SIDE).withColumn("f", F.lit(1.0))
    dense = p.select("tile_id", "y", "x").join(grown, ["tile_id", "y", "x"], "left").select("tile_id", "y", "x", F.coalesce("f", F.lit(0.0)).alias("v"))
    rings = morphology.contours(morphology.box_mean(dense, 3), 0.45).where("not is_hole and area >= 2")
    kept = rings.withColumn("ring", G.quarter_turn("ring")).withColumn("m", G.rotated_dimensions("ring")).where("m.min_dim >= 1 and m.max_dim >= 2")
    rows = store.anomaly_rows(kept.select(F.col("tile_id").cast("string").alias("slide_uuid"), "ring"), 0.5)
    return rows.select("slide_uuid", "partition_number", F.size("segment").alias("points"), F.round(G.area("segment") * 1e12, 6).alias("square_microns"))


@query("tiled_inpainting_mask", f"WITH {D.PIXELS} SELECT turn::INTEGER AS turn, tile_id, y, x, CASE WHEN (y // 2 * 4 + x // 2) % 3 = turn THEN -1.0 ELSE v END AS v FROM pixels, (SELECT unnest(range(0, 3)) AS turn)")
def tiled_inpainting_mask(spark, d):
    return scoring.tiled_inpainting(D.pixels(spark, d), 2, D.SIDE, 3).select("turn", "tile_id", "y", "x", "v")


@query("rectangle_mask", f"""WITH {D.PIXELS}, r AS (SELECT tile_id, label % 5 AS y0, tile_id % 5 AS x0, 3 AS h, 3 AS w FROM tiles UNION ALL SELECT tile_id, tile_id % 4, label % 4, 4, 2 FROM tiles),
c AS (SELECT p.tile_id, p.y, p.x, any_value(p.v) AS v, count(r.h)::BIGINT AS covers FROM pixels p LEFT JOIN r ON r.tile_id = p.tile_id AND p.y BETWEEN r.y0 AND r.y0 + r.h - 1 AND p.x BETWEEN r.x0 AND r.x0 + r.w - 1 GROUP BY p.tile_id, p.y, p.x) SELECT tile_id, y, x, covers, covers = 1 AS masked, CASE WHEN covers = 1 THEN -1.0 ELSE v END AS v FROM c""")
def rectangle_mask(spark, d):
    t = D.tiles(spark, d)
    i = lambda c: c.cast("int")
    one = t.select("tile_id", i(F.col("label") % 5).alias("y0"), i(F.col("tile_id") % 5).alias("x0"), F.lit(3).alias("h"), F.lit(3).alias("w"))
    two = t.select("tile_id", i(F.col("tile_id") % 4).alias("y0"), i(F.col("label") % 4).alias("x0"), F.lit(4).alias("h"), F.lit(2).alias("w"))
    masked = scoring.rectangle_mask(D.pixels(spark, d).select("tile_id", "y", "x", "v"), one.union(two))
    return scoring.dead_mask(masked).select("tile_id", "y", "x", "covers", "masked", "v")


@query("shuffle_mask", f"""WITH {D.PIXELS}, m AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY y, x) AS p, row_number() OVER (PARTITION BY tile_id ORDER BY {D.digest_unit('shuffle-1', 'tile_id', 'y', 'x')}, y, x) AS q FROM pixels WHERE y < 4 AND x < 4)
SELECT p.tile_id, p.y, p.x, p.y < 4 AND p.x < 4 AS masked, coalesce(b.v, p.v) AS v FROM pixels p LEFT JOIN m a USING (tile_id, y, x) LEFT JOIN m b ON b.tile_id = a.tile_id AND b.q = a.p""")
def shuffle_mask(spark, d):
    p = D.pixels(spark, d).select("tile_id", "y", "x", "v").withColumn("masked", (F.col("y") < 4) & (F.col("x") < 4))
    return scoring.shuffle_mask(p)


@query("mask_block_sizes", """WITH RECURSIVE b AS (SELECT p_partkey, 0 AS k, p_size::BIGINT AS l FROM part WHERE p_size > 0 UNION ALL SELECT p_partkey, k + 1, l - greatest(1, l // 2) FROM b WHERE l > greatest(1, l // 2))
SELECT p_partkey, k::INTEGER AS k, greatest(1, l // 2)::BIGINT AS size FROM b""")
def mask_block_sizes(spark, d):
    return D.table(spark, d, "part").select("p_partkey", F.posexplode(scoring.block_sizes("p_size")).alias("k", "size"))


def _orders(spark, d):
    """A table, orders not filled, and new rows for it, large orders at another price."""
    o = D.table(spark, d, "orders")
    columns = ["o_orderkey", "o_totalprice"]
    return o.where("o_orderstatus <> 'F'").select(columns), o.where("o_totalprice > 150000").select(columns).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)


@query("upsert_if_absent", "WITH t AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'), s AS (SELECT o_orderkey, o_totalprice + 1.0 AS o_totalprice FROM orders WHERE o_totalprice > 150000) SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def upsert_if_absent(spark, d):
    target, source = _orders(spark, d)
    return store.insert_absent(target, source, "o_orderkey")


@query("delete_then_insert", "WITH t AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'), s AS (SELECT o_orderkey, o_totalprice + 1.0 AS o_totalprice FROM orders WHERE o_totalprice > 150000) SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s")
def delete_then_insert(spark, d):
    target, source = _orders(spark, d)
    return store.delete_insert(target, source, "o_orderkey")


def _wrapped(a: str, sign: str, b: str) -> str:
    """SQL of a sum or product that keeps 64 bits."""
    return f"((({a})::UHUGEINT {sign} ({b})::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT"


def _rotated(a: str, bits: int) -> str:
    return f"(({a}) >> {bits} | {_wrapped(a, '*', f'{1 << (64 - bits)}')})"


def _fingerprint(table: str, key: str, text: str) -> str:
    """SQL of the fingerprint, as `f`, of ASCII texts of 17 to 32 characters."""
    times, plus = (lambda a, b: _wrapped(a, "*", b)), (lambda a, b: _wrapped(a, "+", b))
    word = lambda at: f"('0x' || hex(reverse(substr({text}, {at}, 8))))::UBIGINT"
    k1, k2 = "'0xb492b66fbe98f273'::UBIGINT", "'0x9ae16a3b2f90404f'::UBIGINT"
    return f"""b AS (SELECT {key}, {text}, {plus(k2, f'2 * length({text})')} AS m, {word('1')} AS w0, {word('9')} AS b, {word(f'length({text}) - 7')} AS w2, {word(f'length({text}) - 15')} AS w3 FROM {table}),
c AS (SELECT *, {times('w0', k1)} AS a, {times('w2', 'm')} AS c, {times('w3', k2)} AS d FROM b),
e AS (SELECT *, {plus('a', 'b')} AS ab, {plus('b', k2)} AS bk FROM c),
u AS (SELECT *, {plus(plus(_rotated('ab', 43), _rotated('c', 30)), 'd')} AS u, {plus(plus('a', _rotated('bk', 18)), 'c')} AS v FROM e),
h AS (SELECT *, {times('xor(u, v)', 'm')} AS p FROM u), i AS (SELECT *, {times('xor(v, xor(p, p >> 47))', 'm')} AS q FROM h),
j AS (SELECT {key}, {times('xor(q, q >> 47)', 'm')}::HUGEINT AS f FROM i), prints AS (SELECT {key}, CASE WHEN f >= 9223372036854775808 THEN f - 18446744073709551616 ELSE f END AS f FROM j)"""


@query("hash_partition", f"WITH {_fingerprint('customer', 'c_custkey', 'c_name')} SELECT c_custkey, (abs(f) % 4000)::BIGINT AS partition_number FROM prints")
def hash_partition(spark, d):
    return store.with_partition(D.table(spark, d, "customer").select("c_custkey", "c_name"), "c_name").select("c_custkey", "partition_number")


@query("annotation_left_default", "SELECT doc_id, coalesce(quality, 0) AS label, coalesce(toxic, 0) AS mask FROM documents LEFT JOIN labels USING (doc_id)")
def annotation_left_default(spark, d):
    rows = D.table(spark, d, "documents").select("doc_id").join(D.table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce("quality", F.lit(0)).alias("label"), F.coalesce("toxic", F.lit(0)).alias("mask"))


@query("prediction_keys", "SELECT event_id, event_type || '_' || (event_id % 9)::VARCHAR AS name, (event_id % 9)::INTEGER AS growth FROM events")
def prediction_keys(spark, d):
    e = D.table(spark, d, "events").select("event_id", F.format_string("StatefulPartitionedCall:%s_%d:0", "event_type", F.col("event_id") % 9).alias("key"))
    return coordinates.prediction_names(e, "key").select("event_id", "name", "growth")


@query("export_versions", "SELECT event_type AS prefix, min(event_id) AS first_seen FROM events GROUP BY event_type ORDER BY first_seen LIMIT 3 OFFSET 1")
def export_versions(spark, d):
    e = D.table(spark, d, "events").select("event_id", F.concat(F.lit("exports/"), "event_type", F.lit("/saved_model.pb")).alias("path"))
    return coordinates.first_seen(e, "path", 2, "event_id").offset(1).limit(3)


@query("growth_selection", "SELECT event_id, event_id % 9 AS growth FROM events WHERE event_id % 9 % 2 = 0 AND event_id % 9 IN (0, 2, 8)")
def growth_selection(spark, d):
    e = D.table(spark, d, "events").select("event_id", (F.col("event_id") % 9).alias("growth"))
    return e.where((F.col("growth") % 2 == 0) & F.col("growth").isin(0, 2, 8))


@query("json_last_key_wins", "SELECT event_type AS name, arg_max(value, event_id) AS value FROM events GROUP BY event_type")
def json_last_key_wins(spark, d):
    e = D.table(spark, d, "events").select(F.col("event_id").alias("line"), F.to_json(F.create_map("event_type", "value")).alias("json"))
    return coordinates.last_keys(e, "json", "line", "double")
