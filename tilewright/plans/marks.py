"""Queries on edges, masks block by block and polygons of whole slides, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import canny, composites, morphology, scoring, serving
from . import domain as D
from .slides import TILE

Q: dict = {}
SQL: dict[str, str] = {}
LEVEL = 0.15


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _canny(keys: str, low: float, high: float) -> str:
    """SQL of edges of 8 by 8 images im (keys, y, x, v), as `edges`; their hysteresis is recursive."""
    same = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))
    own = lambda a: ", ".join(f"{a}.{k}" for k in keys.split(", "))
    return f"""sobel(dy, dx, wx, wy) AS (VALUES (-1, -1, -1, -1), (-1, 0, 0, -2), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 0, 0, 2), (1, 1, 1, 1)),
g AS (SELECT {own('a')}, a.y, a.x, sum(wx * b.v) AS gx, sum(wy * b.v) AS gy FROM im a, sobel, im b WHERE {same('a', 'b')} AND b.y = least(greatest(a.y + dy, 0), 7) AND b.x = least(greatest(a.x + dx, 0), 7) GROUP BY {own('a')}, a.y, a.x),
m AS MATERIALIZED (SELECT *, abs(gx) + abs(gy) AS s, CASE WHEN abs(gy) * 32768 < abs(gx) * 13573 THEN [0, -1] WHEN abs(gy) * 32768 > abs(gx) * 79109 THEN [-1, 0] WHEN (gx < 0) = (gy < 0) THEN [-1, -1] ELSE [-1, 1] END AS d FROM g),
tops AS MATERIALIZED (SELECT {own('c')}, c.y, c.x, c.s FROM m c LEFT JOIN m a ON {same('a', 'c')} AND a.y = c.y + c.d[1] AND a.x = c.x + c.d[2] LEFT JOIN m b ON {same('b', 'c')} AND b.y = c.y - c.d[1] AND b.x = c.x - c.d[2]
  WHERE c.s > {low} AND c.s > coalesce(a.s, 0) AND (c.s > coalesce(b.s, 0) OR c.s = b.s AND c.d[1] * c.d[2] = 0)),
edges AS (SELECT {keys}, y, x FROM tops WHERE s > {high} UNION SELECT {own('t')}, t.y, t.x FROM edges w, tops t WHERE {same('w', 't')} AND abs(w.y - t.y) <= 1 AND abs(w.x - t.x) <= 1)"""


@query("canny_edges", f"WITH RECURSIVE {D.PIXELS}, im AS MATERIALIZED (SELECT tile_id, y, x, floor(v * 100) AS v FROM pixels), {_canny('tile_id', 40, 90)} SELECT tile_id, y, x FROM edges")
def canny_edges(spark, d):
    """Edges of every tile: thinned gradients above one threshold that reach one above another."""
    p = D.pixels(spark, d).select("tile_id", F.col("y").alias("Y"), F.col("x").alias("X"), F.floor(F.col("v") * 100).cast("double").alias("v"))
    return canny.edges(p, 40.0, 90.0, TILE, ["tile_id"]).select("tile_id", F.col("Y").alias("y"), F.col("X").alias("x"))


@query("cell_edges", f"""WITH RECURSIVE {D.PIXELS}, flags AS MATERIALIZED (SELECT tile_id, y, x FROM pixels WHERE v > {LEVEL}),
walk AS (SELECT tile_id, y, x, y * 8 + x AS l FROM flags UNION SELECT f.tile_id, f.y, f.x, w.l FROM walk w, flags f WHERE f.tile_id = w.tile_id AND abs(f.y - w.y) <= 1 AND abs(f.x - w.x) <= 1 AND w.l < f.y * 8 + f.x),
cells AS MATERIALIZED (SELECT tile_id, y, x, min(l) AS label FROM walk GROUP BY ALL), grown AS (SELECT DISTINCT tile_id, label, y + dy AS y, x + dx AS x FROM cells, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)),
im AS MATERIALIZED (SELECT k.tile_id, k.label, i // 8 AS y, i % 8 AS x, CASE WHEN g.y IS NULL THEN 0 ELSE 1 END AS v FROM (SELECT DISTINCT tile_id, label FROM cells) k CROSS JOIN (SELECT unnest(range(64)) AS i) LEFT JOIN grown g ON g.tile_id = k.tile_id AND g.label = k.label AND g.y = i // 8 AND g.x = i % 8),
{_canny('tile_id, label', 2, 5)} SELECT DISTINCT tile_id, y::INTEGER AS y, x::INTEGER AS x FROM edges""")
def cell_edges(spark, d):
    """Edges of every component of flagged pixels by itself, grown by a pixel."""
    labels = morphology.components(D.pixels(spark, d).where(F.col("v") > LEVEL).select("tile_id", "y", "x"))
    found = canny.cell_edges(labels.select("tile_id", F.col("y").alias("Y"), F.col("x").alias("X"), "label"), TILE, F.lit(D.SIDE), F.lit(D.SIDE), ["tile_id"])
    return found.select("tile_id", F.col("Y").cast("int").alias("y"), F.col("X").cast("int").alias("x"))


@query("block_shuffle_masks", f"""WITH {D.PIXELS}, a AS (SELECT tile_id, block, (size + floor({D.digest_unit('area-1', 'tile_id', 'block')} * 4) - 2)::INTEGER AS area FROM tiles, (VALUES (0, 8), (1, 4), (2, 2), (3, 1), (4, 1)) t(block, size)),
s AS (SELECT tile_id, block, floor(sqrt(area))::INTEGER AS h, area // floor(sqrt(area))::INTEGER AS w FROM a WHERE area > 0),
r AS (SELECT *, floor({D.digest_unit('y-1', 'tile_id', 'block')} * (9 - h))::INTEGER AS y0, floor({D.digest_unit('x-1', 'tile_id', 'block')} * (9 - w))::INTEGER AS x0 FROM s),
k AS MATERIALIZED (SELECT p.tile_id, block, p.y, p.x, p.v, row_number() OVER (PARTITION BY p.tile_id, block ORDER BY p.y, p.x) AS place, row_number() OVER (PARTITION BY p.tile_id, block ORDER BY {D.digest_unit('shuffle-1', 'p.tile_id', 'block', 'p.y', 'p.x')}, p.y, p.x) AS turn
  FROM r JOIN pixels p ON p.tile_id = r.tile_id AND p.y BETWEEN y0 AND y0 + h - 1 AND p.x BETWEEN x0 AND x0 + w - 1),
c AS (SELECT a.tile_id, a.y, a.x, count(*) AS n, max(b.v) AS v FROM k a JOIN k b ON b.tile_id = a.tile_id AND b.block = a.block AND b.turn = a.place GROUP BY ALL)
SELECT p.tile_id, p.y, p.x, coalesce(n, 0)::BIGINT AS covers, CASE WHEN n = 1 THEN c.v ELSE p.v END AS v FROM pixels p LEFT JOIN c USING (tile_id, y, x)""")
def block_shuffle_masks(spark, d):
    """Rectangles of random sizes whose pixels change places, each within itself."""
    rects = serving.random_rectangles(D.tiles(spark, d), D.SIDE, scoring.mask_blocks(16), shift=2)
    p = D.pixels(spark, d).select("tile_id", "y", "x", "v")
    return scoring.masked_images(p, rects, shuffle=True).select("tile_id", "y", "x", "covers", "v")


def _slide(spark, d):
    """Stitched pixels of a slide for every 8 rows of tiles."""
    high, wide = 8 * D.SIDE, D.GRID * D.SIDE
    p = D.pixels(spark, d)
    return p.select(F.floor(F.col("row") / 8).alias("slide"), (F.col("row") % 8 * D.SIDE + F.col("y")).alias("Y"), (F.col("col") * D.SIDE + F.col("x")).alias("X"), "v", F.lit(high).alias("height"), F.lit(wide).alias("width"))


@query("slide_anomaly_outlines")
def slide_anomaly_outlines(spark, d):
    """Anomalies of whole slides by all steps: grown, blurred, traced, filtered, less each other, measured, smoothed and scaled."""
    flags = _slide(spark, d).where(F.col("v") > 0.25)
    found = composites.anomaly_outlines(flags, ["slide"], tile=TILE, cell=64.0, grow=2, blur=3, level=0.5, least_area=2.0, share=0.5, smooth=1.0, sizes=(2.0, 3.0), factor=4.0)
    rings = found.groupBy("slide", "ring_id").agg(F.count(F.lit(1)).alias("rings"), F.first("area").alias("area"), F.first("min_dim").alias("min_dim"), F.first("max_dim").alias("max_dim"))
    return rings.select("slide", "ring_id", "rings", *[F.round(c, 4).alias(c) for c in ("area", "min_dim", "max_dim")])


@query("slide_prediction_outlines")
def slide_prediction_outlines(spark, d):
    """Predictions of whole slides, twice as large, clipped, united and met with patches: every second tile of every second row."""
    p = _slide(spark, d)
    x, y = F.expr("X div 8") * 8, F.expr("Y div 8") * 8
    patches = p.where("X div 8 % 2 = 0 and Y div 8 % 2 = 0").select("slide", G.rectangle(x, y, x + 8, y + 8).alias("ring")).distinct()
    found = composites.prediction_outlines(p, "slide", 0.3, factor=2.0, patches=patches, tile=TILE, cell=64.0)
    return found.groupBy("slide").agg(F.count(F.lit(1)).alias("rings"), F.round(F.sum(G.signed_area("ring")), 4).alias("area"))
