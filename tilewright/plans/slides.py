"""Queries on a whole stitched slide, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import slides
from . import domain as D

Q: dict = {}
SQL: dict[str, str] = {}
LEVEL = 0.15
#: Pixels on a side of the pieces that a slide is worked on in.
TILE = 64


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def stitched(spark, d):
    """Y, X, v of the slide that all tiles make."""
    return D.pixels(spark, d).select((F.col("row") * D.SIDE + F.col("y")).alias("Y"), (F.col("col") * D.SIDE + F.col("x")).alias("X"), "v")


def _walk(near: str) -> str:
    """SQL of the least place that each flagged pixel reaches."""
    return f"""WITH RECURSIVE {D.PIXELS}, slide AS MATERIALIZED (SELECT ("row" * 8 + y)::BIGINT AS "Y", (col * 8 + x)::BIGINT AS "X", v FROM pixels),
flags AS MATERIALIZED (SELECT "Y", "X", "Y" * 4294967296 + "X" AS p FROM slide WHERE v >= {LEVEL}), ways(dy, dx) AS (VALUES {near}),
walk AS (SELECT "Y", "X", p AS l FROM flags UNION SELECT f."Y", f."X", w.l FROM walk w, ways, flags f WHERE f."Y" = w."Y" + dy AND f."X" = w."X" + dx AND w.l < f.p),
m AS MATERIALIZED (SELECT "Y", "X", min(l) AS label FROM walk GROUP BY ALL)"""


EIGHT = "(0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)"
FOUR = "(0, 1), (1, 0), (0, -1), (-1, 0)"


@query("slide_components", _walk(EIGHT) + ' SELECT "Y", "X", label FROM m')
def slide_components(spark, d):
    """Components across all tiles of the slide."""
    return slides.components(stitched(spark, d).where(F.col("v") >= LEVEL), TILE)


@query("slide_component_centres", _walk(EIGHT) + ' SELECT label, count(*)::BIGINT AS size, floor(avg("Y"))::BIGINT AS cy, floor(avg("X"))::BIGINT AS cx FROM m GROUP BY label')
def slide_component_centres(spark, d):
    return slides.enclosed(slide_components(spark, d))


#: Rings are counted by Euler's formula, areas and points by the segments of every cell.
@query("slide_contours", _walk(FOUR) + f""", spots AS (SELECT DISTINCT "Y" + dy AS r, "X" + dx AS c FROM flags, (VALUES (0, 0), (-1, 0), (0, -1), (-1, -1)) o(dy, dx)),
cells AS (SELECT r, c, list(coalesce(v, {LEVEL} - 1) ORDER BY k) AS v, list(label ORDER BY k) AS l FROM spots, (VALUES (0, 0, 0), (1, 0, 1), (2, 1, 1), (3, 1, 0)) o(k, dy, dx)
  LEFT JOIN slide s ON s."Y" = r + dy AND s."X" = c + dx LEFT JOIN m ON m."Y" = r + dy AND m."X" = c + dx GROUP BY r, c),
lines AS (SELECT r, c, v, l[k + 1] AS label, (k + 3) % 4 AS a, k AS b, (k + n - 1) % 4 AS e, (k + n) % 4 AS f FROM cells, (VALUES (0), (1), (2), (3)) s(k), (VALUES (1), (2), (3)) t(n)
  WHERE v[(k + 3) % 4 + 1] < {LEVEL} AND v[(k + n) % 4 + 1] < {LEVEL} AND NOT list_contains([v[(k + i) % 4 + 1] >= {LEVEL} FOR i IN range(n)], false)),
ends AS (SELECT label, r + [0, 0, 1, 1][a + 1] + ({LEVEL} - v[a + 1]) / (v[b + 1] - v[a + 1]) * ([0, 0, 1, 1][b + 1] - [0, 0, 1, 1][a + 1]) AS y0, c + [0, 1, 1, 0][a + 1] + ({LEVEL} - v[a + 1]) / (v[b + 1] - v[a + 1]) * ([0, 1, 1, 0][b + 1] - [0, 1, 1, 0][a + 1]) AS x0,
  r + [0, 0, 1, 1][e + 1] + ({LEVEL} - v[e + 1]) / (v[f + 1] - v[e + 1]) * ([0, 0, 1, 1][f + 1] - [0, 0, 1, 1][e + 1]) AS y1, c + [0, 1, 1, 0][e + 1] + ({LEVEL} - v[e + 1]) / (v[f + 1] - v[e + 1]) * ([0, 1, 1, 0][f + 1] - [0, 1, 1, 0][e + 1]) AS x1 FROM lines),
areas AS (SELECT label, round(-sum(x0 * y1 - x1 * y0) / 2, 6) AS area, count(*)::BIGINT AS points FROM ends GROUP BY label),
euler AS (SELECT m.label, count(*) - count(e.label) - count(s.label) + count(CASE WHEN e.label IS NOT NULL AND s.label IS NOT NULL AND q.label IS NOT NULL THEN 1 END) AS chi
  FROM m LEFT JOIN m e ON e."Y" = m."Y" AND e."X" = m."X" + 1 LEFT JOIN m s ON s."Y" = m."Y" + 1 AND s."X" = m."X" LEFT JOIN m q ON q."Y" = m."Y" + 1 AND q."X" = m."X" + 1 GROUP BY m.label)
SELECT label, (2 - chi)::BIGINT AS rings, (1 - chi)::BIGINT AS holes, area, points FROM euler JOIN areas USING (label)""")
def slide_contours(spark, d):
    """Contours of the whole slide by component: rings, holes (with the component's outer ring as parent), enclosed area and points."""
    found = slides.contours(stitched(spark, d), LEVEL, TILE)
    return found.groupBy("label").agg(
        F.count(F.lit(1)).alias("rings"), F.count("parent").alias("holes"), F.round(F.sum(F.when(F.col("is_hole"), -F.col("area")).otherwise(F.col("area"))), 6).alias("area"),
        F.sum(F.size("ring") - 1).cast("long").alias("points"))
