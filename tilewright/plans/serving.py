"""Queries on model scoring, dispatch, sampling and set operations, each with its SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import scoring, serving, spatial
from ..operators.tiles import batches
from ..sources import coordinates
from . import domain as D
from .tiling import _BATCH

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def halving_model():
    """Stands in for a network: halves and centres its input."""
    return lambda x: {"generated_images": np.round(x * 0.5 - 0.25, 6)}


@query("model_scoring", "SELECT vec_id AS tile_id, round(embedding[1]::DOUBLE * 0.5 - 0.25, 6) AS first, round(embedding[64]::DOUBLE * 0.5 - 0.25, 6) AS last FROM embeddings")
def model_scoring(spark, d):
    made = serving.score(D.tiles(spark, d).select("tile_id", "values"), halving_model, ["generated_images"])
    return made.select("tile_id", F.col("generated_images")[0].alias("first"), F.col("generated_images")[63].alias("last"))


@query("dispatch_batches", f"WITH {_BATCH} SELECT a.tile_id, a.batch_idx, CASE WHEN a.tissue THEN round(e.embedding[1]::DOUBLE * 0.5 - 0.25, 6) ELSE 1.0 END AS first FROM a JOIN embeddings e ON e.vec_id = a.tile_id")
def dispatch_batches(spark, d):
    t = D.tiles(spark, d).withColumn("tissue", F.aggregate("values", F.lit(0), lambda s, x: s + (x > 0.05).cast("int")) > 19)
    t = batches(t, "tissue", 16).select("tile_id", "batch_idx", "values")
    return serving.dispatch(t, halving_model, "generated_images").select("tile_id", "batch_idx", F.col("generated_images")[0].alias("first"))


@query("growth_pyramid", "SELECT vec_id AS tile_id, g::INTEGER AS growth, (4 * (1 << ((g + 1) // 2)))::INTEGER AS resolution FROM embeddings, (SELECT unnest([0, 3, 6]) AS g)")
def growth_pyramid(spark, d):
    return serving.pyramid(D.tiles(spark, d).select("tile_id"), 32, [0, 3, 6, 99])


@query("pyramid_images", f"""WITH {D.PIXELS} SELECT 0 AS level, tile_id, y // 2 AS y, x // 2 AS x, round(avg(v), 8) AS v FROM pixels GROUP BY ALL UNION ALL SELECT 1, tile_id, y, x, round(v, 8) FROM pixels""")
def pyramid_images(spark, d):
    made = serving.pyramid_images(D.pixels(spark, d).select("tile_id", "y", "x", "v"), D.SIDE, 32, [0, 1, 99])
    return made.withColumn("v", F.round("v", 8))


@query("masked_image", f"WITH {D.PIXELS} SELECT tile_id, y, x, CASE WHEN (y BETWEEN 1 AND 3 AND x BETWEEN 1 AND 3) <> (y BETWEEN 3 AND 5 AND x BETWEEN 3 AND 5) THEN -1.0 ELSE v END AS v FROM pixels")
def masked_image(spark, d):
    p = D.pixels(spark, d).select("tile_id", "y", "x", "v")
    rects = D.tiles(spark, d).select("tile_id", F.explode(F.array(F.lit(1), F.lit(3))).alias("y0")).select("tile_id", "y0", F.col("y0").alias("x0"), F.lit(3).alias("h"), F.lit(3).alias("w"))
    return scoring.masked_images(p, rects).select("tile_id", "y", "x", "v")


@query("channel_mean", "SELECT vec_id AS tile_id, round((embedding[1]::DOUBLE + embedding[2]::DOUBLE + embedding[3]::DOUBLE) / 3.0, 8) AS gray FROM embeddings")
def channel_mean(spark, d):
    t = D.tiles(spark, d).select("tile_id", *[F.col("values")[k].alias(c) for k, c in enumerate("rgb")])
    return t.select("tile_id", F.round(serving.gray("r", "g", "b"), 8).alias("gray"))


@query("nan_guard", "SELECT event_id, event_id % 7 = 0 OR event_id % 11 = 0 AS bad FROM events")
def nan_guard(spark, d):
    nan = F.lit(float("nan"))
    e = D.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, nan).otherwise(F.col("value")).alias("a"), F.when(F.col("event_id") % 11 == 0, nan).otherwise(F.lit(1.0)).alias("b"))
    return e.select("event_id", serving.any_nan("a", "b").alias("bad"))


@query("class_filter_padded", f"WITH {D.PIXELS} SELECT tile_id, y + 2 AS y, x + 2 AS x, v FROM pixels WHERE label = 1")
def class_filter_padded(spark, d):
    return serving.padded(D.pixels(spark, d).where("label = 1").select("tile_id", "y", "x", "v"), 2)


@query("repeat_epochs", "SELECT vec_id, e::INTEGER AS epoch FROM embeddings, (SELECT unnest([0, 1, 2]) AS e)")
def repeat_epochs(spark, d):
    return serving.epochs(D.table(spark, d, "embeddings").select("vec_id"), 3)


@query("role_split", "WITH a AS (SELECT vec_id, ('0x' || substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT % 10 AS k FROM embeddings) SELECT vec_id, CASE WHEN k < 6 THEN 'reconstruct' WHEN k < 8 THEN 'fit' ELSE 'threshold' END AS role FROM a")
def role_split(spark, d):
    return serving.split(D.table(spark, d, "embeddings").select("vec_id"), "vec_id", {"reconstruct": 6, "fit": 2, "threshold": 2})


@query("shuffled_take", f"SELECT vec_id, label FROM embeddings ORDER BY {D.digest_unit('order-1', 'vec_id')}, vec_id LIMIT 64")
def shuffled_take(spark, d):
    return serving.shuffled(D.table(spark, d, "embeddings").select("vec_id", "label"), "vec_id").limit(64)


@query("random_rectangle_masks", f"""
WITH {D.PIXELS}, b AS (SELECT * FROM (VALUES (0, 2, 4), (1, 2, 2), (2, 1, 2), (3, 1, 1), (4, 1, 1)) AS t(block, h, w)),
r AS (SELECT tile_id, h, w, floor({D.digest_unit('y-1', 'tile_id', 'block')} * (9 - h))::INTEGER AS y0, floor({D.digest_unit('x-1', 'tile_id', 'block')} * (9 - w))::INTEGER AS x0 FROM tiles, b)
SELECT p.tile_id, p.y, p.x, count(r.h)::BIGINT AS covers, count(r.h) = 1 AS masked FROM pixels p LEFT JOIN r ON r.tile_id = p.tile_id AND p.y BETWEEN r.y0 AND r.y0 + r.h - 1 AND p.x BETWEEN r.x0 AND r.x0 + r.w - 1 GROUP BY p.tile_id, p.y, p.x""")
def random_rectangle_masks(spark, d):
    rects = serving.random_rectangles(D.tiles(spark, d), D.SIDE, scoring.mask_blocks(16))
    return scoring.rectangle_mask(D.pixels(spark, d).select("tile_id", "y", "x", "v"), rects).select("tile_id", "y", "x", "covers", "masked")


def _normal(k: int) -> str:
    return f"round(sqrt(-2.0 * ln(1.0 - {D.digest_unit(f'length-1-{k}', 'vec_id')})) * cos(2.0 * pi() * {D.digest_unit(f'turn-1-{k}', 'vec_id')}) * 0.5 + 1.0, 8) AS z{k}"


@query("latent_samples", f"SELECT vec_id AS tile_id, {', '.join(map(_normal, range(4)))} FROM embeddings")
def latent_samples(spark, d):
    z = serving.latent(D.tiles(spark, d).select("tile_id"), "tile_id", 4, 1.0, 0.5)
    return z.select("tile_id", *[F.round(F.col("z")[k], 8).alias(f"z{k}") for k in range(4)])


@query("uniform_noise", f"WITH {D.PIXELS} SELECT tile_id, y, x, round(v + {D.digest_unit('noise-1', 'tile_id', 'y', 'x')}, 9) AS v FROM pixels")
def uniform_noise(spark, d):
    return serving.noisy(D.pixels(spark, d), ["tile_id", "y", "x"]).select("tile_id", "y", "x", F.round("v", 9).alias("v"))


@query("map_union", "SELECT event_id, value AS a, (event_id * 2)::DOUBLE AS b, value + 1.0 AS c FROM events")
def map_union(spark, d):
    e = D.table(spark, d, "events").select("event_id", F.create_map(F.lit("a"), F.col("value"), F.lit("b"), F.lit(0.0)).alias("l"), F.create_map(F.lit("b"), (F.col("event_id") * 2).cast("double"), F.lit("c"), F.col("value") + 1.0).alias("r"))
    m = e.select("event_id", serving.merged_maps("l", "r").alias("m"))
    return m.select("event_id", *[F.col("m")[k].alias(k) for k in "abc"])


@query("output_sets", "SELECT DISTINCT event_type FROM events WHERE value > 100 INTERSECT SELECT DISTINCT event_type FROM events WHERE value < 50")
def output_sets(spark, d):
    e = D.table(spark, d, "events")
    return e.where("value > 100").select("event_type").intersect(e.where("value < 50").select("event_type"))


@query("confusion_csv", f"WITH {D.PREDICTIONS}, t AS (SELECT (1000 * k)::BIGINT AS threshold FROM (SELECT unnest(range(0, 4)) AS k)) SELECT concat('slide,', threshold, ',', count(*) FILTER (score > threshold AND truth = 1), ',', count(*) FILTER (score > threshold AND truth <> 1), ',', count(*) FILTER (score <= threshold AND truth = 1), ',', count(*) FILTER (score <= threshold AND truth <> 1)) AS line FROM pred, t GROUP BY threshold")
def confusion_csv(spark, d):
    c = scoring.confusion_at(D.predictions(spark, d), spark.range(4).select((F.col("id") * 1000).alias("threshold")), "score", "truth")
    return coordinates.confusion_lines(c.withColumn("filename", F.lit("slide")))


@query("area_confusion", f"""WITH {D.BOXES}, c AS (SELECT event_type, bool_or(event_id % 2 = 0) AS p, bool_or(event_id % 2 = 1) AS t FROM (SELECT event_type, event_id, y0, y1, unnest(range(x0, x1)) AS x FROM boxes), LATERAL (SELECT unnest(range(y0, y1)) AS y) GROUP BY event_type, x, y),
s AS (SELECT event_type, (max(x1) - min(x0)) * (max(y1) - min(y0)) AS slide FROM boxes GROUP BY event_type)
SELECT event_type, count(*) FILTER (p AND t)::DOUBLE AS tp, count(*) FILTER (p AND NOT t)::DOUBLE AS fp, count(*) FILTER (t AND NOT p)::DOUBLE AS fn, (any_value(slide) - count(*))::DOUBLE AS tn FROM c JOIN s USING (event_type) GROUP BY event_type""")
def area_confusion(spark, d):
    """Areas of boxes of even ids against those of odd ones within the rectangle around all of a type."""
    b = D.boxes(spark, d)
    rings = b.select("event_type", (F.col("event_id") % 2 == 1).alias("annotated"), F.col("event_id").alias("polygon_id"), G.rectangle("x0", "y0", "x1", "y1").alias("ring"))
    slide = b.groupBy("event_type").agg(((F.max("x1") - F.min("x0")) * (F.max("y1") - F.min("y0"))).cast("double").alias("slide"))
    found = scoring.area_confusion(spatial.region_areas(rings, "event_type", 64.0).join(slide, "event_type"), "common", "predicted", "annotated", "slide")
    return found.select("event_type", *[F.round(c, 4).alias(c) for c in ("tp", "fp", "fn", "tn")])
