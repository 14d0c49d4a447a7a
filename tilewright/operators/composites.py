"""From flagged pixels of whole slides to polygons: the steps of the other modules in their order.

Only pixels that are not 0 are worked on; a slide's pixels, contours and outlines stay dealt to
tiles and grid cells in every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import settled
from . import outlines, slides
from .morphology import square


def grown(flags: DataFrame, size: int, by: list[str], height: str = "height", width: str = "width") -> DataFrame:
    """by, Y, X, height, width within reach of a flagged pixel, one axis after the other; flags carry their slide's height and width."""
    before, after = square(size)
    reach = lambda c, n: F.explode(F.sequence(F.greatest(F.col(c) - after, F.lit(0)), F.least(F.col(c) + before, F.col(n) - 1)))
    ends = [F.col(height).cast("long").alias("height"), F.col(width).cast("long").alias("width")]
    rows = flags.select(*by, F.col("Y").cast("long").alias("Y"), F.col("X").cast("long").alias("X"), *ends)
    for c, n in (("Y", "height"), ("X", "width")):
        rows = rows.withColumn(c, reach(c, n)).distinct()
    return rows


def sparse_mean(flags: DataFrame, size: int, by: list[str]) -> DataFrame:
    """by, Y, X, v: share of flagged pixels in the square around each pixel, where it isn't 0; squares end at the slide's borders."""
    before, after = square(size)
    rows = flags.select(*by, "Y", "X", "height", "width", F.lit(1).cast("long").alias("n"))
    many = F.lit(1.0)
    for c, n in (("Y", "height"), ("X", "width")):
        seen = F.explode(F.sequence(F.greatest(F.col(c) - after, F.lit(0)), F.least(F.col(c) + before, F.col(n) - 1)))
        rows = rows.withColumn(c, seen).groupBy(*by, "Y", "X", "height", "width").agg(F.sum("n").alias("n"))
        many = many * (F.least(F.col(c) + after, F.col(n) - 1) - F.greatest(F.col(c) - before, F.lit(0)) + 1)
    return rows.select(*by, "Y", "X", (F.col("n") / many).alias("v"))


def _keyed(rings: DataFrame, by: list[str], number: str) -> DataFrame:
    """`key`, one text for a slide and a ring's number; the texts of different ones differ."""
    return rings.withColumn("key", F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], F.col(number).cast("string"))))


def largest(rings: DataFrame, by: list[str], least: float, q: float) -> DataFrame:
    """Rings of at least the q-quantile, rounded half to even, of their slide's areas above `least`; none where no area is above it."""
    cut = rings.where(F.col("area") > least).groupBy(*by).agg(F.bround(F.percentile("area", q)).alias("_cut"))
    return rings.join(cut, by).where(F.col("area") >= F.col("_cut")).drop("_cut")


def anomaly_outlines(
    flags: DataFrame, by: list[str], tile: int = 512, cell: float = 256.0, grow: int = 4, blur: int = 8, level: float = 0.9, least_area: float = 200.0, share: float = 0.9,
    smooth: float = 10.0, sizes: tuple[float, float] = (0.0, 0.0), factor: float = 1.0,
) -> DataFrame:
    """by, ring_id, min_dim, max_dim, area, ring of the anomalies of every slide, at the slide's full scale.

    flags: by, Y, X, height, width of flagged pixels. They are grown and blurred; contours at
    `level` are turned by -90 degrees and those under a quantile of the areas go; each that is
    left loses what other ones that it shares a point with cover, is measured by its least rotated
    rectangle, smoothed by growing and shrinking, kept if it is as large as `sizes` (pixels; 0:
    any) and scaled by `factor`. An anomaly in several rings, its holes among them, has several rows; min_dim
    and max_dim are before smoothing and scaling, area is all its rings' at full scale. A slide
    without flags, or without a ring above `least_area`, has no row.
    """
    blurred = sparse_mean(grown(flags, grow, by), blur, by)
    rings = largest(slides.contours(blurred, level, tile, by, pad=0.0), by, least_area, share)
    rings = settled(_keyed(rings.withColumn("ring", G.quarter_turn("ring")), by, "ring_id").select(*by, "ring_id", "key", "ring"))
    pairs = outlines.meeting(rings, rings, "ring_id", cell, by).where("l <> r").select(*by, F.col("l").alias("ring_id"), F.col("r").alias("_other"))
    others = rings.select(*by, F.col("ring_id").alias("_other"), F.col("ring").alias("_ring"))
    own = rings.select("key", F.lit(False).alias("annotated"), F.col("ring_id").alias("polygon_id"), "ring")
    cover = pairs.join(rings.select(*by, "ring_id", "key"), [*by, "ring_id"]).join(others, [*by, "_other"]).select("key", F.lit(True), "_other", "_ring")
    left = settled(outlines.dissolved(own.union(cover), "key", cell, "difference"))
    points = left.where(G.signed_area("ring") > 0).groupBy("key").agg(F.flatten(F.collect_list("ring")).alias("_p"))
    sized = points.select("key", G.rotated_dimensions("_p").alias("_m")).select("key", "_m.min_dim", "_m.max_dim")
    kept = settled(sized.where((F.col("min_dim") >= min(sizes)) & (F.col("max_dim") >= max(sizes))))
    shapes = left.join(kept.select("key"), "key", "left_semi")
    shapes = outlines.closed(shapes, "key", smooth, cell) if smooth else shapes
    full = shapes.withColumn("ring", G.scale("ring", factor, factor))
    areas = settled(full.withColumn("_a", G.signed_area("ring")))
    whole = areas.groupBy("key").agg(F.sum("_a").alias("area"))
    return areas.drop("_a").join(kept, "key").join(whole, "key").join(rings.select("key", *by, "ring_id"), "key").select(*by, "ring_id", "min_dim", "max_dim", "area", "ring")


def prediction_outlines(
    pixels: DataFrame, by: str, threshold: float, factor: float = 1.0, about: str = "center", patches: DataFrame | None = None, tile: int = 512, cell: float = 256.0, v: str = "v",
) -> DataFrame:
    """by, ring: the outlines of predictions above a threshold, each scaled, clipped to its image, united and met with patches.

    pixels: by, Y, X, v, height, width. Predictions are the outer outlines of pixels above the
    threshold, what they enclose included. about: "center" of the box around an outline or its
    "centroid". patches: by, ring; of an image without patches nothing is left. Points are held
    within 0 and width, 0 and height. Outer rings run counter-clockwise, holes clockwise.
    """
    ends = pixels.groupBy(by).agg(F.max("width").alias("_w"), F.max("height").alias("_h"))
    mask = pixels.where(F.col(v) > threshold).select(by, "Y", "X", F.lit(1.0).alias("v"))
    outer = slides.contours(mask, 0.5, tile, [by], pad=0.0).where("not is_hole")
    named = lambda rows, number: rows.select(by, F.lit(False).alias("annotated"), number.cast("long").alias("polygon_id"), "ring")
    whole = outlines.dissolved(named(outer, F.col("ring_id")), by, cell).where(G.signed_area("ring") > 0)
    b = G.bounds("ring")
    centre = G.centroid("ring") if about == "centroid" else F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))
    moved = whole.withColumn("_c", centre).withColumn("ring", G.scale("ring", factor, factor, "_c.x", "_c.y")).join(ends, by)
    held = named(moved.withColumn("ring", G.clip("ring", F.lit(0.0), F.lit(0.0), F.col("_w").cast("double"), F.col("_h").cast("double"))), F.monotonically_increasing_id())
    if patches is None:
        return outlines.dissolved(held, by, cell)
    beside = patches.select(by, F.lit(True), F.monotonically_increasing_id(), "ring")
    return outlines.dissolved(settled(held.union(beside)), by, cell, "intersection")
