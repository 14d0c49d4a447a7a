"""Components and contours of whole slides: rasters (by, Y, X, ...) that no task holds.

A slide is cut into tiles. What lies within a tile is found there; what crosses a seam meets
its other side by equality joins, and only pieces of components and contours that touch a seam
are linked across the slide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import signed_area
from ..session import settled
from . import graph
from .morphology import label_image, steps

#: Places are Y * 2**32 + X.
SHIFT = 32
POINTS = "array<struct<x: double, y: double>>"


def place(y="Y", x="X") -> Column:
    y, x = (F.col(c) if isinstance(c, str) else c for c in (y, x))
    return F.shiftleft(y.cast("long"), SHIFT) + x.cast("long")


def _kinds(rows: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in columns)


def _own(key: tuple, names: list[str], n: int) -> dict[str, pa.Array]:
    return {name: pa.array([value.as_py()] * n, value.type) for name, value in zip(names, key)}


def components(flags: DataFrame, tile: int, by: list[str] = [], corners: bool = True) -> DataFrame:
    """by, Y, X, label: the place of the first pixel, by row and column, of each flagged pixel's component.

    Components are 8-connected or, without corners, 4-connected. flags: by, Y, X of flagged pixels.
    """
    dealt = flags.select(*by, F.floor(F.col("Y") / tile).alias("ty"), F.floor(F.col("X") / tile).alias("tx"), F.col("Y").cast("long").alias("Y"), F.col("X").cast("long").alias("X"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        y, x = table["Y"].to_numpy(), table["X"].to_numpy()
        _, at = np.unique(label_image(y, x, corners), return_inverse=True)
        first = np.full(at.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, at, (y << SHIFT) + x)
        return pa.table({**_own(key, by, len(y)), "Y": y, "X": x, "label": first[at]})

    own = dealt.groupBy(*by, "ty", "tx").applyInArrow(run, f"{_kinds(flags, by)}Y long, X long, label long")
    near = [(0, 1), (1, 0)] + [(1, 1), (1, -1)] * corners
    ways = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in near]))
    here, there = [F.floor(F.col(c) / tile) for c in ("Y", "X")], [F.floor((F.col(c) + F.col(f"w.d{c.lower()}")) / tile) for c in ("Y", "X")]
    last = (F.pmod(F.col("Y"), F.lit(tile)) == tile - 1) | F.pmod(F.col("X"), F.lit(tile)).isin(0, tile - 1)
    asked = own.where(last).select("*", ways.alias("w")).where((here[0] != there[0]) | (here[1] != there[1]))
    asked = asked.select(*by, F.col("label").alias("a"), (F.col("Y") + F.col("w.dy")).alias("Y"), (F.col("X") + F.col("w.dx")).alias("X"))
    seam = F.pmod(F.col("Y"), F.lit(tile)).isin(0, tile - 1) | F.pmod(F.col("X"), F.lit(tile)).isin(0, tile - 1)
    edges = asked.join(own.where(seam).select(*by, "Y", "X", F.col("label").alias("b")), [*by, "Y", "X"]).select(*by, "a", "b")
    roots = graph.components(edges, by).withColumnRenamed("id", "label")
    return own.join(roots, [*by, "label"], "left").select(*by, "Y", "X", F.coalesce("component", "label").alias("label"))


def _chains(nxt: dict) -> list[tuple]:
    """(first crossing, crossing after the last, least crossing, a high pixel beside it, points) of lines that begin or end at the tile's border, and of closed ones."""
    ends = {end for end, _, _ in nxt.values()}
    begins = [k for k in nxt if k not in ends]
    out = []
    while nxt:
        first = at = begins.pop() if begins else next(iter(nxt))
        least, pixel, points = None, None, []
        while at in nxt:
            end, point, high = nxt.pop(at)
            if least is None or at < least:
                least, pixel = at, high
            points.append(point)
            at = end
        out.append((first, at, least, pixel, points))
    return out


def contour_parts(pixels: DataFrame, level: float, tile: int, by: list[str] = [], v: str = "v", pad: float | None = None) -> DataFrame:
    """by, first, last, least (crossings), y, x (a pixel above the level beside the least one), points: lines within tiles, closed where first is last.

    A tile has `tile` by `tile` cells, each between four pixels; a pixel is dealt to the up to
    four tiles whose cells it is a corner of. Absent pixels, and those around the slide, have the
    value `pad`, by default 1 below the level.
    """
    low = level - 1.0 if pad is None else pad
    over = lambda c: F.explode(F.array_distinct(F.array(F.floor((F.col(c) - 1) / tile), F.floor(F.col(c) / tile))))
    dealt = pixels.select(*by, F.col("Y").cast("long").alias("Y"), F.col("X").cast("long").alias("X"), F.col(v).cast("double").alias("v")).withColumn("ty", over("Y")).withColumn("tx", over("X"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        y0, x0 = (k.as_py() * tile for k in key[-2:])
        image = np.full((tile + 1, tile + 1), low)
        image[table["Y"].to_numpy() - y0, table["X"].to_numpy() - x0] = table["v"].to_numpy()
        code = lambda c: ((y0 + c[0] + 1) << SHIFT) + ((x0 + c[1] + 1) << 1) + c[2]  # noqa: E731  crossings of the frame around the slide count from 0
        rows = [(code(f), code(e), code(m), y0 + p[0], x0 + p[1], [{"x": x0 + x, "y": y0 + y} for y, x in points]) for f, e, m, p, points in _chains(steps(image, level))]
        kinds = [pa.int64()] * 5 + [pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))]
        columns = list(zip(*rows)) or [()] * 6
        return pa.table({**_own(key, by, len(rows)), **{n: pa.array(c, k) for n, c, k in zip(("first", "last", "least", "y", "x", "points"), columns, kinds)}})

    return dealt.groupBy(*by, "ty", "tx").applyInArrow(run, f"{_kinds(pixels, by)}first long, last long, least long, y long, x long, points {POINTS}")


def contours(pixels: DataFrame, level: float, tile: int, by: list[str] = [], v: str = "v", pad: float | None = None) -> DataFrame:
    """by, ring_id, parent, is_hole, area, label, ring (closed; x = column, y = row) of every contour of a slide.

    ring_id is the least crossing on the ring, and so the same for any size of tile. label is the
    component of pixels above the level (4-connected) that the ring bounds; a hole's parent is the
    outer ring of that component. Outer rings and holes are told apart by their turn.
    """
    parts = settled(contour_parts(pixels, level, tile, by, v, pad))
    open_ = parts.where("first <> last")
    linked = graph.rings(open_.select(*by, F.col("first").alias("id"), F.col("last").alias("next")), by)
    joined = open_.join(linked.withColumnRenamed("id", "first"), [*by, "first"])
    least = F.struct("least", "y", "x")
    whole = joined.groupBy(*by, "ring").agg(F.min(least).alias("m"), F.flatten(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), "points"))), lambda p: p["points"])).alias("points"))
    closed = parts.where("first = last").select(*by, least.alias("m"), "points")
    rows = whole.select(*by, "m", "points").union(closed)
    rows = rows.select(*by, F.col("m.least").alias("ring_id"), F.col("m.y").alias("Y"), F.col("m.x").alias("X"), F.concat("points", F.slice("points", 1, 1)).alias("ring"))
    labels = components(pixels.where(F.col(v) >= level).select(*by, "Y", "X"), tile, by, corners=False)
    rows = settled(rows.join(labels, [*by, "Y", "X"]).withColumn("signed", signed_area("ring")).drop("Y", "X"))
    outer = rows.where("signed <= 0").groupBy(*by, "label").agg(F.min("ring_id").alias("outer"))
    out = rows.join(outer, [*by, "label"], "left")
    hole = F.col("signed") > 0
    return out.select(*by, "ring_id", F.when(hole, F.col("outer")).alias("parent"), hole.alias("is_hole"), F.abs("signed").alias("area"), "label", "ring")


def enclosed(labels: DataFrame, by: list[str] = []) -> DataFrame:
    """by, label, size, cy, cx: pixels and centroid (whole pixels, cut off) of every component."""
    return labels.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("size"), F.floor(F.avg("Y")).cast("long").alias("cy"), F.floor(F.avg("X")).cast("long").alias("cx"))
