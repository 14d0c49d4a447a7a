"""Neighbourhood operators, components and contours of rasters (tile_id, y, x, ...)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BY = ["tile_id"]


def neighbourhood(pixels: DataFrame, up: int, down: int, left: int, right: int) -> DataFrame:
    """A row for each pixel at every place that sees it: places y - down .. y + up and so on."""
    return pixels.withColumn("y", F.explode(F.sequence(F.col("y") - down, F.col("y") + up))).withColumn("x", F.explode(F.sequence(F.col("x") - right, F.col("x") + left)))


def square(size: int) -> tuple[int, int]:
    """How far a square reaches before and after its centre; an even one reaches further before."""
    return size // 2, (size - 1) // 2


def dilate(flags: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """(tile_id, y, x) within reach of a flagged pixel, given flagged pixels only."""
    before, after = square(size)
    reach = lambda c, n: F.explode(F.sequence(F.greatest(F.col(c) - after, F.lit(0)), F.least(F.col(c) + before, F.lit(n - 1))))
    tall = flags.select(*BY, reach("y", height).alias("y"), "x").distinct()  # one axis after the other: 2 * size rows a pixel, not size * size
    return tall.select(*BY, "y", reach("x", width).alias("x")).distinct()


def swept(pixels: DataFrame, v: str, thresholds: list[float], sizes: list[int], height: int, width: int) -> DataFrame:
    """(threshold, size, tile_id, y, x): pixels above each threshold, dilated by each size; both lists are short parameters."""
    rows = pixels.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))).where(F.col(v) > F.col("threshold"))
    rows = rows.select("threshold", F.explode(F.array(*[F.lit(k) for k in sizes])).alias("size"), *BY, "y", "x")
    reach = lambda c: F.explode(F.expr(f"sequence(cast({c} - (size - 1) div 2 as int), cast({c} + size div 2 as int))"))
    grown = rows.withColumn("y", reach("y")).withColumn("x", reach("x"))
    return grown.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)).distinct()


def erode(flags: DataFrame, size: int, height: int, width: int, mirrored: bool = False) -> DataFrame:
    """(tile_id, y, x) whose whole neighbourhood within the image is flagged; mirrored: of an even square, the other way round."""
    before, after = square(size)[::-1] if mirrored else square(size)
    seen = neighbourhood(flags.select(*BY, "y", "x"), before, after, before, after).groupBy(*BY, "y", "x").agg(F.count(F.lit(1)).alias("n"))
    inside = lambda c, n: F.least(F.col(c) + after, F.lit(n - 1)) - F.greatest(F.col(c) - before, F.lit(0)) + 1
    whole = seen.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1) & (F.col("n") == inside("y", height) * inside("x", width)))
    return whole.select(*BY, "y", "x").join(flags.select(*BY, "y", "x"), [*BY, "y", "x"], "left_semi")


def close(flags: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """Dilation, then erosion: what growing and shrinking a polygon outline approximates."""
    return erode(dilate(flags, size, height, width), size, height, width, mirrored=True)


def box_mean(pixels: DataFrame, size: int, v: str = "v") -> DataFrame:
    """Mean over the square around each pixel of a dense raster, truncated at borders: rows, then columns."""
    before, after = square(size)
    across = Window.partitionBy(*BY, "y").orderBy("x").rowsBetween(-before, after)
    down = Window.partitionBy(*BY, "x").orderBy("y").rowsBetween(-before, after)
    part = pixels.withColumns({"_s": F.sum(v).over(across), "_n": F.count(F.lit(1)).over(across)})
    return part.withColumn(v, F.sum("_s").over(down) / F.sum("_n").over(down)).drop("_s", "_n")


def median(pixels: DataFrame, size: int, height: int, width: int, v: str = "v") -> DataFrame:
    """Median over the square around each pixel, truncated at borders."""
    before, after = square(size)
    seen = neighbourhood(pixels, before, after, before, after)
    return seen.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)).groupBy(*BY, "y", "x").agg(F.percentile(v, 0.5).alias(v))


def overlay(image: DataFrame, marks: DataFrame, green: str = "g", full: int = 255) -> DataFrame:
    """The image with green at its full value where a mark (y, x) is, and marked: whether there is one."""
    found = marks.select(*BY, "y", "x").distinct().withColumn("marked", F.lit(True))
    rows = image.join(found, [*BY, "y", "x"], "left").withColumn("marked", F.coalesce("marked", F.lit(False)))
    return rows.withColumn(green, F.when(F.col("marked"), F.greatest(F.col(green), F.lit(full))).otherwise(F.col(green)))


def edges(labels: DataFrame) -> DataFrame:
    """Pixels with a 4-neighbour of another label, or none."""
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    asked = labels.select(*BY, "y", "x", "label", near.alias("d")).select(*BY, F.col("y").alias("oy"), F.col("x").alias("ox"), "label", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"))
    other = labels.select(*BY, "y", "x", F.col("label").alias("other"))
    hit = asked.join(other, [*BY, "y", "x"], "left").where(F.col("other").isNull() | (F.col("other") != F.col("label")))
    return hit.select(*BY, F.col("oy").alias("y"), F.col("ox").alias("x"), "label").distinct()


def label_image(y: np.ndarray, x: np.ndarray, corners: bool = True) -> np.ndarray:
    """Of flagged pixels the least place of their component, 8-connected or, without corners, 4-connected; union by runs of a row."""
    reach = 1 if corners else 0
    order = np.lexsort((x, y))
    ys, xs = y[order], x[order]
    new = np.ones(len(ys), dtype=bool)
    new[1:] = (ys[1:] != ys[:-1]) | (xs[1:] != xs[:-1] + 1)
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ys)) - 1
    root = np.arange(len(first))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    a, b = 0, 0
    for b in range(len(first)):
        while a < b and (ys[first[a]] < ys[first[b]] - 1 or (ys[first[a]] == ys[first[b]] - 1 and xs[last[a]] < xs[first[b]] - reach)):
            a += 1
        k = a
        while k < b and ys[first[k]] == ys[first[b]] - 1 and xs[first[k]] <= xs[last[b]] + reach:
            i, j = find(k), find(b)
            root[max(i, j)] = min(i, j)
            k += 1
    out = np.empty(len(ys), dtype=np.int64)
    out[order] = np.array([find(k) for k in range(len(first))], dtype=np.int64)[run] if len(first) else run
    return out


def _images(rows: DataFrame, *columns: str) -> DataFrame:
    """One row for each image with its pixels as arrays in equal order; an image's size is bounded."""
    gathered = rows.groupBy(*BY).agg(F.collect_list(F.struct(*columns)).alias("_p"))
    return gathered.select(*BY, *[F.col(f"_p.{c}").alias(c) for c in columns])


def components(flags: DataFrame) -> DataFrame:
    """tile_id, y, x, label of flagged pixels; labels count from 0 in order of a component's first pixel."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for tile, y, x in zip(pdf["tile_id"], pdf["y"], pdf["x"]):
                label = np.unique(label_image(np.asarray(y), np.asarray(x)), return_inverse=True)[1]
                out.append(pd.DataFrame({"tile_id": tile, "y": y, "x": x, "label": label}))
            if out:
                yield pd.concat(out)

    schema = flags.select(*BY, "y", "x").withColumn("label", F.lit(0).cast("bigint")).schema
    return _images(flags, "y", "x").mapInPandas(run, schema)


def component_centres(labels: DataFrame) -> DataFrame:
    """size and centroid (whole pixels, cut off) of every component."""
    return labels.groupBy(*BY, "label").agg(F.count(F.lit(1)).alias("size"), F.floor(F.avg("y")).cast("bigint").alias("cy"), F.floor(F.avg("x")).cast("bigint").alias("cx"))


#: Where a contour crosses the side between two pixels: row and column of the first, and whether the second is below it.
Crossing = tuple[int, int, int]


def steps(v: np.ndarray, level: float) -> dict[Crossing, tuple[Crossing, tuple[float, float], tuple[int, int]]]:
    """By marching squares, for each crossing where a line enters a cell: where it leaves, the point of entry, and a pixel above the level beside it.

    Each 2 by 2 cell gives at most two segments between points interpolated on its sides, with
    higher values on the left; of a saddle, high corners stay apart.
    """
    out = {}
    up = v >= level
    mixed = up[:-1, :-1].astype(int) + up[:-1, 1:] + up[1:, :-1] + up[1:, 1:]

    def side(a: tuple[int, int], b: tuple[int, int]) -> Crossing:
        a, b = sorted((a, b))
        return (*a, b[0] - a[0])

    for r, c in zip(*(x.tolist() for x in np.nonzero((mixed > 0) & (mixed < 4)))):
        corner = [(r, c), (r, c + 1), (r + 1, c + 1), (r + 1, c)]
        high = [bool(up[p]) for p in corner]
        # Going round the cell, the line enters where low turns to high and leaves where high turns to low next.
        for k in range(4):
            if not high[k - 1] and high[k]:
                j = k
                while high[(j + 1) % 4]:
                    j += 1
                a, b = sorted((corner[k - 1], corner[k]))
                t = (level - v[a]) / (v[b] - v[a])
                point = (float(a[0] + t * (b[0] - a[0])), float(a[1] + t * (b[1] - a[1])))
                out[side(a, b)] = (side(corner[j % 4], corner[(j + 1) % 4]), point, corner[k])
    return out


def trace(values: np.ndarray, level: float) -> list[np.ndarray]:
    """Closed rings (row, column) at a level over the image padded below it: segments linked end to start."""
    low = min(float(values.min()) if values.size else 0.0, level) - 1.0
    nxt = steps(np.pad(values.astype(float), 1, constant_values=low), level)
    rings = []
    while nxt:
        at = next(iter(nxt))
        ring = []
        while at in nxt:
            at, (y, x), _ = nxt.pop(at)
            ring.append((y - 1, x - 1))
        rings.append(np.array(ring + ring[:1]))
    return rings


def contours(pixels: DataFrame, level: float, v: str = "v") -> DataFrame:
    """tile_id, ring_id, is_hole, area, ring (x = column, y = row) of every image."""
    names = ["tile_id", "ring_id", "is_hole", "area", "ring"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for tile, y, x, value in zip(*(pdf[c] for c in ("tile_id", "y", "x", "v"))):
                y, x = np.asarray(y), np.asarray(x)
                image = np.full((int(y.max()) + 1, int(x.max()) + 1), min(level, float(np.min(value))) - 1.0)
                image[y, x] = value
                for k, ring in enumerate(trace(image, level)):
                    px, py = ring[:, 1], ring[:, 0]
                    signed = float((px[:-1] * py[1:] - px[1:] * py[:-1]).sum() / 2)
                    rows.append((tile, k, signed > 0, abs(signed), [{"x": float(a), "y": float(b)} for a, b in zip(px, py)]))
            yield pd.DataFrame(rows, columns=names)

    gathered = _images(pixels.select(*BY, "y", "x", F.col(v).alias("v")), "y", "x", "v")
    return gathered.mapInPandas(run, "tile_id long, ring_id int, is_hole boolean, area double, ring array<struct<x double, y double>>")


def run_flags(pixels: DataFrame, on: Column) -> DataFrame:
    return pixels.where(on).select(*BY, "y", "x")
