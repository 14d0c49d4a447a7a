"""Scoring tiles with a supplied model, dispatch of batches, sampling of datasets and training-side inputs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import digest_unit
from ..sources import png
from .tiles import bilinear

#: What can be stitched.
OUTPUTS = ("query_images", "generated_images", "query_anomaly_images_sigmoid", "query_anomaly_images_linear", "query_mahalanobis_distance_images_sigmoid", "query_mahalanobis_distance_images_linear", "query_pixel_anomaly_flag_images")


def score(tiles: DataFrame, load: Callable[[], Callable[[np.ndarray], dict[str, np.ndarray]]], outputs: list[str], column: str = "values") -> DataFrame:
    """`tiles` with an array column for each output of a model over stacked arrays; the model is loaded once for each task.

    Rows that need no model should be filtered out before: a filter isn't moved across Python code.
    """
    schema = T.StructType([*tiles.schema, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in outputs]])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for pdf in parts:
            model = model or load()
            made = model(np.stack([np.asarray(v, dtype=float) for v in pdf[column]])) if len(pdf) else {}
            yield pdf.assign(**{n: list(np.asarray(made[n], dtype=float).reshape(len(pdf), -1)) for n in outputs} if len(pdf) else {n: [] for n in outputs})

    return tiles.mapInPandas(run, schema)


def flipped(column: str, height: int) -> Column:
    """An image's flat array with its rows in reverse."""
    width = (F.size(column) / height).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(height - 1), F.lit(0)), lambda y: F.slice(column, y * width + 1, width)))


def score_files(spark: SparkSession, path: str, load, outputs: list[str], height: int, width: int, flip: tuple[str, ...] = ()) -> DataFrame:
    """path, x, y and `outputs` of a model over PNG files, each resized to height and width by nearest neighbour; those in `flip` are turned upside down.

    x and y come from names that end in two numbers, such as tile_3_4.png (null otherwise). The model gets
    height * width * channels numbers a row; files are read and scored where they are, without a shuffle.
    """

    def images(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for name, content in zip(pdf["path"], pdf["content"]):
                image = png.decode(bytes(content))
                h, w, _ = image.shape
                small = image[np.arange(height) * h // height][:, np.arange(width) * w // width]
                yield pd.DataFrame({"path": [name], "values": [small.astype(float).ravel()]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(path).select("path", "content")
    made = score(files.mapInPandas(images, "path string, values array<double>"), load, outputs)
    made = made.withColumns({n: flipped(n, height) for n in outputs if n in flip})
    place = lambda k: F.regexp_extract("path", r"(\d+)_(\d+)\.png$", k)
    return made.select("path", *[F.when(place(k) != "", place(k).cast("long")).alias(n) for k, n in ((1, "x"), (2, "y"))], *outputs)


def keyed_cells(rings: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """x, y, cells: for each tile a map from its place, as text "(x, y)", to its cells' outlines and centroids in order of ring_id.

    rings: x, y, ring_id, ring (closed) of the tiles' cells, holes left out before; a tile without cells has no row.
    """
    from ..functions.geometry import centroid

    points = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    c = centroid("ring")
    cell = F.struct("ring_id", F.struct(points.alias("exterior"), F.array(c["x"], c["y"]).alias("centroid")).alias("cell"))
    own = rings.groupBy(x, y).agg(F.transform(F.array_sort(F.collect_list(cell)), lambda s: s["cell"]).alias("_cells"))
    return own.select(x, y, F.create_map(F.format_string("(%d, %d)", F.col(x).cast("long"), F.col(y).cast("long")), "_cells").alias("cells"))


def dispatch(tiles: DataFrame, load, output: str, fill: float = 1.0, column: str = "values") -> DataFrame:
    """tile_id, batch_idx, output: tiles with a batch of 0 or more are scored, the others are filled."""
    real = score(tiles.where("batch_idx >= 0"), load, [output], column).select("tile_id", "batch_idx", output)
    blank = tiles.where("batch_idx < 0").select("tile_id", "batch_idx", F.transform(column, lambda _: F.lit(fill)).alias(output))
    return real.unionByName(blank)


def requested(flags: dict[str, bool]) -> list[str]:
    """Names of the outputs that are asked for; unknown names are ignored."""
    return [n for n in OUTPUTS if flags.get(n)]


def growths(largest: int) -> int:
    """Growth stages up to a resolution: one for 4, then a transition and a stable one for each doubling."""
    return ((largest.bit_length() - 1) - 2) * 2 + 1


def pyramid(tiles: DataFrame, largest: int, wanted: list[int] | None = None) -> DataFrame:
    """A row for each tile and growth with its resolution; wanted: only these growths."""
    rows = tiles.withColumn("growth", F.explode(F.sequence(F.lit(0), F.lit(growths(largest) - 1))))
    rows = rows if wanted is None else rows.where(F.col("growth").isin(wanted))
    return rows.withColumn("resolution", F.lit(4) * F.pow(F.lit(2), F.floor((F.col("growth") + 1) / 2)).cast("int"))


def pyramid_images(pixels: DataFrame, side: int, largest: int, wanted: list[int] | None = None) -> DataFrame:
    """level, tile_id, y, x, v: square images resized to 4, 8 and so on up to `largest`; wanted: only these levels, others give no rows."""
    levels = [k for k in range(largest.bit_length() - 2) if 4 << k <= largest and (wanted is None or k in wanted)]
    sizes = [bilinear(pixels, side, side, 4 << k, 4 << k).select(F.lit(k).alias("level"), "tile_id", "y", "x", "v") for k in levels]
    none = pixels.select(F.lit(0).alias("level"), "tile_id", F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("v").cast("double").alias("v")).where(F.lit(False))
    return reduce(DataFrame.unionByName, sizes, none)


def overridden(defaults: dict, overrides: dict, known_only: bool = False) -> dict:
    """Nested settings with some of them replaced; known_only: names that the defaults lack are ignored."""
    out = dict(defaults)
    for name, value in overrides.items():
        if known_only and name not in defaults:
            continue
        own = out.get(name)
        out[name] = overridden(own if isinstance(own, dict) else {}, value, known_only and isinstance(own, dict)) if isinstance(value, dict) else value
    return out


def learned_flags(distance, threshold, custom: float = -1.0) -> Column:
    """Shown flags: 1 where not flagged, -1 where flagged, so that flags are dark."""
    from ..functions.scalars import flag

    return -flag(distance, threshold, custom)


def gray(*channels: str) -> Column:
    """Mean of the channels."""
    return sum((F.col(c) for c in channels[1:]), F.col(channels[0])) / float(len(channels))


def latent(rows: DataFrame, key: str, size: int, mean: float = 0.0, deviation: float = 1.0, seed: int = 1) -> DataFrame:
    """z: an array of normal numbers for each row, the same for equal keys (two digests each, by Box and Muller)."""
    normal = lambda k: F.sqrt(-2.0 * F.log(1.0 - digest_unit(f"length-{seed}-{k}", key))) * F.cos(2.0 * math.pi * digest_unit(f"turn-{seed}-{k}", key))
    return rows.withColumn("z", F.array(*[normal(k) * deviation + mean for k in range(size)]))


def noisy(pixels: DataFrame, key: list[str], v: str = "v", seed: int = 1) -> DataFrame:
    """Uniform noise in [0, 1) added to every element, the same for equal keys."""
    return pixels.withColumn(v, F.col(v) + digest_unit(f"noise-{seed}", *key))


def any_nan(*columns: str) -> Column:
    """Whether a loss is not a number, which rolls a step back."""
    return F.exists(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: F.isnan(x))


def padded(pixels: DataFrame, by: int) -> DataFrame:
    """Images moved by a border of `by`; the border itself is left to the dense grid's filler."""
    return pixels.withColumns({"y": F.col("y") + by, "x": F.col("x") + by})


def epochs(rows: DataFrame, times: int) -> DataFrame:
    """Rows repeated `times`, numbered by epoch."""
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def shuffled(rows: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """Rows in a reproducible random order."""
    return rows.orderBy(digest_unit(f"order-{seed}", key), key)


def split(rows: DataFrame, key: str, shares: dict[str, int]) -> DataFrame:
    """role of every row (reconstruct, fit, threshold and so on) by a digest of its key: disjoint sets in the shares given."""
    total, upto, role = sum(shares.values()), 0, F.lit(None).cast("string")
    at = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(total))
    for name, share in shares.items():
        role = F.when((at >= upto) & (at < upto + share), F.lit(name)).otherwise(role)
        upto += share
    return rows.withColumn("role", role)


def random_rectangles(tiles: DataFrame, side: int, areas: list[int], seed: int = 1, shift: int = 0) -> DataFrame:
    """tile_id, block, y0, x0, h, w: a rectangle of each area in every tile, as square as it goes, wholly inside.

    shift: areas change by a random whole number from -shift to shift - 1; those without area go.
    """
    rows = tiles.select("tile_id", F.posexplode(F.array(*[F.lit(a) for a in areas])).alias("block", "area"))
    u = lambda name: digest_unit(f"{name}-{seed}", "tile_id", "block")
    if shift:
        rows = rows.withColumn("area", (F.col("area") + F.floor(u("area") * (2 * shift)) - shift).cast("int")).where("area > 0")
    rows = rows.withColumn("h", F.least(F.floor(F.sqrt("area")), F.lit(side)).cast("int")).withColumn("w", F.least(F.expr("area div h"), F.lit(side)).cast("int"))
    return rows.select("tile_id", "block", F.floor(u("y") * (side - F.col("h") + 1)).cast("int").alias("y0"), F.floor(u("x") * (side - F.col("w") + 1)).cast("int").alias("x0"), "h", "w")


def merged_maps(left: str, right: str) -> Column:
    """Two maps as one; of equal keys the right one's value stays."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k)), F.col(right))
