"""Tile grids, batches, tissue filters, quadtree assembly and windows over rasters.

Rasters are rows (tile_id, y, x, v); a slide's grid is rows (row, col).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import morton, tree_depth
from ..session import settled
from .order import positions


def padded_side(grid: DataFrame) -> DataFrame:
    """side: the least power of two that holds all rows and columns; one row."""
    n = F.greatest(F.max("row"), F.max("col")) + 1
    return grid.agg(F.call_function("shiftleft", F.lit(1).cast("bigint"), tree_depth(n)).alias("side"), tree_depth(n).alias("depth"))


#: Tiles of a padded grid that one task makes, about.
SHARE = 1 << 15


def full_grid(tiles: DataFrame) -> DataFrame:
    """All (row, col) of the padded square grid, with code and depth, and the tiles' own columns where there is one.

    Only the columns that a row of tiles has meet in a task; the places between them are made where
    they are used, in tasks of about SHARE, and are neither shuffled nor joined.
    """
    own = tiles.withColumns({"row": F.col("row").cast("bigint"), "col": F.col("col").cast("bigint")}).where("row >= 0 and col >= 0")
    side, depth = padded_side(tiles).first()
    side = side or 0
    more = [c for c in own.columns if c not in ("row", "col")]
    taken = own.groupBy("row").agg(F.collect_set("col").alias("_taken"))
    rows = tiles.sparkSession.range(side).withColumnRenamed("id", "row").join(taken, "row", "left").repartition(max(1, min(side, side * side // SHARE)), "row")
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(max(side - 1, 0)).cast("bigint"))
    free = rows.select("row", F.explode(F.when(F.col("_taken").isNull(), every).otherwise(F.array_except(every, "_taken"))).alias("col"))
    grid = own.select("row", "col", *more).union(free.select("row", "col", *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in more]))
    return grid.select("row", "col", F.lit(depth).cast("int").alias("depth"), *more).withColumn("code", morton("row", "col"))


def index_stacks(depth: int, code="code") -> tuple[Column, Column]:
    """(global, local) indices of a tile at depths 0 .. depth - 1 above its leaf."""
    c = F.col(code)
    levels = range(1, depth + 1)
    return F.array(*[F.shiftright(c, 2 * (depth - k)) for k in levels]), F.array(*[F.shiftright(c, 2 * (depth - k)).bitwiseAND(F.lit(3).cast("bigint")) for k in levels])


def batches(grid: DataFrame, usable: str, size: int, order: list[str] = ["row", "col"], by: list[str] = []) -> DataFrame:
    """batch_idx: k // size of the usable tiles in order; -(k // size + 1) of the others. Tiles of one value of the first order column meet in one task."""
    b = F.floor(F.col("_k") / size)
    placed = positions(grid, order, [*by, usable], F.col(order[0]), "_k")
    return placed.withColumn("batch_idx", F.when(F.col(usable), b).otherwise(-(b + 1)).cast("bigint")).drop("_k")


def drop_remainder(rows: DataFrame, size: int, batch: str = "batch_idx") -> DataFrame:
    """Full batches only."""
    return rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(batch))).where(F.col("_n") == size).drop("_n")


def tissue_share(pixels: DataFrame, inside: Column, area: int) -> DataFrame:
    """tile_id, tissue, share: flagged pixels over the full patch area, also at ragged borders."""
    return pixels.groupBy("tile_id").agg(F.sum(F.when(inside, 1).otherwise(0)).cast("bigint").alias("tissue")).withColumn("share", F.col("tissue") / F.lit(area))


def thumbnail_tiles(mask: DataFrame, height: int, width: int, tile: int, scale: int, least: float) -> DataFrame:
    """row, col, share of tiles whose thumbnail cells, both bounds included, are flagged above `least`.

    mask: (y, x) of flagged thumbnail pixels. A flagged pixel is dealt to the tiles that contain it; a
    last partial row or column of tiles is not visited.
    """
    step = tile // scale
    spread = lambda name: F.expr(f"filter(array({name} div {step}, {name} div {step} - 1), r -> r >= 0 and {name} between r * {step} and r * {step} + {step})")
    hits = mask.select(F.explode(spread("y")).alias("row"), "x").select("row", F.explode(spread("x")).alias("col"))
    counts = hits.groupBy("row", "col").agg(F.count(F.lit(1)).alias("flagged"))
    return counts.where((F.col("row") < height // step) & (F.col("col") < width // step)).withColumn("share", F.col("flagged") / F.lit((step + 1) ** 2)).where(F.col("share") > least)


def siblings(rows: DataFrame, code: str, value: str) -> DataFrame:
    """parent, c0 .. c3: the four children of every parent tile side by side."""
    parent = F.shiftright(F.col(code), 2).alias("parent")
    local = F.col(code).bitwiseAND(F.lit(3).cast("bigint")).alias("local")
    wide = rows.select(parent, local, value).groupBy("parent").pivot("local", [0, 1, 2, 3]).agg(F.first(value, ignorenulls=True))
    return wide.select("parent", *[F.col(str(k)).alias(f"c{k}") for k in range(4)])


def place(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """Y, X of every pixel (row, col, y, x) in the stitched image: no grouping is needed."""
    return pixels.withColumns({"Y": F.col("row") * height + F.col("y"), "X": F.col("col") * width + F.col("x")})


def stitch(pixels: DataFrame, height: int, width: int, fill: float = 1.0) -> DataFrame:
    """Y, X, v of the whole padded image; places without a pixel (row, col, y, x, v), of a tile or of all of it, are filled.

    Pixels stay where they are. Only tiles that lack some of theirs are joined with them.
    """
    own = pixels.select(F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "y", "x", F.coalesce("v", F.lit(fill)).alias("v"))
    own = own.where((F.col("row") >= 0) & (F.col("col") >= 0) & F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))
    held = settled(own.groupBy("row", "col").agg(F.count_distinct(F.col("y") * width + F.col("x")).alias("_n")))

    def blank(rows: DataFrame) -> DataFrame:
        spread = rows.select("row", "col", F.explode(F.sequence(F.lit(0), F.lit(height * width - 1))).alias("_i"))
        return spread.select("row", "col", F.expr(f"_i div {width}").cast("int").alias("y"), (F.col("_i") % width).alias("x"), F.lit(fill).alias("v"))

    empty = blank(full_grid(held).where(F.col("_n").isNull()))
    lacking = blank(held.where(F.col("_n") < height * width)).join(own, ["row", "col", "y", "x"], "left_anti")
    return place(own.union(empty).union(lacking), height, width).select("Y", "X", "v")


def halve(pixels: DataFrame, by: list[str], y: str = "Y", x: str = "X", v: str = "v") -> DataFrame:
    """Means of 2 by 2 blocks."""
    return pixels.groupBy(*by, F.floor(F.col(y) / 2).alias(y), F.floor(F.col(x) / 2).alias(x)).agg(F.avg(v).alias(v))


def covering(at: str, length: int, window: int, stride: int) -> Column:
    """Numbers of the windows (0 .. ceil((length - window) / stride)) that contain the place `at`."""
    last = -(-(length - window) // stride)
    low = F.greatest(F.lit(0), F.ceil((F.col(at) - window + 1) / stride)).cast("int")
    high = F.least(F.lit(last), F.floor(F.col(at) / stride)).cast("int")
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def windows(pixels: DataFrame, height: int, width: int, window: int, stride: int) -> DataFrame:
    """wy, wx of every window over each pixel; a row for each."""
    return pixels.withColumn("wy", F.explode(covering("y", height, window, stride))).withColumn("wx", F.explode(covering("x", width, window, stride)))


def mirrored(pixels: DataFrame, height: int, width: int, window: int, stride: int) -> tuple[DataFrame, int, int]:
    """Pixels with a border below and to the right that whole windows take, and its height and width.

    The border mirrors the image, the outermost line included, as often as it must.
    """
    def targets(name: str, length: int) -> tuple[Column, int]:
        full = window + stride * max(0, -(-(length - window) // stride))
        starts = range(0, full, 2 * length)
        places = F.array(*[p for s in starts for p in (F.col(name) + s, F.lit(s + 2 * length - 1) - F.col(name))])
        return F.explode(F.filter(places, lambda p: p < full)), full

    (y, full_height), (x, full_width) = targets("y", height), targets("x", width)
    rows = pixels.withColumn("_y", y).withColumn("_x", x).drop("y", "x").withColumnsRenamed({"_y": "y", "_x": "x"})
    return rows, full_height, full_width


def overlap_mean(scores: DataFrame, by: list[str] = ["tile_id", "y", "x"], v: str = "v") -> DataFrame:
    """Mean over all windows that cover a pixel, and how many do."""
    return scores.groupBy(*by).agg(F.avg(v).alias(v), F.count(F.lit(1)).alias("covers"))


def nearest(pixels: DataFrame, height: int, width: int, to_height: int, to_width: int) -> DataFrame:
    """Resize by nearest neighbour: target (i, j) takes source (floor(i * h / H), floor(j * w / W))."""
    def targets(name: str, old: int, new: int) -> Column:
        low, high = F.ceil(F.col(name) * F.lit(new) / F.lit(old)), F.ceil((F.col(name) + 1) * F.lit(new) / F.lit(old)) - 1
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

    rows = pixels.withColumn("_y", F.explode(targets("y", height, to_height))).withColumn("_x", F.explode(targets("x", width, to_width)))
    return rows.drop("y", "x").withColumnsRenamed({"_y": "y", "_x": "x"})


def bilinear(pixels: DataFrame, height: int, width: int, to_height: int, to_width: int, v: str = "v") -> DataFrame:
    """Resize with half-pixel centres; source places outside are held at the border. tile_id, y, x, v.

    Every source pixel is dealt to the targets that read it with its weight, then summed.
    """
    def weights(old: int, new: int) -> list[tuple[int, int, float]]:
        out = []
        for t in range(new):
            s = min(max((t + 0.5) * old / new - 0.5, 0.0), old - 1.0)
            i = int(s)
            f = s - i
            out.append((i, t, 1.0 - f))
            if f > 0:
                out.append((i + 1, t, f))
        return out

    spark = pixels.sparkSession
    wy = spark.createDataFrame(weights(height, to_height), "y int, ty int, fy double")
    wx = spark.createDataFrame(weights(width, to_width), "x int, tx int, fx double")
    rows = pixels.join(F.broadcast(wy), "y").join(F.broadcast(wx), "x")  # tables of one image axis
    return rows.groupBy("tile_id", F.col("ty").alias("y"), F.col("tx").alias("x")).agg(F.sum(F.col(v) * F.col("fy") * F.col("fx")).alias(v))


def half_turn(pixels: DataFrame, height: int, width: int) -> DataFrame:
    return pixels.withColumns({"y": F.lit(height - 1) - F.col("y"), "x": F.lit(width - 1) - F.col("x")})


def non_blank_bounds(pixels: DataFrame, by: list[str], blank: Column) -> DataFrame:
    """max_y, max_x over pixels that aren't blank."""
    return pixels.groupBy(*by).agg(F.max(F.when(~blank, F.col("y"))).alias("max_y"), F.max(F.when(~blank, F.col("x"))).alias("max_x"))


def tile_name(prefix: str, x: str, y: str, width: int, height: int) -> Column:
    return F.format_string(f"{prefix}_x_%d_y_%d_width_{width}_height_{height}.png", F.col(x).cast("bigint"), F.col(y).cast("bigint"))


def parse_tile_names(rows: DataFrame, name: str = "name") -> DataFrame:
    """x, y, width, height from a name; row, col on the grid from the least place; side, the power of two that holds it.

    The name's x runs down the rows and y along the columns.
    """
    part = {k: F.regexp_extract(name, rf"_{k}_(\d+)", 1).cast("bigint") for k in ("x", "y", "width", "height")}
    rows = rows.withColumns(part).where("x is not null")
    low = rows.agg(F.min("x").alias("_lx"), F.min("y").alias("_ly"), F.max("x").alias("_hx"), F.max("y").alias("_hy"), F.max("width").alias("_w"), F.max("height").alias("_h"))
    rows = rows.crossJoin(F.broadcast(low))
    rows = rows.withColumns({"row": F.expr("(x - _lx) div _h"), "col": F.expr("(y - _ly) div _w")})
    side = F.call_function("shiftleft", F.lit(1).cast("bigint"), tree_depth(F.greatest(F.expr("(_hx - _lx) div _h"), F.expr("(_hy - _ly) div _w")) + 1))
    return rows.withColumn("side", side).drop("_lx", "_ly", "_hx", "_hy", "_w", "_h")
