"""Canny edges of dense rasters (by, Y, X, v), of any size: gradients, thinning across the edge, reach from strong pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled
from . import slides

#: Fixed value: the tangent of 22.5 degrees in 15 bits, which parts directions into level, upright and slanted.
TANGENT, BITS = 13573, 15


def gradients(pixels: DataFrame, by: list[str] = [], v: str = "v") -> DataFrame:
    """gx, gy: differences between the columns and rows around each pixel, weighted 1, 2, 1; border pixels are repeated outwards."""
    across, down = Window.partitionBy(*by, "Y").orderBy("X"), Window.partitionBy(*by, "X").orderBy("Y")
    before = lambda c, w: F.coalesce(F.lag(c).over(w), F.col(c))
    after = lambda c, w: F.coalesce(F.lead(c).over(w), F.col(c))
    rows = pixels.withColumns({"_d": after(v, across) - before(v, across), "_s": before(v, across) + F.col(v) * 2 + after(v, across)})
    found = rows.withColumns({"gx": before("_d", down) + F.col("_d") * 2 + after("_d", down), "gy": after("_s", down) - before("_s", down)})
    return found.drop("_d", "_s")


def thinned(gradient: DataFrame, by: list[str] = []) -> DataFrame:
    """strength (|gx| + |gy|) and top: whether it is greatest across the edge; outside the raster it is 0.

    Of two equal ones beside each other in a level or upright direction the first stays; in a
    slanted one a pixel must be greater than both.
    """
    across, down = Window.partitionBy(*by, "Y").orderBy("X"), Window.partitionBy(*by, "X").orderBy("Y")
    none = F.lit(0.0)
    rows = gradient.withColumn("strength", (F.abs("gx") + F.abs("gy")).cast("double"))
    rows = rows.withColumns({"_up": F.coalesce(F.lag("strength").over(down), none), "_down": F.coalesce(F.lead("strength").over(down), none)})
    beside = {f"_{side}{c}": F.coalesce(move(c).over(across), none) for side, move in (("l", F.lag), ("r", F.lead)) for c in ("_up", "strength", "_down")}
    rows = rows.withColumns(beside)
    m, gx, gy = F.col("strength"), F.abs("gx"), F.abs("gy") * (1 << BITS)
    level, upright = gy < gx * TANGENT, gy > gx * (TANGENT + (2 << BITS))
    same = (F.col("gx") < 0) == (F.col("gy") < 0)
    slanted = F.when(same, (m > F.col("_l_up")) & (m > F.col("_r_down"))).otherwise((m > F.col("_r_up")) & (m > F.col("_l_down")))
    top = F.when(level, (m > F.col("_lstrength")) & (m >= F.col("_rstrength"))).when(upright, (m > F.col("_up")) & (m >= F.col("_down"))).otherwise(slanted)
    return rows.withColumn("top", top).drop("_up", "_down", *beside)


def edges(pixels: DataFrame, low: float, high: float, tile: int, by: list[str] = [], v: str = "v") -> DataFrame:
    """by, Y, X of the edges: tops stronger than `low` in an 8-connected group of them with one stronger than `high`.

    Pixels of a slide must fill a rectangle. `tile`: the side of the pieces in which groups are
    looked for, which doesn't change them.
    """
    tops = settled(thinned(gradients(pixels, by, v), by).where(F.col("top") & (F.col("strength") > low)).select(*by, "Y", "X", "strength"))
    labels = slides.components(tops, tile, by).withColumnRenamed("label", "_group")
    own = tops.join(labels, [*by, "Y", "X"])
    strong = own.where(F.col("strength") > high).select(*by, "_group").distinct()
    return own.join(strong, [*by, "_group"], "left_semi").select(*by, "Y", "X")


def cell_edges(labels: DataFrame, tile: int, height: Column, width: Column, by: list[str] = [], low: float = 2.0, high: float = 5.0) -> DataFrame:
    """by, Y, X of the edges of every cell by itself, grown by a pixel all round.

    labels: by, Y, X, label of the pixels of cells. height, width: of the image, as columns of
    `labels`. A cell is drawn, 1 on 0, in the rectangle around it, so that cells that touch each have their whole edge.
    """
    keys = [*by, "label"]
    near = lambda c, n: F.explode(F.sequence(F.greatest(F.col(c) - 1, F.lit(0)), F.least(F.col(c) + 1, n - 1)))
    rows = labels.withColumn("_h", height.cast("long")).withColumn("_w", width.cast("long")).select(*keys, F.col("Y").cast("long").alias("Y"), F.col("X").cast("long").alias("X"), "_h", "_w")
    grown = rows.withColumn("Y", near("Y", F.col("_h"))).select(*keys, "Y", "X", "_w", "_h").distinct().withColumn("X", near("X", F.col("_w"))).select(*keys, "Y", "X", "_h", "_w").distinct()
    ends = grown.groupBy(*keys).agg(*[f(c).alias(f"_{n}{c}") for c in ("Y", "X") for n, f in (("a", F.min), ("b", F.max))], F.first("_h").alias("_h"), F.first("_w").alias("_w"))
    span = lambda c, n: F.explode(F.sequence(F.greatest(F.col(f"_a{c}") - 2, F.lit(0)), F.least(F.col(f"_b{c}") + 2, F.col(n) - 1)))
    around = ends.withColumn("Y", span("Y", "_h")).withColumn("X", span("X", "_w")).select(*keys, "Y", "X")
    drawn = around.join(grown.select(*keys, "Y", "X", F.lit(1.0).alias("v")), [*keys, "Y", "X"], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    own = [*by, "cell"]
    return edges(drawn.withColumnRenamed("label", "cell"), low, high, tile, own).select(*by, "Y", "X").distinct()
