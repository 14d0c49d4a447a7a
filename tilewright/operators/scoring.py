"""Reconstruction errors, distances, flags, scores, losses, masks and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import col, digest_unit, divide_no_nan, flag, min_max, origin_distance, tree_depth


#: Thresholds that are evaluated at a time.
GRID = 10_000


def absolute_errors(pixels: DataFrame, truth: str = "v", made: str = "r") -> DataFrame:
    return pixels.withColumn("error", F.abs(F.col(truth) - F.col(made)))


def normalise(pixels: DataFrame, v: str, by: list[str], out: str) -> DataFrame:
    """Min-max over each image; a flat image is 0. Extremes are aggregated, so an image of any size is never in one task."""
    ends = pixels.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.min(v).alias("_low"), F.max(v).alias("_high"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return pixels.join(ends, reduce(lambda x, y: x & y, same)).withColumn(out, min_max(F.col(v), F.col("_low"), F.col("_high"))).drop("_low", "_high", *[f"_{c}" for c in by])


def residual_loss(pixels: DataFrame, by: list[str], truth: str = "v", made: str = "r") -> DataFrame:
    """residual: mean squared difference of an image and its reconstruction, both normalised."""
    rows = normalise(normalise(pixels, truth, by, "_t"), made, by, "_m")
    return rows.groupBy(*by).agg((F.sum((F.col("_t") - F.col("_m")) * (F.col("_t") - F.col("_m"))) / F.count(F.lit(1))).alias("residual"))


def anomaly_score(residual, latent, share: float = 0.05) -> Column:
    """share * residual + (1 - share) * distance of the latent vector from the origin."""
    return F.lit(share) * col(residual) + F.lit(1.0 - share) * origin_distance(latent)


def flag_counts(scored: DataFrame, distance: str, threshold: str, by: list[str], custom: float = -1.0) -> DataFrame:
    """flagged, pixels, share of every image."""
    on = flag(distance, threshold, custom) == 1
    rows = scored.groupBy(*by).agg(F.count_if(on).alias("flagged"), F.count(F.lit(1)).alias("pixels"))
    return rows.withColumn("share", divide_no_nan("flagged", "pixels"))


def confusion_at(rows: DataFrame, thresholds: DataFrame, score: str, truth: str, by: list[str] = []) -> DataFrame:
    """threshold, tp, fp, fn, tn of score > threshold. thresholds: a parameter table (threshold) of GRID rows at most.

    A score is binned once, by how many thresholds it passes; counts of bins then give every threshold's.
    """
    values = sorted({r[0] for r in thresholds.select("threshold").limit(GRID + 1).collect()})
    if len(values) > GRID:
        raise ValueError(f"more than {GRID} thresholds")
    grid = F.array(*[F.lit(x) for x in values])
    passed = F.size(F.filter(grid, lambda t: F.col(score) > t))
    bins = rows.groupBy(*by, passed.alias("_k")).agg(F.count_if(F.col(truth) == 1).alias("_p"), F.count_if(F.coalesce(F.col(truth) != 1, F.lit(True))).alias("_n"))
    each = bins.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(len(values) - 1)))) if values else bins.withColumn("_t", F.lit(0)).where("false")
    hit = F.col("_k") > F.col("_t")
    sums = [F.sum(F.when(c, F.col(n)).otherwise(0)).alias(a) for c, n, a in ((hit, "_p", "tp"), (hit, "_n", "fp"), (~hit, "_p", "fn"), (~hit, "_n", "tn"))]
    return each.groupBy(*by, "_t").agg(*sums).withColumn("threshold", F.element_at(grid, F.col("_t") + 1)).select(*by, "threshold", "tp", "fp", "fn", "tn")


def mask_confusion(masks: DataFrame, truth: DataFrame, pixels: DataFrame, by: list[str]) -> DataFrame:
    """by, tp, fp, fn, tn of masks (by, tile_id, y, x) against the flagged pixels `truth` (tile_id, y, x) of all `pixels`."""
    place = ["tile_id", "y", "x"]
    real = truth.select(*place).withColumn("_real", F.lit(1))
    hits = masks.join(real, place, "left").groupBy(*by).agg(F.count("_real").alias("tp"), F.count(F.lit(1)).alias("_all"))
    sizes = real.agg(F.count(F.lit(1)).alias("_true")).crossJoin(pixels.agg(F.count(F.lit(1)).alias("_n")))
    rows = hits.crossJoin(F.broadcast(sizes))  # one row
    tp, made, real_n = F.col("tp"), F.col("_all"), F.col("_true")
    return rows.select(*by, "tp", (made - tp).alias("fp"), (real_n - tp).alias("fn"), (F.col("_n") - made - real_n + tp).alias("tn"))


def derived_metrics(rows: DataFrame) -> DataFrame:
    """iou, sensitivity, specificity, precision, accuracy, f1 from tp, fp, fn, tn; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return rows.withColumns({
        "iou": divide_no_nan(tp, tp + fp + fn), "sensitivity": divide_no_nan(tp, tp + fn), "specificity": divide_no_nan(tn, tn + fp),
        "precision": divide_no_nan(tp, tp + fp), "accuracy": divide_no_nan(tp + tn, tp + fp + fn + tn), "f1": divide_no_nan(tp * 2.0, tp * 2.0 + fp + fn),
    })


def area_confusion(pairs: DataFrame, common: str, predicted: str, annotated: str, slide: str) -> DataFrame:
    """tp, fp, fn, tn as areas; missing predictions count as none."""
    p, i, a = F.coalesce(predicted, F.lit(0.0)), F.coalesce(common, F.lit(0.0)), F.col(annotated)
    return pairs.withColumns({"tp": i, "fp": p - i, "fn": a - i, "tn": F.col(slide) - (p + a - i)})


def image_losses(pixels: DataFrame, by: list[str], truth: str = "v", made: str = "r", normalised: bool = True) -> DataFrame:
    """l1, l2 of the table: means over images of each image's mean (or sum) of |d| + 1e-8 and of d squared."""
    d = F.col(truth) - F.col(made)
    fold = F.avg if normalised else F.sum
    each = pixels.groupBy(*by).agg(fold(F.abs(d) + 1e-8).alias("_1"), fold(d * d).alias("_2"))
    return each.agg(F.avg("_1").alias("l1"), F.avg("_2").alias("l2"))


def critic_losses(rows: DataFrame, real: str, fake: str, epsilon: float = 1e-3) -> DataFrame:
    """critic: mean fake - mean real; generator: - mean fake; drift: epsilon * mean of real squared."""
    r, f = F.col(real), F.col(fake)
    return rows.agg((F.avg(f) - F.avg(r)).alias("critic"), (-F.avg(f)).alias("generator"), (F.lit(epsilon) * F.avg(r * r)).alias("drift"))


def gradient_penalty(rows: DataFrame, gradient: str, weight: float = 10.0, target: float = 1.0) -> DataFrame:
    """penalty of the gradients' lengths from the target; gradient: an array column."""
    norm = F.sqrt(F.aggregate(F.col(gradient), F.lit(0.0), lambda s, g: s + g.cast("double") * g.cast("double")) + 1e-8)
    return rows.agg((F.lit(weight / target**2) * F.avg((norm - target) * (norm - target))).alias("penalty"))


def minibatch_slot(position, batch, group: int = 4) -> Column:
    """Slot of the image at a position (from 0) of a batch of so many: images of one slot are compared.

    Groups have `group` images if they divide the batch; else, and in smaller batches, all are one group.
    """
    slots = F.when(col(batch) % group == 0, F.floor(col(batch) / group)).otherwise(1)
    return (col(position) % slots).cast("long")


def minibatch_deviation(pixels: DataFrame, slot: Column, epsilon: float = 1e-8, by: list[str] = []) -> DataFrame:
    """by, slot, deviation: mean over places of the deviation among the images of a slot of each batch (`by`)."""
    spread = pixels.withColumn("slot", slot).groupBy(*by, "slot", "y", "x").agg(F.var_pop("v").alias("_v"))
    return spread.groupBy(*by, "slot").agg(F.avg(F.sqrt(F.col("_v") + epsilon)).alias("deviation"))


def mask_blocks(pixels: int) -> list[int]:
    """Sizes of mask blocks: each takes half of what is left, one at least."""
    out, left = [], pixels
    while left > 0:
        out.append(max(1, left // 2))
        left -= out[-1]
    return out


def block_sizes(pixels) -> Column:
    """mask_blocks of a column of pixel counts, as an array of longs; empty for 0 and null."""
    n = F.coalesce(col(pixels).cast("long"), F.lit(0).cast("long"))
    last = tree_depth(n)
    halved = lambda k: F.floor(F.ceil(n / F.pow(F.lit(2.0), k)) / 2)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.when(k == last, F.lit(1)).otherwise(halved(k)).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def _inside(rects: DataFrame, *keep: str) -> DataFrame:
    """tile_id, keep, y, x: the pixels of every rectangle."""
    rows = rects.select("tile_id", *keep, F.explode(F.sequence("y0", F.col("y0") + F.col("h") - 1)).alias("y"), "x0", "w")
    return rows.select("tile_id", *keep, "y", F.explode(F.sequence("x0", F.col("x0") + F.col("w") - 1)).alias("x"))


def rectangle_mask(pixels: DataFrame, rects: DataFrame) -> DataFrame:
    """covers of every pixel, and masked: covered by exactly one rectangle (y0, x0, h, w).

    Each rectangle is expanded to its own pixels, so the join is an equality join.
    """
    covers = _inside(rects).groupBy("tile_id", "y", "x").agg(F.count(F.lit(1)).alias("covers"))
    return pixels.join(covers, ["tile_id", "y", "x"], "left").withColumn("covers", F.coalesce("covers", F.lit(0))).withColumn("masked", F.col("covers") == 1)


def shuffle_blocks(pixels: DataFrame, rects: DataFrame, seed: int = 1, v: str = "v") -> DataFrame:
    """Pixels with covers, masked and v: each rectangle (block, y0, x0, h, w) changes its own pixels about, by the order of a seeded digest.

    All pixels of a rectangle take part; what comes to a pixel that other rectangles cover too isn't
    seen, as that pixel isn't masked and stays as it is. Pixels missing from the image take no part.
    """
    rows = _inside(rects, "block").join(pixels.select("tile_id", "y", "x", F.col(v).alias("_v")), ["tile_id", "y", "x"])
    own = Window.partitionBy("tile_id", "block")
    key = digest_unit(f"shuffle-{seed}", "tile_id", "block", "y", "x")
    ranks = rows.withColumns({"_to": F.row_number().over(own.orderBy("y", "x")), "_from": F.row_number().over(own.orderBy(key, "y", "x"))})
    moved = ranks.select("tile_id", "block", "y", "x", F.col("_to").alias("_k")).join(ranks.select("tile_id", "block", "_v", F.col("_from").alias("_k")), ["tile_id", "block", "_k"])
    seen = moved.groupBy("tile_id", "y", "x").agg(F.count(F.lit(1)).alias("covers"), F.max("_v").alias("_v"))
    out = pixels.join(seen, ["tile_id", "y", "x"], "left").withColumn("covers", F.coalesce("covers", F.lit(0))).withColumn("masked", F.col("covers") == 1)
    return out.withColumn(v, F.when(F.col("masked"), F.col("_v")).otherwise(F.col(v))).drop("_v")


def dead_mask(pixels: DataFrame, v: str = "v") -> DataFrame:
    """Masked pixels become -1."""
    return pixels.withColumn(v, F.when(F.col("masked"), F.lit(-1.0)).otherwise(F.col(v)))


def shuffle_mask(pixels: DataFrame, seed: int = 1, v: str = "v") -> DataFrame:
    """Masked pixels of an image change places among each other, by the order of a seeded digest."""
    key = digest_unit(f"shuffle-{seed}", "tile_id", "y", "x")
    part = pixels.where("masked")
    place = part.select("tile_id", "y", "x", F.row_number().over(Window.partitionBy("tile_id").orderBy("y", "x")).alias("_k"))
    value = part.select("tile_id", F.col(v).alias("_v"), F.row_number().over(Window.partitionBy("tile_id").orderBy(key, "y", "x")).alias("_k"))
    moved = place.join(value, ["tile_id", "_k"]).drop("_k")
    return pixels.join(moved, ["tile_id", "y", "x"], "left").withColumn(v, F.coalesce("_v", v)).drop("_v")


def masked_images(pixels: DataFrame, rects: DataFrame, shuffle: bool = False, seed: int = 1, v: str = "v") -> DataFrame:
    """Pixels masked by rectangles: those changed about within each rectangle, or dead."""
    return shuffle_blocks(pixels, rects, seed, v) if shuffle else dead_mask(rectangle_mask(pixels, rects), v)


def tiled_inpainting(pixels: DataFrame, block: int, width: int, divisor: int, v: str = "v", fill: float = -1.0) -> DataFrame:
    """turn, y, x, v: for each turn k, blocks whose number leaves k modulo divisor are masked."""
    number = F.floor(F.col("y") / block) * (width // block) + F.floor(F.col("x") / block)
    rows = pixels.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(divisor - 1))))
    masked = F.pmod(number, F.lit(divisor)) == F.col("turn")
    return rows.withColumn("masked", masked).withColumn(v, F.when(masked, F.lit(fill)).otherwise(F.col(v)))
