"""Scalar expressions on pixels, tile codes and levels. All take and return columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def divide_no_nan(n, d) -> Column:
    """n / d, and 0 where d is 0."""
    n, d = col(n), col(d)
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def min_max(x, low, high) -> Column:
    """(x - low) / (high - low); 0 for a flat range."""
    return divide_no_nan(col(x) - col(low), col(high) - col(low))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def sigmoid_localisation(x) -> Column:
    """4 * sigmoid(x) - 3."""
    return F.lit(4.0) * sigmoid(x) - F.lit(3.0)


def flag(distance, threshold, custom: float = -1.0) -> Column:
    """1 where distance > threshold, else -1; a custom threshold of 0 or more replaces the learned one."""
    limit = F.lit(float(custom)) if custom >= 0 else col(threshold)
    return F.when(col(distance) > limit, F.lit(1)).otherwise(F.lit(-1))


def scale_pixel(x, clip: bool = False) -> Column:
    """[0, 255] to [-1, 1]."""
    y = col(x) * 2.0 / 255.0 - 1.0
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), y)) if clip else y


def descale_pixel(x) -> Column:
    """[-1, 1] to a whole number in [0, 255]."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.floor((col(x) + 1.0) * 127.5))).cast("int")


def luma(r, g, b) -> Column:
    return F.round(col(r) * 0.299 + col(g) * 0.587 + col(b) * 0.114).cast("int")


#: The stain vectors of Ruifrok and Johnston, rows haematoxylin, eosin, DAB.
STAINS = ((0.65, 0.70, 0.29), (0.07, 0.99, 0.11), (0.27, 0.57, 0.78))


def _inverse3(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    return (
        ((e * i - f * h) / det, (c * h - b * i) / det, (b * f - c * e) / det),
        ((f * g - d * i) / det, (a * i - c * g) / det, (c * d - a * f) / det),
        ((d * h - e * g) / det, (b * g - a * h) / det, (a * e - b * d) / det),
    )


def stain(r, g, b, channel: int = 2, clamp: bool = True) -> Column:
    """A stain channel of a colour in [0, 255] by deconvolution of optical densities."""
    inverse = _inverse3(STAINS)
    floor = 1e-6
    total = F.lit(0.0)
    for k, x in enumerate((r, g, b)):
        total = total + F.log(F.greatest(col(x) / 255.0, F.lit(floor))) / F.log(F.lit(floor)) * F.lit(inverse[k][channel])
    return F.greatest(total, F.lit(0.0)) if clamp else total


def morton(row, column, bits: int = 15) -> Column:
    """The tile's code in a 4-ary tree: 0 top left, 1 top right, 2 bottom left, 3 bottom right at each level; a row or column of more bits is an error."""
    row, column = col(row).cast("bigint"), col(column).cast("bigint")
    code = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    for k in range(bits):
        code = code.bitwiseOR(F.shiftleft(F.shiftright(column, k).bitwiseAND(one), 2 * k)).bitwiseOR(F.shiftleft(F.shiftright(row, k).bitwiseAND(one), 2 * k + 1))
    return F.when(F.shiftright(row.bitwiseOR(column), bits) != 0, F.raise_error(F.lit(f"a tile's row or column has more than {bits} bits"))).otherwise(code)


def unmorton(code, bits: int = 15) -> tuple[Column, Column]:
    """(row, column) of a code."""
    code, one = col(code), F.lit(1).cast("bigint")
    row, column = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for k in range(bits):
        column = column.bitwiseOR(F.shiftleft(F.shiftright(code, 2 * k).bitwiseAND(one), k))
        row = row.bitwiseOR(F.shiftleft(F.shiftright(code, 2 * k + 1).bitwiseAND(one), k))
    return row, column


def tree_depth(tiles) -> Column:
    """The least d with 2 ** d >= tiles, without logarithms."""
    n = col(tiles).cast("bigint") - 1
    return F.when(n <= 0, 0).otherwise(F.length(F.bin(n))).cast("int")


def slide_depth(width, height, patch_width: int, patch_height: int) -> Column:
    """Levels of the tree over all patches of a slide."""
    return F.greatest(tree_depth(F.ceil(col(width) / patch_width)), tree_depth(F.ceil(col(height) / patch_height)))


def thumbnail_size(width, height, target: int) -> Column:
    """width, height of a thumbnail about `target` wide: both over the whole number of times that the target fits, once at least."""
    times = F.greatest(F.floor(col(width) / target), F.lit(1))
    return F.struct(F.floor(col(width) / times).alias("width"), F.floor(col(height) / times).alias("height"))


def level_of_size(size, largest: int = 1024) -> Column:
    """0 for the largest size, one more for each halving."""
    return (F.lit(largest.bit_length() - 1) - (F.length(F.bin(col(size).cast("bigint"))) - 1)).cast("int")


def block_of_growth(growth) -> Column:
    """Growth 0 is block 0; then one transition and one stable growth for each block."""
    return F.floor((col(growth) + 1) / 2).cast("int")


def alpha(step, steps) -> Column:
    """The fade-in weight, min((step + 1) / steps, 1)."""
    return F.least((col(step) + 1) / col(steps), F.lit(1.0))


def blend(a, x, y) -> Column:
    return col(a) * col(x) + (F.lit(1.0) - col(a)) * col(y)


def he_constant(fan_in) -> Column:
    return F.sqrt(F.lit(2.0) / col(fan_in))


def pixel_norm(values, epsilon: float = 1e-8) -> Column:
    """An array over its root mean square."""
    v = col(values)
    mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) / F.size(v)
    return F.transform(v, lambda x: x / F.sqrt(mean + epsilon))


def origin_distance(values, epsilon: float = 1e-8) -> Column:
    """-|z| / sqrt(size of z)."""
    v = col(values)
    return -F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x) + epsilon) / F.sqrt(F.size(v).cast("double"))


def resize_factor(dim, patch, out_px, n, depth) -> Column:
    """Source pixels for each output pixel of a stitched slide."""
    return col(dim) * col(patch) / (col(out_px) * col(n) / F.pow(F.lit(2.0), col(depth)))


def metres(pixels, microns_per_pixel) -> Column:
    return col(pixels) * col(microns_per_pixel) * 1e-6


def bucket(text, buckets: int = 4000) -> Column:
    """A stable partition number of a string, from the first 32 bits of its MD5 digest."""
    return F.pmod(F.conv(F.substring(F.md5(col(text).cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("bigint")


def digest_unit(name: str, *parts) -> Column:
    """A reproducible number in [0, 1), a multiple of 2**-32, from an MD5 digest of the name and the parts."""
    text = F.concat_ws(":", F.lit(name), *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint").cast("double") / float(1 << 32)
