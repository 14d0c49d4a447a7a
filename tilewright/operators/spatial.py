"""Spatial joins and polygon regions.

A spatial self-join deals every box to the grid cells it touches and joins on the cell. A
pair is kept only in the cell that holds the lower corner of the boxes' overlap, so no
distinct is needed. A crowded cell is split at run time as any skewed equality join.

Regions are worked on in grid cells, which tasks read one after another in order. Cells with
nothing but upright rectangles are solved together as small rasters, others each by slabs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import _points, bounds, clip_ring, slab_areas, slab_rings
from ..functions.rectangles import outlines
from .graph import components

BOX = ("x0", "y0", "x1", "y1")


def _celled(boxes: DataFrame, cell: float) -> DataFrame:
    span = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))
    return boxes.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))


def touching(left: DataFrame, right: DataFrame, cell: float, by: list[str] = []) -> DataFrame:
    """l_*, r_* of all pairs of boxes (x0, y0, x1, y1) that share a point, within equal `by`."""
    own = [*by, "cx", "cy"]
    a = _celled(left, cell).select(*own, *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in by])
    b = _celled(right, cell).select(*own, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in by])
    meet = (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1")) & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    here = (F.floor(F.greatest("l_x0", "r_x0") / cell) == F.col("cx")) & (F.floor(F.greatest("l_y0", "r_y0") / cell) == F.col("cy"))
    return a.join(b, own).where(meet & here).drop("cx", "cy")


def overlapping_self(boxes: DataFrame, key: str, cell: float, by: list[str] = []) -> DataFrame:
    """Each box with `partners`, how many other boxes touch it, `least`, the smallest of their keys (null: none), and `others`, all of them in order."""
    pairs = touching(boxes, boxes, cell, by).where(F.col(f"l_{key}") != F.col(f"r_{key}"))
    found = pairs.groupBy(F.col(f"l_{key}").alias(key)).agg(F.count(F.lit(1)).alias("partners"), F.min(f"r_{key}").alias("least"), F.sort_array(F.collect_list(f"r_{key}")).alias("others"))
    kind = boxes.schema[key].dataType.simpleString()
    return boxes.join(found, key, "left").withColumns({"partners": F.coalesce("partners", F.lit(0)), "others": F.coalesce("others", F.array().cast(f"array<{kind}>"))})


def box_overlap(pairs: DataFrame) -> DataFrame:
    """inter, union, iou of touching box pairs."""
    side = lambda p, a, b: F.col(f"{p}_{b}") - F.col(f"{p}_{a}")
    inter = (F.least("l_x1", "r_x1") - F.greatest("l_x0", "r_x0")) * (F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0"))
    total = side("l", "x0", "x1") * side("l", "y0", "y1") + side("r", "x0", "x1") * side("r", "y0", "y1")
    rows = pairs.withColumn("inter", inter.cast("double"))
    rows = rows.withColumn("union", total.cast("double") - F.col("inter"))
    return rows.withColumn("iou", F.when(F.col("union") == 0, 0.0).otherwise(F.col("inter") / F.col("union")))


def _sides(table: pa.Table) -> list[list[list[np.ndarray]]]:
    """Rings by polygon, of those that aren't annotated and of those that are."""
    sides: tuple[dict, dict] = {}, {}
    for flag, k, ring in zip(*(table[c].to_pylist() for c in ("annotated", "polygon_id", "ring"))):
        sides[bool(flag)].setdefault(k, []).append(_points(ring))
    return [list(side.values()) for side in sides]


POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def _ring_array(lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])).cast(POINTS)


def _slab_array(rings: list[np.ndarray]) -> pa.Array:
    points = np.concatenate(rings) if rings else np.zeros((0, 2))
    return _ring_array(np.array([len(r) for r in rings], np.int64), points[:, 0].copy(), points[:, 1].copy())


def _starts(table: pa.Table, names: list[str]) -> np.ndarray:
    """Where rows begin that have other values of `names` than the row before."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in names:
        column = pc.dictionary_encode(table[name].combine_chunks(), null_encoding="encode")
        codes = column.indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _whole(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, which are rows in a row with equal `names`, and where each group begins."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held and len(_starts(pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), rows]), names)) == 1:
            held.append(rows)
            continue
        table = pa.concat_tables([*held, rows])
        begin = _starts(table, names)
        if len(begin) > 1:
            yield table.slice(0, begin[-1]), begin[:-1]
        held = [table.slice(begin[-1])]
    if held:
        yield pa.concat_tables(held), np.zeros(1, np.int64)


def _upright(rings: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Which rings are upright rectangles, and the x0, y0, x1, y1 that each would have."""
    flat, ends = rings.flatten(), np.asarray(rings.offsets).astype(np.int64)
    begin, n = ends[:-1] - ends[0], np.diff(ends)
    x, y = (flat.field(c).to_numpy(zero_copy_only=False) for c in (0, 1))
    at = [np.minimum(begin + k, len(x) - 1) for k in range(4)]
    last = np.minimum(begin + n - 1, len(x) - 1)
    (ax, bx, cx, dx), (ay, by, cy, dy) = ([v[k] for k in at] for v in (x, y))
    level = (ay == by) & (bx == cx) & (cy == dy) & (dx == ax)
    upright = (ax == bx) & (by == cy) & (cx == dx) & (dy == ay)
    whole = (n == 4) | ((n == 5) & (x[last] == ax) & (y[last] == ay))
    box = np.stack([np.minimum(ax, cx), np.minimum(ay, cy), np.maximum(ax, cx), np.maximum(ay, cy)], axis=1)
    return whole & (level | upright) & np.isfinite(box).all(axis=1), box


def _repeated(*keys: np.ndarray) -> np.ndarray:
    """Whether another row has the same keys."""
    order = np.lexsort(keys)
    same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    out = np.zeros(len(order), bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out


def _in_cells(dealt: DataFrame, by: list[str], cell: float, weights, labels, slabs, columns: dict[str, str]) -> DataFrame:
    """`columns` (names with their kinds) and ring, from the rows of each cell (by, cx, cy); "kind" is which ring it is, others are columns of dealt.

    Cells with nothing but upright rectangles, each a polygon of its own, are given to rectangles.outlines with weights(annotated)
    and labels; without `by` a label is the row a ring belongs to. Of other cells slabs(table, x, y) gives rows, kinds and rings.
    """
    names = [*by, "cx", "cy"]

    def made(table: pa.Table, rows: np.ndarray, which: np.ndarray, ring: pa.Array) -> pa.Table:
        own = table.take(pa.array(rows))
        return pa.table({c: pa.array(which, pa.int32()) if c == "kind" else own[c] for c in columns} | {"ring": ring})

    def solve(table: pa.Table, begin: np.ndarray) -> Iterator[pa.Table]:
        n = table.num_rows
        group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
        upright, box = _upright(table["ring"].combine_chunks())
        side = table["annotated"].combine_chunks().fill_null(False).to_numpy(zero_copy_only=False)
        polygon = pc.dictionary_encode(table["polygon_id"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        slow = np.bincount(group, ~upright | _repeated(polygon, side, group), len(begin)) > 0
        at = [table[c].to_numpy()[begin].astype(float) for c in ("cx", "cy")]
        low, high = (np.stack([a + k for a in at], axis=1) * cell for k in (0, 1))
        box = np.clip(box, np.tile(low, 2)[group], np.tile(high, 2)[group])
        odd = box != np.floor(box)
        box[odd] = [round(v, 9) for v in box[odd].tolist()]
        rows = np.flatnonzero(~slow[group] & (box[:, 0] < box[:, 2]) & (box[:, 1] < box[:, 3]))
        if len(rows):
            which, own, label, length, x, y = outlines(group[rows], box[rows], [w[rows] for w in weights(side)], labels)
            yield made(table, begin[own] if by else label, which, _ring_array(length, x, y))
        for g in np.flatnonzero(slow).tolist():
            part = table.slice(begin[g], (np.append(begin, n)[g + 1]) - begin[g])
            for row, k, rings in slabs(part, float(low[g, 0]), float(low[g, 1])):
                yield made(part, np.full(len(rings), row), np.full(len(rings), k), _slab_array(rings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begin in _whole(batches, names):
            for out in solve(table, begin):
                yield from out.combine_chunks().to_batches()

    ordered = dealt.repartition(*names).sortWithinPartitions(*names)
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
    return ordered.mapInArrow(run, f"{kinds}, ring array<struct<x: double, y: double>>")


def _dealt(polygons: DataFrame, by: str, cell: float) -> DataFrame:
    b = bounds("ring")
    span = lambda lo, hi: F.sequence(F.floor(lo / cell), F.floor(hi / cell))
    dealt = polygons.where(F.size("ring") > 2).select(by, "annotated", "polygon_id", "ring", b.alias("_b"))
    return dealt.withColumn("cx", F.explode(span(F.col("_b.x0"), F.col("_b.x1")))).withColumn("cy", F.explode(span(F.col("_b.y0"), F.col("_b.y1")))).drop("_b")


def _clipped(pdf: pd.DataFrame, x: float, y: float, cell: float) -> list:
    """Polygons that aren't annotated, and those that are, within a cell."""
    sides = [[[clip_ring(_points(r), x, y, x + cell, y + cell) for r in g] for _, g in pdf[pdf["annotated"] == flag].groupby("polygon_id")["ring"]] for flag in (False, True)]
    return [[[r for r in p if len(r)] for p in s] for s in sides]


def region_areas(polygons: DataFrame, by: str, cell: float) -> DataFrame:
    """by, predicted, annotated, common: exact areas of the unions of polygons.

    polygons: by, annotated (boolean), polygon_id, ring; rings of one polygon_id are combined even-odd, so holes count.
    Rings are dealt to the grid cells that their bounds touch and clipped there; a task sees one cell, and areas add up.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, both = slab_areas(*_clipped(pdf, float(key[1]) * cell, float(key[2]) * cell, cell))
        return pd.DataFrame({by: [key[0]], "predicted": [a], "annotated": [b], "common": [both]})

    kind = dict(polygons.dtypes)[by]
    parts = _dealt(polygons, by, cell).groupBy(by, "cx", "cy").applyInPandas(run, f"{by} {kind}, predicted double, annotated double, common double")
    return parts.groupBy(by).agg(*[F.sum(c).alias(c) for c in ("predicted", "annotated", "common")])


#: Which places a region holds, by whether predicted and annotated polygons cover them.
KINDS = {"union": lambda p, a: p, "intersection": lambda p, a: p & a, "difference": lambda p, a: p & ~a}


def region_rings(polygons: DataFrame, by: str, cell: float, kind: str = "union") -> DataFrame:
    """by, cx, cy, ring: outlines of a union, intersection or difference of polygons, cut at the grid cells.

    polygons as for region_areas; union: of the predicted ones; intersection: where those meet annotated ones;
    difference: the predicted ones less the annotated ones. Outer rings run counter-clockwise, holes clockwise.
    """
    return all_rings(polygons, by, cell, [kind]).drop("kind")


def all_rings(polygons: DataFrame, by: str, cell: float, kinds: list[str]) -> DataFrame:
    """by, cx, cy, kind, ring: as region_rings, of several kinds from one pass over the cells."""
    return _cell_rings(_dealt(polygons, by, cell), [by], cell, kinds).withColumn("kind", F.element_at(F.array(*map(F.lit, kinds)), F.col("kind") + 1))


def _cell_rings(dealt: DataFrame, by: list[str], cell: float, kinds: list[str]) -> DataFrame:
    """by, cx, cy, kind (a place in kinds), ring."""
    keeps = [KINDS[k] for k in kinds]

    def labels(p: np.ndarray, a: np.ndarray) -> list[np.ndarray]:
        return [np.where(keep(p > 0, a > 0), 0, -1) for keep in keeps]

    def slabs(table: pa.Table, x: float, y: float) -> Iterator[tuple[int, int, list[np.ndarray]]]:
        sides = [[[c for r in p if len(c := clip_ring(r, x, y, x + cell, y + cell))] for p in side] for side in _sides(table)]
        for k, keep in enumerate(keeps):
            yield 0, k, slab_rings(*sides, lambda p, a: keep(np.bool_(p), np.bool_(a)))

    columns = {c: dealt.schema[c].dataType.simpleString() for c in by} | {"cx": "long", "cy": "long", "kind": "int"}
    return _in_cells(dealt, by, cell, lambda side: [~side * 1.0, side * 1.0], labels, slabs, columns)


def less_partners(polygons: DataFrame, key: str, partners: DataFrame, cell: float) -> DataFrame:
    """key, ring: each polygon (key, ring) less the union of its partners, cut at the grid cells; partners: key, others (arrays of keys), as overlapping_self gives them."""
    own = _dealt(polygons.select(key, F.lit(False).alias("annotated"), F.col(key).alias("polygon_id"), "ring"), key, cell)
    pairs = partners.select(F.col(key).alias("_own"), F.explode("others").alias(key)).join(polygons.select(key, "ring"), key)
    beside = pairs.where(F.size("ring") > 2).select(F.col("_own").alias(key), F.col(key).alias("_other"), F.col("ring").alias("_ring"), bounds("ring").alias("_b"))
    within = (F.col("_b.x0") < (F.col("cx") + 1) * cell) & (F.col("_b.x1") > F.col("cx") * cell) & (F.col("_b.y0") < (F.col("cy") + 1) * cell) & (F.col("_b.y1") > F.col("cy") * cell)
    cover = beside.join(own.select(key, "cx", "cy"), key).where(within).select(key, F.lit(True), "_other", "_ring", "cx", "cy")
    return _cell_rings(own.union(cover), [key], cell, ["difference"]).select(key, "ring")


def less_others(polygons: DataFrame, key: str, cell: float) -> DataFrame:
    """key, ring: each polygon (key, ring) less the union of all others, cut at the grid cells.

    As less_partners with all that touch it, but a cell sees each polygon once and no pairs are made, however many meet.
    """

    def labels(many: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        return [np.where(many == 1, rows, -1).astype(np.int64)]  # where one covers a place, the sum of rows is its own

    def slabs(table: pa.Table, x: float, y: float) -> Iterator[tuple[int, int, list[np.ndarray]]]:
        found: dict = {}
        for row, (k, ring) in enumerate(zip(table[key].to_pylist(), table["ring"].to_pylist())):
            found.setdefault(k, (row, []))[1].append(clip_ring(_points(ring), x, y, x + cell, y + cell))
        parts = [(row, [r for r in rings if len(r)]) for row, rings in found.values()]
        parts = [(row, rings) for row, rings in parts if rings]
        box = np.array([[f(np.concatenate(rings), axis=0) for f in (np.min, np.max)] for _, rings in parts]).reshape(-1, 2, 2)
        for k, (row, rings) in enumerate(parts):
            near = np.flatnonzero((box[:, 0] < box[k, 1]).all(axis=1) & (box[:, 1] > box[k, 0]).all(axis=1)).tolist()
            yield row, 0, slab_rings([rings], [parts[j][1] for j in near if j != k], lambda p, a: p and not a)

    named = polygons.select(key, F.lit(False).alias("annotated"), F.col(key).alias("polygon_id"), "ring")
    found = _in_cells(_dealt(named, key, cell), [], cell, lambda side: [np.ones(len(side)), np.arange(len(side)) * 1.0], labels, slabs, {key: named.schema[key].dataType.simpleString()})
    return found.select(key, "ring")


def merge_touching(boxes: DataFrame, key: str, cell: float, by: list[str]) -> DataFrame:
    """key, component: the smallest key that is reachable over boxes of equal `by` that touch; keys are whole numbers, told apart within `by`."""
    pairs = touching(boxes, boxes, cell, by).select(*by, F.col(f"l_{key}").alias("a"), F.col(f"r_{key}").alias("b"))
    found = components(pairs.where("a < b"), by)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col(key) == F.col("_id")]
    found = found.withColumnsRenamed({c: f"_{c}" for c in [*by, "id"]})
    return boxes.join(found, reduce(and_, on), "left").select(key, F.coalesce("component", key).cast("long").alias("component"))
