"""Outlines of regions as whole rings: dissolved cells, offsets, closing, repair, and exact tests of rings that meet.

A region is worked on in grid cells (spatial.region_rings); here its pieces become whole again.
Sides on cell borders cancel where the neighbouring cell has the opposite side, the sides left
are linked to chains block by block and these across the plane, so neither a region nor a ring
has to fit into one task before it is a value of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import settled
from . import graph, spatial


#: Cells along a side of the blocks whose sides are linked in tasks, and sides that a task links at once.
BLOCK, CHAINED = 16, 50_000


def sides(rings: DataFrame, keep: list[str], ring: str = "ring") -> DataFrame:
    """keep, x0, y0, x1, y1: the sides of rings in their direction, those without length left out."""
    turn = F.explode(G._turns(ring)).alias("_side")
    rows = rings.where(F.size(ring) > 1).select(*keep, turn)
    out = rows.select(*keep, *[F.col(f"_side.{p}.{c}").alias(f"{c}{k}") for k, p in enumerate("pq") for c in "xy"])
    return out.where("x0 <> x1 or y0 <> y1")


def _uncut(pieces: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, x0, y0, x1, y1: sides of pieces (by, cx, cy, ring) less those that two cells have in opposite directions.

    On a line between cells the sides are intervals with a sign for their direction; where signs
    add up to none, nothing is left. Only sides within one cell's stretch of a line meet.
    """
    rows = sides(pieces, [*by, "cx", "cy"])

    def on(a: str, b: str, number: str) -> Column:
        low, high = F.col(number) * F.lit(cell), (F.col(number) + 1) * F.lit(cell)
        return (F.col(a) == F.col(b)) & ((F.col(a) == low) | (F.col(a) == high))

    upright, level = on("x0", "x1", "cx"), on("y0", "y1", "cy")
    inner = rows.where(~upright & ~level).select(*by, "x0", "y0", "x1", "y1")
    kept = []
    for found, at, along, cells in ((upright, "x", "y", "cy"), (~upright & level, "y", "x", "cx")):
        sign = F.when(F.col(f"{along}1") > F.col(f"{along}0"), 1).otherwise(-1)
        ends = F.explode(F.array(F.struct(F.col(f"{along}0").alias("_p"), F.lit(1).alias("_e")), F.struct(F.col(f"{along}1").alias("_p"), F.lit(-1).alias("_e")))).alias("_v")
        # A side of direction +1 begins at its first end, one of -1 ends there.
        marks = rows.where(found).select(*by, F.col(f"{at}0").alias("_line"), F.col(cells).alias("_stretch"), sign.alias("_sign"), ends)
        marks = marks.groupBy(*by, "_line", "_stretch", F.col("_v._p").alias("_p")).agg(F.sum(F.col("_v._e")).alias("_e"))
        order = Window.partitionBy(*by, "_line", "_stretch").orderBy("_p")
        runs = marks.withColumn("_n", F.sum("_e").over(order)).withColumn("_q", F.lead("_p").over(order)).where("_n <> 0")
        first, last = F.when(F.col("_n") > 0, F.col("_p")).otherwise(F.col("_q")), F.when(F.col("_n") > 0, F.col("_q")).otherwise(F.col("_p"))
        places = {f"{at}0": F.col("_line"), f"{at}1": F.col("_line"), f"{along}0": first, f"{along}1": last}
        kept.append(runs.select(*by, *[places[c].alias(c) for c in ("x0", "y0", "x1", "y1")]))
    return inner.union(kept[0]).union(kept[1])


def _chains(batches: Iterable[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """by, id (of a chain's first side), next (the side after its last; null: the first again), points (where its sides begin), for sides at hand together."""

    def solve(table: pa.Table) -> pa.Table:
        ids, following = table["id"].to_numpy(), table["next"].to_numpy()
        order = np.argsort(ids)
        place = np.minimum(np.searchsorted(ids, following, sorter=order), len(ids) - 1)
        to = np.where(ids[order[place]] == following, order[place], -1)
        led = np.zeros(len(ids), bool)
        led[to[to >= 0]] = True
        path, begin, seen, way = [], [], bytearray(len(ids)), to.tolist()
        for at in [*np.flatnonzero(~led).tolist(), *np.flatnonzero(led).tolist()]:
            if not seen[at]:
                begin.append(len(path))
                while at >= 0 and not seen[at]:
                    seen[at] = 1
                    path.append(at)
                    at = way[at]
        rows, first = np.array(path), np.array(begin)
        last = rows[np.append(first[1:], len(rows)) - 1]
        own = table.take(pa.array(rows[first]))
        xy = pa.StructArray.from_arrays([pa.array(table[c].to_numpy()[rows]) for c in ("x0", "y0")], ["x", "y"])
        points = pa.ListArray.from_arrays(pa.array(np.append(first, len(rows)).astype(np.int32)), xy)
        return pa.table({c: own[c] for c in [*by, "id"]} | {"next": pa.array(following[last], mask=to[last] >= 0), "points": points})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] * (batch.num_rows > 0)
        if sum(b.num_rows for b in held) >= CHAINED:
            yield from solve(pa.Table.from_batches(held).combine_chunks()).combine_chunks().to_batches()
            held = []
    if held:
        yield from solve(pa.Table.from_batches(held).combine_chunks()).combine_chunks().to_batches()


def linked(edges: DataFrame, by: list[str], cell: float) -> DataFrame:
    """by, ring: closed rings of directed sides (by, x0, y0, x1, y1) of which as many enter a point as leave it.

    A side that enters a point goes on with the one that comes next before it, counter-clockwise
    around the point, so rings that only touch stay apart; each side is gone on with once. Points
    on a straight line between their neighbours are left out. Blocks of BLOCK cells are linked in
    tasks, only their chains are linked across the plane.
    """
    own = settled(edges.withColumn("id", F.monotonically_increasing_id()))
    angle = lambda a, b: F.atan2(F.col(f"y{b}") - F.col(f"y{a}"), F.col(f"x{b}") - F.col(f"x{a}"))
    enters = own.select(*by, F.col("x1").alias("_vx"), F.col("y1").alias("_vy"), angle(1, 0).alias("_angle"), F.lit(-1).alias("_w"), "id", "x0", "y0")
    leaves = own.select(*by, F.col("x0").alias("_vx"), F.col("y0").alias("_vy"), angle(0, 1).alias("_angle"), F.lit(1).alias("_w"), "id", F.lit(None).cast("double"), F.lit(None).cast("double"))
    at = Window.partitionBy(*by, "_vx", "_vy")
    around = at.orderBy("_angle", F.col("_w").desc(), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = enters.union(leaves).withColumns({"_outs": F.sum((F.col("_w") > 0).cast("int")).over(around), "_ins": F.sum((F.col("_w") < 0).cast("int")).over(around)})
    # Counted from where fewest are open, the k-th to enter goes on with the k-th to leave.
    open_ = F.col("_outs") - F.col("_ins")
    least = F.col("_open") == F.col("_least")
    ends = ends.withColumn("_open", open_).withColumn("_least", F.min("_open").over(at))
    ends = ends.withColumns({"_n": F.max("_outs").over(at), "_outs0": F.max(F.when(least, F.col("_outs"))).over(at), "_ins0": F.max(F.when(least, F.col("_ins"))).over(at)})
    k = F.when(F.col("_w") > 0, F.pmod(F.col("_outs") - 1 - F.col("_outs0"), "_n")).otherwise(F.pmod(F.col("_ins") - 1 - F.col("_ins0"), "_n"))
    pairs = ends.withColumn("_k", k).groupBy(*by, "_vx", "_vy", "_k").agg(F.max(F.when(F.col("_w") < 0, F.col("id"))).alias("id"), F.max(F.when(F.col("_w") > 0, F.col("id"))).alias("next"), F.max("x0").alias("x0"), F.max("y0").alias("y0"))
    blocks = [F.floor(F.col(c) / (BLOCK * cell)).alias(f"_b{c}") for c in ("x0", "y0")]
    near = [*by, "_bx0", "_by0"]
    following = pairs.select(*by, "id", "next", "x0", "y0", *blocks).repartition(*near).sortWithinPartitions(*near).drop("_bx0", "_by0")
    kinds = "".join(f"`{c}` {edges.schema[c].dataType.simpleString()}, " for c in by)
    chains = settled(following.mapInArrow(lambda batches: _chains(batches, by), f"{kinds}id long, next long, points array<struct<x: double, y: double>>"))
    order = graph.rings(chains.where(F.col("next").isNotNull()), by)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "id"]]
    open_ = chains.where(F.col("next").isNotNull()).join(order.withColumnsRenamed({c: f"_{c}" for c in [*by, "id"]}), reduce(and_, on))
    joined = open_.groupBy(*by, "ring").agg(F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("k"), "points"))).alias("c"))
    whole = chains.where(F.col("next").isNull()).select(*by, F.col("points").alias("p")).union(joined.select(*by, F.flatten(F.col("c.points"))))
    n = F.size("p")
    at = lambda k: F.element_at("p", (F.pmod(k, n) + 1).cast("int"))

    def bends(p: Column, k: Column) -> Column:
        before, after = at(k - 1), at(k + 1)
        return F.abs((p["x"] - before["x"]) * (after["y"] - p["y"]) - (p["y"] - before["y"]) * (after["x"] - p["x"])) > 1e-9

    bent = F.filter("p", bends)
    return whole.select(*by, F.concat(bent, F.slice(bent, 1, 1)).alias("ring")).where(F.size("ring") > 3)


def dissolved(polygons: DataFrame, by: str, cell: float, kind: str = "union") -> DataFrame:
    """by, ring: whole outlines of a union, intersection or difference (see region_rings); outer rings counter-clockwise, holes clockwise."""
    return all_dissolved(polygons, by, cell, [kind]).drop("kind")


def all_dissolved(polygons: DataFrame, by: str, cell: float, kinds: list[str]) -> DataFrame:
    """by, kind, ring: as dissolved, of several kinds together."""
    own = [by, "kind"]
    return linked(_uncut(settled(spatial.all_rings(polygons, by, cell, kinds)), own, cell), own, cell)


def _beside(ring: str, distance: float, quarter: int) -> Column:
    """Rings to add to an outline that grows by a distance, or to take from one that shrinks.

    Of every side the rectangle on its right (left, if it shrinks), and where the outline turns
    away from it the sector between two rectangles, its arc in steps of a quarter turn / quarter.
    """
    points = F.slice(ring, 1, F.size(ring) - 1)
    n = F.size(ring) - 1
    at = lambda k: F.element_at(points, (F.pmod(k, n) + 1).cast("int"))
    hand = 1.0 if distance > 0 else -1.0
    radius = abs(distance)
    away = lambda p, q: F.atan2(q["y"] - p["y"], q["x"] - p["x"]) - hand * math.pi / 2
    off = lambda p, angle: G.point(p["x"] + radius * F.cos(angle), p["y"] + radius * F.sin(angle))

    def pieces(k: Column) -> Column:
        p, q, r = at(k), at(k + 1), at(k + 2)
        one, two = away(p, q), away(q, r)
        sweep = F.pmod(hand * (two - one), F.lit(2 * math.pi))
        many = F.greatest(F.ceil(sweep / (math.pi / 2 / quarter) - 1e-9), F.lit(1)).cast("int")
        arc = F.transform(F.sequence(F.lit(0), many), lambda j: off(q, one + hand * sweep * j / many))
        turns = ((q["x"] - p["x"]) * (r["y"] - q["y"]) - (q["y"] - p["y"]) * (r["x"] - q["x"])) * hand > 0
        corner = F.when(turns, F.concat(F.array(G.point(q["x"], q["y"])), arc)).otherwise(F.array().cast(G.RING))
        return F.array(F.array(G.point(p["x"], p["y"]), G.point(q["x"], q["y"]), off(q, one), off(p, one)), corner)

    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), pieces))


def buffered(polygons: DataFrame, key: str, distance: float, cell: float, quarter: int = 8, clean: bool = False) -> DataFrame:
    """key, ring: polygons (key, ring; holes are further rings of a key) grown by a distance, or shrunk by a negative one.

    Corners get round joins of 4 * quarter corners a circle. Rings are dissolved first, which
    repairs those that cross themselves: what they wind around an odd number of times is kept.
    A distance of 0 only repairs. clean: they are closed outlines already, holes clockwise.
    """
    named = lambda rows: rows.select(key, F.lit(False).alias("annotated"), F.lit(-1).cast("long").alias("polygon_id"), "ring")
    whole = polygons if clean else dissolved(named(polygons), key, cell)
    if not distance:
        return whole
    whole = whole if clean else settled(whole)
    own = named(whole)
    beside = whole.select(key, F.explode(_beside("ring", distance, quarter)).alias("ring")).where(F.size("ring") > 2)
    more = beside.select(key, F.lit(distance < 0), F.monotonically_increasing_id(), "ring")
    return dissolved(own.union(more), key, cell, "difference" if distance < 0 else "union")


def closed(polygons: DataFrame, key: str, distance: float, cell: float, quarter: int = 8) -> DataFrame:
    """key, ring: outlines smoothed by growing and shrinking them by a distance."""
    return buffered(settled(buffered(polygons, key, distance, cell, quarter)), key, -distance, cell, quarter, clean=True)


def _cross(ox, oy, ax, ay, bx, by) -> Column:
    ox, oy, ax, ay, bx, by = map(F.col, (ox, oy, ax, ay, bx, by))
    return (ax - ox) * (by - oy) - (ay - oy) * (bx - ox)


def _sides_meet(l: str, r: str) -> Column:  # noqa: E741
    """Whether two sides, whose boxes share a point, share one."""
    a = _cross(f"{l}x0", f"{l}y0", f"{l}x1", f"{l}y1", f"{r}x0", f"{r}y0")
    b = _cross(f"{l}x0", f"{l}y0", f"{l}x1", f"{l}y1", f"{r}x1", f"{r}y1")
    c = _cross(f"{r}x0", f"{r}y0", f"{r}x1", f"{r}y1", f"{l}x0", f"{l}y0")
    d = _cross(f"{r}x0", f"{r}y0", f"{r}x1", f"{r}y1", f"{l}x1", f"{l}y1")
    return (F.signum(a) * F.signum(b) <= 0) & (F.signum(c) * F.signum(d) <= 0)


def holds_point(ring, x, y) -> Column:
    """Whether a point is within a ring, by the sides to its right that it lies between."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    hits = F.filter(G._turns(ring), lambda s: ((s["p"]["y"] > y) != (s["q"]["y"] > y)) & (x < s["p"]["x"] + (y - s["p"]["y"]) / (s["q"]["y"] - s["p"]["y"]) * (s["q"]["x"] - s["p"]["x"])))
    return F.size(hits) % 2 == 1


def meeting(left: DataFrame, right: DataFrame, key: str, cell: float, by: list[str] = []) -> DataFrame:
    """by, l, r: keys of all pairs of rings (by, key, ring) that share a point, on their outlines or inside.

    Sides are dealt to the grid cells that their boxes touch and meet there, so a ring of any
    length is spread; of pairs without such sides, one ring may lie within the other.
    """
    def named(rows: DataFrame, p: str) -> DataFrame:
        cut = sides(rows.where(F.col("ring").isNotNull()), [*by, key])
        span = lambda c: F.explode(F.sequence(F.floor(F.least(f"{c}0", f"{c}1") / cell), F.floor(F.greatest(f"{c}0", f"{c}1") / cell)))
        dealt = cut.withColumn("cx", span("x")).withColumn("cy", span("y"))
        return dealt.select(*by, "cx", "cy", F.col(key).alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("x0", "y0", "x1", "y1")])

    over = [F.least(f"{a}_{c}0", f"{a}_{c}1") <= F.greatest(f"{b}_{c}0", f"{b}_{c}1") for c in "xy" for a, b in (("l", "r"), ("r", "l"))]
    near = named(left, "l").join(named(right, "r"), [*by, "cx", "cy"]).where(over[0] & over[1] & over[2] & over[3])
    crossing = near.where(_sides_meet("l_", "r_")).select(*by, "l", "r")

    def boxed(rows: DataFrame) -> DataFrame:
        b = G.bounds("ring")
        return rows.where(F.size("ring") > 2).select(*by, key, "ring", *[b[c].alias(c) for c in spatial.BOX])

    boxes = spatial.touching(boxed(left), boxed(right), cell, by)
    covers = lambda o, i: (F.col(f"{o}_x0") <= F.col(f"{i}_x0")) & (F.col(f"{o}_y0") <= F.col(f"{i}_y0")) & (F.col(f"{o}_x1") >= F.col(f"{i}_x1")) & (F.col(f"{o}_y1") >= F.col(f"{i}_y1"))
    first = lambda s: (F.col(f"{s}_ring")[0]["x"], F.col(f"{s}_ring")[0]["y"])
    within = boxes.where((covers("l", "r") & holds_point("l_ring", *first("r"))) | (covers("r", "l") & holds_point("r_ring", *first("l"))))
    return crossing.union(within.select(*by, F.col(f"l_{key}").alias("l"), F.col(f"r_{key}").alias("r"))).distinct()


def meeting_self(rings: DataFrame, key: str, cell: float, by: list[str] = []) -> DataFrame:
    """Each ring with `partners`, how many others share a point with it, and `others`, their keys in order."""
    pairs = meeting(rings, rings, key, cell, by).where(F.col("l") != F.col("r"))
    found = pairs.groupBy(F.col("l").alias(key)).agg(F.count(F.lit(1)).alias("partners"), F.sort_array(F.collect_list("r")).alias("others"))
    kind = rings.schema[key].dataType.simpleString()
    return rings.join(found, key, "left").withColumns({"partners": F.coalesce("partners", F.lit(0)), "others": F.coalesce("others", F.array().cast(f"array<{kind}>"))})
