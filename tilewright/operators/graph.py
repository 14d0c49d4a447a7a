"""Graphs too large for one task: components by contraction, and rings linked by pointer jumping.

Nodes are longs, within equal `by` columns. Groups of up to SMALL rows are each solved in a
task; of larger ones every round is a few equality joins, kept in the checkpoint folder, and no
task holds more than Spark's share of the edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled

SMALL = 50_000


def total(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def _follow(rows: DataFrame, by: list[str], column: str, way: DataFrame) -> DataFrame:
    """`column` replaced by where `way` (by, id, to) sends it, if anywhere."""
    step = way.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("id").alias("_id"), F.col("to").alias("_to"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col(column) == F.col("_id")]
    return rows.join(step, on, "left").withColumn(column, F.coalesce("_to", column)).select(*rows.columns)


def _by_size(rows: DataFrame, by: list[str], small, large) -> DataFrame:
    """small(rows of groups of up to SMALL rows) and large(rows of the others), united."""
    sizes = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count(F.lit(1)).alias("_rows"))
    many = settled(sizes.where(F.col("_rows") > SMALL))
    if many.isEmpty():
        return small(rows)
    if not by:
        return large(rows)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return small(rows.join(many, on, "left_anti")).union(large(rows.join(many, on, "left_semi")))


def _in_tasks(rows: DataFrame, by: list[str], solve, columns: list[str]) -> DataFrame:
    """by and `columns` (longs) as solve(table) gives them for each group."""
    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in by)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = solve(table)
        own = {c: pa.array([v.as_py()] * len(found[0]), v.type) for c, v in zip(by, key)}
        return pa.table(own | dict(zip(columns, found)))

    dealt = rows if by else rows.withColumn("_all", F.lit(0))
    return dealt.groupBy(*(by or ["_all"])).applyInArrow(run, kinds + ", ".join(f"{c} long" for c in columns))


def _components(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    a, b = table["a"].to_numpy(), table["b"].to_numpy()
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(nxt, end, low)
        nxt = nxt[nxt]
        if (nxt == root).all():
            return ids, ids[root]
        root = nxt


def _rings(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, following = table["id"].to_numpy(), table["next"].to_numpy()
    order = np.argsort(ids)
    to = order[np.searchsorted(ids, following, sorter=order)]
    ring, left, seen = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    for first in order.tolist():
        if not seen[first]:
            path = []
            at = first
            while not seen[at]:
                seen[at] = True
                path.append(at)
                at = to[at]
            if at != first:
                raise ValueError("every part must be the next of exactly one")
            ring[path], left[path] = ids[first], np.arange(len(path), 0, -1)
    return ids, ring, left


def components(edges: DataFrame, by: list[str] = []) -> DataFrame:
    """by, id, component (the least node reachable) of every node of an edge to another; edges: by, a, b.

    In large groups every node points to its least neighbour, or to itself; pointers are doubled
    until they end; the edges left between their ends make the next graph, of half the nodes or fewer.
    """
    rows = settled(edges.where("a <> b").select(*by, "a", "b").distinct())
    return _by_size(rows, by, lambda x: _in_tasks(x, by, _components, ["id", "component"]), lambda x: _contracted(x, by))


def _contracted(now: DataFrame, by: list[str]) -> DataFrame:
    now, found = settled(now), None
    while True:
        ends = now.select(*by, F.col("a").alias("id"), F.col("b").alias("to")).union(now.select(*by, F.col("b").alias("id"), F.col("a").alias("to")))
        up = settled(ends.groupBy(*by, "id").agg(F.least("id", F.min("to")).alias("to")))
        while True:
            nxt = settled(_follow(up, by, "to", up))
            moved = nxt.agg(total("to")).first() != up.agg(total("to")).first()  # ends only fall
            up = nxt
            if not moved:
                break
        found = up.withColumnRenamed("to", "component") if found is None else settled(_follow(found, by, "component", up))
        now = settled(_follow(_follow(now, by, "a", up), by, "b", up).where("a <> b").distinct())
        if now.isEmpty():
            return found


def rings(parts: DataFrame, by: list[str] = []) -> DataFrame:
    """by, id, ring (the least id on it), left (steps until the ring's first part comes again, all of them for that part itself).

    parts: by, id, next, each the next of exactly one. In large groups doubled pointers carry the
    least id of twice as many parts every round, then the number of steps.
    """
    rows = settled(parts.select(*by, "id", "next"))
    return _by_size(rows, by, lambda x: _in_tasks(x, by, _rings, ["id", "ring", "left"]), lambda x: _doubled(x, by))


def _doubled(parts: DataFrame, by: list[str]) -> DataFrame:
    names = [*by, "id"]

    def ahead(rows: DataFrame, to: str, *columns: str) -> DataFrame:
        other = rows.select(*[F.col(c).alias(f"_{c}") for c in [*names, *columns]])
        return rows.join(other, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col(to) == F.col("_id")], "left")

    now = settled(parts.select(*names, F.col("next").alias("to"), F.col("id").alias("ring")))
    while True:
        nxt = settled(ahead(now, "to", "to", "ring").select(*names, F.col("_to").alias("to"), F.least("ring", "_ring").alias("ring")))  # least passes over nulls
        same = nxt.agg(total("ring")).first() == now.agg(total("ring")).first()  # least ids only fall
        now = nxt
        if same:
            break
    own = now.select(*[F.col(c).alias(f"_{c}") for c in names], F.col("ring").alias("_ring"))
    begun = parts.select(*names, "next").join(own, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("id") == F.col("_id")])
    now = settled(begun.select(*names, F.col("_ring").alias("ring"), F.when(F.col("next") != F.col("_ring"), F.col("next")).alias("to"), F.lit(1).cast("long").alias("left")))
    rounds = parts.count().bit_length() + 1
    while not now.where("to is not null").isEmpty():
        if not rounds:
            raise ValueError("every part must be the next of exactly one")
        rounds -= 1
        now = settled(ahead(now, "to", "to", "left").select(*names, "ring", F.col("_to").alias("to"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left")))
    return now.select(*names, "ring", "left")
