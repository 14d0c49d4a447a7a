"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir; only where it is unset and there is but one machine, as in tests, a temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))


def free_name(rows: DataFrame, name: str) -> str:
    """`name`, with underscores until no column of `rows` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(rows: DataFrame) -> DataFrame:
    """`rows` computed once and kept in the shared folder."""
    checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every end of an edge; edges: a, b (long, no nulls).

    Alternating steps on edges (larger, smaller): the smaller end of every edge gives way to
    its own least neighbour, then all smaller neighbours of a node but the least, and the node
    itself, point to the least. Edges end as stars. Only minima are gathered for a node, and
    those that a hub's edges meet are written first, so that the join with them is one the
    engine can split.
    """
    now = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        low = settled(now.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low")))
        large = now.join(low, F.col("b") == F.col("n"), "left").select("a", F.coalesce("low", "b").alias("b")).repartition("a")
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        small = large.join(low, F.col("a") == F.col("n")).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
        now = settled(small.distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def stored(rows: DataFrame) -> DataFrame:
    """`rows` written as Parquet in the shared folder and read again; for wide rows, smaller than a checkpoint."""
    spark = rows.sparkSession
    checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stored-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
