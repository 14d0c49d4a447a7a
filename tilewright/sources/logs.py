"""Training logs: JSON arrays of steps, named loss_logs_growth_{g}_epoch_{e}_epoch_step_{s}.json; every value is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import row_before

SCHEMA = "global_step string, growth_step string, epoch_step string, `steps/sec` string, datetime_utc string, block_idx string, growth_idx string, epoch_idx string, losses map<string,string>"
NAME = r"growth_(\d+)_epoch_(\d+)_epoch_step_(\d+)"


def read(spark: SparkSession, path: str) -> DataFrame:
    """growth, epoch, epoch_step (of the file), global_step and losses, in order of these."""
    rows = spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("_f", F.input_file_name())
    part = [F.regexp_extract("_f", NAME, k).cast("long").alias(n) for k, n in ((1, "growth"), (2, "epoch"), (3, "file_step"))]
    return rows.select(*part, F.col("global_step").cast("long").alias("global_step"), F.col("steps/sec").cast("double").alias("rate"), "losses").orderBy("growth", "epoch", "file_step", "global_step")


def flatten(rows: DataFrame, names: list[str], losses: str = "losses") -> DataFrame:
    """Named losses as columns of doubles; text that isn't a number is null."""
    return rows.withColumns({n: F.try_element_at(F.col(losses), F.lit(n)).try_cast("double") for n in names}).drop(losses)


def write(rows: DataFrame, path: str, every: int) -> None:
    """Every `every`-th step of (global_step, losses as columns of numbers) as JSON lines of text values."""
    names = [c for c in rows.columns if c != "global_step"]
    rows = rows.where(F.col("global_step") % every == 0)
    losses = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    rows.select(F.col("global_step").cast("string").alias("global_step"), losses.alias("losses")).write.mode("overwrite").json(path)


def rates(rows: DataFrame, at: str, by: list[str], order: list[str], steps: int) -> DataFrame:
    """rate: steps over the seconds since the row before; null for the first, and for no time passed. `order` begins with `at`; rows of one hour meet in one task."""
    now = F.unix_micros(F.col(at).cast("timestamp"))
    gap = now - F.col("_since")
    rows = row_before(rows, now, order, by, F.date_trunc("hour", F.col(at).cast("timestamp")), "_since")
    return rows.withColumn("rate", F.lit(float(steps)) / F.when(gap != 0, gap) * 1000000).drop("_since")
