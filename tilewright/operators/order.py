"""Running results along an order, without a task that holds everything under one key.

`bucket` is a column that never falls along the order, such as the hour of a time. Rows of one
bucket meet in one task; buckets meet each other only as one row each, with their totals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_states(rows: DataFrame, by: list[str], bucket: str, own: Column, carried) -> DataFrame:
    """rows with _carried: `carried` (a function of a column and a window over the buckets before) of the aggregate `own`; keys may be null."""
    keys = [*by, bucket]
    states = rows.groupBy(*keys).agg(own.alias("_own"))
    along = Window.partitionBy(*by).orderBy(bucket)
    states = states.select(*[F.col(c).alias(f"_at_{i}") for i, c in enumerate(keys)], carried("_own", along).alias("_carried"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_at_{i}")) for i, c in enumerate(keys)])
    return rows.join(states, same).drop(*[f"_at_{i}" for i in range(len(keys))])


def positions(rows: DataFrame, order: list[str], by: list[str], bucket: Column, out: str) -> DataFrame:
    """out: the place of each row, from 0, among those of its `by`."""
    before = lambda c, along: F.coalesce(F.sum(c).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = bucket_states(rows.withColumn("_bucket", bucket), by, "_bucket", F.count(F.lit(1)), before)
    here = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order)) - 1
    return rows.withColumn(out, F.col("_carried") + here).drop("_bucket", "_carried")


def row_before(rows: DataFrame, value: Column, order: list[str], by: list[str], bucket: Column, out: str) -> DataFrame:
    """out: `value` of the row before, null for the first."""
    rows = rows.withColumns({"_bucket": bucket, "_value": value})
    rows = bucket_states(rows, by, "_bucket", F.max_by("_value", F.struct(*order)), lambda c, along: F.lag(c).over(along))
    here = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return rows.withColumn(out, F.when(F.row_number().over(here) == 1, F.col("_carried")).otherwise(F.lag("_value").over(here))).drop("_bucket", "_value", "_carried")
