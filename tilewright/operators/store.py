"""Tables keyed by slide: create, insert where absent, delete and insert again, partitions by hash.

Parquet has neither MERGE nor DELETE; both become joins, and a partition is replaced by
dynamic overwrite, so a repeated run leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import RING
from ..functions.fingerprint import partition_number
from ..functions.scalars import metres
from ..session import settled

#: Fixed values.
SLIDE_TYPES = {"SKIN": 0, "COLON": 1, "LUNG": 2}
PARTITIONS = 4000


def _field(name: str, kind: T.DataType, null: bool = True) -> T.StructField:
    return T.StructField(name, kind, null)


SLIDES = T.StructType([_field("slide_uuid", T.StringType(), False), _field("slide_type", T.IntegerType(), False), _field("microns_per_pixel", T.DoubleType()), _field("x_dimension", T.DoubleType()), _field("y_dimension", T.DoubleType())])
ANOMALY_POLYGONS = T.StructType([_field("slide_uuid", T.StringType(), False), _field("partition_number", T.LongType(), False), _field("segment", RING, False)])
NUCLEAR_POLYGONS = T.StructType([_field("slide_uuid", T.StringType(), False), _field("partition_number", T.LongType(), False), _field("centroid", RING.elementType), _field("diameter", T.DoubleType()), _field("is_tumor", T.BooleanType())])


def create_tables(spark: SparkSession, database: str = "default", drop: bool = False) -> list[str]:
    """slides, anomaly_polygons and nuclear_polygons, the latter two partitioned by partition_number."""
    made = []
    for name, schema in (("slides", SLIDES), ("anomaly_polygons", ANOMALY_POLYGONS), ("nuclear_polygons", NUCLEAR_POLYGONS)):
        table = f"{database}.{name}"
        if drop:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
        part = " PARTITIONED BY (partition_number)" if "partition_number" in schema.names else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{part}")
        made.append(table)
    return made


def with_partition(rows: DataFrame, key: str = "slide_uuid") -> DataFrame:
    return rows.withColumn("partition_number", partition_number(key, PARTITIONS))


def insert_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """`target` and a row of `source` for each key that it lacks: of several the least, column by column. A null key is absent, once."""
    old = target.select(F.col(key).alias("_old")).distinct()
    new = source.select(F.struct(*target.columns).alias("_row"), F.col(key).alias("_new")).join(old, F.col("_new").eqNullSafe(F.col("_old")), "left_anti")
    return target.unionByName(new.groupBy("_new").agg(F.min("_row").alias("_row")).select("_row.*"))


def checked(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """`rows`; a job that meets a row for which a rule isn't true fails with the rule's name, so a write commits nothing."""
    broken = F.concat_ws(", ", *[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    fail = F.raise_error(F.concat(F.lit("a row breaks: "), broken)).cast("boolean")
    return rows.where(F.when(broken == "", F.lit(True)).otherwise(fail))


def polygon_rules(schema: T.StructType) -> dict[str, Column]:
    """What rows of a table of polygons must meet: its columns that may not be null aren't, numbers are finite, rings have three points or more."""
    out = {f"{f.name} is null": F.col(f.name).isNotNull() for f in schema if not f.nullable}
    for f in schema:
        if isinstance(f.dataType, T.DoubleType):
            out[f"{f.name} is not finite"] = F.col(f.name).isNull() | (F.abs(f.name) < float("inf"))
        elif isinstance(f.dataType, T.ArrayType):
            out[f"{f.name} is no ring"] = (F.size(f.name) > 2) & F.forall(f.name, lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))
    return out


def delete_insert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """`target` without the keys of `source`, and `source`: the same however often it is done."""
    return target.join(source.select(key).distinct(), key, "left_anti").unionByName(source.select(*target.columns))


def replace_slides(rows: DataFrame, path: str, key: str = "slide_uuid") -> None:
    """Write rows into their partitions of a Parquet table, in place of older rows of the same slides."""
    spark = rows.sparkSession
    rows = with_partition(rows, key)
    try:
        old = spark.read.schema(rows.schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows.write.partitionBy("partition_number").parquet(path)
        return
    parts = [r[0] for r in rows.select("partition_number").distinct().limit(PARTITIONS).collect()]
    kept = old.where(F.col("partition_number").isin(parts))
    kept = kept.join(rows.select(key).distinct(), key, "left_anti").select(*rows.columns)
    whole = settled(kept.unionByName(rows))  # the partitions are read and then replaced
    whole.sortWithinPartitions(key).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("partition_number").parquet(path)


def anomaly_rows(polygons: DataFrame, microns_per_pixel: float) -> DataFrame:
    """slide_uuid, partition_number, segment in metres."""
    ring = F.transform("ring", lambda p: F.struct(metres(p["x"], F.lit(microns_per_pixel)).alias("x"), metres(p["y"], F.lit(microns_per_pixel)).alias("y")))
    return with_partition(polygons.select("slide_uuid", ring.alias("segment"))).select(*ANOMALY_POLYGONS.names)


def nuclei_rows(polygons: DataFrame, microns_per_pixel: float, least: float = 7.0e-6) -> DataFrame:
    """slide_uuid, partition_number, centroid, diameter (metres), is_tumor: wider than `least`."""
    from ..functions.geometry import centroid, rotated_dimensions

    c = centroid("ring")
    mpp = F.lit(microns_per_pixel)
    rows = polygons.withColumns({"centroid": F.struct(metres(c["x"], mpp).alias("x"), metres(c["y"], mpp).alias("y")), "diameter": metres(rotated_dimensions("ring")["max_dim"], mpp)})
    return with_partition(rows.withColumn("is_tumor", F.col("diameter") > least)).select(*NUCLEAR_POLYGONS.names)
