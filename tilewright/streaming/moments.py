"""Running means and covariances of a stream, kept as one merged state.

Each micro-batch is one aggregation, merged with the state that the batch before left and
written under the batch's number. A batch that is run again starts from the same state and
replaces its own; only the newest few states stay, so what is kept doesn't grow with the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.stats import merge_moments, moments


def _whole(spark: SparkSession, states: str) -> tuple[object, dict[int, object]]:
    """The file system, and the paths of all states written to their end, by number of batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(states)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for entry in files.listStatus(folder) if files.exists(folder) else []:
        path = entry.getPath()
        if path.getName().startswith("batch=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            found[int(path.getName()[6:])] = path
    return files, found


def keep(stream: DataFrame, columns: list[str], by: list[str], states: str, checkpoint: str, once: bool = True, max_to_keep: int = 5) -> StreamingQuery:
    """Keep the moments of a stream (Parquet, a folder for each of the last batches); once: all that is there, then stop.

    A null key of `by` is a group of its own; a batch without rows leaves the state as it is.
    """
    if max_to_keep < 2:
        raise ValueError("keep two states or more: a batch that is run again needs the one before")

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = moments(batch, columns, by)
        before = [n for n in _whole(spark, states)[1] if n < number]
        if before:
            last = spark.read.schema(own.schema).parquet(f"{states}/batch={max(before)}")
            own = merge_moments(last.unionByName(own), columns, by)
        own.coalesce(1).write.mode("overwrite").parquet(f"{states}/batch={number}")
        files, found = _whole(spark, states)
        for n in sorted(found)[:-max_to_keep]:
            files.delete(found[n], True)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, columns: list[str], by: list[str], states: str) -> DataFrame:
    """The moments of all rows seen so far; columns and by as they were kept."""
    found = _whole(spark, states)[1]
    if not found:
        raise ValueError(f"no state in {states}")
    return spark.read.parquet(f"{states}/batch={max(found)}")
