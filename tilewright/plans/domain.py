"""The workload's tables bound to the given ones: tiles, pixels, boxes, logs and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 8
GRID = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tiles(spark, sf_dir) -> DataFrame:
    """tile_id, label, row, col, values: an 8 by 8 image for each embedding on a grid GRID tiles wide."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("tile_id"), "label", F.expr(f"vec_id div {GRID}").alias("row"), (F.col("vec_id") % GRID).alias("col"), F.col("embedding").cast("array<double>").alias("values"))


def pixels(spark, sf_dir) -> DataFrame:
    """tile_id, label, row, col, y, x, v."""
    t = tiles(spark, sf_dir).select("tile_id", "label", "row", "col", F.posexplode("values").alias("i", "v"))
    return t.select("tile_id", "label", "row", "col", F.expr(f"i div {SIDE}").cast("int").alias("y"), (F.col("i") % SIDE).cast("int").alias("x"), "v")


def reconstructed(spark, sf_dir) -> DataFrame:
    """Pixels with r, the mean image of the label, in place of a generator's output."""
    p = pixels(spark, sf_dir)
    mean = p.groupBy("label", "y", "x").agg(F.avg("v").alias("r"))
    return p.join(mean, ["label", "y", "x"])


def boxes(spark, sf_dir) -> DataFrame:
    """event_id, x0, y0, x1, y1 from events."""
    e = table(spark, sf_dir, "events")
    x, y = F.col("user_id") * 3, F.floor("value").cast("bigint")
    return e.select("event_id", "event_type", x.alias("x0"), y.alias("y0"), (x + 4).alias("x1"), (y + 6).alias("y1"))


def predictions(spark, sf_dir) -> DataFrame:
    """doc_id, score, truth: document length against its quality label."""
    d, q = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", F.col("n_chars").alias("score")).join(q.select("doc_id", F.col("quality").alias("truth")), "doc_id")


#: The same tables as DuckDB expressions.
TILES = "tiles AS (SELECT vec_id AS tile_id, label, vec_id // 32 AS \"row\", vec_id % 32 AS col, embedding FROM embeddings)"
PIXELS = TILES + ', pixels AS (SELECT tile_id, label, "row", col, ((i - 1) // 8)::INTEGER AS y, ((i - 1) % 8)::INTEGER AS x, embedding[i]::DOUBLE AS v FROM tiles, (SELECT unnest(range(1, 65)) AS i))'
RECONSTRUCTED = PIXELS + ", means AS (SELECT label, y, x, avg(v) AS r FROM pixels GROUP BY ALL), rec AS (SELECT * FROM pixels JOIN means USING (label, y, x))"
BOXES = "boxes AS (SELECT event_id, event_type, user_id * 3 AS x0, floor(value)::BIGINT AS y0, user_id * 3 + 4 AS x1, floor(value)::BIGINT + 6 AS y1 FROM events)"
PREDICTIONS = "pred AS (SELECT doc_id, n_chars AS score, quality AS truth FROM documents JOIN labels USING (doc_id))"


def digest_unit(name: str, *parts: str) -> str:
    """SQL of scalars.digest_unit."""
    text = " || ':' || ".join([f"'{name}'", *[f"{p}::VARCHAR" for p in parts]])
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
