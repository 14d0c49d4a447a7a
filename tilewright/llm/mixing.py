"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an Efraimidis-Spirakis key, an exponential variate over its quality
weight, from a digest of its id; smaller keys are drawn first. A source whose target is q
times its size plus a rest gives q complete epochs and then, by key order, documents whose
prefix sum reaches the rest. Keys are spread evenly over buckets of the unit interval, so
prefix sums run within (source, bucket) and start from the sums of earlier buckets: no task
ever holds a whole source. The number of buckets grows with the table. Texts are read once;
what is kept of them, id, source and size, is written to the shared folder.

Cases: a null text has size 0 and takes part with taken 0. A null source is a source of its
own and last in order. Repeated rows are drawn on their own. An empty table gives no rows.
A very long text is one row whose size counts whole. `mix` reads `doc_id`, `text` and `source`
alone; `mixed_documents` returns all columns, whatever their names. A missing quality weight
counts as 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
#: About so many documents in one of a source's buckets if they were all of that source.
BUCKET_DOCS = 20_000


def unit(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(4503599627370496.0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target: shares of the total by weight, held at `cap` times the source's size, the rest shared again.

    With sources in order of cap over weight, those held at their cap are a prefix; the level
    of the others is (total - their caps) / (remaining weight), and the prefix ends at the
    first source whose own cap is not below the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("bigint"))
    everything = Window.partitionBy()
    rank = Window.orderBy((F.col("source_size") * cap / F.col("w")), F.col("source").isNull(), F.col("source"))
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(everything)).withColumn("total_w", F.sum("w").over(everything))
    per = per.withColumn("held", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))).withColumn("held_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
    per = per.withColumn("level", (F.col("total") - F.col("held")).cast("double") / (F.col("total_w") - F.col("held_w")).cast("double"))
    own = (F.col("source_size") * cap).cast("double")
    free = F.when(own >= F.col("w") * F.col("level"), F.struct(F.col("source_size") * cap / F.col("w"), F.col("level")))
    per = per.withColumn("final", F.min(free).over(everything)["level"])
    return per.select("source", "source_size", F.coalesce(F.least(own, F.col("w") * F.col("final")), own).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, quality: DataFrame | None = None, seed: str = SEED, bucket_docs: int = BUCKET_DOCS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, and the columns `keep`, whose names must be none of the others.

    quality: doc_id and weight (positive); the first weight of an id counts. A document is in
    the rest of its source when the middle of its words, in key order, lies within the rest.
    """
    rows = stored(docs.select("doc_id", "source", *keep, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")))
    buckets = -(-rows.count() // bucket_docs)
    targets = source_targets(rows, weights, cap)
    if quality is not None:
        weight = quality.groupBy("doc_id").agg(F.max("weight").alias("weight"))
        rows = rows.join(weight, "doc_id", "left").withColumn("weight", F.coalesce(F.col("weight"), F.lit(1.0)))
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    # The smallest keys come first; 1 - u**(1/weight) rises with the key and lies in (0, 1).
    rows = rows.withColumn("key", -F.log(unit(F.col("doc_id"), seed)) / F.col("weight"))
    rows = rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * buckets), F.lit(buckets - 1)).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("here"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    sums = sums.select(F.col("source").alias("k_source"), F.col("bucket").alias("k_bucket"), "base")
    targets = targets.withColumnRenamed("source", "t_source")
    known = sums.join(targets, F.col("k_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rows = rows.join(known, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("bucket") == F.col("k_bucket")))
    within = Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.col("base") + F.sum("size").over(within))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.col("target") - epochs * F.col("source_size")
    chosen = (F.col("upto") - F.col("size") / F.lit(2.0) < rest) & (epochs < cap)
    rows = rows.withColumn("copies", (epochs + chosen.cast("bigint")))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), *keep)


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """The rows of `docs` with each repeated as often as the mix takes that row, whatever its id.

    Rows are numbered and written to the shared folder first, so that a number stays with its row.
    """
    row, copies, copy = (free_name(docs, x) for x in ("mix_row", "mix_copies", "mix_copy"))
    tagged = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    plan = mix(tagged.select("doc_id", "text", "source", F.col(row).alias("_row")), quality=quality, keep=("_row",)).where("copies > 0")
    kept = tagged.join(plan.select(F.col("_row").alias(row), F.col("copies").alias(copies)), row)
    return kept.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight: 1.0 where labelled good, 0.5 where labelled bad."""
    return labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select("doc_id", F.when(F.col("quality") >= 1, 1.0).otherwise(0.5).alias("weight"))


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), quality=quality_weights(labels))
    return out.select("doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"), F.col("target").cast("double"), F.col("taken").cast("long"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), q AS (
  SELECT doc_id, max(CASE WHEN quality >= 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS weight
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total, (sum(w) OVER ())::BIGINT AS total_w,
         coalesce(sum(source_size * 3) OVER r, 0)::BIGINT AS held, coalesce(sum(w) OVER r, 0)::BIGINT AS held_w
  FROM s WINDOW r AS (ORDER BY (source_size * 3)::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (total - held)::DOUBLE / (total_w - held_w)::DOUBLE AS level FROM c
), f AS (
  SELECT *, (SELECT level FROM l WHERE (source_size * 3)::DOUBLE >= w * level ORDER BY (source_size * 3)::DOUBLE / w, level LIMIT 1) AS final FROM l
), t AS (
  SELECT source, source_size, coalesce(least((source_size * 3)::DOUBLE, w * final), (source_size * 3)::DOUBLE) AS target FROM f
), k AS (
  SELECT d.*, t.source_size, t.target,
         -ln((('0x' || substr(md5('mix-1:' || d.doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(q.weight, 1.0) AS key
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON d.doc_id = q.doc_id
), u AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS upto,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM k
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto - size / 2.0::DOUBLE < target - epochs * source_size AND epochs < 3 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM u
"""
