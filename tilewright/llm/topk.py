"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become whole numbers. Candidates are sorted into buckets of near-equal length (range
partitions of the norm), each packed into one row with its longest length; queries are packed
into blocks with the least length that any of them still needs, which is its bound, a score
that k candidates are known to reach, over its own length. Buckets are visited in rounds of
falling length, each GROWTH times as many as before, and every round raises the bounds. A
block and a bucket that is too short for it don't meet: that test is the join's condition, so
such a pair never leaves the JVM. In a pair that meets, a query prunes on its own: if its
bound needs a longer candidate it skips the bucket; else the bound gives a least cosine for
this bucket. If that is high, candidates must have the query's strongest coordinate within a
feasible range; if not, candidates are cut by length alone. What is left is verified by exact
products. A pair returns k rows for each query at most.

Blocks and buckets have a fixed size, so memory doesn't depend on the table; the pairs of
packed rows are a stated query set against all rows, in blocks.

Products are taken as doubles where these are exact (lengths whose product is below 2**52);
else the doubles' error bound picks the rows to verify with whole numbers of any size.

Cases: null vectors, vectors with a null or non-finite part, or one that isn't finite once
scaled, and rows with a null id take no part; of vectors whose dimension differs from the most
common one, likewise. Large finite parts do; a score beyond a long is given, and ranked, as
the nearest long. Equal scores go to the smaller id. Repeated ids: a query never meets rows of
its own id; each repeated row is a candidate, and a repeated query has the ranks of one. An
empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import settled

SCALE = 256
TOP = 5
EVERY = 50
#: Candidates of one bucket, queries of one block.
BUCKET = 4096
BLOCK = 512
#: Buckets of a round over those of the round before.
GROWTH = 8
#: Least cosine from which coordinates prune more than they cost.
COSINE = 0.5
#: Below this product of lengths, doubles are exact.
SURE = 2.0**52
LARGEST = 1.7e308
LONG = (1 << 63) - 1


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole numbers, as doubles), norm of the usable rows."""
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < F.lit(float("inf"))))
    whole = lambda x: F.when(F.abs(x) < F.lit(SURE), F.floor(x).cast("double")).otherwise(x)
    rows = vectors.select("vec_id", "embedding").where(usable).select("vec_id", F.transform("embedding", lambda x: whole(x.cast("double") * scale)).alias("v"))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d"))["d"].alias("d"))
    rows = rows.join(F.broadcast(common), F.size("v") == F.col("d")).drop("d")
    rows = rows.withColumn("most", F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0.0)))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most")))
    return rows.select("vec_id", "v", F.when(F.col("most") > 0, F.least(F.col("most") * F.sqrt(squares), F.lit(LARGEST))).otherwise(0.0).alias("norm"))


def _flat(part: pa.RecordBatch) -> bytes:
    return part.column(1).flatten().to_numpy().astype("<f8").tobytes()


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BUCKET):
            part = batch.slice(first, BUCKET)
            ids, longest = part.column(0).to_numpy().astype("<i8"), float(part.column(2).to_numpy().max())
            yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([_flat(part)], pa.binary()), pa.array([longest])], names=["ids", "vals", "longest"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            ids, bounds, need = (part.column(k).to_numpy() for k in (0, 2, 3))
            arrays = [pa.array([x], pa.binary()) for x in (ids.astype("<i8").tobytes(), _flat(part), bounds.astype("<f8").tobytes())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([float(need.min())])], names=["q_ids", "q_vals", "bounds", "need"])


def _unpack(ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    return own, np.frombuffer(values, "<f8").reshape(len(own), -1)


def lengths(v: np.ndarray) -> np.ndarray:
    most = np.abs(v).max(axis=1, initial=0.0)
    share = v / np.where(most > 0, most, 1.0)[:, None]
    with np.errstate(over="ignore"):
        return np.minimum(most * np.sqrt((share * share).sum(axis=1)), LARGEST)


def best(scores: np.ndarray, q: np.ndarray, v: np.ndarray, reach: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k largest products of q and rows of v; of equals, of the smaller ids.

    scores: the products as doubles; reach: products of the lengths.
    """
    wide = reach >= SURE
    with np.errstate(invalid="ignore", over="ignore"):
        error = np.where(wide, reach * (len(q) * 2.0**-51), 0.0)
        known = np.isfinite(scores)
        low = np.where(known, np.clip(scores - error, -LONG, LONG), -np.inf)
        high = np.where(known, np.clip(scores + error, -LONG, LONG), np.inf)
    cut = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
    some = np.flatnonzero(high >= cut)
    exact = np.zeros(len(some), dtype=np.int64)
    narrow = ~wide[some]
    exact[narrow] = scores[some[narrow]].astype(np.int64)
    parts = [int(x) for x in q] if wide.any() else []
    for j in np.flatnonzero(~narrow).tolist():
        exact[j] = max(-LONG, min(LONG, sum(a * int(b) for a, b in zip(parts, v[some[j]]))))
    order = np.lexsort((ids[some], -exact))[:k]
    return some[order], exact[order]


def search_bucket(q_ids, q, bounds, ids, v, top: int = TOP):
    """(query, id, score) of the up to `top` best of a bucket for every query that it can matter to.

    bounds: for each query a score that `top` candidates are known to reach; smaller ones can't count.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    norms = lengths(v)
    order = np.argsort(-norms, kind="stable")
    ids, v, norms = ids[order], v[order], norms[order]
    longest = norms[0] if len(norms) else 0.0
    q_norm = lengths(q)

    def verify(k: int, some: np.ndarray, scores: np.ndarray) -> None:
        other = ids[some] != q_ids[k]
        some, scores = some[other], scores[other]
        if len(some):
            at, exact = best(scores, q[k], v[some], norms[some] * q_norm[k], ids[some], top)
            good = exact >= bounds[k]
            out.append((np.full(int(good.sum()), q_ids[k]), ids[some[at[good]]], exact[good]))

    with np.errstate(over="ignore", invalid="ignore"):
        alive = (q_norm * longest * (1 + 1e-12) >= bounds) & (len(norms) > 0)
        cosine = np.where(alive & (bounds > 0), bounds / np.maximum(q_norm * longest, 1e-300), 0.0)
        sharp = alive & (cosine > COSINE)
        plain = np.flatnonzero(alive & ~sharp)
        if len(plain):
            # By length: every candidate as long as the weakest of these queries needs.
            need = (bounds[plain] / np.maximum(q_norm[plain], 1e-300)).min()
            many = int(np.searchsorted(-norms, -need * (1 - 1e-12), side="right")) if need > 0 else len(norms)
            scores = q[plain] @ v[:many].T
            for row, k in zip(scores, plain.tolist()):
                verify(k, np.arange(many), row)
        for k in np.flatnonzero(sharp).tolist():
            # By coordinate: with q and x of unit length and q.x >= t, x_f lies within t q_f -+ sqrt((1 - t t)(1 - q_f q_f)).
            t, f = min(cosine[k], 1.0), int(np.argmax(np.abs(q[k])))
            part = q[k, f] / q_norm[k]
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - part * part)))
            high = 1.0 if part >= t else t * part + spread
            low = -1.0 if part <= -t else t * part - spread
            x = v[:, f] / np.maximum(norms, 1e-300)
            some = np.flatnonzero((x >= low - 1e-9) & (x <= high + 1e-9) & (norms * q_norm[k] * (1 + 1e-12) >= bounds[k]))
            if len(some):
                verify(k, some, v[some] @ q[k])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _first_lengths(vectors: DataFrame, n: int) -> list[float]:
    """Lengths at which rounds begin, falling; n: rows."""
    shares, size, done = [], BUCKET, BUCKET
    while done < n:
        shares.append(1.0 - done / n)
        size *= GROWTH
        done += size
    if not shares:
        return []
    return vectors.agg(F.percentile_approx("norm", shares, 10000)).first()[0]


def top_products(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of `queries` against `vectors`, both as integers() gives them."""
    n = vectors.count()
    starts = _first_lengths(vectors, n)
    # Pairs of partitions are tasks: no more partitions than full buckets and blocks take.
    sorted_ = vectors.repartitionByRange(F.col("norm").desc()).sortWithinPartitions(F.col("norm").desc()).coalesce(max(1, -(-n // BUCKET)))
    packed = sorted_.mapInArrow(_buckets, "ids binary, vals binary, longest double")
    buckets = settled(packed.withColumn("round", sum((F.when(F.col("longest") < x, 1).otherwise(0) for x in starts), F.lit(0))))
    queries = queries.dropDuplicates(["vec_id"])
    parts = max(1, -(-queries.count() // (4 * BLOCK)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vals, q_ids, q_vals, bounds in zip(*(c.to_pylist() for c in batch.columns)):
                own, q = _unpack(q_ids, q_vals)
                a, b, s = search_bucket(own, q, np.frombuffer(bounds, "<f8"), *_unpack(ids, vals), top)
                yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(s)], names=["query_id", "vec_id", "score"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    known = None
    for turn in range(len(starts) + 1):
        if known is None:
            asked = queries.select("vec_id", "v", F.lit(float("-inf")).alias("bound"), F.lit(0.0).alias("need"))
        else:
            kth = known.where(F.col("rank") == top).select(F.col("query_id").alias("k_id"), F.col("score").cast("double").alias("bound"))
            kth = kth.withColumn("bound", F.when(F.abs("bound") >= SURE, F.col("bound") - F.abs("bound") * 2.0**-51).otherwise(F.col("bound")))  # a long may have been rounded up
            asked = queries.join(kth, F.col("vec_id") == F.col("k_id"), "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
            need = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm")).otherwise(0.0)
            asked = asked.select("vec_id", "v", "bound", need.alias("need"))
        blocks = asked.coalesce(parts).sortWithinPartitions("need").mapInArrow(_blocks, "q_ids binary, q_vals binary, bounds binary, need double")
        blocks = settled(blocks)  # read once for each partition of buckets
        pairs = buckets.where(F.col("round") == turn).join(blocks, F.col("longest") * (1 + 1e-9) >= F.col("need"))
        found = pairs.select("ids", "vals", "q_ids", "q_vals", "bounds").mapInArrow(meet, "query_id long, vec_id long, score long")
        found = found if known is None else found.union(known.drop("rank"))
        known = found.withColumn("rank", rank).where(F.col("rank") <= top)
        if turn < len(starts):
            known = settled(known)
    return known.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op10_exact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_products(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP10_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
