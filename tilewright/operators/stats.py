"""Means, covariances, thresholds, quantiles and histograms."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import positions


#: Bins of a histogram, and distinct values that are counted one by one.
BINS = 4096
#: Places in a block of a running mean.
BLOCK = 1 << 16


def moments(rows: DataFrame, columns: list[str], by: list[str] = [], sample: bool = True) -> DataFrame:
    """n, mean_<c> and cov_<c>_<d> (c not after d) of every group, in one partial aggregation."""
    cov = F.covar_samp if sample else F.covar_pop
    out = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns]]
    out += [cov(c, d).alias(f"cov_{c}_{d}") for i, c in enumerate(columns) for d in columns[i:]]
    return rows.groupBy(*by).agg(*out)


def vector_moments(rows: DataFrame, column: str, by: list[str] = []) -> DataFrame:
    """i, j, n, mean_i, mean_j, cov (sample) of an array column of numbers of one length.

    A batch of vectors becomes one row for each pair of places i <= j and group: its count,
    means and sum of products about the means. These merge exactly.
    """
    kinds = dict(rows.dtypes)
    own = "".join(f"{c} {kinds[c]}, " for c in by)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for key, group in pdf.groupby(by, dropna=False, sort=False) if by else [((), pdf)]:
                if not len(group):
                    continue
                x = np.stack([np.asarray(v, dtype=float) for v in group[column]])
                mean = x.mean(axis=0)
                i, j = np.triu_indices(x.shape[1])
                products = (x - mean).T @ (x - mean)
                yield pd.DataFrame({**{c: [k] * len(i) for c, k in zip(by, key)}, "i": i, "j": j, "n": len(x), "mean_i": mean[i], "mean_j": mean[j], "m": products[i, j]})

    part = rows.where(F.col(column).isNotNull()).select(*by, column).mapInPandas(run, f"{own}i int, j int, n long, mean_i double, mean_j double, m double")
    total = F.sum("n")
    mean = {c: F.sum(F.col("n") * F.col(c)) / total for c in ("mean_i", "mean_j")}
    sums = part.groupBy(*by, "i", "j").agg(
        total.alias("n"), mean["mean_i"].alias("mean_i"), mean["mean_j"].alias("mean_j"),
        (F.sum("m") + F.sum(F.col("n") * F.col("mean_i") * F.col("mean_j")) - total * mean["mean_i"] * mean["mean_j"]).alias("_m"))
    return sums.select(*by, "i", "j", "n", "mean_i", "mean_j", F.when(F.col("n") > 1, F.col("_m") / (F.col("n") - 1)).alias("cov"))


def merge_moments(states: DataFrame, columns: list[str], by: list[str] = []) -> DataFrame:
    """One state from saved ones (as moments() gives them): their counts, means and covariances combined.

    With sums of squares about each state's mean, the combined one adds n times the product of
    the distances of the means. Any batching gives the covariance of all the rows.
    """
    states = states.where("n > 0")
    total = F.sum("n")
    out = [total.cast("bigint").alias("n")]
    mean = {c: F.sum(F.col("n") * F.col(f"mean_{c}")) / total for c in columns}
    out += [mean[c].alias(f"mean_{c}") for c in columns]
    for i, c in enumerate(columns):
        for d in columns[i:]:
            within = F.sum(F.when(F.col("n") > 1, F.col(f"cov_{c}_{d}") * (F.col("n") - 1)).otherwise(0.0))
            between = F.sum(F.col("n") * F.col(f"mean_{c}") * F.col(f"mean_{d}")) - total * mean[c] * mean[d]
            out.append((F.when(total > 1, (within + between) / (total - 1))).alias(f"cov_{c}_{d}"))
    return states.groupBy(*by).agg(*out)


def dynamic_threshold(rows: DataFrame, distance: str, by: list[str] = [], k: float = 3.0, spread: str = "variance") -> DataFrame:
    """threshold = mean + k times the variance (as fitted by the workload) or the standard deviation."""
    wide = F.var_samp(distance) if spread == "variance" else F.stddev_samp(distance)
    return rows.groupBy(*by).agg((F.avg(distance) + F.lit(k) * wide).alias("threshold"))


def inverse3(s: dict[tuple[int, int], Column]) -> dict[tuple[int, int], Column]:
    """The inverse of a symmetric 3 by 3 matrix, entries (i, j) with i <= j."""
    a, b, c, d, e, f = (s[k] for k in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)))
    det = a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d)
    return {(0, 0): (d * f - e * e) / det, (0, 1): (c * e - b * f) / det, (0, 2): (b * e - c * d) / det, (1, 1): (a * f - c * c) / det, (1, 2): (b * c - a * e) / det, (2, 2): (a * d - b * b) / det}


def squared_distance3(columns: list[str]) -> Column:
    """Squared Mahalanobis distance of three columns to the moments beside them in the row."""
    inv = inverse3({(i, j): F.col(f"cov_{columns[i]}_{columns[j]}") for i in range(3) for j in range(i, 3)})
    z = [F.col(c) - F.col(f"mean_{c}") for c in columns]
    total = F.lit(0.0)
    for i in range(3):
        for j in range(3):
            total = total + z[i] * z[j] * inv[(min(i, j), max(i, j))]
    return total


def whitening(cov: np.ndarray) -> np.ndarray:
    """The lower L with L @ L.T the inverse of a covariance."""
    return np.linalg.cholesky(np.linalg.inv(cov))


def squared_distance(column: str, mean: np.ndarray, factor: np.ndarray) -> Column:
    """Sum of squares of (x - mean) @ L of an array column; mean and L are small literals."""
    x = F.col(column)
    total = F.lit(0.0)
    for j in range(len(mean)):
        part = F.lit(0.0)
        for i in range(j, len(mean)):
            part = part + (x[i] - F.lit(float(mean[i]))) * F.lit(float(factor[i, j]))
        total = total + part * part
    return total


def order_values(rows: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """The values at `ranks` (from 0) among the non-null ones in ascending order; NaN counts as null.

    A histogram of BINS equal bins narrows the range that holds a rank until few enough
    distinct values are left to count; no task and not the driver holds more than that.
    """
    x = F.col(column).cast("double")
    rows = rows.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    found: dict[int, float] = {}

    def search(low: float, high: float, before: int, wanted: list[int]) -> None:
        part = rows.where(F.col("x").between(low, high))
        counts = {r["x"]: r["n"] for r in part.groupBy("x").agg(F.count(F.lit(1)).alias("n")).limit(BINS + 1).collect()} if low < high else {low: None}
        if len(counts) <= BINS:
            for value in sorted(counts):
                upto = before + counts[value] if counts[value] is not None else None
                while wanted and (upto is None or wanted[0] < upto):
                    found[wanted.pop(0)] = value
                before = upto
            return
        at = F.least(F.floor((F.col("x") - low) / (high - low) * BINS), F.lit(BINS - 1))
        for r in part.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("l"), F.max("x").alias("h")).orderBy("b").collect():
            own = [k for k in wanted if k < before + r["n"]]
            wanted = wanted[len(own) :]
            if own:
                search(r["l"], r["h"], before, own)
            before += r["n"]

    if low is not None:
        search(low, high, 0, sorted(set(ranks)))
    return [found[k] for k in ranks]


def exact_quantiles(rows: DataFrame, column: str, shares: list[float]) -> list[float]:
    """Quantiles with linear interpolation between neighbouring values; none of an empty column."""
    n = rows.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return []
    places = [q * (n - 1) for q in shares]
    values = order_values(rows, column, [k for p in places for k in (math.floor(p), math.ceil(p))])
    return [a + (b - a) * (p - math.floor(p)) for p, a, b in zip(places, values[::2], values[1::2])]


def quantile_filter(rows: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows between two exact quantiles, both included."""
    bounds = exact_quantiles(rows, column, [low, high])
    return rows.where(F.col(column).between(*bounds)) if bounds else rows.where("false")


def large_area_filter(rows: DataFrame, column: str, least: float = 200.0, q: float = 0.9) -> DataFrame:
    """Rows of at least the q-quantile, rounded half to even, of the areas above `least`."""
    cut = exact_quantiles(rows.where(F.col(column) > least), column, [q])
    return rows.where(F.col(column) >= float(round(cut[0]))) if cut else rows.where("false")


def otsu(rows: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    """threshold: the first value after the cut with the greatest between-class variance.

    Counts by value come first, so the running sums are over distinct gray values only.
    """
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    x = F.col(value)
    counts = counts.select(*by, x.alias("v"), F.sum("n").over(upto).alias("w0"), F.sum(F.col("n") * x).over(upto).alias("s0"), F.sum("n").over(every).alias("w"), F.sum(F.col("n") * x).over(every).alias("s"),
                           F.lead(value).over(Window.partitionBy(*by).orderBy(value)).alias("after"))
    w1, s1 = F.col("w") - F.col("w0"), F.col("s") - F.col("s0")
    gap = F.col("s0") / F.col("w0") - s1 / w1
    cut = counts.where("w0 < w").withColumn("between", F.round(F.col("w0").cast("double") * w1.cast("double") * gap * gap, 3))
    return cut.groupBy(*by).agg(F.max_by("after", F.struct(F.col("between"), -F.col("v"))).alias("threshold"))


def centred_mean(rows: DataFrame, value: str, order: list, n: int, by: list[str] = [], bucket: Column | None = None) -> DataFrame:
    """smooth: mean over n rows around each (an even n counts as n - 1), fewer at the ends.

    With a bucket (see `order`), rows are dealt in blocks of BLOCK places, each with the few rows around it.
    """
    half = (n - 1 if n % 2 == 0 else n) // 2
    if bucket is None:
        return rows.withColumn("smooth", F.avg(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(-half, half)))
    size, k = max(BLOCK, n), F.col("_k")
    seen = F.sequence(F.greatest(F.floor((k - half) / size), F.lit(0)), F.floor((k + half) / size))
    dealt = positions(rows, order, by, bucket, "_k").withColumn("_block", F.explode(seen))
    around = Window.partitionBy(*by, "_block").orderBy("_k").rowsBetween(-half, half)
    return dealt.withColumn("smooth", F.avg(value).over(around)).where(F.col("_block") == F.floor(k / size)).drop("_k", "_block")


def standardise(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns less their mean over their population deviation; a constant one is 0."""
    stats = rows.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    z = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}")) for c in columns}
    return rows.crossJoin(F.broadcast(stats)).withColumns(z).drop(*[f"_{k}_{c}" for c in columns for k in "ms"])


def pca(rows: DataFrame, column: str, k: int | None = None) -> tuple[DataFrame, list[float]]:
    """Rows with `scores`, and the explained-variance ratios, of standardised arrays.

    Covariances are summed on the executors; only the d by d matrix reaches the driver. Each
    axis points so that its loading of largest size is positive.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    vectors = rows.withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))
    s = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s")).first()["s"]
    n, mean = s["count"], s["mean"].toArray()
    std = np.sqrt(s["variance"].toArray() * (n - 1) / max(n, 1))
    std[std == 0] = 1.0
    d = len(mean)
    part = vector_moments(rows, column).select("i", "j", "cov").collect()
    cov = np.zeros((d, d))
    for r in part:
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["cov"] / (std[r["i"]] * std[r["j"]])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)
    k = k or d
    x = F.col(column)
    scores = F.array(*[_dot(x, axes[:, c] / std, float(-(mean / std) @ axes[:, c])) for c in range(k)])
    return rows.withColumn("scores", scores), (values[:k] / values.sum()).tolist()


def _dot(x: Column, weights: np.ndarray, start: float) -> Column:
    return F.aggregate(F.zip_with(x.cast("array<double>"), F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(start), lambda s, v: s + v)


def top_share(rows: DataFrame, score: str, share: float, key: list[str]) -> DataFrame:
    """The int(rows * share) rows with the largest scores; ties by key. None for a share that rounds to 0.

    The last score is found by its rank; only rows that tie with it are ordered. A null score isn't taken.
    """
    scored = rows.where(F.col(score).isNotNull())
    n = scored.count()
    many = min(math.floor(rows.count() * share), n)
    if not many:
        return rows.limit(0)
    last = order_values(scored, score, [n - many])[0]
    above = scored.where(F.col(score) > last)
    return above.union(scored.where(F.col(score) == last).orderBy(*key).limit(many - above.count()))
