"""Queries on errors, thresholds, scores, losses and logs, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import morphology, scoring, stats
from ..sources import logs
from . import domain as D

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("anomaly_flag_counts", f"""
WITH {D.RECONSTRUCTED}, err AS (SELECT *, abs(v - r) AS e FROM rec), st AS (SELECT avg(e) AS m, var_samp(e) AS s FROM err),
dist AS (SELECT tile_id, (e - m) * (e - m) / s AS d FROM err, st), thr AS (SELECT avg(d) + 3.0 * var_samp(d) AS t FROM dist)
SELECT tile_id, (count(*) FILTER (d > t))::BIGINT AS flagged, count(*)::BIGINT AS pixels, (count(*) FILTER (d > t))::DOUBLE / count(*) AS share FROM dist, thr GROUP BY tile_id""")
def anomaly_flag_counts(spark, d):
    err = scoring.absolute_errors(D.reconstructed(spark, d)).select("tile_id", "error")
    st = stats.moments(err, ["error"])
    dist = err.crossJoin(F.broadcast(st)).select("tile_id", ((F.col("error") - F.col("mean_error")) * (F.col("error") - F.col("mean_error")) / F.col("cov_error_error")).alias("d"))
    threshold = stats.dynamic_threshold(dist, "d")
    return scoring.flag_counts(dist.crossJoin(F.broadcast(threshold)), "d", "threshold", ["tile_id"])


ERR3 = ["l_quantity", "l_discount", "l_tax"]


@query("error_mean_covariance", "SELECT count(*)::BIGINT AS n, " + ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in ERR3) + ", " + ", ".join(f"round(covar_samp({a}, {b}), 8) AS cov_{a}_{b}" for i, a in enumerate(ERR3) for b in ERR3[i:]) + " FROM lineitem")
def error_mean_covariance(spark, d):
    m = stats.moments(D.table(spark, d, "lineitem"), ERR3)
    return m.select("n", *[F.round(c, 6 if c.startswith("mean") else 8).alias(c) for c in m.columns[1:]])


@query("merged_mean_covariance", "SELECT count(*)::BIGINT AS n, round(avg(l_quantity), 7) AS mean_l_quantity, round(avg(l_tax), 7) AS mean_l_tax, round(covar_samp(l_quantity, l_quantity), 7) AS cov_l_quantity_l_quantity, round(covar_samp(l_quantity, l_tax), 7) AS cov_l_quantity_l_tax, round(covar_samp(l_tax, l_tax), 7) AS cov_l_tax_l_tax FROM lineitem")
def merged_mean_covariance(spark, d):
    columns = ["l_quantity", "l_tax"]
    saved = stats.moments(D.table(spark, d, "lineitem").withColumn("batch", F.col("l_orderkey") % 37), columns, ["batch"])
    m = stats.merge_moments(saved, columns)
    return m.select("n", *[F.round(c, 7).alias(c) for c in m.columns[1:]])


@query("vector_covariance", "SELECT i::INTEGER AS i, j::INTEGER AS j, count(*)::BIGINT AS n, round(covar_samp(embedding[i + 1]::DOUBLE, embedding[j + 1]::DOUBLE), 8) AS cov FROM embeddings, (SELECT unnest(range(0, 64)) AS i), (SELECT unnest(range(0, 64)) AS j) WHERE i <= j GROUP BY i, j")
def vector_covariance(spark, d):
    return stats.vector_moments(D.table(spark, d, "embeddings"), "embedding").select("i", "j", "n", F.round("cov", 8).alias("cov"))


@query("mahalanobis_sq_3d", """
WITH s AS (SELECT avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_tax) AS mt, var_samp(l_quantity) AS a, covar_samp(l_quantity, l_discount) AS b, covar_samp(l_quantity, l_tax) AS c, var_samp(l_discount) AS d, covar_samp(l_discount, l_tax) AS e, var_samp(l_tax) AS f FROM lineitem),
i AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM s)
SELECT l_orderkey, l_linenumber, round(((l_quantity - mq) * (l_quantity - mq) * (d * f - e * e) + 2 * (l_quantity - mq) * (l_discount - md) * (c * e - b * f) + 2 * (l_quantity - mq) * (l_tax - mt) * (b * e - c * d)
 + (l_discount - md) * (l_discount - md) * (a * f - c * c) + 2 * (l_discount - md) * (l_tax - mt) * (b * c - a * e) + (l_tax - mt) * (l_tax - mt) * (a * d - b * b)) / det, 5) AS distance FROM lineitem, i""")
def mahalanobis_sq_3d(spark, d):
    rows = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *ERR3)
    scored = rows.crossJoin(F.broadcast(stats.moments(rows, ERR3)))
    return scored.select("l_orderkey", "l_linenumber", F.round(stats.squared_distance3(ERR3), 5).alias("distance"))


@query("dynamic_threshold_by_group", "SELECT event_type, round(avg(value) + 3.0 * var_samp(value), 4) AS threshold FROM events GROUP BY event_type")
def dynamic_threshold_by_group(spark, d):
    return stats.dynamic_threshold(D.table(spark, d, "events"), "value", ["event_type"]).select("event_type", F.round("threshold", 4).alias("threshold"))


@query("minmax_normalise", "SELECT event_id, CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (value - lo) / (hi - lo) END AS norm, 2.0 * CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (value - lo) / (hi - lo) END - 1.0 AS local FROM (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM events WINDOW w AS (PARTITION BY event_type))")
def minmax_normalise(spark, d):
    rows = scoring.normalise(D.table(spark, d, "events"), "value", ["event_type"], "norm")
    return rows.select("event_id", "norm", (F.lit(2.0) * F.col("norm") - 1.0).alias("local"))


@query("otsu_threshold", """
WITH c AS (SELECT event_type, floor(value)::BIGINT AS v, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT event_type, v, sum(n) OVER u AS w0, sum(n * v) OVER u AS s0, sum(n) OVER e AS w, sum(n * v) OVER e AS s, lead(v) OVER (PARTITION BY event_type ORDER BY v) AS nxt FROM c WINDOW u AS (PARTITION BY event_type ORDER BY v), e AS (PARTITION BY event_type)),
b AS (SELECT event_type, v, nxt, round(w0::DOUBLE * (w - w0)::DOUBLE * (s0::DOUBLE / w0 - (s - s0)::DOUBLE / (w - w0)) * (s0::DOUBLE / w0 - (s - s0)::DOUBLE / (w - w0)), 3) AS g FROM r WHERE w0 < w)
SELECT event_type, nxt AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY g DESC, v) AS k FROM b) WHERE k = 1""")
def otsu_threshold(spark, d):
    return stats.otsu(D.table(spark, d, "events").select("event_type", F.floor("value").cast("bigint").alias("gray")), "gray", ["event_type"])


@query("percentile_bounds_filter", "SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM events) WHERE value BETWEEN lo AND hi")
def percentile_bounds_filter(spark, d):
    return stats.quantile_filter(D.table(spark, d, "events").select("event_id", "value"), "value", 0.05, 0.95)


@query("area_percentile_filter", "WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS area FROM lineitem) SELECT a.* FROM a, (SELECT round_even(quantile_cont(area, 0.9), 0) AS q FROM a WHERE area > 200) WHERE area >= q")
def area_percentile_filter(spark, d):
    rows = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("area"))
    return stats.large_area_filter(rows, "area")


@query("rolling_mean_centred", "SELECT event_id, (sum(round(value * 100)::BIGINT) OVER w)::DOUBLE / (count(*) OVER w) AS smooth FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)")
def rolling_mean_centred(spark, d):
    cents = D.table(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return stats.centred_mean(cents, "cents", ["ts", "event_id"], 26, ["event_type"], F.date_trunc("hour", "ts")).select("event_id", "smooth")


@query("anomaly_score_convex", f"""
WITH {D.RECONSTRUCTED}, n AS (SELECT *, min(v) OVER t AS lv, max(v) OVER t AS hv, min(r) OVER t AS lr, max(r) OVER t AS hr FROM rec WINDOW t AS (PARTITION BY tile_id)),
s AS (SELECT tile_id, avg(((v - lv) / (hv - lv) - (r - lr) / (hr - lr)) ** 2) AS residual FROM n GROUP BY tile_id),
o AS (SELECT vec_id AS tile_id, -sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) + 1e-8) / 8.0 AS dist FROM embeddings)
SELECT tile_id, round(0.05 * residual + 0.95 * dist, 6) AS score, CASE WHEN 0.05 * residual + 0.95 * dist > 5.0 THEN 1 ELSE -1 END AS flag FROM s JOIN o USING (tile_id)""")
def anomaly_score_convex(spark, d):
    residual = scoring.residual_loss(D.reconstructed(spark, d), ["tile_id"])
    rows = residual.join(D.tiles(spark, d).select("tile_id", "values"), "tile_id").withColumn("s", scoring.anomaly_score("residual", "values"))
    return rows.select("tile_id", F.round("s", 6).alias("score"), S.flag("s", F.lit(5.0)).alias("flag"))


@query("sigmoid_localisation", "SELECT event_id, round(4.0 / (1.0 + exp(-value / 100.0)) - 3.0, 8) AS local FROM events")
def sigmoid_localisation(spark, d):
    return D.table(spark, d, "events").select("event_id", F.round(S.sigmoid_localisation(F.col("value") / 100.0), 8).alias("local"))


@query("pixel_flags", f"WITH {D.PIXELS} SELECT tile_id, y, x, CASE WHEN v > 0.2 THEN 1 ELSE -1 END AS flag, CASE WHEN v > 0.2 THEN -1 ELSE 1 END AS shown FROM pixels")
def pixel_flags(spark, d):
    return D.pixels(spark, d).select("tile_id", "y", "x", S.flag("v", "v", 0.2).alias("flag"), (-S.flag("v", "v", 0.2)).alias("shown"))


@query("image_l1_l2", f"WITH {D.RECONSTRUCTED}, t AS (SELECT tile_id, avg(abs(v - r) + 1e-8) AS a, avg((v - r) ** 2) AS b FROM rec GROUP BY tile_id) SELECT round(avg(a), 8) AS l1, round(avg(b), 8) AS l2 FROM t")
def image_l1_l2(spark, d):
    return scoring.image_losses(D.reconstructed(spark, d), ["tile_id"]).select(F.round("l1", 8).alias("l1"), F.round("l2", 8).alias("l2"))


@query("latent_l1_l2", f"WITH {D.RECONSTRUCTED}, t AS (SELECT tile_id, sum(abs(v - r) + 1e-8) AS a, sum((v - r) ** 2) AS b FROM rec GROUP BY tile_id) SELECT round(avg(a), 7) AS l1, round(avg(b), 7) AS l2 FROM t")
def latent_l1_l2(spark, d):
    return scoring.image_losses(D.reconstructed(spark, d), ["tile_id"], normalised=False).select(F.round("l1", 7).alias("l1"), F.round("l2", 7).alias("l2"))


@query("critic_losses", "SELECT round(avg(l_discount) - avg(l_quantity), 6) AS critic, round(-avg(l_discount), 6) AS generator, round(0.001 * avg(l_quantity * l_quantity), 6) AS drift FROM lineitem")
def critic_losses(spark, d):
    m = scoring.critic_losses(D.table(spark, d, "lineitem"), "l_quantity", "l_discount")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("gradient_penalty", "WITH n AS (SELECT sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) + 1e-8) AS g FROM embeddings) SELECT round(10.0 * avg((g - 1.0) * (g - 1.0)), 8) AS penalty FROM n")
def gradient_penalty(spark, d):
    return scoring.gradient_penalty(D.table(spark, d, "embeddings"), "embedding").select(F.round("penalty", 8).alias("penalty"))


@query("wgan_gp_total", "WITH n AS (SELECT sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) + 1e-8) AS g FROM embeddings), p AS (SELECT 10.0 * avg((g - 1.0) * (g - 1.0)) AS gp FROM n), c AS (SELECT avg(l_discount) - avg(l_quantity) + 0.001 * avg(l_quantity * l_quantity) AS w FROM lineitem) SELECT round(gp + w, 6) AS total FROM p, c")
def wgan_gp_total(spark, d):
    c = scoring.critic_losses(D.table(spark, d, "lineitem"), "l_quantity", "l_discount")
    return c.crossJoin(F.broadcast(scoring.gradient_penalty(D.table(spark, d, "embeddings"), "embedding"))).select(F.round(F.col("penalty") + F.col("critic") + F.col("drift"), 6).alias("total"))


@query("global_batch_mean", "SELECT event_type, round(sum(value) / 64.0, 4) AS loss FROM events GROUP BY event_type")
def global_batch_mean(spark, d):
    return D.table(spark, d, "events").groupBy("event_type").agg(F.round(F.sum("value") / 64.0, 4).alias("loss"))


@query("minibatch_stddev", f"WITH {D.PIXELS}, s AS (SELECT tile_id % 4 AS slot, y, x, var_pop(v) AS w FROM pixels GROUP BY ALL) SELECT slot, round(avg(sqrt(w + 1e-8)), 8) AS deviation FROM s GROUP BY slot")
def minibatch_stddev(spark, d):
    return scoring.minibatch_deviation(D.pixels(spark, d), F.col("tile_id") % 4).select("slot", F.round("deviation", 8).alias("deviation"))


#: Batches of 32 and 30 images by turns; the last one has what is left.
@query("minibatch_fallback", f"""WITH {D.PIXELS}, b AS (SELECT *, 2 * (tile_id // 62) + (tile_id % 62 >= 32)::BIGINT AS batch, CASE WHEN tile_id % 62 >= 32 THEN tile_id % 62 - 32 ELSE tile_id % 62 END AS place FROM pixels),
n AS (SELECT batch, count(DISTINCT tile_id) AS n FROM b GROUP BY batch),
s AS (SELECT batch, place % CASE WHEN n % 4 = 0 THEN n // 4 ELSE 1 END AS slot, y, x, var_pop(v) AS w FROM b JOIN n USING (batch) GROUP BY ALL)
SELECT batch, slot, round(avg(sqrt(w + 1e-8)), 8) AS deviation FROM s GROUP BY batch, slot""")
def minibatch_fallback(spark, d):
    """Deviations of groups of 4 images, of the whole batch where 4 doesn't divide it."""
    k = F.col("tile_id") % 62
    tiles = D.tiles(spark, d).select((F.expr("tile_id div 62") * 2 + (k >= 32).cast("long")).alias("batch"), F.when(k >= 32, k - 32).otherwise(k).alias("place"), "values")
    counted = tiles.join(tiles.groupBy("batch").agg(F.count("*").alias("n")), "batch")
    pixels = counted.select("batch", "place", "n", F.posexplode("values").alias("i", "v")).withColumns({"y": F.expr(f"i div {D.SIDE}"), "x": F.col("i") % D.SIDE})
    return scoring.minibatch_deviation(pixels, scoring.minibatch_slot("place", "n"), by=["batch"]).select("batch", "slot", F.round("deviation", 8).alias("deviation"))


@query("global_average_pool", f"WITH {D.PIXELS} SELECT tile_id, x AS channel, round(avg(v), 7) AS feature FROM pixels GROUP BY tile_id, x")
def global_average_pool(spark, d):
    return D.pixels(spark, d).groupBy("tile_id", F.col("x").alias("channel")).agg(F.round(F.avg("v"), 7).alias("feature"))


@query("confusion_at_thresholds", f"WITH {D.PREDICTIONS}, t AS (SELECT (500 * k)::BIGINT AS threshold FROM (SELECT unnest(range(0, 11)) AS k)) SELECT threshold, (count(*) FILTER (score > threshold AND truth = 1))::BIGINT AS tp, (count(*) FILTER (score > threshold AND truth <> 1))::BIGINT AS fp, (count(*) FILTER (score <= threshold AND truth = 1))::BIGINT AS fn, (count(*) FILTER (score <= threshold AND truth <> 1))::BIGINT AS tn FROM pred, t GROUP BY threshold")
def confusion_at_thresholds(spark, d):
    return scoring.confusion_at(D.predictions(spark, d), spark.range(11).select((F.col("id") * 500).alias("threshold")), "score", "truth")


@query("derived_metrics", f"""
WITH {D.PREDICTIONS}, t AS (SELECT (500 * k)::BIGINT AS threshold FROM (SELECT unnest(range(0, 11)) AS k)),
c AS (SELECT threshold, (count(*) FILTER (score > threshold AND truth = 1))::DOUBLE AS tp, (count(*) FILTER (score > threshold AND truth <> 1))::DOUBLE AS fp, (count(*) FILTER (score <= threshold AND truth = 1))::DOUBLE AS fn, (count(*) FILTER (score <= threshold AND truth <> 1))::DOUBLE AS tn FROM pred, t GROUP BY threshold)
SELECT threshold, coalesce(tp / nullif(tp + fp + fn, 0), 0) AS iou, coalesce(tp / nullif(tp + fn, 0), 0) AS sensitivity, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision", (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp * 2.0 / nullif(tp * 2.0 + fp + fn, 0), 0) AS f1 FROM c""")
def derived_metrics(spark, d):
    return scoring.derived_metrics(confusion_at_thresholds(spark, d)).drop("tp", "fp", "fn", "tn")


@query("threshold_dilation_grid", f"""
WITH {D.PIXELS}, t AS (SELECT unnest([0.1, 0.2, 0.3]::DOUBLE[]) AS threshold), g AS (SELECT unnest([1, 2, 3]) AS size),
m AS (SELECT DISTINCT threshold, size, tile_id, y + dy AS y, x + dx AS x FROM pixels, t, g, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)
 WHERE v > threshold AND dy BETWEEN -((size - 1) // 2) AND size // 2 AND dx BETWEEN -((size - 1) // 2) AND size // 2 AND y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7),
c AS (SELECT threshold, size, (count(*) FILTER (p.v > 0.15))::DOUBLE AS tp, count(*)::DOUBLE AS made FROM m JOIN pixels p USING (tile_id, y, x) GROUP BY ALL),
n AS (SELECT count(*)::DOUBLE AS total, (count(*) FILTER (v > 0.15))::DOUBLE AS truth FROM pixels)
SELECT threshold, size, tp::BIGINT AS tp, (made - tp)::BIGINT AS fp, (truth - tp)::BIGINT AS fn, (total - made - truth + tp)::BIGINT AS tn, round(tp / (made + truth - tp), 9) AS iou, round(2.0 * tp / (made + truth), 9) AS f1 FROM c, n""")
def threshold_dilation_grid(spark, d):
    """Masks by threshold and dilation against the pixels above 0.15."""
    p = D.pixels(spark, d).select("tile_id", "y", "x", "v")
    masks = morphology.swept(p, "v", [0.1, 0.2, 0.3], [1, 2, 3], D.SIDE, D.SIDE)
    c = scoring.mask_confusion(masks, p.where("v > 0.15"), p, ["threshold", "size"])
    return scoring.derived_metrics(c).select("threshold", "size", "tp", "fp", "fn", "tn", F.round("iou", 9).alias("iou"), F.round("f1", 9).alias("f1"))


@query("loss_log_flatten", "SELECT event_id AS global_step, event_type AS growth, value AS loss, (props ->> '$.k')::DOUBLE AS k FROM events")
def loss_log_flatten(spark, d):
    e = D.table(spark, d, "events").select(F.col("event_id").alias("global_step"), F.col("event_type").alias("growth"), F.col("value").alias("loss"), F.from_json("props", "map<string,string>").alias("losses"))
    return logs.flatten(e, ["k"]).select("global_step", "growth", "loss", "k")


@query("steps_per_second", "SELECT event_id, round(10.0 / nullif(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id), 0) * 1000000, 8) AS rate FROM events")
def steps_per_second(spark, d):
    return logs.rates(D.table(spark, d, "events"), "ts", ["event_type"], ["ts", "event_id"], 10).select("event_id", F.round("rate", 8).alias("rate"))


@query("growth_fade_in", "SELECT event_id, ((event_id % 17 + 1) // 2)::INTEGER AS block, least((event_id % 50 + 1) / 40.0::DOUBLE, 1.0::DOUBLE) AS alpha, (4 * (1 << ((event_id % 17 + 1) // 2)))::BIGINT AS resolution FROM events")
def growth_fade_in(spark, d):
    e = D.table(spark, d, "events")
    block = S.block_of_growth(F.col("event_id") % 17)
    return e.select("event_id", block.alias("block"), S.alpha(F.col("event_id") % 50, F.lit(40.0)).alias("alpha"), (F.lit(4).cast("bigint") * F.call_function("shiftleft", F.lit(1).cast("bigint"), block)).alias("resolution"))


@query("pca_explained_variance")
def pca_explained_variance(spark, d):
    _, ratio = stats.pca(D.table(spark, d, "embeddings"), "embedding")
    rows = spark.createDataFrame(list(enumerate(ratio)), "component int, ratio double")
    from pyspark.sql import Window

    return rows.withColumn("cumulative", F.sum("ratio").over(Window.orderBy("component")))


@query("topk_by_component", "WITH s AS (SELECT vec_id, round(embedding[1]::DOUBLE + 0.5 * embedding[2]::DOUBLE - 0.25 * embedding[3]::DOUBLE, 9) AS score FROM embeddings) SELECT vec_id, score FROM s ORDER BY score DESC, vec_id LIMIT (SELECT floor(count(*) * 0.1)::BIGINT FROM embeddings)")
def topk_by_component(spark, d):
    e = F.col("embedding")
    x = [e[k].cast("double") for k in range(3)]
    rows = D.table(spark, d, "embeddings").select("vec_id", F.round(x[0] + x[1] * 0.5 - x[2] * 0.25, 9).alias("score"))
    return stats.top_share(rows, "score", 0.1, ["vec_id"])


#: The first principal axis: the matrix of correlations, squared again and again, keeps only it.
_AXIS = """WITH RECURSIVE x AS (SELECT vec_id, i, embedding[i]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
m AS (SELECT i, avg(v) AS mean, stddev_pop(v) AS dev FROM x GROUP BY i),
z AS MATERIALIZED (SELECT vec_id, i, (v - mean) / CASE WHEN dev = 0 THEN 1 ELSE dev END AS v FROM x JOIN m USING (i)),
c AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) / count(*) AS v FROM z a JOIN z b USING (vec_id) GROUP BY ALL),
p AS (SELECT 0 AS k, i, j, v FROM c UNION ALL SELECT k + 1, i, j, v / sum(v) FILTER (i = j) OVER () FROM (SELECT a.k, a.i, b.j, sum(a.v * b.v) AS v FROM p a JOIN p b ON a.j = b.i WHERE a.k < 24 GROUP BY ALL)),
last AS MATERIALIZED (SELECT i, j, v FROM p WHERE k = 24),
axis AS MATERIALIZED (SELECT i, v / sqrt(sum(v * v) OVER ()) AS w FROM last WHERE j = (SELECT i FROM last WHERE i = j ORDER BY v DESC LIMIT 1)) """


@query("principal_spread", _AXIS + "SELECT (SELECT count(*) FROM axis)::BIGINT AS axes, (SELECT round(sum(v) FILTER (i = j), 6) FROM c) AS variance, (SELECT round(sum(v * v) / 4096, 8) FROM c) AS squares, (SELECT round(sum(a.w * c.v * b.w) / 64, 8) FROM c JOIN axis a ON a.i = c.i JOIN axis b ON b.i = c.j) AS largest")
def principal_spread(spark, d):
    """Of the shares of variance that principal axes explain: how many, what they are of, sum of squares, largest."""
    rows, ratio = stats.pca(D.table(spark, d, "embeddings"), "embedding")
    scores = rows.select(F.posexplode("scores").alias("axis", "s")).groupBy("axis").agg(F.var_pop("s").alias("variance"))
    share = F.col("variance") / F.col("total")
    total = scores.agg(F.sum("variance").alias("total"), F.collect_list("variance").alias("each"))
    each = total.select("total", F.explode("each").alias("variance"))
    return each.agg(F.count("*").alias("axes"), F.round(F.max("total"), 6).alias("variance"), F.round(F.sum(share * share), 8).alias("squares"), F.round(F.max(share), 8).alias("largest"))


@query("topk_by_principal_axis", _AXIS + ", s AS (SELECT vec_id, round(sum(z.v * w), 6) AS score FROM z JOIN axis USING (i) GROUP BY vec_id) SELECT vec_id, score FROM s ORDER BY score DESC, vec_id LIMIT (SELECT floor(count(*) * 0.1)::BIGINT FROM embeddings)")
def topk_by_principal_axis(spark, d):
    """The tenth of the rows that lie farthest along the first principal axis."""
    rows, _ = stats.pca(D.table(spark, d, "embeddings"), "embedding", 1)
    return stats.top_share(rows.select("vec_id", F.round(F.col("scores")[0], 6).alias("score")), "score", 0.1, ["vec_id"])


@query("standardise_columns", "SELECT vec_id, round((embedding[1]::DOUBLE - m1) / s1, 7) AS a, round((embedding[2]::DOUBLE - m2) / s2, 7) AS b FROM embeddings, (SELECT avg(embedding[1]::DOUBLE) AS m1, stddev_pop(embedding[1]::DOUBLE) AS s1, avg(embedding[2]::DOUBLE) AS m2, stddev_pop(embedding[2]::DOUBLE) AS s2 FROM embeddings)")
def standardise_columns(spark, d):
    rows = D.table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))
    return stats.standardise(rows, ["a", "b"]).select("vec_id", F.round("a", 7).alias("a"), F.round("b", 7).alias("b"))


@query("pixel_norm", "SELECT vec_id, round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / 64 + 1e-8), 7) AS first, round(0.3 * embedding[1]::DOUBLE + 0.7 * embedding[2]::DOUBLE, 8) AS blended, round(sqrt(2.0 / (label + 1)), 8) AS he FROM embeddings")
def pixel_norm(spark, d):
    e = D.table(spark, d, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", F.round(S.pixel_norm("v")[0], 7).alias("first"), F.round(S.blend(F.lit(0.3), F.col("v")[0], F.col("v")[1]), 8).alias("blended"), F.round(S.he_constant(F.col("label") + 1), 8).alias("he"))
