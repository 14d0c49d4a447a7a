"""The language model: plain counts, distributions that sum to one, seating that follows the exact posterior, held-out perplexity."""

import math
import random
import re
import time
import tracemalloc
import types
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilewright.llm import hpylm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def corpus():
    r = random.Random(1)
    words = ["the", "The", "of", "été", "x", "日本", "AND"]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for k in range(60)]
    return [*rows, (60, None), (61, ""), (None, "the end"), (None, None), (7, "again the  same"), (7, "again the  same"), (62, "new\twords\x0bhere of"), (63, "z" * 300_000 + " of" * 50_000)]


@pytest.mark.parametrize("bucket_bytes,gathered", [(48 << 20, 4_000_000), (60_000, 500)])
def test_plain_score_equals_counts(spark, monkeypatch, bucket_bytes, gathered):
    monkeypatch.setattr(hpylm, "GATHERED", gathered)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("part", "bucket", "score", "learned_from")})
    out = hpylm.scored(docs, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)), bucket_bytes).collect()
    counts = Counter(t for i, text in rows if i is None or i % 3 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = [(repr(i), len(w := tokens(t)), sum(x in counts for x in w), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 4)) for i, t in rows]
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out) == sorted(want)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def test_probabilities_sum_to_one(spark):
    """From scores of texts of one and two words alone: q, the first words' probabilities, solves q = s1 + (s2 / s1) q."""
    words = ["the", "of", "été", "x", "日本", "and", "unheard"]
    asked = [""] + words + [f"{a} {b}" for a in words for b in words]
    rows = [(2 * k + 1, t) for k, (_, t) in enumerate(corpus()[:60])] + [(2 * k, t) for k, t in enumerate(asked)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for size in (200, 1 << 20):
        p = {r["doc_id"]: 10 ** r["score"] for r in hpylm.scored(docs, F.col("doc_id") % 2 == 1, size).where("doc_id % 2 = 0").collect()}
        p = {t: p[2 * k] for k, t in enumerate(asked)}
        s1 = np.array([p[a] for a in words])
        s2 = np.array([[p[f"{a} {b}"] for b in words] for a in words])
        q = np.linalg.solve(np.eye(len(words)) - s2 / s1, s1)
        assert (q > 0).all() and abs(q.sum() + p[""] - 1) < 1e-6


def test_moves_follow_the_posterior():
    """Shares of table counts among many equal words against all seatings of c customers."""
    d, base, parent, c, n = 0.6, 3.0, 0.2, 6, 40_000
    rng = np.random.default_rng(5)
    many = np.full(n, c)
    t, sizes = np.ones(n, np.int64), np.full(n, c)
    for _ in range(12):
        t, sizes = hpylm.moved(many, t, sizes, np.full(n, base), np.full(n, parent), d, rng)
    assert (sizes > 0).all() and (np.add.reduceat(sizes, np.cumsum(t) - t) == c).all()
    stirling = {(0, 0): 1.0}  # weights of seatings at k tables, one customer after another
    for i in range(c):
        for k in range(1, i + 2):
            stirling[i + 1, k] = stirling.get((i, k - 1), 0.0) + (i - d * k) * stirling.get((i, k), 0.0)
    weight = np.array([stirling[c, k] * math.prod((base + d * j) * parent for j in range(k)) for k in range(1, c + 1)])
    found = np.bincount(t, minlength=c + 1)[1:] / n
    assert np.abs(found - weight / weight.sum()).max() < 0.01


def test_moves_of_uneven_words():
    rng = np.random.default_rng(6)
    c = rng.integers(2, 3000, 500)
    t = hpylm.opened(c, np.full(500, 2.0), rng)
    assert (t >= 1).all() and (t <= c).all()
    sizes = np.ones(t.sum(), np.int64)
    sizes[np.cumsum(t) - t] = c - t + 1
    t, sizes = hpylm.moved(c, t, sizes, np.full(500, 9.0), np.full(500, 0.3), 0.7, rng)
    assert (sizes > 0).all() and (np.add.reduceat(sizes, np.cumsum(t) - t) == c).all() and t.mean() > 5


def test_customers_of_frequent_words_all_move():
    """Table counts of words of 400 customers, all at one table before, against the recursion of all seatings."""
    d, base, parent, c, n = 0.6, 40.0, 0.5, 400, 1500
    log = np.full(c + 1, -np.inf)
    log[0] = 0.0
    for i in range(c):  # weights of seatings at k tables, one customer after another
        stay = i - d * np.arange(c + 1)
        log = np.logaddexp(np.append(-np.inf, log[:-1]), np.where(stay > 0, np.log(np.where(stay > 0, stay, 1.0)), -np.inf) + log)
    log += np.append(0.0, np.cumsum(np.log((base + d * np.arange(c)) * parent)))
    weight = np.exp(log - log.max())
    mean = (weight * np.arange(c + 1)).sum() / weight.sum()
    spread = math.sqrt((weight * (np.arange(c + 1) - mean) ** 2).sum() / weight.sum())
    rng = np.random.default_rng(8)
    t, sizes = np.ones(n, np.int64), np.full(n, c)
    for _ in range(8):
        t, sizes = hpylm.moved(np.full(n, c), t, sizes, np.full(n, base), np.full(n, parent), d, rng)
    assert (sizes > 0).all() and (np.add.reduceat(sizes, np.cumsum(t) - t) == c).all()
    assert abs(t.mean() - mean) < 0.1 * spread and abs(t.std() - spread) < 0.1 * spread


def test_millions_of_customers_move_at_once():
    rng = np.random.default_rng(9)
    c = np.array([33, 5_000_000, 40, 2, 300_000])
    t, sizes = np.ones(5, np.int64), c
    t, sizes = hpylm.moved(c, t, sizes, np.full(5, 5000.0), np.full(5, 0.02), 0.7, rng)
    assert (sizes > 0).all() and (np.add.reduceat(sizes, np.cumsum(t) - t) == c).all() and t[1] > 100 and t[4] > 100


@pytest.mark.parametrize("step,most", [(hpylm._asked, 70), (hpylm.pair_blocks, 120)])
def test_gathered_tokens_are_held_once(monkeypatch, step, most):
    """Bytes held at most for each token of a group."""
    monkeypatch.setattr(hpylm, "GATHERED", 1_000_000)
    monkeypatch.setattr(hpylm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    run = step(types.SimpleNamespace(mapInArrow=lambda f, schema: f), 8)

    def batches(count):
        for k in range(count):
            words = np.random.default_rng(k).integers(0, 50_000, (100, 3000))
            yield pa.RecordBatch.from_arrays([pa.array([k] * 100), pa.array([" ".join(map(str, x)) for x in words]), pa.array([True] * 100)], names=["doc_id", "text", "learned_from"])

    for _ in run(batches(1)):  # tables of powers
        pass
    tracemalloc.start()
    try:
        for _ in run(batches(12)):
            pass
        assert tracemalloc.get_traced_memory()[1] < most * 1_000_000
    finally:
        tracemalloc.stop()


def test_a_bucket_is_small_in_memory(monkeypatch):
    """Bytes held at most by the steps of a bucket with as much text as one has: its pairs merged, seated by sweeps, scored."""
    monkeypatch.setattr(hpylm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    rng, batches, size = np.random.default_rng(3), [], 0
    while size < hpylm.BUCKET_BYTES:
        words = np.minimum(rng.pareto(0.4, (200, 1000)) * 20, 1e9).astype(np.int64)
        texts = [" ".join(map(str, x)) for x in words]
        size += sum(map(len, texts))
        batches.append(pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts), pa.array([True] * 200)], names=["doc_id", "text", "learned_from"]))
    whole = types.SimpleNamespace(mapInArrow=lambda f, schema: pa.Table.from_batches(f(iter(batches))))
    blocks, asked = hpylm.pair_blocks(whole, 1), hpylm._asked(whole, 1)
    plain = ["bucket", "part", "round", "z"]
    held = {}

    def step(name, f, table):
        tracemalloc.start()
        try:
            out = f((), table)
            held[name] = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        return out

    pairs = step("merged", hpylm._merged, blocks).select(plain)
    root, kept, history, roots = None, pairs, {}, {}
    for turn in range(4):
        sent = step(f"sweep {turn}", hpylm._sweep(turn, root, 1, turn == 3) if root else hpylm._first(1), kept)
        assert all(len(z) == (5 if turn in (0, 3) else 3) for z, part in zip(sent["z"].to_pylist(), sent["part"].to_pylist()) if part >= 0)
        answered = hpylm._owned(turn, root)((), sent)
        total = {c: sum(answered[c].to_pylist()) for c in hpylm.SUMS}
        root = roots[turn] = hpylm.Root(total["customers"], total["tables"], root.words if root else total["words"], 0.7, 0.7, root.learned if root else total["learned"])
        history[turn] = answered.select(plain)
        kept = pa.concat_tables([pairs, history[turn]])
    step("scored", hpylm._scored({k: roots[k] for k in (2, 3)}), pa.concat_tables([pairs, history[2], history[3], asked]))
    assert max(held.values()) < 260_000_000, held


def test_shuffle_files_of_sweeps_go(spark):
    docs = spark.createDataFrame(corpus()[:60], "doc_id long, text string").repartition(4)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(b.name()) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllBlocks()) if b.name().startswith("shuffle_")}
    before = files()
    out = hpylm.scored(docs, F.lit(True), 200)
    for _ in range(60):
        left = files() - before
        if len({x.split("_")[1] for x in left}) <= 2:
            break
        time.sleep(0.25)
    assert len({x.split("_")[1] for x in left}) <= 2, left  # those of the last step's sums at most
    assert out.count() == 60


def test_packing():
    rng = np.random.default_rng(7)
    for a in (np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)), rng.integers(0, 9, 77).astype(np.uint32), np.zeros(0, np.int64), rng.random(5)):
        assert (hpylm.unpack(hpylm.pack(a), a.dtype.type) == a).all()
        if a.dtype != float:
            assert (hpylm.unpack(hpylm.pack(np.sort(a), True), a.dtype.type, True) == np.sort(a)).all()


def test_held_out_perplexity_and_reruns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = hpylm.scored(docs, ~hpylm.held_out()).persist()
    row = hpylm.perplexity(out.where(hpylm.held_out())).first()
    assert row["perplexity"] < 0.3 * row["base_perplexity"]
    again = hpylm.scored(docs, ~hpylm.held_out())
    assert out.join(again.select("doc_id", F.col("score").alias("other")), "doc_id").where("abs(score - other) > 1e-6").count() == 0
    out.unpersist()


def test_nothing_learned_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in hpylm.scored(docs, F.lit(False)).collect()) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert hpylm.scored(docs.where("false"), F.lit(True)).count() == 0
