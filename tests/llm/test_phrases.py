"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilewright.llm import phrases


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(rows, least, top, scale=2_000_000, covered=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = []
    for lang in n:
        found = []
        for (own, w), a in cand.items():
            if own != lang:
                continue
            score, k = min((scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            inside = any(o == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v))) and 100 * b >= covered * a for (o, v), b in cand.items())
            if not inside:
                found.append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus():
    r = random.Random(3)
    vocabulary = ["the", "The", "of", "a", "é", "日本", "x", "xx", "to-day", "NEW", "york", "new", "…"]
    between = [" "] * 12 + ["  ", "\t", ", ", ".", "\n", "; ", " : ", "!", "\r\n", "\x0b", "\x85", "\xa0"]
    rows = [("".join(r.choice(vocabulary) + r.choice(between) for _ in range(r.randint(0, 120))), r.choice(("en", "fr", None, "und"))) for _ in range(120)]
    rows += [("the quick brown fox jumps", "en")] * 9 + [("new york city. New  york, new york", "en")] * 8 + [(None, "en"), ("", None), (" ,;\n", "de"), ("word", "de"), ("ab ab ab ab ab ab ab ab", "ab"), ("z" * 100_000 + " z z", "ab")]
    return rows


@pytest.mark.parametrize("least,top,shard,bits", [(6, 2000, 16 << 20, 28), (4, 7, 300, 28), (1, 40, 4000, 16), (12, 2000, 1 << 12, 6)])
def test_equal_to_plain_counts(spark, monkeypatch, least, top, shard, bits):
    """Shards of a few texts, and a sketch so small that all bounds are reached."""
    for name, value in (("SHARD", shard), ("MOST_BITS", bits), ("LEAST_BITS", min(bits, 16)), ("GATHERED", 500)):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns({c: F.lit(1) for c in ("phrase", "a", "words", "n")})
    out = phrases.collocations(docs, least, top).collect()
    assert sorted(map(tuple, out)) == brute(rows, least, top)


def test_sketch_is_an_upper_bound_and_prunes(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    reached = phrases.sketch(docs, 9, 20)
    counts = Counter()
    for text, lang in rows:
        lang = lang or "und"
        for n, _, hashes in phrases.Pieces((text or "").encode()).phrases(phrases._salt(lang)):
            counts.update((int(h), n) for h in hashes)
    hashes = np.array([h for h, _ in counts], np.uint64)
    enough = np.array(list(counts.values())) >= 9
    found = phrases._reaches(reached, hashes, 20)
    assert found[enough].all() and enough.any() and found[~enough].mean() < 0.02


def test_shards_send_few_bytes_for_a_phrase():
    """Blocks of phrases come back whole, and are summed; rows of strings took about 20 bytes each."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    met = Counter(" ".join(r.choice(words) for _ in range(r.randint(1, 3))) for _ in range(30_000))
    met[""] = 30_000
    heads = np.array([hash(" ".join(p.split()[:2])) & 0xFFFF for p in met], np.uint64)
    made = phrases._blocks("en", list(met), list(met.values()), heads, 8)
    assert made.nbytes < 8 * len(met)
    (other,) = [phrases._blocks("fr", ["w1", ""], [5, 5], np.zeros(2, np.uint64), 8)]
    rows = [x for b in phrases._summed(2)(iter([made, other, made])) for x in b.to_pylist()]
    assert {(x["lang"], x["phrase"]): (x["words"], x["f"]) for x in rows} == {("en", p): (len(p.split()), 2 * n) for p, n in met.items()} | {("fr", "w1"): (1, 5), ("fr", ""): (0, 5)}
    assert list(phrases._summed(2)(iter([]))) == [] and pa.types.is_string(made.schema.field("lang").type)


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    """Counts of 10**15: products of 2 * 10**21."""
    big = 10**15 + 7
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, 3 * big + 1), ("en", "a b", 2, big - 1)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 5 * big)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda docs, least: (counts, totals))
    (row,) = phrases.collocations(counts).collect()
    assert row["score"] == 2_000_000 * (big - 1) // (4 * big + 1)
