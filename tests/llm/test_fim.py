"""Fill-in-the-middle: equal to a plain version over lists of units, and an exact round trip."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tilewright.llm import fim

TEXTS = [
    None, "", "\n", "one", "one\n", "a\nb", "a\n\nb\n", "\r\nx\r\n", "é\n日本\n" * 5, "<P>", "x <S> y\n", "a<M\n>b", "<<P\n<\nS>\n>", "line\n" * 4000, "no end " * 90_000, *[f"l{k}\nm{k}\nn" for k in range(40)]
]


def plain(doc_id, text, plan):
    """(written, n, form, prefix, middle) with all units in a list."""
    text = text or ""
    units = re.findall(plan.units, text)
    n = len(units)
    h = hashlib.sha256(f"{plan.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    p, s, m = plan.marks
    if not text or any(x in text for x in plan.marks) or h3 % 100 >= plan.share:
        return text, n, "plain", None, None
    ends = [0, *(x.end() for x in re.finditer(plan.units, text))]
    a, b = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    one, two, three = text[:a], text[a:b], text[b:]
    if h4 % 100 < plan.spm_share:
        return s + three + p + one + m + two, n, "spm", len(one), len(two)
    return p + one + s + three + m + two, n, "psm", len(one), len(two)


@pytest.mark.parametrize("plan", [fim.Plan(), fim.Plan(units=r"\S+", marks=("[pre]", "[suf]", "[mid]"), share=60, spm_share=20, seed=3), fim.Plan(units=r"[^\n]+|\n", spm_share=100)])
def test_equal_to_lists_and_back(spark, plan):
    rows = [(None if k % 9 == 4 else k // 2, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("form", "n", "units", "h")})
    out = fim.fill_in_middle(docs, plan).withColumn("back", fim.restored(plan=plan)).collect()
    assert {r["h"] for r in out} == {"h"} and {r["n"] for r in out} == {"n"}
    found = sorted((tuple(r[c] for c in ("doc_id", "text", "fim_text", "units", "form", "prefix_chars", "middle_chars")) for r in out), key=repr)
    assert found == sorted(((i, t, *plain(i, t, plan)) for i, t in rows), key=repr)
    assert all(r["back"] == (r["text"] or "") for r in out)
    assert {r["form"] for r in out} >= {"plain", "spm"}


def test_marks_that_could_be_met_early_are_refused():
    for marks in (("", "b", "c"), ("a", "a", "c"), ("ab", "xabx", "c"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fim.Plan(marks=marks)
    with pytest.raises(ValueError):
        fim.Plan(units="x*")


def test_units_are_not_stored():
    import tracemalloc

    text = "ab\n" * 1_000_000
    tracemalloc.start()
    pattern = re.compile(fim.LINES)
    assert fim.count_units(text, pattern) == 1_000_000
    assert fim.cut(text, pattern, (400_000, 900_000)) == (1_200_000, 2_700_000)
    assert tracemalloc.get_traced_memory()[1] < 100_000
    tracemalloc.stop()


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
