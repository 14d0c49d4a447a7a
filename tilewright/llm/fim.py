"""Fill-in-the-middle transformation of whole texts.

A text is cut into units, by default lines, and two of the places between units split it into
prefix, middle and suffix. The matcher goes over a text twice: once to count its units, then
with a lazy iterator of matches that is advanced to the lower and on to the higher of the two
ranks. No list of units is kept, so a text takes the same memory however many units it has.

Whether a text is transformed, in which order its parts are written and where it is cut follow
from a SHA-256 digest of its id, so reruns agree. `restored` gives the text back from what was
written; no mark may begin as it ends (as "<P><" would), so that the first place where a mark
is found is where it was put.

Cases: a null text counts as empty. An empty text, and one that holds a mark, stays as it is
(plain). A null id is drawn as the word null; repeated rows and ids are drawn alike, each row
on its own. An empty table gives no rows. A very long text is one step of its own. Other
columns are passed on; those that have the name of a new one are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textcore import steps

#: Lines; the last one may lack its end.
LINES = r"[^\n]*\n|[^\n]+"
NEW = {"fim_text": "string", "units": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long"}


@dataclass(frozen=True)
class Plan:
    """units: pattern of a unit; marks: before prefix, suffix and middle; share, spm_share: percent of texts transformed, and of those with the suffix first."""

    units: str = LINES
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    share: int = 100
    spm_share: int = 50
    seed: int = 7

    def __post_init__(self) -> None:
        for k, mark in enumerate(self.marks):
            if not mark or any(mark in other for j, other in enumerate(self.marks) if j != k) or any(mark[:n] == mark[-n:] for n in range(1, len(mark))):
                raise ValueError("marks must not be empty, hold each other or begin as they end")
        if re.match(self.units, ""):
            raise ValueError("a unit must not be empty")


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four numbers below 2**32 from the digest of a seed and an id."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def cut(text: str, pattern: re.Pattern, ranks: tuple[int, int]) -> tuple[int, int]:
    """Where the text's first `ranks[0]` and first `ranks[1]` units end; ranks ascend."""
    found, passed, at, places = pattern.finditer(text), 0, 0, []
    for rank in ranks:
        if rank > passed:
            at = next(islice(found, rank - passed - 1, None)).end()
            passed = rank
        places.append(at)
    return places[0], places[1]


def count_units(text: str, pattern: re.Pattern) -> int:
    return sum(1 for _ in pattern.finditer(text))


def transformed(text: str, doc_id: int | None, plan: Plan, pattern: re.Pattern) -> tuple[str, int, str, int | None, int | None]:
    """What is written for a text, its units, the form, and the code points of prefix and middle (none if plain)."""
    n = count_units(text, pattern)
    h1, h2, h3, h4 = draws(doc_id, plan.seed)
    p, s, m = plan.marks
    if not text or p in text or s in text or m in text or h3 % 100 >= plan.share:
        return text, n, "plain", None, None
    a, b = cut(text, pattern, tuple(sorted((h1 % (n + 1), h2 % (n + 1)))))
    if h4 % 100 < plan.spm_share:
        return "".join((s, text[b:], p, text[:a], m, text[a:b])), n, "spm", a, b - a
    return "".join((p, text[:a], s, text[b:], m, text[a:b])), n, "psm", a, b - a


def fill_in_middle(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """All columns of `docs` with fim_text, units, form, prefix_chars and middle_chars; docs: doc_id, text."""
    kept = docs.drop(*NEW)
    schema = kept.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in NEW.items()]).schema
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(plan.units)
        for batch in steps(batches):
            ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            rows = [transformed(text.as_py() or "", doc, plan, pattern) for doc, text in zip(ids.to_pylist(), texts)]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(columns, types)]], names=[*batch.schema.names, *NEW])

    return kept.mapInArrow(run, schema)


def restored(written: str = "fim_text", form: str = "form", plan: Plan = Plan()) -> Column:
    """The text that was transformed, from what was written and its form."""
    p, s, m = plan.marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(F.col(written), F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, m, 1)
        return one, two, F.substr(rest, F.length(two) + len(m) + 1)

    prefix, suffix, middle = parts(p, s)
    late_suffix, late_prefix, late_middle = parts(s, p)
    return F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix)).when(F.col(form) == "spm", F.concat(late_prefix, late_middle, late_suffix)).otherwise(F.col(written))


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars", digest(F.col("fim_text")).alias("output_sha256"), digest(restored()).alias("restored_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents
), u AS (
  SELECT *, string_split(t, chr(10)) AS parts,
         len(t) - len(replace(t, chr(10), '')) + CASE WHEN t <> '' AND right(t, 1) <> chr(10) THEN 1 ELSE 0 END AS n
  FROM d
), r AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS r1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS r2, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM u
), c AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(parts, 1, least(r1, r2)), chr(10)) || CASE WHEN least(r1, r2) BETWEEN 1 AND len(parts) - 1 THEN chr(10) ELSE '' END AS head,
         array_to_string(list_slice(parts, 1, greatest(r1, r2)), chr(10)) || CASE WHEN greatest(r1, r2) BETWEEN 1 AND len(parts) - 1 THEN chr(10) ELSE '' END AS upto
  FROM r
), s AS (
  SELECT *, substr(t, len(head) + 1, len(upto) - len(head)) AS middle, substr(t, len(upto) + 1) AS tail FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(head) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
