"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts of order 0 to 3 is counted on labelled texts and
frozen. A byte costs -log2 of n / (n + q) in the longest context that has been seen with it,
n being its count and q the context's distinct bytes, plus the escapes q / (n + q) from the
longer contexts that have been seen without it; below order 0 every byte costs 8 bits. (This
is escape method C with full counts and without exclusion.) A text goes to the language with
the shortest code. Its score is that language's share of 2 ** (-SHARP * bits per byte) over
all languages and a code of 8 bits a byte for none of them: near 1 where one language stands
out, lower where two are as likely, near 0 for a text that no tree can shorten.

The trees are fitted on a bounded sample of labelled rows: about SAMPLE rows for each
language, picked by a hash of id and text. Trees are kept for up to LANGUAGES languages
together, as many times as it takes. Everything else covers every byte of every text.

Cases: `und` with score 0 for a null text, a text without a letter, or if nothing was
learned. Rows with a null `lang` teach nothing. A null id is never held out. Equal lengths go
to the first language in order. Equal rows give equal rows. An empty table gives no rows. A
very long text is one step of its own. Other columns are passed on; one that has the name of
a new one is replaced by it, and the new ones can be given other names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import MULT, SPACE, spans_of, steps

ORDER = 3
#: About so many labelled rows of each language are learned from.
SAMPLE = 1200
#: Languages whose trees share a table.
LANGUAGES = 64
SHARP = 2.0
UNKNOWN = "und"
SLOT_BITS = 21


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def grams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """At every byte, it and the three before it as one number; three line breaks stand before a text."""
    n = len(raw)
    key = raw.astype(np.uint32)
    for back in range(1, ORDER + 1):
        before = np.full(n, 10, dtype=np.uint32)
        before[back:] = raw[: n - back] if n > back else raw[:0]
        starts = offsets[:-1]
        for k in range(back):
            at = starts + k
            before[at[at < offsets[1:]]] = 10
        key |= before << np.uint32(8 * back)
    return key


@dataclass
class Level:
    """Costs of n-grams seen in some language, for all languages, and escapes of the contexts seen."""

    keys: np.ndarray
    costs: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


class Model:
    """Frozen statistics. counts: for each language its sorted 4-grams and their counts."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        self.levels: list[Level] = []
        if not languages:
            return
        for order in range(ORDER + 1):
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            own = []
            for keys, n in counts:
                found, back = np.unique(keys & mask, return_inverse=True)
                own.append((found, np.bincount(back, weights=n)))
            keys = np.unique(np.concatenate([k for k, _ in own]))
            contexts = np.unique(keys >> np.uint32(8))
            escapes = np.zeros((len(contexts), len(languages)), dtype=np.float64)
            sums = np.zeros_like(escapes)
            for j, (found, n) in enumerate(own):
                at = np.searchsorted(contexts, found >> np.uint32(8))
                total, kinds = np.bincount(at, weights=n, minlength=len(contexts)), np.bincount(at, minlength=len(contexts))
                sums[:, j] = total + kinds
                with np.errstate(divide="ignore", invalid="ignore"):
                    escapes[:, j] = np.where(kinds > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
            costs = escapes[np.searchsorted(contexts, keys >> np.uint32(8))] + self.cost(keys & (mask >> np.uint32(8)), order - 1)
            for j, (found, n) in enumerate(own):
                rows = np.searchsorted(keys, found)
                costs[rows, j] = np.log2(sums[np.searchsorted(contexts, found >> np.uint32(8)), j]) - np.log2(n)
            self.levels.append(Level(keys, costs, contexts, escapes))
        top = self.levels[-1]
        self.slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
        self.slots[self.slot(top.keys)] = np.arange(len(top.keys), dtype=np.int32)
        self.top_costs = top.costs.astype(np.float32)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MULT) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def cost(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Bits of the last byte of every (order + 1)-gram, a column for each language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0)
        level = self.levels[order]
        at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
        out = level.costs[at]
        new = np.flatnonzero(level.keys[at] != keys)
        if len(new):
            context = keys[new] >> np.uint32(8)
            place = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            escape = np.where((level.contexts[place] == context)[:, None], level.escapes[place], 0.0)
            mask = np.uint32((1 << (8 * order)) - 1)
            out[new] = escape + self.cost(keys[new] & mask, order - 1)
        return out

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of every text (rows) in every language (columns)."""
        n, out = len(offsets) - 1, np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(raw) or not self.languages:
            return out
        keys = grams(raw, offsets)
        at = self.slots[self.slot(keys)]
        sure = self.levels[-1].keys[at] == keys
        sure &= at >= 0
        at[~sure] = 0
        costs = self.top_costs[at]
        rest = np.flatnonzero(~sure)
        if len(rest):
            some, back = np.unique(keys[rest], return_inverse=True)
            costs[rest] = self.cost(some, ORDER).astype(np.float32)[back]
        full = np.flatnonzero(np.diff(offsets) > 0)
        out[full] = np.add.reduceat(costs, offsets[full], axis=0, dtype=np.float64)
        return out


class Models:
    """Trees of any number of languages, in order."""

    def __init__(self, parts: list[Model]):
        self.parts = parts
        self.languages = [x for p in parts for x in p.languages]

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.hstack([p.lengths(raw, offsets) for p in self.parts])


def _letters(texts: pa.Array, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter."""
    low = raw | 0x20
    before = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))
    has = before[offsets[1:]] > before[offsets[:-1]]
    for k in np.flatnonzero(~has & (np.diff(offsets) > 0)):
        has[k] = any(map(str.isalpha, texts[int(k)].as_py()))
    return has


def learn(docs: DataFrame, sample: int = SAMPLE) -> Models:
    """Trees from rows of `docs` (doc_id, text, lang) that aren't held out."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(known)
    if not languages:
        return Models([])
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, sample / known[lang]))])
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * float(1 << 20)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            names = batch.column(0)
            for lang in names.unique().to_pylist():
                raw, offsets = spans_of(batch.column(1).filter(pa.compute.equal(names, lang)))
                keys, n = np.unique(grams(raw, offsets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

    counted = picked.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    by = {}
    for lang in languages:
        own = counted.filter(pa.compute.equal(counted["lang"], lang))
        if own.num_rows:
            keys, n = own["key"].to_numpy().astype(np.uint32), own["n"].to_numpy().astype(np.float64)
            order = np.argsort(keys)
            by[lang] = keys[order], n[order]
    names = list(by)
    return Models([Model(own, [by[x] for x in own]) for own in (names[k : k + LANGUAGES] for k in range(0, len(names), LANGUAGES))])


def identify(docs: DataFrame, model: Model | Models, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of `docs` with `pred` and `score`; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(pred, score)
    schema = kept.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in steps(batches):
            texts = batch.column(batch.schema.get_field_index("text"))
            raw, offsets = spans_of(texts)
            ok = _letters(texts, raw, offsets)
            best, share = np.full(len(ok), len(names) - 1), np.zeros(len(ok))
            if len(names) > 1 and len(ok):
                bits = model.lengths(raw, offsets)
                best = np.where(ok, bits.argmin(axis=1), best)
                rate = bits / np.maximum(np.diff(offsets), 1)[:, None]
                gap = np.column_stack((rate, np.full(len(rate), 8.0))) - rate.min(axis=1)[:, None]
                share = np.where(ok, 1.0 / np.exp2(-SHARP * np.maximum(gap, -400.0)).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best], pa.string()), pa.array(share)], names=[*batch.schema.names, pred, score])

    return kept.mapInArrow(run, schema)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
