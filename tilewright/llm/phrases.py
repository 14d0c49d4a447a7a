"""Collocations: phrases whose words are met together more often than their parts explain.

Three passes, none of which gathers the corpus anywhere:

1. A count-min sketch. Every task counts its words and phrases of 2 to MOST words in cells
   picked by a hash; blocks of cells are shuffled and added up. What is left of them is one
   bit a cell, whether its sum, an upper bound for each phrase in it, reaches the least count.
   The sketch has a cell for each few bytes of text up to 2 ** MOST_BITS cells, so the bits
   that are broadcast never pass 2 ** MOST_BITS / 8 bytes; a sketch that is full lets more
   candidates through, it never loses one.
2. Every shard, some SHARD bytes of text of one language, takes those of its phrases whose
   bound reaches the least count, and whose shorter phrases' do, as candidates, compiles them,
   with a delimiter before and after, into an Aho-Corasick automaton and runs it over its
   normalised text. Words are one delimiter apart, pieces two, so a match is never part of a
   word and never leaves its piece; overlapping matches all count.
3. A shard sends its phrases and counts in sorted, compressed blocks, by a hash of the first two
   words; they are summed by phrase, which gives exact counts, and the thresholds apply:
   joins with the counts of the parts, and with the most frequent longer phrase around each.

Words and phrases of a shard are told apart by 64-bit hashes.

Cases: a null text is empty; a null language is `und`. An empty table gives no rows. Repeated
rows count each. A very long text is a shard of its own, whole. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .textcore import LOWER, MULT, STEP_BYTES, U64, mix64, prefix_hash, span_hash, steps

#: Most words of a phrase.
MOST = 4
#: Text bytes for each cell of the sketch, and bounds of its size as powers of two.
CELL_BYTES = 32
LEAST_BITS, MOST_BITS = 16, 28
#: Cells of a block, as a power of two.
BLOCK_BITS = 14
#: Counts that a task gathers before it hands on a sketch, and text bytes of a shard.
GATHERED = 8_000_000
SHARD = 4 << 20
#: Text bytes for each part of the phrases, and most parts; phrases that a task holds before it adds them up.
PART_BYTES, MOST_PARTS, HELD = 8 << 20, 512, 1_000_000
UNKNOWN = "und"

BREAK = np.zeros(256, dtype=bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09]] = True


class Pieces:
    """Words of some texts, whose joined bytes are given: where they begin and end, their hashes, and whether the next word is in the same piece."""

    def __init__(self, data: bytes):
        raw = LOWER[np.frombuffer(data, np.uint8)]
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = ~(BREAK | BLANK)[raw]
        self.raw, self.inside = raw, inside[1:-1]
        self.begin, self.end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        breaks = np.flatnonzero(BREAK[raw])
        self.goes_on = np.searchsorted(breaks, self.end[:-1]) == np.searchsorted(breaks, self.begin[1:])
        self.words = np.zeros(len(self.begin), np.uint64)
        i = 0
        while i < len(self.begin):  # some bytes at a time
            low = self.begin[i]
            j = max(i + 1, int(np.searchsorted(self.end, low + STEP_BYTES, side="right")))
            self.words[i:j] = span_hash(prefix_hash(raw[low : self.end[j - 1]]), self.begin[i:j] - low, self.end[i:j] - low)
            i = j

    def phrases(self, salt: np.uint64) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first word, hash) of all runs of n words within pieces, n from 1 to MOST."""
        at, hashes = np.arange(len(self.words)), mix64(self.words ^ salt)
        yield 1, at, hashes
        for n in range(2, MOST + 1):
            keep = at + n - 1 < len(self.words)
            keep[keep] = self.goes_on[at[keep] + n - 2]
            at = at[keep]
            hashes = mix64(hashes[keep] * MULT + self.words[at + n - 1])
            yield n, at, hashes

    def normalised(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words with one blank around each and one more between pieces; where each word begins and ends there, in bytes."""
        gaps = np.where(self.goes_on, 1, 2)
        times = self.inside.astype(np.int8)
        times[self.end[:-1]] = gaps
        text = b" " + np.repeat(np.where(self.inside, self.raw, np.uint8(0x20)), times).tobytes() + b" "
        length = self.end - self.begin
        begin = 1 + np.concatenate(([0], np.cumsum(length[:-1] + gaps)))
        return text, begin, begin + length


def _salt(lang: str) -> np.uint64:
    data = np.frombuffer(b"l" + lang.encode(), np.uint8)
    return span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0]


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytes]]:
    """Texts by language, some `size` bytes at a time, with a line break between texts; batches: text, lang."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in steps(batches):
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            data, lang = (text.as_py() or "").encode(), UNKNOWN if lang is None else lang
            held.setdefault(lang, []).append(data)
            sizes[lang] += len(data) + 1
            if sizes[lang] >= size or sum(sizes.values()) >= 2 * size:
                lang = max(sizes, key=sizes.get)
                yield lang, b"\n".join(held.pop(lang))
                del sizes[lang]
    for lang, texts in held.items():
        yield lang, b"\n".join(texts)


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.uint32)


def sketch(docs: DataFrame, least: int, bits: int) -> np.ndarray:
    """A bit for each of 2 ** bits cells: whether at least `least` words and phrases fall into it. docs: text, lang."""
    block_bits = min(BLOCK_BITS, bits)
    full = min(255, least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)

        def flushed(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            cells = np.concatenate(parts)
            parts.clear()
            cells.sort()
            first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            n = np.minimum(np.diff(first, append=len(cells)), full).astype(np.uint8)
            cells = cells[first]
            block = cells >> np.uint32(block_bits)
            starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            rows = []
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(cells)]):
                dense = np.zeros(1 << block_bits, np.uint8)
                dense[cells[i:j] & np.uint32((1 << block_bits) - 1)] = n[i:j]
                rows.append(squeeze.compress(dense.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(block[starts].astype(np.int32)), pa.array(rows, pa.binary())], names=["block", "cells"])

        parts, held = [], 0
        for lang, data in _shards(batches, 2 << 20):
            for _, _, hashes in Pieces(data).phrases(_salt(lang)):
                if len(hashes):
                    parts.append(_cells(hashes, bits))
                    held += len(hashes)
            if held >= GATHERED:
                yield from flushed(parts)
                held = 0
        if held:
            yield from flushed(parts)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unsqueeze, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(unsqueeze.decompress(cells.as_py()), np.uint8)
                sums[block] = np.minimum(sums[block].astype(np.uint16) + own, full).astype(np.uint8) if block in sums else own
        reached = [np.packbits(x >= full).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(reached, pa.binary())], names=["block", "reached"])

    parts = docs.select("text", "lang").mapInArrow(count, "block int, cells binary")
    found = parts.repartition("block").mapInArrow(added, "block int, reached binary").toArrow()
    out = np.zeros((1 << (bits - block_bits), (1 << block_bits) // 8), np.uint8)
    for block, reached in zip(found["block"].to_pylist(), found["reached"].to_pylist()):
        out[block] = np.frombuffer(reached, np.uint8)
    return out.ravel()


def _reaches(bits_set: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    cells = _cells(hashes, bits)
    return (bits_set[cells >> np.uint32(3)] >> (np.uint8(7) - (cells & np.uint32(7)).astype(np.uint8))) & np.uint8(1) == 1


def counted_shard(data: bytes, lang: str, bits_set: np.ndarray, bits: int) -> tuple[list[str], list[int], np.ndarray, int]:
    """Phrases (words a blank apart), their counts and hashes of their first two words in a shard, of those that may reach the least count; and all its words."""
    pieces = Pieces(data)
    total = len(pieces.words)
    if not total:
        return [], [], np.zeros(0, np.uint64), 0
    text, begin, end = pieces.normalised()
    out: tuple[list, list, list] = [], [], []
    automaton, keys = ahocorasick.Automaton(), []
    may, heads = np.zeros(0, dtype=bool), np.zeros(total, np.uint64)
    for n, at, hashes in pieces.phrases(_salt(lang)):
        own = _reaches(bits_set, hashes, bits)
        if n > 1:  # a phrase is at most as frequent as its parts
            own &= may[at] & may[at + 1]
        may = np.zeros(total + 1, dtype=bool)
        may[at[own]] = True
        if n <= 2:
            heads[at] = hashes
        _, first, counts = np.unique(hashes[own], return_index=True, return_counts=True)
        places = at[own][first]
        out[2].append(heads[places])
        if n == 1:
            out[0].extend(text[i:j].decode() for i, j in zip(begin[places].tolist(), end[places].tolist()))
            out[1].extend(counts.tolist())
            continue
        for i, j in zip((begin[places] - 1).tolist(), (end[places + n - 1] + 1).tolist()):
            phrase = text[i:j].decode()
            automaton.add_word(phrase, len(keys))
            keys.append(phrase[1:-1])
    if keys:
        automaton.make_automaton()
        met = Counter(map(itemgetter(1), automaton.iter(text.decode())))
        out[0].extend(keys)
        out[1].extend(met[k] for k in range(len(keys)))
    return out[0], out[1], np.concatenate(out[2]), total


def _blocks(lang: str, phrases: list[str], counts: list[int], heads: np.ndarray, parts: int) -> pa.RecordBatch:
    """part, lang, phrases, counts: a shard's phrases by part, sorted, a line each, and their counts' byte planes, compressed."""
    squeeze = zstandard.ZstdCompressor(level=6)
    rows = pa.table({"part": (heads % U64(parts)).astype(np.int32), "phrase": pa.array(phrases, pa.large_string()), "f": pa.array(counts, pa.int64())}).sort_by([("part", "ascending"), ("phrase", "ascending")])
    part, lines, f = rows["part"].to_numpy(), rows["phrase"].to_pylist(), rows["f"].to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    packed: tuple[list, list] = [], []
    for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        packed[0].append(squeeze.compress("\n".join(lines[i:j]).encode()))
        packed[1].append(squeeze.compress(np.ascontiguousarray(f[i:j]).view(np.uint8).reshape(-1, 8).T.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array([lang] * len(starts), pa.string()), *[pa.array(x, pa.binary()) for x in packed]], names=["part", "lang", "phrases", "counts"])


def _added(tables: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
    return summed.select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"])


def _summed(least: int):
    """Blocks to lang, phrase, words, f of all phrases with f >= least, and of the phrase of no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unsqueeze, sums, held, size = zstandard.ZstdDecompressor(), [], [], 0
        for batch in batches:
            for k, lang in enumerate(batch.column(1).to_pylist()):
                lines = unsqueeze.decompress(batch.column(2)[k].as_py()).decode().split("\n")
                f = np.frombuffer(unsqueeze.decompress(batch.column(3)[k].as_py()), np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()
                held.append(pa.table({"lang": pa.array([lang] * len(lines), pa.large_string()), "phrase": pa.array(lines, pa.large_string()), "f": f}))
                size += len(lines)
                if size >= HELD:
                    sums, held, size = [_added(sums + held)], [], 0
        if not sums and not held:
            return
        rows = _added(sums + held)
        none = pc.equal(rows["phrase"], "")
        words = pc.if_else(none, 0, pc.add(pc.count_substring(rows["phrase"], " "), 1)).cast(pa.int32())
        rows = pa.table({"lang": rows["lang"].cast(pa.string()), "phrase": rows["phrase"].cast(pa.string()), "words": words, "f": rows["f"]})
        yield from rows.filter(pc.or_(none, pc.greater_equal(rows["f"], least))).combine_chunks().to_batches(max_chunksize=50_000)

    return run


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, f of all words and phrases with f >= least; and lang, n, the words of each language. docs: text, lang."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((total // CELL_BYTES).bit_length(), LEAST_BITS), MOST_BITS)
    parts = min(max(total // PART_BYTES, 1), MOST_PARTS)
    shared = spark.sparkContext.broadcast(sketch(docs, least, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in _shards(batches, SHARD):
            phrases, counts, heads, n = counted_shard(data, lang, shared.value, bits)
            if n:  # the phrase of no words stands for all words
                yield _blocks(lang, [*phrases, ""], [*counts, n], np.append(heads, _salt(lang)), parts)

    blocks = docs.select("text", "lang").mapInArrow(run, "part int, lang string, phrases binary, counts binary")
    summed = stored(blocks.repartition("part").mapInArrow(_summed(least), "lang string, phrase string, words int, f long"))
    return summed.where("words > 0"), summed.where("words = 0").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, covered: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases by score.

    A phrase of a occurrences cut in two parts of l and r scores floor(scale * a / (l + r)), by
    the cut that scores least (of equal ones the first). Phrases of which `covered` percent are
    within one longer phrase are left out, whether that one is or not. docs: text, lang.
    """
    counts, totals = phrase_counts(docs, least)
    f = counts.select(F.col("lang").alias("f_lang"), F.col("phrase").alias("f_phrase"), "f")
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    for name, side in (("l", "first"), ("r", "rest")):
        own = f.select("f_lang", "f_phrase", F.col("f").alias(name))
        cuts = cuts.join(own, (F.col("lang") == F.col("f_lang")) & (F.col(side) == F.col("f_phrase"))).drop("f_lang", "f_phrase")
    # Exact: products in decimals of 38 digits, an integer quotient.
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("part_sum", exact("l") + exact("r")).withColumn("product", exact("a") * F.lit(scale).cast("decimal(10,0)"))
    cuts = cuts.withColumn("score", F.expr("product div part_sum"))
    least_cut = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    longer = phrases.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("from", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = longer.groupBy(F.col("lang").alias("i_lang"), part(F.col("from"), F.col("size")).alias("inner")).agg(F.max("a").alias("around"))
    kept = least_cut.join(longer, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inner")), "left")
    kept = kept.where(F.col("around").isNull() | (F.col("around").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * covered))
    order = Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))


def op13_phrase_mining(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP13_SQL = r"""
WITH pieces AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS MATERIALIZED (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30
), cuts AS (
  SELECT c.lang, c.k, phrase, a, j, array_to_string(w[1:j], ' ') AS one, array_to_string(w[j + 1 :], ' ') AS two
  FROM cand c, (VALUES (1), (2), (3)) s(j) WHERE j < c.k
), scored AS (
  SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a // (l.a + r.a))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.one JOIN f r ON r.lang = c.lang AND r.phrase = c.two
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), longer AS (
  SELECT c.lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS around
  FROM cand c, (VALUES (2), (3)) s(m), (VALUES (1), (2), (3)) t(i) WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL
), kept AS (
  SELECT x.* FROM lowest x LEFT JOIN longer y ON x.lang = y.lang AND x.phrase = y.phrase WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * x.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
