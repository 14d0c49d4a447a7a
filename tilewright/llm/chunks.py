"""Substring dedup by content-defined chunks.

A 32-bit gear hash (shift by four and add the byte's code) runs over the bytes of a text; it
forgets what is 8 bytes back. A chunk ends where the hash is least among all places less than
LEAST bytes away; then, again and again, where it is least among the places LEAST bytes or
more from every end found. So an end depends on the bytes around it and not on the chain of
chunks before it, and a passage met again is cut alike but for some bytes at its two ends.
Chunks have LEAST to 2 * LEAST - 1 bytes, but for shorter texts. They are compared by a
128-bit digest of their bytes; the first one by (doc_id, place) stays. Others are removed
where they follow each other over RUN bytes or make up a whole text: a few common words in a
row are no repetition.

Texts are read once, and only digests, places and lengths are shuffled, once by digest and,
of repeated chunks, once by document. Of equal chunks met together in one step only the first
goes to its digest; the others can't be the first of all and are spread at random. So a chunk
that a third of all documents share is a row for each step, not for each document.

Cases: a null or empty text has no chunk. Rows are told apart by id and a 64-bit hash of the
text: those with one id, or none, and different texts are documents of their own; rows equal
in both are copies of one document, in which a chunk stays at the same place. A null id comes
first, then the hash decides. An empty table
gives no rows. A very long text is one step of its own. `removed` reads no other columns;
`dedup_texts` returns them all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name
from .textcore import BYTE_CODE, mix64, spans_of, steps

LEAST = 24
#: Repeated chunks in a row count from so many bytes.
RUN = 100
#: So often ends are sought everywhere; what is left, mostly one string over and over, is gone through from its left.
ROUNDS = 6
GEAR = (BYTE_CODE >> np.uint64(32)).astype(np.uint32)
NEVER = np.uint32(0xFFFFFFFF)


def gear(raw: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte; hashes near the front of `raw` cover fewer bytes."""
    h = GEAR[raw]
    for k in range(3):
        back = 1 << k
        if len(h) <= back:
            break
        nxt = h.copy()
        nxt[back:] += h[:-back] << np.uint32(4 * back)
        h = nxt
    return h


def cuts(raw: np.ndarray, least: int = LEAST) -> list[int]:
    """Ends of the chunks of one text's bytes."""
    n, side = len(raw), least - 1
    if n < 2 * least:
        return [n] if n else []
    h = gear(raw)[side : n - least]  # of all places where a chunk may end
    m = len(h)
    open_ = np.full(m + 2 * side, NEVER)
    open_[side:-side] = h
    around = np.arange(2 * side + 1)
    found = []
    for _ in range(ROUNDS):
        low, width = open_, 1  # least hash of so many places from each
        while 2 * width <= side:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        rest = side - width
        low = np.minimum(low[: len(low) - rest], low[rest:])
        own = open_[side:-side]
        at = np.flatnonzero((own < low[:m]) & (own <= low[least : least + m]))  # the leftmost of equal ones
        if not len(at):
            break
        found.append(at)
        open_[(at[:, None] + around).ravel()] = NEVER
    ends = np.sort(np.concatenate([*found, [m + side]])) + least  # and the text's own
    gaps = np.diff(ends, prepend=0)
    out = ends.tolist()
    for k in np.flatnonzero(gaps >= 2 * least).tolist():
        last, stop = int(ends[k] - gaps[k]), int(ends[k])
        while stop - last >= 2 * least:
            last += least + int(np.argmin(h[last : min(last + least, stop - 2 * least + 1)]))
            out.append(last)
    return sorted(out)


def chunk_table(docs: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash), mark, length, d1, d2 of every chunk; mark: twice its place, and 1 more for the last one of a text; length: negative, and the digest random, if one like it comes before in the step."""
    schema = "doc_id long, h long, mark int, length int, d1 long, d2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            raw, offsets = spans_of(batch.column(1))
            data = raw.tobytes()
            counts, lengths, digests = [], [], []
            for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                ends = cuts(raw[i:j])
                counts.append(len(ends))
                last = 0
                for at in ends:
                    digests.append(xxhash.xxh3_128_digest(data[i + last : i + at]))
                    lengths.append(at - last)
                    last = at
            row = np.repeat(np.arange(len(counts)), counts)
            counts = np.array(counts, dtype=np.int64)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            mark = 2 * place + (place == counts[row] - 1)
            d = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
            doc, size, own = batch.column(0).cast(pa.int64()), np.array(lengths, dtype=np.int32), batch.column(2).to_numpy()[row]
            ids = np.where(doc.is_valid().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy(), np.iinfo(np.int64).min)[row]
            order = np.lexsort((mark, own, ids, d[:, 1], d[:, 0]))
            same = (d[order][1:] == d[order][:-1]).all(axis=1)
            best = np.maximum.accumulate(np.where(np.insert(same, 0, False), 0, np.arange(len(order)))) if len(order) else order
            later = order[(ids[order] != ids[order][best]) | (own[order] != own[order][best]) | (mark[order] != mark[order][best])]  # than the first one; copies of one document at one place are
            size[later] = -size[later]
            d[later, 0] = mix64(d[later, 0].view(np.uint64) ^ mix64((ids[later].view(np.uint64) << np.uint64(20)) ^ own[later].view(np.uint64) ^ mark[later].astype(np.uint64))).view(np.int64)
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(row, pa.int64())), pa.array(own, pa.int64()), pa.array(mark, pa.int32()), pa.array(size), pa.array(d[:, 0]), pa.array(d[:, 1])], names=["doc_id", "h", "mark", "length", "d1", "d2"])

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, schema)


def duplicate_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, h, place, length of every chunk to remove."""
    rank = F.rank().over(Window.partitionBy("d1", "d2").orderBy(F.col("doc_id").asc_nulls_first(), "h", "mark"))
    again = chunk_table(docs).withColumn("rank", rank).where("rank > 1 or length < 0")
    again = again.select("doc_id", "h", F.shiftright("mark", 1).alias("place"), (F.col("mark") % 2).alias("last"), F.abs("length").alias("length"))
    # Chunks in a row have places that rise with their ranks.
    again = again.withColumn("row", F.col("place") - F.dense_rank().over(Window.partitionBy("doc_id", "h").orderBy("place")))
    same = Window.partitionBy("doc_id", "h", "row")
    whole = (F.min("place").over(same) == 0) & (F.max("last").over(same) == 1)
    again = again.withColumn("gone", whole | (F.sum("length").over(same) >= RUN))
    # Rows equal in id and text have the same chunks: one of each counts.
    return again.where("gone").groupBy("doc_id", "h", "place").agg(F.first("length").alias("length"))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed (bytes), n_duplicate (chunks), places (of the removed chunks, ascending) of every document."""
    gone = duplicate_chunks(docs).groupBy(F.col("doc_id").alias("g_id"), F.col("h").alias("g_h")).agg(
        F.sum("length").cast("long").alias("n_removed"), F.count(F.lit(1)).alias("n_duplicate"), F.sort_array(F.collect_list("place")).alias("places"))
    sizes = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = sizes.join(gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("h") == F.col("g_h")), "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_duplicate", F.lit(0)).cast("long").alias("n_duplicate"),
                      F.coalesce("places", F.array().cast("array<int>")).alias("places"))


def without(data: bytes, places: set[int]) -> str:
    """A text less some of its chunks."""
    runs, last = [], 0
    for k, end in enumerate(cuts(np.frombuffer(data, np.uint8))):
        if k in places:
            runs[-1:] = [(runs[-1][0], end)] if runs and runs[-1][1] == last else [*runs[-1:], (last, end)]
        last = end
    parts, last = [], 0
    inside = lambda k: k < len(data) and data[k] & 0xC0 == 0x80
    for begin, end in runs:
        while inside(begin) and begin < end:
            begin += 1
        while inside(end) and begin < end:
            end -= 1
        parts.append(data[last:begin])
        last = end
    return b"".join([*parts, data[last:]]).decode()


def dedup_texts(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, removed chunks cut out of `text`; a character that is partly in a removed run stays whole."""
    key, h, gone_places = free_name(docs, "gone_id"), free_name(docs, "gone_h"), free_name(docs, "gone_places")
    gone = duplicate_chunks(docs).groupBy(F.col("doc_id").alias(key), F.col("h").alias(h)).agg(F.collect_list("place").alias(gone_places))
    rows = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(h)), "left").drop(key, h)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            at = batch.schema.get_field_index("text")
            out = []
            for text, places in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if text and places:
                    text = without(text.encode(), set(places))
                out.append(text)
            columns = [c for c in batch.columns[:-1]]
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return rows.mapInArrow(run, docs.schema)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = removed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_duplicate", F.array_join(F.transform("places", lambda x: x.cast("string")), ",").alias("places"))
