"""Exact removal of bytes covered by repeated strings of WIDTH bytes, by column-wise construction.

Equal WIDTH-byte windows have equal least K-gram hashes, so runs of windows with one least
hash (at most WIDTH - K + 1 windows, a string of under 2 * WIDTH bytes) are the unit: two
equal windows always lie in runs with the same key.

1. Every run gives its key and a digest of its string. Of equal strings met together in one
   step only two are sent to their key, which stands for the rest. Keys are read as a stream,
   of which at most CROWD strings are held. Keys met once are dropped. A string met twice is
   repeated as a whole. Only keys with several different strings go on, with one place of each
   string, and single strings periodic enough to repeat a window within.
2. The strings of a key, with those of other keys up to COLLECTION strings, form a document
   collection. Strings with no window whose hash is met twice in it are left out. Its Burrows-Wheeler transform is built column by column: each round inserts
   the next symbol, from the right, of every string, where counting symbols before its last
   place puts it, and updates the longest common prefixes by range minima. A window is
   repeated if its suffix shares WIDTH bytes with a neighbour. As a collection's strings are
   short and their number is bounded, its files would be a few megabytes; they are arrays.
3. A key with more than CROWD different strings (the edge of a passage that very many
   documents share) is cut again by a longer K; at K = WIDTH a run is one window and equal
   windows are equal digests. So no task holds an unbounded group.
4. Covered spans are merged for each document and cut out.

Windows are compared on whole texts as UTF-8 bytes and never cross documents.

Cases: a null or empty text, or one shorter than WIDTH, has nothing removed. Equal rows
repeat each other. A row with a null id takes part like any other. Different texts under one
id are told apart by 16 bits of a hash. A very long text is one step of its own. An empty
table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settled
from .textcore import POWERS, mix64, prefix_hash, ranges, span_hash, spans_of, squeezed, steps, unsqueezed

WIDTH = 200
LEVELS = (100, 150, 180, 194, 200)
COLLECTION = 512
CROWD = 1024


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row, by block-wise prefix and suffix minima."""
    n = len(values)
    if width == 1:
        return values
    pad = -n % width
    blocks = np.concatenate((values, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF)))).reshape(-1, width)
    front = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], front[width - 1 : n])


def runs_of(raw: np.ndarray, offsets: np.ndarray, k: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start (in raw), number of windows, key and digest of every run; runs never cross texts.

    The number has bit 7 set if a window may repeat within the run.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < width:
        return none, none, none, none
    sums = prefix_hash(raw)
    _, down = POWERS.get(len(sums))
    grams = mix64((sums[k:] - sums[:-k]) * down[: len(raw) - k + 1])
    least = least_of(grams, width - k + 1)
    size = np.diff(offsets)
    count = np.maximum(size - width + 1, 0)
    at = ranges(offsets[:-1], count)
    if not len(at):
        return none, none, none, none
    key = least[at]
    head = np.ones(len(at), dtype=bool)
    head[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    head[(np.cumsum(count) - count)[count > 0]] = True
    first = np.flatnonzero(head)
    length = np.diff(np.append(first, len(at)))
    most = width - k + 1
    parts = -(-length // most)
    place = ranges(np.zeros(len(first), np.int64), parts)
    first, length = np.repeat(first, parts) + place * most, np.repeat(length, parts)
    n = np.minimum(length - place * most, most)
    start = at[first]
    # A run can hold two equal windows only if its key is the hash of two of its K-grams. A K-gram is the least of some
    # window if the greatest of the minima of the windows around it is its own hash.
    none = np.zeros(most - 1, dtype=np.uint64)
    sharp = np.flatnonzero(grams == ~least_of(~np.concatenate((none, least, none)), most))
    twice = np.zeros(len(grams) + 1, dtype=np.int64)
    twice[sharp[1:][(grams[sharp[1:]] == grams[sharp[:-1]]) & (np.diff(sharp) < most)] + 1] = 1
    twice = np.cumsum(twice)
    n = n | ((twice[start + n + most - 1] > twice[start + 1]).astype(np.int64) << 7)
    return start, n, key[first].view(np.int64), span_hash(sums, start, start + (n & 127) - 1 + width).view(np.int64)


def repeated_windows(strings: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For every string, which of its windows also start elsewhere in the strings, by column-wise construction."""
    m = len(strings)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    longest = int(size.max()) if m else 0
    out = [np.zeros(max(0, n - width + 1), dtype=bool) for n in size.tolist()]
    if longest < width or m == 0:
        return out
    # Symbols from the right, as ranks of the bytes that occur; 0 once a string has ended.
    flat = np.frombuffer(b"".join(s[::-1] for s in strings), dtype=np.uint8)
    occurs = np.bincount(flat, minlength=256) > 0
    small = np.uint8 if occurs.sum() < 256 else np.uint16
    owner = np.repeat(np.arange(m), size)
    column = np.zeros((longest + 2, m), dtype=small)
    column[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), owner] = np.cumsum(occurs)[flat].astype(small)
    bwt = column[0].copy()
    lcp = np.zeros(m, dtype=np.int16)
    counts = np.bincount(bwt, minlength=int(occurs.sum()) + 1)
    newest, who = np.arange(m), np.arange(m)
    for j in range(1, longest + 1):
        alive = bwt[newest] > 0
        newest, who = newest[alive], who[alive]
        if not len(newest):
            break
        n = len(bwt)
        order = np.argsort(bwt, kind="stable")
        heads, ended = np.cumsum(counts) - counts, int(counts[0])
        symbol = bwt[newest]
        by = np.lexsort((newest, symbol))
        newest, who, symbol = newest[by], who[by], symbol[by]
        # Where each newest place is among those of its symbol.
        r = np.empty(len(newest), dtype=np.int64)
        first = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
        for low, high in zip(first.tolist(), [*first[1:].tolist(), len(r)]):
            head = heads[symbol[low]]
            r[low:high] = head + np.searchsorted(order[head : head + counts[symbol[low]]], newest[low:high])
        before = order[np.maximum(r - 1, 0)]
        has_before = (r > 0) & (bwt[before] == symbol)
        after = order[np.minimum(r + 1, n - 1)]
        has_after = (r + 1 < n) & (bwt[after] == symbol)
        padded = np.append(lcp, np.int16(0))
        up, down = np.zeros(len(r), dtype=np.int16), np.zeros(len(r), dtype=np.int16)
        for value, has, low, high in ((up, has_before, before, newest), (down, has_after, newest, after)):
            if has.any():
                edges = np.stack([low[has] + 1, high[has] + 1], axis=1).ravel()
                value[has] = np.minimum.reduceat(padded, edges)[::2] + 1
        place = r - ended + m
        old = np.ones(n + len(r), dtype=bool)
        old[place] = False
        nxt_bwt, nxt_lcp = np.empty(n + len(r), small), np.empty(n + len(r), np.int16)
        nxt_bwt[old], nxt_lcp[old] = bwt, lcp
        nxt_bwt[place] = column[j][who]
        counts = counts + np.bincount(nxt_bwt[place], minlength=len(counts))
        nxt_lcp[place[has_after] + 1] = down[has_after]  # a new follower's own value, the same, is written next
        nxt_lcp[place] = up
        bwt, lcp, newest = nxt_bwt, nxt_lcp, place
    near = np.maximum(lcp, np.append(lcp[1:], np.int16(0))) >= width
    # Places of all suffixes, from the shortest: stepping from one to the next is counting symbols before it.
    step = np.empty(len(bwt), dtype=np.int64)
    step[np.argsort(bwt, kind="stable")] = np.arange(len(bwt)) - (len(bwt) - int(np.count_nonzero(bwt))) + m
    at = np.arange(m)
    for length in range(1, longest + 1):
        alive = np.flatnonzero(size >= length)
        at[alive] = step[at[alive]]
        if length >= width:
            for k in alive[near[at[alive]]].tolist():
                out[k][size[k] - length] = True
    return out


def _mark(text: bytes) -> int:
    """16 bits of a hash, above the 32 of a place."""
    return (xxhash.xxh3_64_intdigest(text) & 0xFFFF) << 32


def _sent(key: np.ndarray, digest: np.ndarray, doc: pa.Array, place: np.ndarray) -> pa.RecordBatch:
    """Runs to send to their keys; of equal strings, the third one and later ones are covered for sure: a random key and the digest 0."""
    digest = np.where(digest == 0, 1, digest)
    order = np.lexsort((digest, key))
    head = np.ones(len(order), dtype=bool)
    head[1:] = (key[order][1:] != key[order][:-1]) | (digest[order][1:] != digest[order][:-1])
    first = np.flatnonzero(head)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    sure = order[rank > 1]
    key, digest = key.copy(), digest.copy()
    key[sure] = mix64(place[sure].view(np.uint64) ^ digest[sure].view(np.uint64)).view(np.int64)
    digest[sure] = 0
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(digest), doc, pa.array(place)], names=["key", "digest", "doc_id", "place"])


def _runs(k: int):
    """Of whole texts. place: from bit 15 on start and mark; in bits 8 to 14 the start in the string that was cut; then whether a window may repeat within, and the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ids = batch.column(0).cast(pa.int64())
            raw, offsets = spans_of(batch.column(1))
            start, n, key, digest = runs_of(raw, offsets, k)
            data = raw.tobytes()
            marks = np.array([_mark(data[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())], dtype=np.int64)
            doc = np.searchsorted(offsets, start, side="right") - 1
            yield _sent(key, digest, ids.take(pa.array(doc)), ((start - offsets[doc] + marks[doc]) << 15) | n)

    return run


def _runs_again(k: int):
    """Of strings (doc_id, start, string) of crowded keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "string"):
            raw, offsets = spans_of(batch.column(2))
            start, n, key, digest = runs_of(raw, offsets, k)
            doc = np.searchsorted(offsets, start, side="right") - 1
            base = batch.column(1).to_numpy()[doc]
            yield _sent(key, digest, batch.column(0).take(pa.array(doc)), ((start - offsets[doc] + base) << 15) | ((start - offsets[doc]) << 8) | n)

    return run


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs by (key, digest): doc_id, start, size of covered spans (key null), and of strings to compare, with key, whether it is crowded and the place in the string it was cut from.

    Held over: of the last key one run for each digest, with whether more were met; once it is crowded, of its last digest alone.
    """
    names = ["doc_id", "start", "size", "key", "crowded", "inset"]
    none = [np.zeros(0, np.int64)] * 4
    held, held_many, asked = none, np.zeros(0, dtype=bool), False  # asked: the held key is crowded, its held digest has been handed out

    def covered(doc, place) -> pa.RecordBatch:
        n = len(doc)
        size = (place & 127) + WIDTH - 1
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place >> 15), pa.array(size), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64())], names=names)

    def compared(doc, place, key, crowded) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place >> 15), pa.array((place & 127) + WIDTH - 1), pa.array(key), pa.array(crowded), pa.array((place >> 8) & 127)], names=names)

    def gone_through(rows, last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, held_many, asked
        key, digest, doc, place = [np.concatenate(x) for x in zip(held, rows)]
        n, old = len(key), len(held[0])
        if not n:
            return
        known = np.zeros(n, dtype=bool)  # handed out as covered
        known[:old] = held_many
        head = np.ones(n, dtype=bool)
        head[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
        first = np.flatnonzero(head)
        many = np.add.reduceat(1 + known, first) > 1
        some = np.flatnonzero(np.repeat(many, np.diff(np.append(first, n))) & ~known)
        yield covered(doc[some], place[some])
        k_head = np.concatenate(([True], key[first][1:] != key[first][:-1]))
        k_first = np.flatnonzero(k_head)
        kinds = np.diff(np.append(k_first, len(first)))
        if asked:
            kinds[0] += CROWD
        open_ = len(first) if last else k_first[-1]  # digests of the last key aren't complete
        crowd = kinds > CROWD
        if crowd[-1]:
            open_ = len(first)
        kinds, crowd = np.repeat(kinds, np.diff(np.append(k_first, len(first)))), np.repeat(crowd, np.diff(np.append(k_first, len(first))))
        ask = (kinds > 1) | (~many & ((place[first] & 128) > 0))
        ask[open_:] = False
        ask[0] &= not asked
        one = first[ask]
        if len(one):
            yield compared(doc[one], place[one], key[one], crowd[ask])
        asked = bool(crowd[-1])
        keep = first[-1:] if asked else first[k_first[-1] :]
        held, held_many = [x[keep] for x in (key, digest, doc, place)], many[-1:] if asked else many[k_first[-1] :]

    for batch in batches:
        rows = [x.to_numpy() for x in batch.columns]
        sure = rows[1] == 0
        if sure.any():
            yield covered(rows[2][sure], rows[3][sure])
            rows = [x[~sure] for x in rows]
        if len(rows[0]):
            yield from gone_through(rows, False)
    yield from gone_through(none, True)


FOUND = "doc_id long, start long, size long, key long, crowded boolean, inset long"


def _found(runs: DataFrame, parts: int) -> DataFrame:
    return settled(runs.repartition(parts, "key").sortWithinPartitions("key", "digest").mapInArrow(_classify, FOUND))


def _cut_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, start, key, crowded, data = [], [], [], [], []
        for d, base, z, wanted in zip(*(batch.column(k).to_pylist() for k in range(4))):
            text = unsqueezed(z) if base is None else z
            base = _mark(text) if base is None else base
            for w in wanted:
                if w["start"] >> 32 != base >> 32:  # of another text with this id
                    continue
                doc.append(d)
                start.append(w["start"])
                key.append(w["key"])
                crowded.append(w["crowded"])
                data.append(text[w["start"] - base : w["start"] - base + w["size"]])
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(data, pa.binary()), pa.array(key, pa.int64()), pa.array(crowded, pa.bool_())], names=["doc_id", "start", "string", "key", "crowded"])


def promising(strings: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Which strings have a window whose hash is met twice; no others can repeat one."""
    size = np.array([len(x) for x in strings], dtype=np.int64)
    count = np.maximum(size - width + 1, 0)
    at = ranges(np.cumsum(size) - size, count)
    _, back, n = np.unique(span_hash(prefix_hash(np.frombuffer(b"".join(strings), np.uint8)), at, at + width), return_inverse=True, return_counts=True)
    return np.bincount(np.repeat(np.arange(len(strings)), count), weights=n[back] > 1, minlength=len(strings)) > 0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered spans from strings by key; a collection holds whole keys."""
    held: list[tuple[int, int, int, bytes]] = []

    def close(upto: int) -> Iterator[pa.RecordBatch]:
        part = [held[k] for k in np.flatnonzero(promising([x[3] for x in held[:upto]])).tolist()]
        del held[:upto]
        doc, start, size = [], [], []
        for (_, d, s, _), hit in zip(part, repeated_windows([x[3] for x in part])):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
                doc.append(d)
                start.append(s + i)
                size.append(j - i - 1 + WIDTH)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, size)], names=["doc_id", "start", "size"])

    for batch in batches:  # sorted by key
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if len(held) >= COLLECTION and row[0] != held[-1][0]:
                yield from close(len(held))
            held.append(row)
    if held:
        yield from close(len(held))


def covered_spans(docs: DataFrame) -> DataFrame:
    """doc_id, start (with the text's mark), size: spans, which may overlap, of bytes to remove."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    docs = docs.select("doc_id", "text")
    runs = docs.mapInArrow(_runs(LEVELS[0]), "key long, digest long, doc_id long, place long")
    spans, strings = None, None
    for level, k in enumerate(LEVELS):
        found = _found(runs, parts)
        covered = found.where("key is null").select("doc_id", "start", "size")
        spans = covered if spans is None else spans.union(covered)
        asked = found.where("key is not null")
        if k == WIDTH:
            break
        whole = strings is None
        wanted = asked.withColumn("base", F.lit(None).cast("long") if whole else F.col("start") - F.col("inset"))
        wanted = wanted.groupBy("doc_id", "base").agg(F.collect_list(F.struct("start", "size", "key", "crowded")).alias("wanted"))
        if whole:  # cut from texts
            source = squeezed(docs).join(wanted, "doc_id").select("doc_id", "base", "z", "wanted")
        else:  # cut from the strings of crowded keys
            source = crowd.withColumnsRenamed({"start": "base", "string": "z"}).join(wanted, ["doc_id", "base"]).select("doc_id", "base", "z", "wanted")
        strings = settled(source.mapInArrow(_cut_strings, "doc_id long, start long, string binary, key long, crowded boolean"))
        quiet = strings.where("not crowded").select("key", "doc_id", "start", "string").repartition(parts, "key").sortWithinPartitions("key")
        spans = spans.union(quiet.mapInArrow(_compare, "doc_id long, start long, size long"))
        crowd = strings.where("crowded").select("doc_id", "start", "string").dropDuplicates(["doc_id", "start"])
        if crowd.isEmpty():
            break
        runs = crowd.mapInArrow(_runs_again(LEVELS[level + 1]), "key long, digest long, doc_id long, place long")
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal (start, end) of spans (start, end); those that touch are one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _apply(row_of, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, z, starts, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                text = unsqueezed(z)
                own = _mark(text)
                gone = merged([(i - own, i - own + n) for i, n in zip(starts or [], sizes or []) if i >> 32 == own >> 32])
                parts, last = [], 0
                for i, j in gone:
                    parts.append(text[last:i])
                    last = j
                rows.append(row_of(doc, text, gone, b"".join(parts) + text[last:]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    return run


def _with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, z (the compressed text), starts and sizes of its spans; a row without an id goes by a hash of its text."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("doc_id"), "text", F.col("doc_id").cast("long").alias("own_id"))
    by = covered_spans(rows).groupBy(F.col("doc_id").alias("s_id")).agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    z = squeezed(rows, "own_id")
    return z.join(by, F.col("doc_id") == F.col("s_id"), "left").select(F.col("own_id").alias("doc_id"), "z", "starts", "sizes")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    row = lambda doc, text, gone, kept: (doc, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
    return _with_spans(docs).mapInArrow(_apply(row, schema), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept_bytes(docs: DataFrame) -> DataFrame:
    """doc_id and what is left of every text, as bytes, since a span may begin within a character."""
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary())])
    return _with_spans(docs).mapInArrow(_apply(lambda doc, text, gone, kept: (doc, kept), schema), "doc_id long, kept binary")


#: Windows by MD5 digests of their hexadecimal form, cut from blocks of 500 places.
OP4_SQL = r"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS MATERIALIZED (
  SELECT r, from_pos + i AS pos, md5_number(substr(block, 2 * i + 1, 400)) AS d
  FROM (SELECT *, unnest(range(0, length(block) // 2 - 199)) AS i
        FROM (SELECT r, from_pos, substr(h, 2 * from_pos + 1, 1398) AS block
              FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 199, 500)) AS from_pos FROM texts)))
), again AS (
  SELECT r, pos, pos - lag(pos) OVER (PARTITION BY r ORDER BY pos) AS step
  FROM windows WHERE d IN (SELECT d FROM windows GROUP BY d HAVING count(*) > 1)
), numbered AS (
  SELECT r, pos, count(*) FILTER (WHERE step IS NULL OR step > 200) OVER (PARTITION BY r ORDER BY pos) AS span FROM again
), spans AS (
  SELECT r, span, min(pos) AS start, max(pos) + 200 AS stop FROM numbered GROUP BY r, span
), gaps AS (
  SELECT r, start, stop, coalesce(lag(stop) OVER (PARTITION BY r ORDER BY start), 0) AS since FROM spans
), cut AS (
  SELECT r, sum(stop - start) AS n_removed, count(*) AS n_spans, max(stop) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' ORDER BY start) AS front
  FROM gaps JOIN texts USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
