"""Vectorised byte, word and shingle primitives over Arrow string columns.

Texts are treated as UTF-8 bytes. A null text is an empty text. A word is a maximal run
of bytes outside 0x20 and 0x09-0x0D, which on valid UTF-8 is the pattern
``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MULT = U64(0x9E3779B97F4A7C15)
#: Text bytes that one numpy step handles; a longer document is one step of its own.
STEP_BYTES = 2 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * MULT)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base = [base, pow(base, -1, 1 << 64)]
        self.table = [np.ones(1, dtype=np.uint64)] * 2

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.table[0]) < n:
            size = max(n, 1 << 16)
            size = size if size > 4 * STEP_BYTES else 1 << (size - 1).bit_length()
            for k in (0, 1):
                steps = np.full(size, U64(self.base[k]), dtype=np.uint64)
                steps[0] = 1
                self.table[k] = np.multiply.accumulate(steps)
        return self.table[0][:n], self.table[1][:n]


POWERS = _Powers(0xD6E8FEB86659FD93)


def spans_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and, of n rows, n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about STEP_BYTES of text each."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        _, offsets = spans_of(batch.column(at))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and n + 1 offsets of the documents' words."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~SPACE[raw]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    starts[cuts] = True
    ends[cuts] = True
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    return begin, end, np.searchsorted(begin, offsets, side="left")


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = base**i times the polynomial hash of raw[i:j]."""
    up, _ = POWERS.get(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[raw] * up[: len(raw)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of raw[begin:end] that depends on those bytes alone."""
    _, down = POWERS.get(len(sums))
    return mix64((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * MULT)


ROLL = mix64(np.arange(101, 164, dtype=np.uint64)) | U64(1)


def windows_of(word_hash: np.ndarray, word_at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of `size` words; of fewer words in a document, of all of them as one run."""
    counts = np.diff(word_at)
    runs = np.maximum(counts - size + 1, (counts > 0).astype(counts.dtype))
    doc = np.repeat(np.arange(len(counts)), runs)
    first = np.repeat(word_at[:-1] - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(len(doc))
    padded = np.concatenate((word_hash, np.zeros(size, dtype=np.uint64)))
    length = np.minimum(counts, size)[doc]
    total = length.astype(np.uint64) * MULT
    for k in range(size):
        part = padded[first + k] * ROLL[k]
        total = total + (part if not (counts < size).any() else np.where(k < length, part, U64(0)))
    return mix64(total), doc


def shingle_sets(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Of every text the distinct hashes of its shingles of lower-cased words, ascending; and n + 1 offsets."""
    raw, offsets = spans_of(texts)
    raw = LOWER[raw]
    begin, end, word_at = words_of(raw, offsets)
    hashes, doc = windows_of(span_hash(prefix_hash(raw), begin, end), word_at, size)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[keep], doc[keep]
    return hashes, np.searchsorted(doc, np.arange(len(offsets)))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, and so on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.repeat(starts - before, counts) + np.arange(total)


def squeezed(docs, *more: str):
    """doc_id, z, the compressed bytes of every text, and the columns `more` of a DataFrame: what to shuffle instead of texts."""
    rows = docs.select("doc_id", "text", *more)
    schema = ", ".join(["doc_id long, z binary", *(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in steps(batches):
            raw, offsets = spans_of(batch.column(1))
            data = raw.tobytes()
            packed = [squeeze.compress(data[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(packed, pa.binary()), *batch.columns[2:]], names=["doc_id", "z", *more])

    return rows.mapInArrow(run, schema)


def unsqueezed(z: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z) if z else b""
