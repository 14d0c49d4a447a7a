"""Packing token sequences by the sum-of-squares rule.

A document becomes its token ids and one closing id. Only a document longer than a sequence
is cut, counted from its end, so that every piece but perhaps the first fills a sequence.
Pieces are placed one at a time: of the open sequences with room, or a new one, the piece
goes where the sum over residual gaps of the squared number of open sequences with that gap
becomes smallest; of equals, where the smaller gap is left. Pieces are dealt to groups of the
expected size of GROUP_DOCS documents by a hash of themselves, and each group is packed on
its own, so a task holds lengths of a bounded number of pieces and never any token.

Cases: a null or empty text is the closing id alone. Equal rows are packed each on its own;
so are rows with a null id. An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcore import prefix_hash, ranges, span_hash, spans_of, steps

SEQUENCE = 1024
CLOSING = 2
GROUP_DOCS = 16384
#: Pieces of at least this share of a sequence are placed first.
LONG = 0.3
TOKENIZER = "byte_bpe_50k.json"
#: Cached words of one Python worker; the cache is emptied when it is full.
CACHED_WORDS = 1_500_000
#: White space of one byte other than the space and the line break.
ODD_SPACE = np.zeros(256, dtype=bool)
ODD_SPACE[[9, 11, 12, 13, 28, 29, 30, 31]] = True
#: Fixed value: the split pattern of the byte-level pre-tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print every byte as one visible character."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE file for whole columns of texts.

    A single space between two characters that aren't white space always begins a new unit of
    the split pattern, and so does a single line break, which is a unit of its own. A text
    with no other white space is therefore the sum of its words, each with the space or line
    break before it, and words are looked up in a table of those met before. The merges come
    from the tokenizer's file and are run by tiktoken, several times as fast as the file's own
    library with the same ids (tests compare them).
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec.get("normalizer"):
            raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        code = _byte_of_char()
        ranks = {bytes(code[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in self.special}
        made = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.ordinary, self.piece = made.encode_ordinary, made._core_bpe.encode_single_piece
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.mark_bytes = [x.encode() for x in self.special]
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def text_ids(self, text: str) -> list[int]:
        """The plain way, for texts with other white space or special tokens."""
        if self.marks is None or not any(x in text for x in self.special):
            return self.ordinary(text)
        return [k for x in self.marks.split(text) for k in ([self.special[x]] if x in self.special else self.ordinary(x))]

    def word_ids(self, word: bytes) -> list[int]:
        text = word.decode()
        return self.piece(word) if text[0] == " " and text[1:].isalpha() else self.ordinary(text)

    def learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        if len(self.keys) + len(keys) > CACHED_WORDS:
            self.forget()
        made = [self.word_ids(w) for w in words]
        count = np.fromiter(map(len, made), np.int64, len(made))
        at = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(made), np.uint32, int(count.sum()))))
        order = np.argsort(np.concatenate((self.keys, keys)), kind="stable")
        self.keys, self.at, self.count = (np.concatenate(x)[order] for x in ((self.keys, keys), (self.at, at), (self.count, count)))

    def column_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts, one after another, and n + 1 offsets into them."""
        raw, offsets = spans_of(texts)
        n = len(offsets) - 1
        gap = np.zeros(len(raw) + 1, dtype=bool)
        gap[:-1] = (raw == 32) | (raw == 10)
        crowded = gap[:-1] & gap[1:]
        crowded |= ODD_SPACE[raw]
        if (raw == 0xC2).any() or ((raw >= 0xE1) & (raw <= 0xE3)).any():
            crowded |= _wide_space(raw)
        begin, end = offsets[:-1], offsets[1:]
        full = end > begin
        slow = np.zeros(n, dtype=bool)
        slow[full] = np.logical_or.reduceat(crowded, begin[full]) | gap[begin[full]] | gap[end[full] - 1] if full.any() else False
        for mark in self.mark_bytes:
            place, data = 0, raw.tobytes()
            while (place := data.find(mark, place)) >= 0:
                slow[np.searchsorted(offsets, place, side="right") - 1] = True
                place += len(mark)
        gap[begin[full]] = True
        start = np.flatnonzero(gap[:-1])
        stop = np.append(start[1:], len(raw))
        doc = np.searchsorted(offsets, start, side="right") - 1
        quick = ~slow[doc]
        start, stop, doc = start[quick], stop[quick], doc[quick]
        keys, first, back = np.unique(span_hash(prefix_hash(raw), start, stop), return_index=True, return_inverse=True)
        known = np.searchsorted(self.keys, keys)
        new = np.append(self.keys, np.uint64(0))[known] != keys if len(self.keys) else np.ones(len(keys), dtype=bool)
        if new.any() and len(self.keys) + int(new.sum()) > CACHED_WORDS:
            self.forget()
            new[:] = True
        if new.any():
            at = first[new]
            self.learn(keys[new], [raw[i:j].tobytes() for i, j in zip(start[at].tolist(), stop[at].tolist())])
        known = np.searchsorted(self.keys, keys)[back]
        counts = self.count[known]
        total = np.bincount(doc, weights=counts, minlength=n).astype(np.int64)
        ids = self.ids[ranges(self.at[known], counts)]
        if not slow.any():
            return ids, np.concatenate(([0], np.cumsum(total)))
        parts, place = [], 0
        for k in range(n):
            if slow[k]:
                parts.append(np.asarray(self.text_ids(raw[begin[k] : end[k]].tobytes().decode()), dtype=np.uint32))
                total[k] = len(parts[-1])
            else:
                parts.append(ids[place : place + total[k]])
                place += total[k]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(total)))


def _wide_space(raw: np.ndarray) -> np.ndarray:
    """Where one of Unicode's other spaces begins."""
    padded = np.concatenate((raw, np.zeros(2, np.uint8)))
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    return (
        (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        | (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


_ENCODERS: dict[str, Encoder] = {}


def token_pieces(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, closing: int = CLOSING) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32. tokenizer: a file on every executor, by default the installed one."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.uint32(closing).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or tokenizer_path()
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        for batch in steps(batches):
            ids, offsets = encoder.column_ids(batch.column(1))
            data = memoryview(ids.astype("<u4", copy=False)).cast("B")
            total = np.diff(offsets) + 1
            count = -(-total // sequence)
            row = np.repeat(np.arange(len(total)), count)
            piece = ranges(np.zeros(len(total), np.int64), count)
            first = total - (count - 1) * sequence
            length = np.where(piece == 0, first[row], sequence)
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * sequence)
            last = piece == count[row] - 1
            low = 4 * (offsets[row] + start)
            high = low + 4 * (length - last)
            crc = [zlib.crc32(end, x) if z else x for x, z in zip((zlib.crc32(data[i:j]) for i, j in zip(low.tolist(), high.tolist())), last.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths of at most `room`, in the order given: the sequence and the offset of each."""
    opened = np.zeros(room + 1, dtype=np.int64)  # open sequences by residual gap; those without a gap are closed
    waiting: list[list[int]] = [[] for _ in range(room + 1)]
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # Moving one sequence from gap g to g - size changes the sum by 2 * (N[g - size] - N[g] + 1); the closed ones don't count.
        cost = np.where(opened[size:] > 0, opened[: room - size + 1] - opened[size:] + 1, 1 << 40).astype(np.float64)
        if opened[size]:
            cost[0] = -opened[size] + 0.5
        fresh = room - size
        cost[fresh] = opened[fresh] + 0.5 if fresh else 0.0
        left = int(np.argmin(cost))
        if left == fresh:
            at, made = made, made + 1
        else:
            at = waiting[left + size].pop()
            opened[left + size] -= 1
        sequence[i], offset[i] = at, room - left - size
        if left:
            waiting[left].append(at)
            opened[left] += 1
    return sequence, offset


def pack(pieces: DataFrame, groups: int, sequence: int = SEQUENCE) -> DataFrame:
    """`pieces` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset; groups: how many to pack apart."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("length", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_numpy()
        group = table.column("group")[0].as_py() if table.num_rows else 0
        at, offset = np.arange(len(lengths)), np.zeros(len(lengths), dtype=np.int64)
        part = np.flatnonzero(lengths < sequence)
        # Long ones first, by length; the others mixed, which leaves the rule gaps of every size to work with.
        long, rest = part[lengths[part] >= LONG * sequence], part[lengths[part] < LONG * sequence]
        order = np.concatenate((long[np.argsort(-lengths[long], kind="stable")], np.random.default_rng(group).permutation(rest)))
        seq, off = sum_of_squares(lengths[order], sequence)
        at[order], offset[order] = seq + len(lengths), off
        return table.drop_columns("group").append_column("sequence_id", pa.array(at + (group << 32), pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    # By the piece and not its document alone, so that neither a very long text nor rows with one id or none fill a group.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(max(1, groups))).cast("long"))
    return dealt.groupBy("group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, closing: int = CLOSING, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Token pieces of every document with their places."""
    docs = docs.select("doc_id", "text")
    return pack(token_pieces(docs, tokenizer, sequence, closing), -(-docs.count() // group_docs), sequence)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
