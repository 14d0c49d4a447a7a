"""Scores of a hierarchical Pitman-Yor language model, learned and used on Spark.

Words are customers of the restaurant of the word before them, whose tables are customers of
one root restaurant that all contexts share as their parent; below it, all V words learned and
one for all others are alike. A table is opened with weight (THETA + d * tables of the
restaurant) * (the parent's probability of the word), an old one is joined with weight
(customers - d). Seating is sampled by Gibbs moves: a customer of a word gets up and sits down
again. A sweep moves all words of all restaurants at once, given the restaurants' tables and the
parent's probabilities of the sweep before. The customers of a word that has up to ALONE of them
move one after another. Those of all other words, however many, are seated anew together,
table by table, by Metropolis-Hastings moves with the same posterior, whose work grows with the
tables. Then the root's customers are the tables of all contexts, and its own seating is sampled
in the same way.
BURN sweeps go first, and the predictive probabilities of the SAMPLES that follow are averaged.
The discount of a level is n1 / (n1 + 2 n2), of words with one and two customers.

How it runs. Pairs (context, word) are dealt to buckets by a hash of both, so a common word is
spread over all of them; the number of buckets grows with the text. Texts are read twice: once
for the pairs and how often each is learned from, counted within each task first, once to score
every text's pairs where the model's are. In a sweep each bucket sends the sums of its words
(tables by context and by word) to the words' owners, ranges of the hash, which add them up,
seat the root's customers and answer with the sums; how often words are learned from is sent in
the first sweep and the last alone. Pairs, seating and sums are written to the shared folder
after every step, so a lost executor costs one step; a step's shuffle files go when it is done.
Random numbers depend on bucket and sweep alone. Nothing but a few sums of numbers reaches the driver.

Tokens are words of lower-cased text (A-Z), then one end; words are told apart by 64-bit
hashes.

Cases: a null or empty text is one token, the end. A null id is learned from. Repeated rows and
ids count, and are scored, each on their own. With nothing learned from, every token has
probability 1. An empty table gives no rows. A very long text is one step of its own. Other
columns are not read.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .textcore import LOWER, MULT, U64, mix64, prefix_hash, span_hash, spans_of, steps, words_of

#: Strength of every restaurant, contexts and root.
THETA = 1.0
BURN, SAMPLES = 1, 2
#: Customers of a word in a restaurant up to which they move one after another in a sweep; more also move all together, this many times.
ALONE, TOGETHER = 32, 4
#: Tables, about, that are seated anew together.
TABLES = 8
#: Added to every count of the plain score.
ADDED = 0.1
#: Text bytes for each bucket.
BUCKET_BYTES = 18 << 20
#: Tokens that a task gathers before it sends them.
GATHERED = 1_500_000
SEED = 12
START, END = mix64(np.array([1, 2], np.uint64) * MULT)
ROWS = "bucket int, part long, round int, z array<binary>"
SUMS = ["ones", "twos", "customers", "tables", "words", "learned"]


def pack(a: np.ndarray, rising: bool = False) -> bytes:
    """Byte planes of numbers, or of their differences, compressed."""
    a = np.diff(a, prepend=a.dtype.type(0)) if rising else np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unpack(z: bytes, kind: type, rising: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    a = np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(a, dtype=kind) if rising else a


def borders(parts: int) -> np.ndarray:
    """Where the ranges of a 64-bit hash begin, but for the first."""
    return np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)


def slices(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of ascending hashes in each range; parts without any are left out."""
    at = [0, *np.searchsorted(keys, borders(parts)).tolist(), len(keys)]
    return [(k, i, j) for k, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i]


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(mix64(context ^ MULT) + word)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every text's tokens and of what stands before each; how many a text has."""
    raw, offsets = spans_of(texts)
    raw = LOWER[raw]
    begin, end, at = words_of(raw, offsets)
    n = np.diff(at) + 1
    last = np.cumsum(n) - 1
    word = np.empty(len(begin) + len(n), np.uint64)
    is_end = np.zeros(len(word), dtype=bool)
    is_end[last] = True
    word[is_end] = END
    if len(begin):
        word[~is_end] = span_hash(prefix_hash(raw), begin, end)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[last + 1 - n] = START
    return word, before, n


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "part", "round", "z"])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _gathered(batches: Iterator[pa.RecordBatch], paired: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Of some GATHERED tokens at a time: tokens, or `paired` keys of pairs; the documents' numbers of tokens, ids, whether these are known, flags."""
    held, size = [], 0

    def joined() -> tuple[np.ndarray, ...]:
        columns = [list(x) for x in zip(*held)]
        held.clear()
        return tuple(np.concatenate(columns.pop(0)) for _ in range(len(columns)))

    for batch in steps(batches):
        doc = batch.column(0).cast(pa.int64())
        word, before, n = tokens(batch.column(1))
        held.append((pair_key(before, word) if paired else word, n, doc.fill_null(0).to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)))
        size += len(word)
        del word, before
        if size >= GATHERED:
            size = 0
            yield joined()
    if held:
        yield joined()


def _places(n: np.ndarray) -> np.ndarray:
    """The document of every token."""
    return np.repeat(np.arange(len(n), dtype=np.uint32), n)


def _distinct(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), dtype=bool), codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def pair_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """ROWS of the pairs of a task's texts by bucket: words, context, word, times learned from; contexts and words by their places among the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for word, n, _, _, train in _gathered(batches, False):
            known, code = np.unique(np.append(word, START), return_inverse=True)
            del word
            start = np.uint64(code[-1])
            code = code[:-1].astype(np.uint64)
            context = np.empty_like(code)
            context[1:] = code[:-1]
            context[np.cumsum(n) - n] = start
            context <<= U64(32)
            code |= context
            del context
            pairs, n = _distinct(code, np.repeat(train.astype(np.uint32), n))
            del code
            u, w = (pairs >> U64(32)).astype(np.int64), (pairs & U64(0xFFFFFFFF)).astype(np.int64)
            bucket = np.searchsorted(borders(buckets), pair_key(known[u], known[w]), side="right")
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                own = order[ends[k] : ends[k + 1]]
                if len(own):
                    used = np.zeros(len(known), dtype=bool)
                    used[u[own]] = used[w[own]] = True
                    at = np.cumsum(used, dtype=np.uint32) - np.uint32(1)
                    yield _batch([(k, 0, 0, [pack(known[used], True), pack(at[u[own]], True), pack(at[w[own]]), pack(n[own].astype(np.uint32))])])
            del pairs, n, u, w, bucket, order

    return docs.mapInArrow(run, ROWS)


def _merged(_: tuple, table: pa.Table) -> pa.Table:
    """One row of a bucket's pairs, as pair_blocks gives them, with 64-bit counts."""
    rows = table["z"].to_pylist()
    words = [unpack(z[0], np.uint64, True) for z in rows]
    known = np.unique(np.concatenate(words))
    codes, counts = [], []
    for z, own in zip(rows, words):
        at = np.searchsorted(known, own).astype(np.uint64)
        codes.append(at[unpack(z[1], np.uint32, True)] << U64(32) | at[unpack(z[2], np.uint32)])
        counts.append(unpack(z[3], np.uint32).astype(np.int64))
    pairs, n = _distinct(np.concatenate(codes), np.concatenate(counts))
    z = [pack(known, True), pack((pairs >> U64(32)).astype(np.uint32), True), pack((pairs & U64(0xFFFFFFFF)).astype(np.uint32)), pack(n)]
    made = _table([(table["bucket"][0].as_py(), -1, 0, z)])
    for name, value in (("ones", int((n == 1).sum())), ("twos", int((n == 2).sum()))):
        made = made.append_column(name, pa.array([value], pa.int64()))
    return made


def opened(c: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A start: about how many tables c customers open who come one after another, each with that weight."""
    more = weight * np.log((c - 1 + weight) / weight)
    return 1 + np.minimum(rng.poisson(np.minimum(more, 1e9)), c - 1)


def moved(c: np.ndarray, t: np.ndarray, sizes: np.ndarray, base: np.ndarray, parent: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables and their sizes after moves of all customers.

    Of each word in a restaurant: c customers (2 or more) at t tables, whose sizes follow each
    other in `sizes`; base: THETA + d * the restaurant's other tables. About c customers of a
    word get up, one after another, each of them any of the c; words with more than ALONE go on
    with all their customers at once.
    """
    pair = np.repeat(np.arange(len(c)), t)
    low = 0
    while low < ALONE:
        high = min(ALONE, max(2, 2 * low))
        some = np.flatnonzero(c > low)
        if not len(some):
            break
        at, size, pair, sizes = _split(pair, sizes, some, len(c))
        for _ in range(low, high):
            at, size = _round(c[some], at, size, base[some], parent[some], d, rng)
        pair, sizes = _joined(pair, sizes, some[at], size)
        low = high
    some = np.flatnonzero(c > ALONE)
    if len(some):
        at, size, pair, sizes = _split(pair, sizes, some, len(c))
        for k in range(TOGETHER):
            at, size = _together(c[some], at, size, base[some], parent[some], d, rng, k % 2 == 1)
        pair, sizes = _joined(pair, sizes, some[at], size)
    return np.bincount(pair, minlength=len(c)), sizes


def _split(pair: np.ndarray, sizes: np.ndarray, some: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Tables of some words, by their places among these, and those of the others."""
    number = np.full(n, -1)
    number[some] = np.arange(len(some))
    busy = number[pair] >= 0
    return number[pair[busy]], sizes[busy], pair[~busy], sizes[~busy]


def _joined(pair: np.ndarray, sizes: np.ndarray, more: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair, sizes = np.concatenate((pair, more)), np.concatenate((sizes, size))
    order = np.argsort(pair, kind="stable")
    return pair[order], sizes[order]


def _falling(m: np.ndarray, d: float) -> np.ndarray:
    """log(Gamma(m - d) / Gamma(m)), m from 1."""
    i = np.arange(8)
    x = m[:, None] + i
    lgamma = lambda y: (y - 0.5) * np.log(y) - y + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return lgamma(m + 8 - d) - lgamma(m + 8.0) - np.log1p(-d / x).sum(1)


def _sizes(z: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Sizes n with chances in proportion to (1 - d)(2 - d)...(n - 1 - d) z ** n / n!, one for each z."""
    out, todo = np.zeros(len(z), np.int64), np.arange(len(z))
    while len(todo):
        own = z[todo]
        low = own < 0.5
        b = rng.beta(np.where(low, 1 + d, d), 1 - d)
        p = np.where(low, 1 - own * (1 - b), b)
        n = np.minimum(rng.geometric(np.maximum(p, 1e-15)), 1 << 40)
        sure = rng.random(len(todo)) < np.where(low, (1 - own) / p, own**n)
        out[todo[sure]] = n[sure]
        todo = todo[~sure]
    return out


def _tilt(c: np.ndarray, rate: np.ndarray, d: float) -> np.ndarray:
    """z up to 1 - 1 / c, so that tables of these sizes, met at that rate, seat about c customers at most."""
    low, high = np.zeros(len(c)), 1 - 1 / c
    full = rate * d * high * (1 - high) ** (d - 1) <= c
    for _ in range(40):
        z = (low + high) / 2
        over = rate * d * z * (1 - z) ** (d - 1) > c
        low, high = np.where(over, low, z), np.where(over, z, high)
    return np.where(full, 1 - 1 / c, np.maximum(low, 1e-9))


def _together(c, at, size, base, parent, d, rng, in_groups):
    """All customers of each word are seated anew, or stay; at: the word of each table, ascending.

    Given a gamma number of each word, its tables are a Poisson process of sizes of `_sizes`
    with z = 1, given that they seat c. One customer's table takes those that the others leave;
    the others are drawn with z of `_tilt`, and stand with the ratio of the posterior to that
    draw. In groups: every table is in one of a few groups of its word by chance, and each group
    is such a process, of the customers that it has.
    """
    n = len(c)
    rate = parent * rng.gamma(base / d + np.bincount(at, minlength=n))
    groups = np.ones(n, np.int64)
    if in_groups:
        groups = np.maximum((rate * (1 - (1 - _tilt(c, rate, d)) ** d) / TABLES).astype(np.int64), 1)
    of = np.cumsum(groups) - groups
    group = of[at] + (rng.random(len(at)) * groups[at]).astype(np.int64)
    order = np.argsort(group, kind="stable")
    at, size = at[order], size[order]
    _, first, group, t = np.unique(group[order], return_index=True, return_inverse=True, return_counts=True)
    word = at[first]
    c, rate = np.add.reduceat(size, first), rate[word] / groups[word]
    one = c == 1
    z = _tilt(np.maximum(c, 2), rate, d)
    own = size[np.searchsorted(np.cumsum(size), np.cumsum(c) - c + (rng.random(len(c)) * c).astype(np.int64), side="right")]
    number = np.where(one, 0, rng.poisson(rate * (1 - (1 - z) ** d)))
    of_new = np.repeat(np.arange(len(c)), number)
    new = _sizes(z[of_new], d, rng)
    others = np.bincount(of_new, weights=new, minlength=len(c)).astype(np.int64)
    rest = np.maximum(c - others, 1)
    log_ratio = _falling(rest, d) - _falling(own, d) + (rest - own) * np.log(z)
    stands = ~one & (others < c) & (np.log1p(-rng.random(len(c))) < log_ratio)
    keep, drawn = ~stands[group], stands[of_new]
    at = np.concatenate((at[keep], word[stands], word[of_new[drawn]]))
    size = np.concatenate((size[keep], rest[stands], new[drawn]))
    order = np.argsort(at, kind="stable")
    return at[order], size[order]


def _round(c, at, size, base, parent, d, rng):
    """One customer of each word gets up and sits down; at: the word of each table, ascending."""
    n = len(c)
    t = np.bincount(at, minlength=n)
    first = np.cumsum(t) - t
    table = np.searchsorted(np.cumsum(size), np.cumsum(c) - c + (rng.random(n) * c).astype(np.int64), side="right")
    size = size.copy()
    size[table] -= 1
    left = size[table] == 0
    now = t - left
    new = (base + d * now) * parent
    draw = rng.random(n) * (new + (c - 1) - d * now)
    sits = (draw >= new) & (now > 0)
    weight = np.cumsum(np.where(size > 0, size - d, 0.0))
    begin = np.where(first > 0, weight[first - 1], 0.0)
    chosen = np.clip(np.searchsorted(weight, begin + draw - new, side="right"), first, first + t - 1)
    chosen = np.where(sits, chosen, table)
    size[chosen[sits | left]] += 1  # a table that was just left is there to be opened again
    more = np.flatnonzero(~sits & ~left)
    keep = size > 0
    at, size = at[keep], size[keep]
    if len(more):
        at, size = np.concatenate((at, more)), np.concatenate((size, np.ones(len(more), size.dtype)))
        order = np.argsort(at, kind="stable")
        at, size = at[order], size[order]
    return at, size


@dataclass(frozen=True)
class Root:
    """The root restaurant of a sweep: customers, tables, words known; discounts of contexts and root; tokens learned from."""

    customers: int
    tables: int
    words: int
    d: float
    d0: float
    learned: int

    def probability(self, k: np.ndarray, tables: np.ndarray) -> np.ndarray:
        rest = (THETA + self.d0 * self.tables) / (THETA + self.customers) / (self.words + 1)
        return np.maximum(k - self.d0 * tables, 0.0) / (THETA + self.customers) + rest


@dataclass
class Bucket:
    """A bucket's pairs and, by sweep, its words' sums: tables as context, tables as word, the root's tables, of the last sweep times as context, times as word."""

    known: np.ndarray
    u: np.ndarray
    w: np.ndarray
    n: np.ndarray
    sums: dict[int, list[np.ndarray]]
    seats: dict[int, list[bytes]]

    @classmethod
    def of(cls, rows: list[dict]) -> Bucket:
        """From rows of part -1 (pairs), -2 (seats) and, by owner, sums."""
        z = next(r["z"] for r in rows if r["part"] == -1)
        parts: dict[int, list] = {}
        for r in sorted((r for r in rows if r["part"] >= 0), key=lambda r: r["part"]):
            parts.setdefault(r["round"], []).append([unpack(x, np.int64) for x in r["z"]])
        sums = {k: [np.concatenate(x) for x in zip(*v)] for k, v in parts.items()}
        seats = {r["round"]: r["z"] for r in rows if r["part"] == -2}
        return cls(unpack(z[0], np.uint64, True), unpack(z[1], np.uint32, True), unpack(z[2], np.uint32), unpack(z[3], np.int64), sums, seats)

    def by_owner(self, number: int, turn: int, t: np.ndarray, sizes: np.ndarray, owners: int, counts: bool) -> list[tuple]:
        """ROWS of the words' sums, with those of times if `counts`, for their owners, and of the seats for this bucket itself."""
        size = len(self.known)
        sums = [np.bincount(x, weights=y, minlength=size).astype(np.int64) for y in ([t, self.n] if counts else [t]) for x in (self.u, self.w)]
        rows = [(k, number, turn, [pack(self.known[i:j], True), *[pack(x[i:j]) for x in sums]]) for k, i, j in slices(self.known, owners)]
        return [*rows, (number, -2 - number, turn, [pack(t), pack(sizes)])]


def _first(owners: int):
    """Before any seating: a table for each word of a restaurant."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        own = Bucket.of(table.to_pylist())
        return _table(own.by_owner(table["bucket"][0].as_py(), 0, np.minimum(own.n, 1), own.n[own.n > 1], owners, True))

    return run


def _sweep(turn: int, root: Root, owners: int, counts: bool):
    """A bucket's seats after the sweep `turn`, from those of the one before; counts: as in `by_owner`."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        number = table["bucket"][0].as_py()
        own = Bucket.of(table.to_pylist())
        rng = np.random.default_rng([SEED, turn, number])
        context, word, root_tables = own.sums[turn - 1]
        many = np.flatnonzero(own.n > 1)
        t, sizes = (unpack(z, np.int64) for z in own.seats[turn - 1])
        c, old = own.n[many], t[many]
        parent = root.probability(word, root_tables)[own.w[many]]
        base = THETA + root.d * (context[own.u[many]] - old)
        if turn == 1:
            old = opened(c, (base + root.d * old) * parent, rng)
            sizes = np.ones(int(old.sum()), np.int64)
            sizes[np.cumsum(old) - old] = c - old + 1
        seated, sizes = moved(c, old, sizes, base, parent, root.d, rng)
        t = np.minimum(own.n, 1)
        t[many] = seated
        return _table(own.by_owner(number, turn, t, sizes, owners, counts))

    return run


def _owned(turn: int, root: Root | None):
    """Sums of an owner's words over all buckets, answered to each (times with a root only), the root's seating, and the columns SUMS in the first row."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        owner = rows[0]["bucket"]
        seats = [(-2 - r["part"], -2, turn, r["z"]) for r in rows if r["part"] < -1]
        asked = [(r["part"], [unpack(r["z"][0], np.uint64, True), *[unpack(x, np.int64) for x in r["z"][1:]]]) for r in rows if r["part"] >= 0]
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *[x[0] for _, x in asked]]))
        sums = np.zeros((max((len(x) - 1 for _, x in asked), default=2), len(known)), np.int64)
        places = [np.searchsorted(known, x[0]) for _, x in asked]
        for at, (_, x) in zip(places, asked):
            for total, more in zip(sums, x[1:]):
                total[at] += more
        context, k, *counts = sums
        times = counts[1] if counts else np.zeros(0, np.int64)
        tables = np.minimum(k, 1)
        if root:
            many = np.flatnonzero(k > 1)
            rng = np.random.default_rng([SEED, turn, owner, 1])
            like = np.full(len(many), 1.0 / (root.words + 1))
            base = np.full(len(many), THETA + root.d0 * root.tables)
            t = opened(k[many], base * like, rng)
            sizes = np.ones(int(t.sum()), np.int64)
            sizes[np.cumsum(t) - t] = k[many] - t + 1
            tables[many] = moved(k[many], t, sizes, base, like, root.d0, rng)[0]
        answers = [(bucket, owner, turn, [pack(x[at]) for x in (context, k, tables, *(counts if root else []))]) for at, (bucket, _) in zip(places, asked)]
        made = _table([*seats, *answers])
        for name, value in zip(SUMS, (int((k == 1).sum()), int((k == 2).sum()), int(k.sum()), int(tables.sum()), int((times > 0).sum()), int(times.sum()))):
            made = made.append_column(name, pa.array([value] + [0] * (made.num_rows - 1), pa.int64()))
        return made

    return run


def _asked(docs: DataFrame, buckets: int) -> DataFrame:
    """ROWS of the pairs of some documents by bucket (keys, times, documents), and of the documents themselves (part and all the rest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for keys, n, ids, valid, _ in _gathered(batches, True):
            yield _batch([(number % buckets, number, -2, [pack(ids), pack(valid.astype(np.uint8)), pack(n.astype(np.int64))])])
            order = np.argsort(keys)
            place = _places(n)[order]
            keys = keys[order]
            del order
            for k, i, j in slices(keys, buckets):
                first = np.flatnonzero(np.concatenate(([True], keys[i + 1 : j] != keys[i : j - 1])))
                yield _batch([(k, number, -1, [pack(keys[i:j][first], True), pack(np.diff(first, append=j - i).astype(np.uint32)), pack(place[i:j])])])
            del keys, place
            number += 1

    return docs.mapInArrow(run, ROWS)


def _scored(roots: dict[int, Root]):
    """Sums over a bucket's pairs for every group of documents: places, known tokens, plain score, score. Rows of documents are passed on."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        rounds, parts, z = table["round"].to_numpy(), table["part"].to_numpy(), table["z"]
        out = [(bucket, parts[i], -2, z[i].as_py()) for i in np.flatnonzero(rounds == -2)]
        asked = np.flatnonzero(rounds == -1)
        if len(asked):
            own = Bucket.of(table.filter(pa.array(rounds >= 0)).to_pylist())
            last = own.sums[max(roots)]
            customers, times = last[3][own.u], last[4][own.w]
            any_root = roots[max(roots)]
            plain = np.log10((times + ADDED) / (any_root.learned + ADDED * (any_root.words + 1)))
            share = np.zeros(len(own.n))
            for turn, root in roots.items():
                context, word, root_tables = own.sums[turn][:3]
                parent = root.probability(word, root_tables)[own.w]
                own_part = own.n - root.d * unpack(own.seats[turn][0], np.int64)
                share += (own_part + (THETA + root.d * context[own.u]) * parent) / (THETA + customers)
            model = np.log10(share / len(roots))
            del last, customers, context, word, root_tables, parent, own_part, share
            own.sums.clear()
            keys = pair_key(own.known[own.u], own.known[own.w])
            order = np.argsort(keys)
            keys = keys[order]
            values = [(times > 0).astype(np.float64)[order], plain[order], model[order]]
            del own, order, times, plain, model
            for i in asked:  # one at a time is held unpacked
                packed = z[i].as_py()
                pairs, reps, place = unpack(packed[0], np.uint64, True), unpack(packed[1], np.uint32), unpack(packed[2], np.uint32)
                at = np.repeat(np.searchsorted(keys, pairs), reps)
                docs, place = np.unique(place, return_inverse=True)
                out.append((bucket, parts[i], -1, [pack(docs, True), *[pack(np.bincount(place, weights=v[at])) for v in values]]))
        return _table(out)

    return run


def _documents(_: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: (r["round"], r["bucket"]))
    z = rows[0]["z"]
    ids, valid, n = unpack(z[0], np.int64), unpack(z[1], np.uint8), unpack(z[2], np.int64)
    sums = np.zeros((3, len(ids)))
    for r in rows[1:]:
        docs = unpack(r["z"][0], np.uint32, True)
        for k in range(3):
            sums[k, docs] += unpack(r["z"][k + 1], np.float64)
    return pa.table({"doc_id": pa.array(ids, mask=valid == 0), "n_tokens": n, "n_known": sums[0].astype(np.int64), "base_score": sums[1], "score": sums[2]})


def _let_go(docs: DataFrame) -> None:
    """Shuffle files of finished steps go when the driver collects garbage, which by itself may be after they fill the disks."""
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


def _discount(ones: int, twos: int) -> float:
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones else 0.5


def scored(docs: DataFrame, learned_from: Column, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row, by a model of the rows `learned_from`; docs: doc_id, text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learned_from, F.lit(False)).alias("learned_from"))
    buckets = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes))
    by_bucket = lambda x, f, schema=ROWS: x.groupBy("bucket").applyInArrow(f, schema)
    with_sums = lambda names: ", ".join([ROWS, *[f"{c} long" for c in names]])
    pairs = stored(by_bucket(pair_blocks(rows, buckets), _merged, with_sums(SUMS[:2])))
    ones, twos = pairs.agg(F.sum("ones"), F.sum("twos")).first()
    pairs = pairs.drop("ones", "twos")
    _let_go(docs)
    d = _discount(ones or 0, twos or 0)
    kept, roots, root = pairs, {}, None
    history: dict[int, DataFrame] = {}
    for turn in range(BURN + SAMPLES + 1):
        sent = by_bucket(kept, _sweep(turn, root, buckets, turn == BURN + SAMPLES) if root else _first(buckets))
        answered = stored(by_bucket(sent, _owned(turn, root), with_sums(SUMS)))
        total = answered.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]).first()
        root = Root(total["customers"], total["tables"], root.words if root else total["words"], d, root.d0 if root else _discount(total["ones"], total["twos"]), root.learned if root else total["learned"])
        history[turn], roots[turn] = answered.drop(*SUMS), root
        kept = pairs.union(history[turn])
        del sent, answered
        _let_go(docs)
    roots = {k: r for k, r in roots.items() if k > BURN}
    model = pairs
    for k in roots:
        model = model.union(history[k])
    sums = by_bucket(model.union(_asked(rows, buckets)), _scored(roots))
    out = sums.groupBy("part").applyInArrow(_documents, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(root.learned).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scores: DataFrame) -> DataFrame:
    """perplexity and base_perplexity over all tokens of some rows of `scored`."""
    per_token = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.agg(per_token("score").alias("perplexity"), per_token("base_score").alias("base_perplexity"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 10."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(10)) == 0, F.lit(False))


def op12_lm_scoring(spark, sf_dir: str) -> DataFrame:
    out = scored(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), ~held_out())
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
