"""Jaccard self-join on word shingles by T-occurrence search.

A document's set holds the hashes of its distinct shingles of SIZE lower-cased words (of all
its words as one, if there are fewer). Two documents link when 100 * common >= 80 * union;
their sets then share at least T = ceil(0.8 n) members of either.

1. One pass profiles the texts: a digest of every set, so that equal sets become one class,
   and, packed and compressed, how many documents have each shingle (32-bit prefixes, which
   only steer the order below). The at most HOT most frequent ones above OFTEN are broadcast.
2. All sets are put in one order: rare shingles by hash, then frequent ones. Two linked sets
   share one of their first n - T + 1 shingles, so only those go into inverted lists, which
   are read as a stream, the classes with the fewest rare shingles first. A list of up to SHORT
   classes gives its pairs. Up to the nearer end of both prefixes a rare shingle is in both
   sets or counts against the link, so a pair with too few in common is dropped; it is
   searched all the same if it shares a longer list. A longer list gives the pairs of each of
   its first PIVOTS classes with the others: the text that near copies were made from has no
   rare shingle of its own. In the list of a frequent shingle all rare ones of a set are in
   its prefix, so a pair that shares none of them, and is in no other list for that, is left
   out if either set has more of them than a link allows.
3. These pairs are verified before anything is tied together. They are dealt into cells of
   about CELL shingles by their first class, a class with more partners into several, and each
   cell is searched by DivideSkip: for a query set the short inverted lists are merged by a
   heap that skips what can't reach T less the number of long lists, the survivors are probed
   in the long lists by binary search, and those with the overlap required for their size link.
4. Links become components by alternating star contraction. A long list whose classes are all
   in one component is settled. Of any other one, the classes outside its largest component
   are searched against all of its classes, in blocks, by DivideSkip; sets already connected
   are left out of the merged lists, and a pair that is in several long lists is searched in
   the first one only.

Links leave a cell as a tree over the sets they connect, with at most FAN branches at a node.
No step emits the pairs of a group or gathers a group, list or component in one task beyond
fixed block sizes, and equal sets are never expanded.

Cases: a null text or one without words has an empty set, no links and its own id as
component. Rows with equal ids share a component id. A null id has a null component unless
linked. An empty table gives no rows. A very long text is one step and, if it has candidates,
at most one set of a cell of its own size; there is no limit but that of a text in memory.
join_components reads no other columns; one_of_each returns them all, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, free_name, settled, stored
from .textcore import STEP_BYTES, mix64, ranges, shingle_sets, squeezed, steps, unsqueezed

SIZE = 5
PERCENT = 80
#: Shingles in more documents than this come last in the order, if among the HOT most frequent.
OFTEN = 24
HOT = 1 << 20
SHORT = 24
PIVOTS = 4
BUCKETS = 256
#: Shingles profiled before a task hands over what it has.
FLUSH = 4_000_000
#: About so many shingles in a cell.
CELL = 1 << 18
FAN = 64
#: DivideSkip's weight: with lists up to M long, T / (MU * log2 M + 1) lists count as long.
MU = 0.05
ENDLESS = (1 << 31) - 1
FREQUENT = -1


def _squeeze(values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as compressed byte planes of their differences."""
    gaps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _expand(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _digests(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set; 0 of an empty one."""
    n = np.diff(at)
    out = np.zeros(len(n), dtype=np.uint64)
    full = n > 0
    if full.any():
        total = np.add.reduceat(mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)), at[:-1][full])
        out[full] = mix64(total + n[full].astype(np.uint64)) | np.uint64(1)
    return out.view(np.int64)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, data, counts: of shingles, by their upper bits; and with bucket -1 ids, sizes and digests of documents, and hashes of their texts."""
    gathered: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(gathered), return_counts=True)
        edges = np.searchsorted(found >> np.uint32(24), np.arange(BUCKETS + 1))
        rows = [(b, _squeeze(found[i:j]), zstandard.compress(n[i:j].astype("<u4").tobytes(), 1)) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "data", "counts"])

    for batch in steps(batches):
        hashes, at = shingle_sets(batch.column(1), SIZE)
        gathered.append((hashes >> np.uint64(32)).astype(np.uint32))
        size += len(hashes)
        valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column(0).cast(pa.int64()).fill_null(0).to_numpy()
        table = np.stack([valid.astype("<i8"), ids, np.diff(at), _digests(hashes, at), batch.column(2).to_numpy()]).astype("<i8")
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([table.tobytes()], pa.binary()), pa.array([b""], pa.binary())], names=["bucket", "data", "counts"])
        if size >= FLUSH:
            yield flush()
            gathered, size = [], 0
    if size:
        yield flush()


def _unpack_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            valid, ids, n, digest, text = np.frombuffer(data, "<i8").reshape(5, -1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=valid == 0), pa.array(n), pa.array(digest), pa.array(text)], names=["doc_id", "n", "c", "t"])


def _frequent(table: pa.Table) -> pa.Table:
    parts = [(_expand(d), np.frombuffer(zstandard.decompress(c), "<u4")) for d, c in zip(table["data"].to_pylist(), table["counts"].to_pylist())]
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.bincount(back, weights=np.concatenate([c for _, c in parts]))
    some = np.flatnonzero(n > OFTEN)
    some = some[np.lexsort((some, -n[some]))[: HOT // BUCKETS]]
    return pa.table({"data": pa.array([np.sort(keys[some]).astype("<u4").tobytes()], pa.binary())})


def _least(n: np.ndarray) -> np.ndarray:
    return (PERCENT * n + 99) // 100


def _prefixes(hot):
    """h, c, size (shingles of the set; from bit 32, rare ones of its prefix) and end (of a prefix of rare ones alone, upper 31 bits of its last; FREQUENT at a frequent one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = hot.value
        for batch in steps(batches):
            hashes, at = shingle_sets(batch.column(1), SIZE)
            n = np.diff(at)
            digest = _digests(hashes, at)
            _, first = np.unique(digest, return_index=True)
            use = np.zeros(len(n), dtype=bool)
            use[first] = True
            use &= n > 0
            doc = np.repeat(np.arange(len(n)), n)
            code = (hashes >> np.uint64(32)).astype(np.uint32)
            place = np.minimum(np.searchsorted(frequent, code), max(len(frequent) - 1, 0))
            late = frequent[place] == code if len(frequent) else np.zeros(len(code), dtype=bool)
            order = np.lexsort((late, doc))  # stable: within a class of frequency still by hash
            many = n - _least(n) + 1
            rare = np.minimum(n - np.bincount(doc[late], minlength=len(n)), many)
            late = late[order]
            end = np.full(len(n), ENDLESS, dtype=np.int64)
            all_rare = (rare == many) & (n > 0)
            end[all_rare] = (hashes[order][(at[:-1] + many - 1)[all_rare]] >> np.uint64(33)).astype(np.int64)
            take = ranges(at[:-1][use], many[use])
            row = doc[take]
            ends = np.where(late[take], FREQUENT, end[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[order][take].view(np.int64)), pa.array(digest[row]), pa.array((rare[row] << 32) | n[row]), pa.array(ends, pa.int32())], names=["h", "c", "size", "end"])

    return run


LISTED = "a long, b long, h long, star int, size_a long, size_b long, end_a int, end_b int"


def _near(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _room(n: np.ndarray, rare_n: np.ndarray, m: np.ndarray, rare_m: np.ndarray) -> np.ndarray:
    """Whether sets of n and m that share none of their rare shingles may link."""
    need = (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT)
    return (rare_n <= n - need) & (rare_m <= m - need)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows by (h, size, c): pairs of short lists; of long ones a star of pairs around each pivot, and the members a with their h.

    Of a list no more than SHORT rows are held, then its pivots alone.
    """
    names = ["a", "b", "h", "star", "size_a", "size_b", "end_a", "end_b"]
    types = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 2 + [pa.int32()] * 2
    none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.int32)]
    out: list[tuple] = []

    def pairs(columns, i, j, star):
        _, c, size, end = columns
        n, m = size[i] & 0xFFFFFFFF, size[j] & 0xFFFFFFFF
        near = _near(n, m)
        if star:
            near &= (end[i] != FREQUENT) | _room(n, size[i] >> 32, m, size[j] >> 32)
        i, j = i[near], j[near]
        if len(i):
            zero = np.zeros(len(i), np.int64)
            out.append((c[i], c[j], zero, zero + star, size[i], size[j], end[i], end[j], True))

    def members(columns, pivots, first):
        """Rows of a long list; first: place of its first row here, 0 or past the pivots."""
        n, k = len(columns[0]), len(pivots[0])
        both = [np.concatenate(x) for x in zip(pivots, columns)]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(k), np.arange(n), indexing="ij"))
        later = i < j + first
        pairs(both, i[later], j[later] + k, 1)
        zero = np.zeros(n, np.int64)
        out.append((columns[1], zero, columns[0], zero, columns[2], zero, columns[3], zero, False))

    def ready() -> Iterator[pa.RecordBatch]:
        if out:
            pair = np.repeat([x[-1] for x in out], [len(x[0]) for x in out])
            gaps = {1: ~pair, 2: pair}
            arrays = [pa.array(np.concatenate([x[k] for x in out]), t, mask=gaps.get(k)) for k, t in enumerate(types)]
            out.clear()
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    held, open_h, pivots, last_c = none, None, none, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.concatenate((r, x.to_numpy())) for r, x in zip(held, batch.columns)]
        keep = np.ones(len(columns[0]), dtype=bool)
        keep[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        if open_h is not None:
            keep[0] = columns[0][0] != open_h or columns[1][0] != last_c
        columns = [x[keep] for x in columns]
        held = none
        if open_h is not None and len(columns[0]):
            other = columns[0] != open_h
            n = int(np.argmax(other)) if other.any() else len(other)
            if n:
                members([x[:n] for x in columns], pivots, PIVOTS)
                last_c = columns[1][n - 1]
                columns = [x[n:] for x in columns]
            if len(columns[0]):
                open_h = None
        if len(columns[0]):
            h = columns[0]
            start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            count = np.diff(np.append(start, len(h)))
            if count[-1] <= SHORT:
                held = [x[start[-1] :] for x in columns]
                start, count = start[:-1], count[:-1]
            else:
                open_h, last_c = h[-1], columns[1][-1]
                pivots = [x[start[-1] : start[-1] + PIVOTS] for x in columns]
            _short_pairs(columns, start, count, pairs)
            for i, n in zip(start[count > SHORT].tolist(), count[count > SHORT].tolist()):
                members([x[i : i + n] for x in columns], [x[i : i + PIVOTS] for x in columns], 0)
        yield from ready()
    _short_pairs(held, np.zeros(1, np.int64), np.array([len(held[0])]), pairs)
    yield from ready()


def _short_pairs(columns, start, count, pairs) -> None:
    for size in np.unique(count[(count > 1) & (count <= SHORT)]).tolist():
        i, j = np.triu_indices(size, 1)
        base = start[count == size][:, None]
        pairs(columns, (base + i).ravel(), (base + j).ravel(), 0)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, packed = (x.to_pylist() for x in batch.columns)
        first = 0
        while first < len(names):
            texts, size, last = [], 0, first
            while last < len(names) and (not texts or size < STEP_BYTES):
                texts.append(unsqueezed(packed[last]))
                size += len(texts[-1])
                last += 1
            hashes, at = shingle_sets(pa.array(texts, pa.large_binary()), SIZE)
            data = [hashes[i:j].astype("<u8").tobytes() for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(names[first:last], pa.int64()), pa.array(data, pa.binary())], names=["c", "members"])
            first = last


def _count(size: str):
    return F.col(size).bitwiseAND(F.lit(0xFFFFFFFF))


def _possible(lists: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) of the pairs of long lists, and of those that share enough rare shingles for a link."""
    n, m, rare_n, rare_m = _count("size_a"), _count("size_b"), F.shiftright("size_a", 32), F.shiftright("size_b", 32)
    need = F.floor((PERCENT * (n + m) + 99 + PERCENT) / (100 + PERCENT))
    by_a, by_b = rare_n - F.col("common") <= n - need, rare_m - F.col("common") <= m - need
    end_a, end_b = (F.when(F.col(x) == FREQUENT, ENDLESS).otherwise(F.col(x)) for x in ("end_a", "end_b"))
    enough = ((end_a <= end_b) & by_a) | ((end_b <= end_a) & by_b)
    return lists.where("h is null").where((F.col("star") > 0) | enough).select("a", "b", n.alias("n_a"), m.alias("n_b"))


def merge_skip(lists: list[list[int]], need: int) -> list[tuple[int, int]]:
    """(number, lists that have it) of the numbers in at least `need` of the ascending lists, by a heap of their heads."""
    heap = [(own[0], k, 0) for k, own in enumerate(lists) if own]
    heapify(heap)
    out = []
    while len(heap) >= need:
        least, heads = heap[0][0], []
        while heap and heap[0][0] == least:
            heads.append(heappop(heap))
        if len(heads) >= need:
            out.append((least, len(heads)))
            goal = least + 1
        else:
            # With need - 1 heads out, what is below the next one can't be in `need` lists.
            while heap and len(heads) < need - 1:
                heads.append(heappop(heap))
            if not heap:
                break
            goal = heap[0][0]
        for _, k, at in heads:
            at = bisect_left(lists[k], goal, at)
            if at < len(lists[k]):
                heappush(heap, (lists[k][at], k, at))
    return out


def divide_skip(sets: list[np.ndarray], ask: np.ndarray, listed: np.ndarray, root: np.ndarray | None = None, rare: np.ndarray | None = None, skip=None, forest: bool = True) -> list[tuple[int, int]]:
    """Links between sets that ask and sets that are listed; with `forest` those that join them as all links do, given that sets of equal `root` are joined.

    rare: of every set so many shingles that no other one shares; where any is negative, all pairs are searched. skip: of a set, those not to search it against.
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    root = np.arange(len(sets)) if root is None else np.unique(root, return_inverse=True)[1]
    others = np.flatnonzero(listed & (size > 0))
    if not len(others):
        return []
    rare = None if rare is None or (rare < 0).any() else rare
    owner = np.repeat(others, size[others])
    tokens, back, df = np.unique(np.concatenate([sets[k] for k in others.tolist()]), return_inverse=True, return_counts=True)
    posted, start = owner[np.argsort(back, kind="stable")], np.cumsum(df) - df
    logs = np.log2(max(2, int(df.max())))
    out = []
    for d in np.flatnonzero(ask).tolist():
        at = np.minimum(np.searchsorted(tokens, sets[d]), len(tokens) - 1)
        own = at[tokens[at] == sets[d]]
        if len(own) < max(_least(size[d]), 1):
            continue
        wanted = listed & _near(size, size[d])
        wanted[d] = False
        if forest:
            wanted &= root != root[d]
        if rare is not None:
            wanted &= _room(size, rare, size[d], rare[d])
        if skip is not None:
            wanted[skip(d)] = False
        if not wanted.any():
            continue
        need = int((PERCENT * (size[d] + size[wanted].min()) + 99 + PERCENT) // (100 + PERCENT))  # what the smallest of them takes
        ids = posted[ranges(start[own], df[own])]
        kept = wanted[ids]
        lengths = np.add.reduceat(kept, np.cumsum(df[own]) - df[own], dtype=np.int64)
        if np.count_nonzero(lengths) < need:
            continue
        ids = ids[kept]
        cut = np.cumsum(lengths) - lengths
        flat = ids.tolist()
        lists = [flat[cut[k] : cut[k] + lengths[k]] for k in np.argsort(lengths, kind="stable").tolist() if lengths[k]]
        long = min(int(need / (MU * logs + 1)), need - 1)
        short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
        for other, total in merge_skip(short, need - long):
            for one in probed:
                place = bisect_left(one, other)
                total += place < len(one) and one[place] == other
            if 100 * total >= PERCENT * (size[other] + size[d] - total) and not (forest and root[other] == root[d]):
                out.append((d, other))
                root[root == root[other]] = root[d]
    return out


def _trees(links: list[tuple[int, int]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links connect, with at most FAN branches at a node."""
    root = np.arange(n)
    for a, b in links:
        if root[a] != root[b]:
            root[root == root[b]] = root[a]
    order = np.argsort(root, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], root[order][1:] != root[order][:-1]))) if n else np.zeros(0, np.int64)
    count = np.diff(np.append(first, n))
    place = ranges(np.zeros(len(count), np.int64), count)
    base = np.repeat(first, count)
    low = place > 0
    return order[low], order[(base + (place - 1) // FAN)[low]]


def _earlier(h: int, hs: list[list[int]]):
    """Of a member of the list h, those that it shares an earlier list with; hs: the lists of each member."""
    by: dict[int, list[int]] = {}
    for k, own in enumerate(hs):
        for x in own:
            if x < h:
                by.setdefault(x, []).append(k)
    arrays = {x: np.array(own) for x, own in by.items()}
    return lambda d: np.concatenate([np.zeros(0, np.int64), *(arrays[x] for x in hs[d] if x < h)])


def _search(table: pa.Table) -> pa.Table:
    c = table["c"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table["members"]]
    skip = _earlier(table["h"][0].as_py(), table["hs"].to_pylist()) if "hs" in table.column_names else None
    links = divide_skip(sets, table["ask"].to_numpy(), table["listed"].to_numpy(), table["root"].to_numpy(), table["rare"].to_numpy(), skip)
    a, b = _trees(links, len(c))
    return pa.table({"a": pa.array(c[a]), "b": pa.array(c[b])})


def _searched(cells: DataFrame, keys: list[str], sets: DataFrame) -> DataFrame:
    """Links of cells of (keys, c, ask, listed, root, rare)."""
    cells = cells.groupBy(*keys, "c").agg(F.max("ask").alias("ask"), F.max("listed").alias("listed"), F.min("root").alias("root"), F.min("rare").alias("rare"))
    return cells.join(sets, "c").groupBy(*keys).applyInArrow(_search, "a long, b long")


def _pair_cells(pairs: DataFrame) -> DataFrame:
    """cell, part, c, ask, listed, root, rare of pairs (a, b, n_a, n_b)."""
    by = pairs.groupBy("a").agg(F.sum("n_b").alias("w"), F.max("n_a").alias("n"))
    whole = by.agg(F.sum(F.col("w") + F.col("n"))).first()[0] or 0
    cells = -(-whole // CELL)
    by = by.select(F.col("a").alias("q"), F.ceil(F.col("w") / F.greatest(F.lit(CELL), "n")).alias("k"))
    dealt = pairs.join(by, F.col("a") == F.col("q"))
    part = F.when(F.col("k") > 1, F.pmod(F.xxhash64("b"), F.col("k"))).otherwise(-1)
    dealt = dealt.select("a", "b", part.alias("part"), F.when(F.col("k") > 1, F.col("a")).otherwise(F.pmod(F.xxhash64("a"), F.lit(max(cells, 1)))).alias("cell"))
    yes, no = F.lit(True), F.lit(False)
    role = lambda c, ask, listed: dealt.select("cell", "part", F.col(c).alias("c"), ask.alias("ask"), listed.alias("listed"), F.col(c).alias("root"), F.lit(-1).cast("long").alias("rare"))
    return role("a", yes, no).union(role("b", no, yes))


def _list_cells(members: DataFrame, linked: DataFrame) -> DataFrame:
    """h, one, two, c, ask, listed, root, rare of long lists (h, c, n, rare) whose classes aren't all in one component."""
    rows = members.join(linked.withColumnRenamed("id", "c"), "c", "left").select("h", "c", "n", "rare", F.coalesce("component", "c").alias("root"))
    per = rows.groupBy("h", "root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w"))
    main = per.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.struct("k", "root", "w")).alias("m"), F.sum("w").alias("all")).where("kinds > 1")
    half = CELL // 2
    main = main.select(F.col("h").alias("m_h"), F.col("m.root").alias("main"), F.ceil((F.col("all") - F.col("m.w")) / half).cast("int").alias("ones"), F.ceil(F.col("all") / half).cast("int").alias("twos"))
    rows = rows.join(main, F.col("h") == F.col("m_h"))
    yes, no = F.lit(True), F.lit(False)
    one, two = F.pmod(F.xxhash64("c"), F.col("ones")).cast("int"), F.pmod(F.xxhash64("c"), F.col("twos")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = rows.where("root <> main").select("h", one.alias("one"), every("twos").alias("two"), "c", yes.alias("ask"), no.alias("listed"), "root", "rare")
    return asking.union(rows.select("h", every("ones").alias("one"), two.alias("two"), "c", no.alias("ask"), yes.alias("listed"), "root", "rare"))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, c, t) of every document, t being a hash of its text and c null for an empty set; (id, component) of the classes c that have links."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    hashed = docs.withColumn("t", F.xxhash64("text"))
    profile = settled(hashed.mapInArrow(_profile, "bucket int, data binary, counts binary"))
    members = profile.where("bucket < 0").select("data").mapInArrow(_unpack_members, "doc_id long, n long, c long, t long")
    members = settled(members.withColumn("c", F.when(F.col("n") > 0, F.col("c"))))
    found = profile.where("bucket >= 0").groupBy("bucket").applyInArrow(_frequent, "data binary").collect()  # HOT numbers at most
    frequent = np.sort(np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["data"], "<u4") for r in found)]))
    hot = spark.sparkContext.broadcast(frequent)
    prefixes = docs.mapInArrow(_prefixes(hot), "h long, c long, size long, end int")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = prefixes.repartition(parts, "h").sortWithinPartitions("h", "size", "c").mapInArrow(_lists, LISTED)
    known = [F.first(x).alias(x) for x in ("size_a", "size_b", "end_a", "end_b")]
    lists = settled(found.groupBy("a", "b", "h").agg(F.sum(1 - F.col("star")).alias("common"), F.max("star").alias("star"), *known))
    frequent = F.col("end_a") == FREQUENT
    first = F.shiftrightunsigned("h", 1)  # lists of rare shingles come before those of frequent ones, which leave pairs to them
    pairs, long = _possible(lists), lists.where("h is not null").select(F.when(frequent, first).otherwise(-1 - first).alias("h"), F.col("a").alias("c"), _count("size_a").alias("n"), F.when(frequent, F.shiftright("size_a", 32)).otherwise(-1).alias("rare"))

    # One text for each class, by id and text: an id may be null, or be on several texts.
    asked = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).union(long.select("c")).distinct()
    which = members.where("c is not null").join(asked, "c").groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("w"))
    texts = squeezed(hashed, "t").join(which, F.col("doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t") == F.col("w.t")))
    sets = stored(texts.groupBy("c").agg(F.first("z").alias("z")).mapInArrow(_sets, "c long, members binary"))

    linked = components(_searched(_pair_cells(pairs), ["cell", "part"], sets))
    own = long.groupBy("c").agg(F.collect_set("h").alias("hs"))
    more = settled(_searched(_list_cells(long, linked), ["h", "one", "two"], sets.join(own, "c")))
    if not more.isEmpty():
        linked = components(linked.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    return members, linked


def join_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    members, linked = classes(docs)
    own = members.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("rep")).join(linked.withColumnRenamed("id", "c"), "c", "left")
    own = own.withColumn("component", F.coalesce("component", "c"))
    least = own.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = own.join(least, "component").select(F.col("c").alias("m_c"), "component_id")
    out = members.join(named, F.col("c") == F.col("m_c"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` without those whose component has a smaller id; rows with null ids stay."""
    name = free_name(docs, "gone")
    gone = join_components(docs).where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def op5_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS g FROM d
), n AS (
  SELECT d.doc_id, count(s.g)::BIGINT AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), l AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id
)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""
