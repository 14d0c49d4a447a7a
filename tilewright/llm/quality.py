"""Quality rules with a linear-chain conditional random field over lines.

Fixed rules count words, symbols, repeated lines and repeated five-word windows. Every line
with a word gets features: shares of symbols, capitals, digits, exclamation marks and words
in repeated windows, whether it repeats an earlier line, and its spread, by how much more
documents have the line than have its neighbours (a footer has strange neighbours each time,
a copied text the same ones). A two-state chain (boilerplate, content) with a weight for each
feature and for each pair of neighbouring states is decoded by Viterbi, and a document is
kept if the words in content lines are at least SHARE of all its words.

The chain is trained here by gradient ascent on the likelihood of the states of every line of
documents labelled good or bad, from a bounded sample of labelled rows. A line has the state
of its document, but one that repeats an earlier line or has a spread above half its range is
boilerplate in any document; so states change within documents. The driver holds 36 bytes for
each of these lines.

Texts are read once; then only hashes, word counts and features of lines are kept and
shuffled. Lines are counted over all documents with partial aggregation. Counts above one are
joined back on line and salt, so a line that very many documents share is split.

Cases: a null or empty text has no words and fails. Lines without a word have no state.
Without labels of both kinds the chain has zero weights and every line is content. Equal rows
give equal rows. An empty table gives no rows. A very long text is measured and decoded in
one step of its own. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .textcore import SPACE, prefix_hash, ranges, span_hash, spans_of, steps, windows_of, words_of

WINDOW = 5
SHARE = 0.5
#: At most about so many labelled rows are trained on, with all their lines.
SAMPLE = 2000
STEPS = 60
#: Lines of which the gradient is taken at a time; a longer document is taken alone.
PART_LINES = 1 << 17
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: Parts that the documents with one line are split into.
SALTS = 8
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
SHOUT = np.zeros(256, dtype=bool)
SHOUT[33] = True
MARKS = 6
FEATURES = MARKS + 2
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINE = np.dtype([("words", "<u4"), ("marks", "u1", MARKS)])


def _between(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many flags are set in every span."""
    before = np.concatenate(([0], np.cumsum(flags)))
    return before[end] - before[begin]


def _repeated(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries equal another one of their group, and which an earlier one."""
    n = len(key)
    order = np.lexsort((key, group))
    same = np.zeros(n + 1, dtype=bool)
    same[1:n] = (key[order][1:] == key[order][:-1]) & (group[order][1:] == group[order][:-1])
    twice, later = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    twice[order] = same[:-1] | same[1:]
    later[order] = same[:-1]  # lexsort is stable: entries stay in text order among equals
    return twice, later


def measure(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of every text; of every line with a word its document, hash, and words and marks (features in 255ths)."""
    raw, offsets = spans_of(texts)
    n = len(offsets) - 1
    begin, end = offsets[:-1], offsets[1:]
    w_begin, w_end, word_at = words_of(raw, offsets)
    sums = prefix_hash(raw)
    words = span_hash(sums, w_begin, w_end)
    n_words = np.diff(word_at)
    doc_of_word = np.repeat(np.arange(n), n_words)
    keys, doc = windows_of(words, word_at, WINDOW)
    many = n_words[doc] >= WINDOW
    keys, doc = keys[many], doc[many]
    runs = np.maximum(n_words - WINDOW + 1, 0)
    first = ranges(word_at[:-1], runs)
    twice, _ = _repeated(doc, keys)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    # Lines: each begins at a text's begin or after a line break.
    head = np.zeros(len(raw) + 1, dtype=bool)
    head[begin[end > begin]] = True
    breaks = np.flatnonzero(raw == 10) + 1
    head[breaks] = True
    head[len(raw)] = False
    l_begin = np.flatnonzero(head)
    l_end = np.append(l_begin[1:], len(raw))
    l_end = l_end - ((l_end > l_begin) & (raw[l_end - 1] == 10)) if len(l_begin) else l_end
    l_word = np.searchsorted(w_begin, l_begin)
    l_stop = np.searchsorted(w_begin, l_end)
    real = l_stop > l_word
    l_begin, l_end, l_word, l_stop = l_begin[real], l_end[real], l_word[real], l_stop[real]
    l_doc = np.searchsorted(offsets, l_begin, side="right") - 1
    l_words = l_stop - l_word
    line = span_hash(sums, l_begin, l_end)
    _, later = _repeated(l_doc, line)
    points = ~SPACE[raw] & ((raw & 0xC0) != 0x80)
    counts = {
        "n_words": n_words,
        "word_chars": _between(points, begin, end),
        "n_symbols": _between(SYMBOL[raw], begin, end),
        "n_dup_lines": np.bincount(l_doc[later], minlength=n),
        "n_repeat_words": np.bincount(doc_of_word[covered], minlength=n),
    }
    chars = np.maximum(_between(points, l_begin, l_end), 1)
    share = lambda flags, scale: np.minimum(scale * _between(flags[raw], l_begin, l_end) / chars, 1.0)
    own = np.zeros(len(l_doc), dtype=LINE)
    own["words"] = l_words
    marks = [share(SYMBOL, 4.0), share(UPPER, 2.0), share(DIGIT, 2.0), _between(covered, l_word, l_stop) / np.maximum(l_words, 1), later, share(SHOUT, 4.0)]
    for k, mark in enumerate(marks):
        own["marks"][:, k] = np.rint(255 * mark)
    return counts, l_doc, line.view(np.int64), own


def features(doc: np.ndarray, own: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Of every line; doc: ascending; seen: how many documents have the line."""
    x = np.ones((len(doc), FEATURES))
    x[:, 1:-1] = own["marks"] / 255.0
    logs = np.log2(seen)
    same = doc[1:] == doc[:-1]
    near = np.zeros(len(doc))
    near[1:] = np.where(same, logs[:-1], 0.0)
    near[:-1] = np.maximum(near[:-1], np.where(same, logs[1:], 0.0))
    alone = ~(np.append(same, False) | np.insert(same, 0, False)) if len(doc) else np.zeros(0, dtype=bool)
    x[:, -1] = np.where(alone, 0.0, np.clip((logs - near) / 4.0, 0.0, 1.0))
    return x


def _side_by_side(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and states of all first lines, then all second ones and so on, the longest sequence first; and how many lines each step has."""
    place = ranges(np.zeros(len(sizes), np.int64), sizes)
    rank = np.empty(len(sizes), np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
    order = np.lexsort((np.repeat(rank, sizes), place))
    return x[order], y[order], np.bincount(place)


class Chain:
    """Two states, 0 boilerplate and 1 content. emit: state by feature; move: state by next state."""

    def __init__(self):
        self.emit, self.move = np.zeros((2, FEATURES)), np.zeros((2, 2))

    def fit(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, steps: int = STEPS, rate: float = 0.5, decay: float = 1e-3) -> "Chain":
        """x: sequence, line, feature; y: state; mask: which lines there are, at the front of each sequence."""
        return self.fit_lines([(x[mask], y[mask], mask.sum(axis=1))], steps, rate, decay)

    def fit_lines(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], steps: int = STEPS, rate: float = 0.5, decay: float = 1e-3) -> "Chain":
        """parts: features and state of every line, sequence after sequence, and the sequences' sizes."""
        parts = [_side_by_side(*part) for part in parts]
        total = max(1, sum(len(y) for _, y, _ in parts))
        m = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        v = [np.zeros_like(self.emit), np.zeros_like(self.move)]
        for step in range(1, steps + 1):
            slopes = [np.zeros_like(self.emit), np.zeros_like(self.move)]
            for part in parts:
                for slope, own in zip(slopes, self._slopes(*part)):
                    slope += own
            for k, weight in enumerate((self.emit, self.move)):
                slope = slopes[k] / total - decay * weight
                m[k] = 0.9 * m[k] + 0.1 * slope
                v[k] = 0.99 * v[k] + 0.01 * slope * slope
                weight += rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8) * 0.2
        return self

    def _slopes(self, x: np.ndarray, y: np.ndarray, running: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Seen less expected features of the states, and pairs of states; lines as of _side_by_side."""
        n, length = len(x), len(running)
        x = x.astype(float)
        start = np.concatenate(([0], np.cumsum(running)))
        score = x @ self.emit.T
        fore, back = score.copy(), np.zeros((n, 2))
        for t in range(1, length):
            k, i, j = running[t], start[t - 1], start[t]
            own = fore[i : i + k]
            fore[j : j + k] += np.logaddexp(own[:, 0, None] + self.move[0], own[:, 1, None] + self.move[1])
        for t in range(length - 2, -1, -1):
            k, i, j = running[t + 1], start[t], start[t + 1]
            later = score[j : j + k] + back[j : j + k]
            back[i : i + k] = np.logaddexp(self.move[:, 0] + later[:, 0, None], self.move[:, 1] + later[:, 1, None])
        whole = fore + back
        norm = np.logaddexp(whole[:, 0], whole[:, 1])
        now = np.arange(running[0], n)
        before = now - np.repeat(running[:-1], running[1:])
        pair = fore[before][:, :, None] + self.move + (score + back)[now][:, None, :] - norm[now, None, None]
        hot = np.eye(2)[y]
        return (hot - np.exp(whole - norm[:, None])).T @ x, hot[before].T @ hot[now] - np.exp(pair).sum(axis=0)

    def decode(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The likeliest states of every line; doc: ascending, a chain for each value. Ties: content."""
        n = len(x)
        if not n:
            return np.zeros(0, dtype=np.int64)
        score = x @ self.emit.T
        head = np.ones(n, dtype=bool)
        head[1:] = doc[1:] != doc[:-1]
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, n))
        # All chains advance together, the longest first, so that those still running are a prefix.
        order = np.argsort(-size, kind="stable")
        at, size = at[order], size[order]
        running = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
        from_one = np.zeros((n, 2), dtype=bool)
        best = score[at]
        for t in range(1, size[0]):
            k = running[t]
            zero, one = best[:k, 0, None] + self.move[0], best[:k, 1, None] + self.move[1]
            came = one >= zero
            from_one[at[:k] + t] = came
            best[:k] = np.where(came, one, zero) + score[at[:k] + t]
        state = np.zeros(n, dtype=np.int64)
        last = best[:, 1] >= best[:, 0]
        now = last.astype(np.int64)
        for t in range(size[0] - 1, -1, -1):
            k = running[t]
            state[at[:k] + t] = now[:k]
            if t:
                now[:k] = from_one[at[:k] + t, now[:k]]
        return state


def survey(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, the counts, lines (hashes), own (words and marks of each) of every document); (line, n): documents that have a line, where more than one."""
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    schema = "doc_id long, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, own binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            counts, doc, line, own = measure(batch.column(1))
            at = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            packed = [own[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(line)), pa.array(packed, pa.binary())],
                names=["doc_id", "key", *COUNTS, "lines", "own"])

    found = stored(rows.mapInArrow(run, schema))
    seen = found.select(F.explode(F.array_distinct("lines")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return found, stored(seen)


def _with_seen(found: DataFrame, seen: DataFrame) -> DataFrame:
    """`found` with `seen`: line and n of the lines that others have too."""
    asked = found.select("key", F.explode(F.array_distinct("lines")).alias("line"), F.pmod("key", F.lit(SALTS)).alias("salt"))
    salted = seen.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    by = asked.join(salted, ["line", "salt"]).groupBy("key").agg(F.collect_list(F.struct("line", "n")).alias("seen"))
    return found.join(by, "key", "left")


def _lines(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, words and features of every line of a batch with lines, own and seen."""
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    lines = column("lines")
    doc = np.repeat(np.arange(batch.num_rows), np.diff(lines.offsets.to_numpy()))
    line = lines.flatten().to_numpy()
    own = np.frombuffer(b"".join(column("own").to_pylist()), dtype=LINE)
    known = column("seen").flatten()
    keys, first = np.unique(known.field(0).to_numpy(), return_index=True)
    n = np.append(known.field(1).to_numpy()[first], 1)
    at = np.searchsorted(keys, line)
    hit = np.append(keys, 0)[at] == line
    hit &= at < len(keys)
    return doc, own["words"].astype(np.int64), features(doc, own, np.where(hit, n[at], 1))


def train(found: DataFrame, seen: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """A chain from lines of labelled documents (labels: doc_id, quality); found, seen: of survey()."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min((F.col("quality") >= 1).cast("int")).alias("good"))
    count = known.count()
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, sample / max(count, 1)) * (1 << 20))
    rows = _with_seen(found.join(F.broadcast(picked), "doc_id"), seen).select("good", "lines", "own", "seen")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, _, x = _lines(batch)
            good = batch.column(0).to_pylist()
            own, first = np.unique(doc, return_index=True)
            parts = [(good[k], x[i:j].astype("<f4").tobytes()) for k, i, j in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(doc)])]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=["good", "x"])

    kept = sorted((r["good"], bytes(r["x"])) for r in rows.mapInArrow(lines, "good int, x binary").collect())
    chain = Chain()
    if not kept or len({g for g, _ in kept}) < 2:
        return chain
    sizes = np.array([len(x) // (4 * FEATURES) for _, x in kept])
    part = (np.cumsum(sizes) - 1) // PART_LINES
    parts = []
    for k in np.unique(part).tolist():
        some = np.flatnonzero(part == k)
        x = np.frombuffer(b"".join(kept[i][1] for i in some.tolist()), "<f4").reshape(-1, FEATURES)
        state = np.repeat([kept[i][0] for i in some.tolist()], sizes[some])
        state[(x[:, 5] > 0) | (x[:, -1] > 0.5)] = 0
        parts.append((x, state, sizes[some]))
    return chain.fit_lines(parts)


def judge(found: DataFrame, seen: DataFrame, chain: Chain, share: float = SHARE) -> DataFrame:
    """doc_id, the counts, base_failed, content_words, n_lines, content_lines and kept of every document; found, seen: of survey()."""
    names = [*COUNTS, "base_failed", "content_words", "n_lines", "content_lines", "kept"]
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, n_lines long, content_lines long, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, words, x = _lines(batch)
            state = chain.decode(x, doc)
            n = batch.num_rows
            lines, good = np.bincount(doc, minlength=n), np.bincount(doc, weights=state, minlength=n).astype(np.int64)
            content = np.bincount(doc, weights=words * state, minlength=n).astype(np.int64)
            total, twice = batch.column(1).to_numpy(), batch.column(5).to_numpy()
            failed = (total < 10) | (100 * twice > 20 * total)
            kept = ~failed & (content >= share * total)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], *map(pa.array, (failed, content, lines, good, kept))], names=["doc_id", *names])

    return _with_seen(found, seen).select("doc_id", *COUNTS, "lines", "own", "seen").mapInArrow(run, schema)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    found, seen = survey(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judge(found, seen, train(found, seen, spark.read.parquet(f"{sf_dir}/labels.parquet")))
