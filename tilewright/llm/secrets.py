"""Secret scans: a keyword automaton, patterns tried only where a keyword is, then checksums.

An Aho-Corasick automaton finds every keyword of every kind in one pass; the pattern of a
kind is anchored at the keyword's place and never searched for. Runs of hexadecimal digits
have no keyword: a byte table marks the digits and only runs long enough are looked at.
Two kinds carry a checksum (a token's last six characters are the CRC-32 of the thirty
before, base 62) and count only if it is right. Spans are in code points, end exclusive.

Cases: a null or empty text has no span. A match that is too short is dropped but still
consumes its characters. Equal rows give equal rows. An empty table gives no rows. Other
columns are untouched by `redact` and never read by `scan`; a column that has the name of a
new one is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .textcore import steps

#: Fixed values.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = bytes(120 if chr(b) in "0123456789abcdef" else 46 for b in range(256))
_RUN = b"x" * LEAST["hex"]
_automaton = None


def checksum(body: str) -> str:
    """The CRC-32 of `body` as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, k = divmod(n, 62)
        out = BASE62[k] + out
    return out


def automaton():
    global _automaton
    if _automaton is None:
        import ahocorasick

        made = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            made.add_word(word, (len(word), kind))
        made.make_automaton()
        _automaton = made
    return _automaton


def find_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then kind as listed in KINDS."""
    if not text:
        return []
    flat = text.encode("ascii", "replace")  # a byte for each code point
    found: list[tuple[int, int, str]] = []
    hits = sorted((end + 1 - size, kind) for end, (size, kind) in automaton().iter(flat.lower().decode("ascii")))
    done = dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < done[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, start):
                done[kind] = m.end()
                if len(m[2]) >= LEAST[kind]:
                    found.append((start, m.end(), kind))
        elif kind == "access":
            if m := ACCESS.match(text, start):
                done[kind] = m.end()
                if m.end() - start >= LEAST[kind]:
                    found.append((start, m.end(), kind))
        elif (m := (GITHUB if kind == "github" else NPM).match(text, start)) and checksum(m[1]) == m[2]:
            done[kind] = m.end()
            found.append((start, m.end(), kind))
    marks = flat.translate(_HEX)
    at = marks.find(_RUN)
    while at >= 0:
        end = marks.find(b".", at)
        end = len(marks) if end < 0 else end
        found.append((at, end, "hex"))
        at = marks.find(_RUN, end)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    types = [pa.int64()] * 4 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                spans = find_spans(text.as_py())
                base = [x for x in spans if x[2] in BASE]
                rows.append((doc, *(sum(x[2] == k for x in base) for k in BASE), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """`text` with every maximal stretch of spans replaced by `mark`."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at, last = [], 0, -1
    for start, end, _ in spans:
        if start >= last:
            if last >= 0:
                at = last
            out += [text[at:start], mark]
            last = end
        else:
            last = max(last, end)
    return "".join(out) + text[last:]


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with secrets replaced in `text`, and `n_chars`, where there is one, counted again if the text changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [redacted(x) for x in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if (size := batch.schema.get_field_index("n_chars")) >= 0:
                before = batch.column(size).to_pylist()
                columns[size] = pa.array([n if x is y or x == y else len(y) for n, x, y in zip(before, old, new)], batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


#: A place is the length of all pieces and matches before it; CRC-32 bit by bit.
OP6_SQL = r"""
WITH flat AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', '?', 'g') AS t FROM documents
), kinds(k, kind, p) AS (VALUES
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'github', 'gh[pousr]_'), (4, 'npm', 'npm_')
), matched AS (
  SELECT r, t, k, kind, p, unnest(range(len(pieces))) AS i, unnest(pieces) AS piece, unnest(ms) AS m
  FROM (SELECT r, t, k, kind, p, string_split_regex(t, p) AS pieces, regexp_extract_all(t, p) AS ms FROM flat, kinds)
), placed AS (
  SELECT r, t, k, kind, p, m, CAST(sum(length(piece) + coalesce(length(m), 0)) OVER w AS BIGINT) - coalesce(length(m), 0) AS start
  FROM matched WINDOW w AS (PARTITION BY r, k ORDER BY i)
), tokens AS (
  SELECT r, k, kind, start, length(m) + 36 AS size, substr(t, start + length(m) + 1, 30) AS body,
         substr(t, start + length(m) + 31, 6) AS digits, substr(t, start + length(m) + 37, 1) AS following
  FROM placed WHERE m IS NOT NULL AND k >= 3
), checked AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [(ascii(body[j // 8 + 1]) >> (j % 8)::INTEGER) & 1 for j in range(240)]),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS crc
  FROM tokens WHERE regexp_full_match(body || digits, '[A-Za-z0-9]{36}') AND NOT regexp_full_match(following, '[A-Za-z0-9]')
), valid AS (
  SELECT r, k, kind, start, start + length(m) AS stop FROM placed
  WHERE k = 0 AND length(regexp_extract(m, p, 2)) >= 6 OR k = 1 AND length(m) >= 20 OR k = 2 AND length(m) >= 24
  UNION ALL
  SELECT r, k, kind, start, start + size FROM checked
  WHERE digits = list_aggregate([substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', (crc // power(62, 5 - j)::BIGINT % 62 + 1)::INTEGER, 1) for j in range(6)], 'string_agg', '')
  QUALIFY coalesce(start - lag(start) OVER (PARTITION BY r, k ORDER BY start) >= size, true)
), joined AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, k) FILTER (k < 3) AS base,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, k) AS spans
  FROM valid GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM flat LEFT JOIN joined USING (r)
"""


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
