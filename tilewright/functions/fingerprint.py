"""FarmHash's fingerprint64 of strings, many at a time, and the partition numbers of existing tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col

#: The multipliers of the published hash, and the seed of long strings.
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
SEED = 81


def _u(n: int) -> np.uint64:
    return np.uint64(n & (1 << 64) - 1)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x >> _u(bits) | x << _u(64 - bits)


def _folded(x: np.ndarray) -> np.ndarray:
    return x ^ x >> _u(47)


def _both(u: np.ndarray, v: np.ndarray, by: np.ndarray) -> np.ndarray:
    a = _folded((u ^ v) * by)
    return _folded((v ^ a) * by) * by


def _words(rows: np.ndarray, at: int, size: int = 8) -> np.ndarray:
    """The little-endian number that begins at a place of every row."""
    return np.ascontiguousarray(rows[:, at : at + size]).view(f"<u{size}")[:, 0].astype(np.uint64)


def _short(rows: np.ndarray) -> np.ndarray:
    n = rows.shape[1]
    if n == 0:
        return np.full(len(rows), K2)
    if n < 4:
        a, b, c = (rows[:, k].astype(np.uint64) for k in (0, n >> 1, n - 1))
        return _folded((a + (b << _u(8))) * K2 ^ (_u(n) + (c << _u(2))) * K0) * K2
    by = K2 + _u(2 * n)
    if n < 8:
        return _both(_u(n) + (_words(rows, 0, 4) << _u(3)), _words(rows, n - 4, 4), by)
    a, b = _words(rows, 0) + K2, _words(rows, n - 8)
    return _both(_turned(b, 37) * by + a, (_turned(a, 25) + b) * by, by)


def _middle(rows: np.ndarray) -> np.ndarray:
    """Of 17 to 64 bytes: the outer four words, and, beyond 32, the four within."""
    n = rows.shape[1]
    by = K2 + _u(2 * n)
    a, b = _words(rows, 0) * (K1 if n <= 32 else K2), _words(rows, 8)
    c, d = _words(rows, n - 8) * by, _words(rows, n - 16) * K2
    y = _turned(a + b, 43) + _turned(c, 30) + d
    z = _both(y, a + _turned(b + K2, 18) + c, by)
    if n <= 32:
        return z
    e, f = _words(rows, 16) * by, _words(rows, 24)
    g, h = (y + _words(rows, n - 32)) * by, (z + _words(rows, n - 24)) * by
    return _both(_turned(e + f, 43) + _turned(g, 30) + h, e + _turned(f + a, 18) + g, by)


def _long(rows: np.ndarray) -> np.ndarray:
    """Of over 64 bytes: seven words of state over blocks of 64, the last block being the last 64 bytes."""
    n = rows.shape[1]
    state = lambda x: np.full(len(rows), x)
    y = state(_u(SEED * int(K1) + 113))
    z = _folded(y * K2 + _u(113)) * K2
    x = state(_u(SEED * int(K2))) + _words(rows, 0)
    v, w = [state(_u(0))] * 2, [state(_u(0))] * 2

    def mixed(at: int, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        p, q, r, s = (_words(rows, at + 8 * k) for k in range(4))
        a = a + p
        b = _turned(b + a + s, 21)
        c = a + q + r
        return [c + s, b + _turned(c, 44) + a]

    def block(at: int, by: np.ndarray, last: int) -> None:
        nonlocal x, y, z, v, w
        x = _turned(x + y + v[0] + _words(rows, at + 8), 37) * by
        y = _turned(y + v[1] + _words(rows, at + 48), 42) * by
        x = x ^ w[1] * _u(last)
        y = y + v[0] * _u(last) + _words(rows, at + 40)
        z = _turned(z + w[0], 33) * by
        v = mixed(at, v[1] * by, x + w[0])
        w = mixed(at + 32, z + w[1], y + _words(rows, at + 16))
        x, z = z, x

    for at in range(0, (n - 1) // 64 * 64, 64):
        block(at, K1, 1)
    by = K1 + ((z & _u(0xFF)) << _u(1))
    w[0] = w[0] + _u((n - 1) % 64)
    v[0] = v[0] + w[0]
    w[0] = w[0] + v[0]
    block(n - 64, by, 9)
    return _both(_both(v[0], w[0], by) + _folded(y) * K0 + z, _both(v[1], w[1], by) + x, by)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Signed 64-bit fingerprints; strings of one length are worked on together."""
    out = np.zeros(len(texts), dtype=np.uint64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    with np.errstate(over="ignore"):
        for n in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == n)
            rows = np.frombuffer(b"".join(texts[k] for k in own), np.uint8).reshape(len(own), n)
            out[own] = (_short if n <= 16 else _middle if n <= 64 else _long)(rows)
    return out.view(np.int64)


def fingerprint64(text) -> Column:
    """The fingerprint of a string's UTF-8 bytes as a signed long; null of null."""

    def run(texts: pd.Series) -> pd.Series:
        there = texts.notna().to_numpy()
        out = pd.Series(pd.array([None] * len(texts), dtype="Int64"))
        out[there] = fingerprints([t.encode() for t in texts[there]])
        return out

    return F.pandas_udf(run, "long")(col(text).cast("string"))


def partition_number(text, buckets: int = 4000) -> Column:
    """0 to buckets - 1: the remainder of the fingerprint's absolute value, as existing tables have it."""
    return F.abs(fingerprint64(text) % F.lit(buckets)).cast("bigint")
