"""PNG tiles: 8-bit gray, RGB or RGBA, not interlaced, with zlib alone."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = b"\x89PNG\r\n\x1a\n"
KIND = {1: 0, 3: 2, 4: 6}
CHANNELS = {0: 1, 2: 3, 6: 4}


def encode(image: np.ndarray) -> bytes:
    """image: uint8 of (h, w) or (h, w, c)."""
    image = image[..., None] if image.ndim == 2 else image
    h, w, c = image.shape
    rows = np.zeros((h, 1 + w * c), dtype=np.uint8)
    rows[:, 1:] = image.reshape(h, w * c)

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    return HEAD + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, KIND[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """uint8 of (h, w, c)."""
    if data[:8] != HEAD:
        raise ValueError("not a PNG file")
    at, body = 8, []
    while at < len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            w, h, depth, kind, _, _, lace = struct.unpack(">IIBBBBB", part)
            if depth != 8 or lace or kind not in CHANNELS:
                raise ValueError("only 8-bit gray, RGB or RGBA without interlacing")
        elif name == b"IDAT":
            body.append(part)
        at += 12 + size
    c = CHANNELS[kind]
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h, w, c), dtype=np.uint8)
    above = np.zeros((w, c), dtype=np.uint8)
    for y in range(h):
        f, line = raw[y, 0], raw[y, 1:].reshape(w, c)
        if f == 0:
            row = line
        elif f == 2:
            row = line + above
        elif f == 1:
            row = np.cumsum(line, axis=0, dtype=np.uint64).astype(np.uint8)
        else:
            row = np.zeros((w, c), dtype=np.uint8)
            left, corner = np.zeros(c, np.int32), np.zeros(c, np.int32)
            for x in range(w):
                up = above[x].astype(np.int32)
                if f == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, d = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= d), left, np.where(b <= d, up, corner))
                row[x] = line[x] + guess.astype(np.uint8)
                left, corner = row[x].astype(np.int32), up
        out[y], above = row, row
    return out


PIXELS = "path string, y int, x int, c array<short>"


def pixels(files: DataFrame) -> DataFrame:
    """path, y, x, c of every pixel of PNG files (path, content)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"]):
                image = decode(bytes(content))
                h, w, _ = image.shape
                yield pd.DataFrame({"path": path, "y": np.repeat(np.arange(h), w), "x": np.tile(np.arange(w), h), "c": list(image.reshape(h * w, -1).astype(np.int16))})

    return files.select("path", "content").mapInPandas(run, PIXELS)


def read(spark: SparkSession, path: str) -> DataFrame:
    return pixels(spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(path))


def pack(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, height, width, png: pixels (y, x, gray) of every image as a file's bytes; one task for each image."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h, w = int(pdf["y"].max()) + 1, int(pdf["x"].max()) + 1
        image = np.zeros((h, w), dtype=np.uint8)
        image[pdf["y"], pdf["x"]] = pdf["gray"]
        return pd.DataFrame([(*key, h, w, encode(image))], columns=[*by, "height", "width", "png"])

    kinds = dict(rows.dtypes)
    return rows.select(*by, "y", "x", F.col("gray").cast("int").alias("gray")).groupBy(*by).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", height int, width int, png binary")
