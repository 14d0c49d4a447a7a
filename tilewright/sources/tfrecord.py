"""TFRecord files of Example messages as a Spark data source, read and written.

    spark.dataSource.register(TFRecord)
    spark.read.format("tfrecord").schema("`image/name` string, `image/encoded` binary").load(path)
    rows.write.format("tfrecord").mode("append").save(path)

A record is its length (u64), a masked CRC-32C of that, the bytes and a masked CRC-32C of
them. Paths are whatever pyarrow's file systems open (folders that all machines mount, s3,
gs, hdfs). Large files are read in ranges of `split` bytes (32 MB; 0: one task a file): a
task finds the first record of its range by the checks of lengths and bytes and follows the
records from there, so no pass over the file comes first. Bytes that are themselves records
mislead it only if they fill a whole range. Files ending in .gz are streamed by one task.

Columns: string, binary, long, int, double, float and arrays of them; a feature that a record
lacks is null, one that the schema leaves out isn't decoded. Lengths are always checked;
option verify=true checks every record's bytes. compression=gzip writes compressed files.
"""

from __future__ import annotations

import fnmatch
import re
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: The reflected Castagnoli polynomial and the mask's offset.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
#: Bytes of a range, of a read and of the values in a batch.
SPLIT = 32 << 20
CHUNK = 4 << 20
BATCH = 16 << 20


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


TABLE = _table()
STEPS = TABLE.tolist()


def crc32c(data: bytes) -> int:
    """Columns of equal rows advance together; rows are then joined by shifts over zero bytes."""
    raw = np.frombuffer(data, np.uint8)
    width = max(1, int(len(raw) ** 0.5))
    rows = len(raw) // width
    state = np.zeros(rows + 32, dtype=np.uint32)
    state[rows:] = np.uint32(1) << np.arange(32, dtype=np.uint32)  # what each bit becomes after a row of zeros
    block = np.zeros((rows + 32, width), dtype=np.uint8)
    block[:rows] = raw[: rows * width].reshape(rows, width)
    for k in range(width):
        state = TABLE[(state ^ block[:, k]) & 0xFF] ^ (state >> 8)
    bits = state[rows:].tolist()
    total = 0xFFFFFFFF
    for s in state[:rows].tolist():
        shifted, k = 0, 0
        while total:
            if total & 1:
                shifted ^= bits[k]
            total >>= 1
            k += 1
        total = shifted ^ s
    for b in raw[rows * width :].tolist():
        total = int(TABLE[(total ^ b) & 0xFF]) ^ (total >> 8)
    return total ^ 0xFFFFFFFF


def _mask(c: int) -> int:
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def masked(data: bytes) -> int:
    return _mask(crc32c(data))


def _length(head: bytes) -> int | None:
    """The length that a head of 12 bytes gives; None if its check fails."""
    c = 0xFFFFFFFF
    for b in head[:8]:
        c = STEPS[(c ^ b) & 0xFF] ^ (c >> 8)
    size, check = struct.unpack("<QI", head)
    return size if check == _mask(c ^ 0xFFFFFFFF) else None


def records(read: Callable[[int], bytes], held: bytes = b"", limit: int | None = None, verify: bool = False) -> Iterator[bytes]:
    """Bodies of the records in `held` and what `read` gives next that begin before `limit` bytes."""
    at, passed = 0, 0

    def has(n: int) -> bool:
        nonlocal held, at, passed
        if len(held) - at < n:
            parts, size = [held[at:]], len(held) - at
            passed, at = passed + at, 0
            while size < n and (more := read(max(CHUNK, n - size))):
                parts.append(more)
                size += len(more)
            held = b"".join(parts)
        return len(held) - at >= n

    while (limit is None or passed + at < limit) and has(1):
        size = _length(held[at : at + 12]) if has(12) else None
        if size is None or not has(16 + size):
            raise ValueError("damaged record")
        body = held[at + 12 : at + 12 + size]
        if verify and struct.unpack_from("<I", held, at + 12 + size)[0] != masked(body):
            raise ValueError("damaged record")
        at += 16 + size
        yield body


def frames(data: bytes, verify: bool = False) -> Iterator[bytes]:
    return records(lambda n: b"", data, None, verify)


def first_record(data: bytes, inside: int, room: int, read_at: Callable[[int, int], bytes]) -> int | None:
    """Place, below `inside`, of the first record in `data`, a part of a file of which `room` bytes follow the part's start.

    A place counts if its length and bytes pass their checks and every length after it, up to `inside`, does.
    """
    raw, n = np.frombuffer(data, np.uint8), len(data) - 11

    def checked(first: int, last: int) -> list[int]:
        """Places from `first` to `last` with a length that passes its check and isn't too large."""
        at = np.arange(first, last)
        sizes = np.ndarray((last - first,), "<u8", data, first, (1,))
        at = at[(at <= room - 16) & (sizes <= np.maximum(room - 16 - at, 0).astype(np.uint64))]
        state = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for k in range(8):
            state = TABLE[(state ^ raw[at + k]) & 0xFF] ^ (state >> 8)
        state = ~state
        return at[((state >> 15) | (state << 17)) + np.uint32(MASK) == np.ndarray((n,), "<u4", data, 8, (1,))[at]].tolist()

    last = min(n, inside)
    for place in (p for first in range(0, last, 1 << 18) for p in checked(first, min(first + (1 << 18), last))):
        size = _length(data[place : place + 12])
        end = place + 16 + size
        body = data[place + 12 : end]
        body += read_at(4 + size - len(body), len(data)) if len(body) < 4 + size else b""
        if struct.unpack_from("<I", body, size)[0] != masked(body[:size]):
            continue
        at = end
        while at < inside and at != room and (step := _length(data[at : at + 12]) if at + 12 <= len(data) else None) is not None:
            at += 16 + step
        if at >= inside or at == room:
            return place
    return None


def frame(body: bytes) -> bytes:
    head = struct.pack("<Q", len(body))
    return head + struct.pack("<I", masked(head)) + body + struct.pack("<I", masked(body))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, at
        shift += 7


def _fields(data: memoryview) -> Iterator[tuple[int, int, object]]:
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        yield tag >> 3, kind, value


def parse(body: bytes, wanted: set[str] | None = None) -> dict[str, list]:
    """Features of an Example by name, all or the wanted ones: lists of bytes, floats or ints."""
    out: dict[str, list] = {}
    for n, _, features in _fields(memoryview(body)):
        for m, _, entry in _fields(features) if n == 1 else ():
            pair = {k: v for k, _, v in _fields(entry)} if m == 1 else {}
            name = bytes(pair[1]).decode() if 1 in pair else None
            if name is None or wanted is not None and name not in wanted:
                continue
            values: list = []
            for kind, _, items in _fields(pair.get(2, memoryview(b""))):
                for _, wire, v in _fields(items):
                    if kind == 1:
                        values.append(bytes(v))
                    elif kind == 2:
                        values += struct.unpack(f"<{len(v) // 4}f", v)
                    elif wire == 0:
                        values.append(v - (1 << 64) if v >> 63 else v)
                    else:
                        at = 0
                        while at < len(v):
                            x, at = _varint(v, at)
                            values.append(x - (1 << 64) if x >> 63 else x)
            out[name] = values
    return out


def _number(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _part(field: int, data: bytes) -> bytes:
    return _number(field << 3 | 2) + _number(len(data)) + data


def example(row: dict[str, object]) -> bytes:
    """An Example of named values; nulls are left out."""
    out = b""
    for name, value in row.items():
        if value is None:
            continue
        values = list(value) if isinstance(value, (list, tuple)) else [value]
        if values and isinstance(values[0], float):
            feature = _part(2, _part(1, struct.pack(f"<{len(values)}f", *values)))
        elif values and isinstance(values[0], int):
            feature = _part(3, _part(1, b"".join(map(_number, values))))
        else:
            feature = _part(1, b"".join(_part(1, v.encode() if isinstance(v, str) else bytes(v)) for v in values))
        out += _part(1, _part(1, name.encode()) + _part(2, feature))
    return _part(1, out)


def _place(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path in it, wildcards untouched; s3a is another name of s3."""
    path = re.sub(r"^file:/*", "/", path)
    if not re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pa.fs.LocalFileSystem(), path
    wild = re.search(r"[*?\[]", path)
    fixed = path[: wild.start()].rpartition("/")[0] if wild else path
    system, base = pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", fixed))
    return system, base + path[len(fixed) :]


def _files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of a folder's record files, or of the files that a path with wildcards stands for."""
    system, path = _place(path)
    path = path.rstrip("/")
    if not re.search(r"[*?\[]", path):
        found = system.get_file_info(path)
        if found.type == pa.fs.FileType.File:
            return [(path, found.size)]
        folder, pattern = path, f"{re.sub(r'([*?[])', r'[\1]', path)}/*.tfrecord*"
    else:
        folder, pattern = path[: re.search(r"[*?\[]", path).start()].rpartition("/")[0], path
    depth = pattern.count("/") - folder.count("/") > 1
    found = system.get_file_info(pa.fs.FileSelector(folder or ".", recursive=depth))
    names = [(f.path.removeprefix("./") if not folder else f.path, f.size) for f in found if f.type == pa.fs.FileType.File and not f.base_name.startswith((".", "_"))]
    return sorted((p, n) for p, n in names if p.count("/") == pattern.count("/") and fnmatch.fnmatchcase(p, pattern))


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int):
        super().__init__((path, start, end, size))


#: Arrow's types of a column's or an element's type.
ARROW = {T.StringType: pa.string(), T.BinaryType: pa.binary(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32()}


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.list_(_arrow(kind.elementType)) if isinstance(kind, T.ArrayType) else ARROW[type(kind)]


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.verify = schema, options["path"], options.get("verify", "false").lower() == "true"
        self.split = int(options.get("split", SPLIT))

    def partitions(self):
        out = []
        for path, size in _files(self.path):
            step = self.split if self.split > 0 and not path.endswith(".gz") else max(size, 1)
            out += [_Range(path, at, min(at + step, size), size) for at in range(0, size, step)]
        return out

    def _bodies(self, path: str, start: int, end: int, size: int) -> Iterator[bytes]:
        system = _place(self.path)[0]
        if path.endswith(".gz"):
            with system.open_input_stream(path, compression="gzip") as file:
                yield from records(file.read, verify=self.verify)
            return
        with system.open_input_file(path) as file:
            held, limit = b"", end - start
            if start > 0:
                held = file.read_at(min(end + 11, size) - start, start)
                first = first_record(held, end - start, size - start, lambda n, at: file.read_at(n, start + at))
                if first is None:
                    return
                file.seek(start + len(held))
                held, limit = held[first:], end - start - first
            yield from records(file.read, held, limit, self.verify)

    def read(self, partition):
        schema = pa.schema([(f.name, _arrow(f.dataType)) for f in self.schema])
        wanted, rows, size = {f.name for f in self.schema}, [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array([self._value(f.dataType, r.get(f.name)) for r in rows], t) for f, t in zip(self.schema, schema.types)]
            return pa.RecordBatch.from_arrays(columns, schema=schema) if columns else pa.RecordBatch.from_pylist([{}] * len(rows))

        for body in self._bodies(*partition.value) if partition is not None else ():  # None: no files
            rows.append(parse(body, wanted))
            size += len(body)
            if size > BATCH or len(rows) >= 1024:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    def _value(self, kind: T.DataType, values: list | None):
        if not values:
            return None
        if isinstance(kind, T.ArrayType):
            return [self._value(kind.elementType, [v]) for v in values]
        return values[0].decode() if isinstance(kind, T.StringType) else values[0]


class _Written(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = options.get("compression", "none").lower() == "gzip"

    def write(self, rows):
        system, folder = _place(self.path)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(name, compression="gzip" if self.gzip else None) as file:
            for row in rows:
                file.write(frame(example(row.asDict())))
        return _Written(name)

    def commit(self, messages):
        system = _place(self.path)[0]
        if self.overwrite:
            for p, _ in _files(self.path):
                system.delete_file(p)
        for m in messages:
            folder, _, name = m.path.rpartition("/")
            system.move(m.path, f"{folder}/part-{name[1:]}.tfrecords{'.gz' if self.gzip else ''}")

    def abort(self, messages):
        system = _place(self.path)[0]
        for m in messages:
            if m is not None and system.get_file_info(m.path).type == pa.fs.FileType.File:
                system.delete_file(m.path)


class TFRecord(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return "`image/name` string, `image/format` string, `image/height` long, `image/width` long, `image/depth` long, `image/encoded` binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, overwrite)
