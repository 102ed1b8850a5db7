"""Avro object containers as a Python data source, for sites without the spark-avro module.

``spark.read.format(FORMAT).load(path)`` and ``df.write.format(FORMAT).save(path)`` work once ``register`` was called;
``read`` and ``write`` do so themselves. Records are flat: booleans, ints, longs, floats, doubles, strings, dates and
timestamps (``timestamp-micros``), each of them optional or not. Blocks are deflated on their own; a file is read in
splits that start at sync markers. Partition columns are path levels (``asset_class=stock/event_date=2024-01-05``) that the
reader prunes by pushed filters; types are date for ``event_date`` and text for all others.

A record's length shows only when it is read, so the blocks of a split are walked together: each step advances by one
record in every block, and numpy finds the places of all fields; the values are then decoded column by column. Files
are reached through ``pyarrow.fs``, by the same path on the driver and the executors. Truncated or damaged blocks raise.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

FORMAT = "flat-avro"
MAGIC = b"Obj\x01"
#: Rows of a block, bytes of a split, and raw bytes that are decoded at a time.
BLOCK_ROWS = 1024
SPLIT_BYTES = 32 << 20
PASS_BYTES = 8 << 20
#: Files that a task keeps open when its rows aren't sorted by partition.
OPEN_FILES = 16

# The Avro name of each type that is written, and its logical type.
AVRO_TYPES = {
    "boolean": ("boolean", None), "integer": ("int", None), "long": ("long", None), "float": ("float", None), "double": ("double", None),
    "string": ("string", None), "date": ("int", "date"), "timestamp": ("long", "timestamp-micros"),
}
SPARK_TYPES = {names: kind for kind, names in AVRO_TYPES.items()} | {("bytes", None): "binary"}
ARROW_TYPES = {
    "boolean": pa.bool_(), "integer": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(),
    "string": pa.string(), "binary": pa.binary(), "date": pa.date32(), "timestamp": pa.timestamp("us", "UTC"),
}
FIXED_WIDTH = {"boolean": 1, "float": 4, "double": 8}


class DamagedFile(ValueError):
    """A container that doesn't read as Avro."""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    #: The union branch of the value, or None where the field isn't optional.
    branch: int | None = None


# ---- schemas


def avro_schema(schema: T.StructType, record: str = "Row") -> str:
    fields = []
    for f in schema.fields:
        if f.dataType.typeName() not in AVRO_TYPES:
            raise ValueError(f"{FORMAT} has no type for {f.name} {f.dataType.simpleString()}")
        name, logical = AVRO_TYPES[f.dataType.typeName()]
        kind = {"type": name, "logicalType": logical} if logical else name
        fields.append({"name": f.name, "type": ["null", kind] if f.nullable else kind})
    return json.dumps({"type": "record", "name": record, "fields": fields})


def fields_of(schema: str) -> list[Field]:
    spec = json.loads(schema)
    if not isinstance(spec, dict) or spec.get("type") != "record":
        raise DamagedFile("the schema is no record")
    out = []
    for f in spec["fields"]:
        kind, branch = f["type"], None
        if isinstance(kind, list):
            named = [k for k in kind if k != "null"]
            if len(kind) != 2 or len(named) != 1:
                raise ValueError(f"{f['name']}: only unions of null and one type are read")
            kind, branch = named[0], kind.index(named[0])
        names = (kind.get("type"), kind.get("logicalType")) if isinstance(kind, dict) else (kind, None)
        found = SPARK_TYPES.get(names) or SPARK_TYPES.get((names[0], None))
        if found is None:
            raise ValueError(f"{f['name']}: type {kind} is not read")
        out.append(Field(f["name"], found, branch))
    return out


def spark_schema(fields: list[Field]) -> T.StructType:
    made = {"boolean": T.BooleanType(), "integer": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
            "string": T.StringType(), "binary": T.BinaryType(), "date": T.DateType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(f.name, made[f.kind], f.branch is not None) for f in fields])


# ---- records


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i], start[i] + 1 ... of all i, `size` each."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zigzag varints of many integers: their bytes and the length of each."""
    v = values.astype(np.int64)
    z = ((v << 1) ^ (v >> 63)).view(np.uint64)
    shifts = np.arange(10, dtype=np.uint64) * np.uint64(7)
    size = 1 + (z[:, None] >= (np.uint64(1) << shifts[1:])[None, :]).sum(1)
    place = np.arange(10)
    groups = ((z[:, None] >> shifts[None, :]) & np.uint64(0x7F)).astype(np.uint8)
    groups |= np.where(place[None, :] < size[:, None] - 1, 0x80, 0).astype(np.uint8)
    return groups[place[None, :] < size[:, None]], size


def _column_bytes(column: pa.Array, field: Field) -> list[tuple[np.ndarray, np.ndarray]]:
    """Parts (bytes, length of each row) that make up the column's values one after another."""
    present = np.ones(len(column), bool) if not column.null_count else np.asarray(column.is_valid())
    parts = []
    if field.branch is None:
        if not present.all():
            raise ValueError(f"null in {field.name}, which is not optional")
    else:
        parts.append(varints(np.where(present, field.branch, 1 - field.branch)))
    known = column.drop_null() if not present.all() else column

    def spread(size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(column), np.int64)
        out[present] = size
        return out

    if field.kind in ("string", "binary"):
        wide = known.cast(pa.large_binary())
        _, bounds, data = wide.buffers()
        at = np.frombuffer(bounds, np.int64)[wide.offset : wide.offset + len(wide) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        head, head_size = varints(np.diff(at))
        return [*parts, (head, spread(head_size)), (raw, spread(np.diff(at)))]
    if field.kind in FIXED_WIDTH:
        width = FIXED_WIDTH[field.kind]
        dtype = {1: np.uint8, 4: "<f4", 8: "<f8"}[width]
        raw = np.ascontiguousarray(known.to_numpy(zero_copy_only=False).astype(dtype)).view(np.uint8)
        return [*parts, (raw, spread(np.full(len(known), width)))]
    whole = known.cast(pa.int32() if field.kind == "date" else pa.int64()).to_numpy(zero_copy_only=False)
    raw, size = varints(whole)
    return [*parts, (raw, spread(size))]


def encode(batch: pa.RecordBatch, fields: list[Field]) -> bytes:
    """The records of a batch, whose columns are those of `fields`, one after another."""
    parts = [p for column, field in zip(batch.columns, fields, strict=True) for p in _column_bytes(column, field)]
    total = np.sum([size for _, size in parts], axis=0) if parts else np.zeros(batch.num_rows, np.int64)
    at = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    for raw, size in parts:
        out[ragged(at, size)] = raw
        at = at + size
    return out.tobytes()


def _unzigzag(z: np.ndarray) -> np.ndarray:
    return (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)


def _varint_at(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    value = np.zeros(len(at), np.uint64)
    for k in range(int(size.max(initial=0))):
        group = (data[at + k] & 0x7F).astype(np.uint64) << np.uint64(7 * k)
        value |= np.where(k < size, group, np.uint64(0))
    return _unzigzag(value)


def decode(blocks: list[tuple[int, bytes]], fields: list[Field], wanted: set[str]) -> dict[str, pa.Array]:
    """The wanted columns of some blocks (number of records, raw bytes), in order."""
    counts = np.array([n for n, _ in blocks], np.int64)
    ends = np.cumsum([len(raw) for _, raw in blocks])
    data = np.frombuffer(b"".join(raw for _, raw in blocks) + bytes(16), np.uint8)
    if (counts < 0).any():
        raise DamagedFile("negative number of records")
    total = int(counts.sum())
    # The last byte of the varint that begins at or before each byte.
    stop = np.minimum.accumulate(np.where(data < 0x80, np.arange(len(data)), len(data))[::-1])[::-1]
    order = np.argsort(-counts, kind="stable")
    cursor, limit, base = (ends - [len(raw) for _, raw in blocks])[order], ends[order], (np.cumsum(counts) - counts)[order]
    left = counts[order]
    place = {f.name: np.zeros(total, np.int64) for f in fields}
    length = {f.name: np.zeros(total, np.int64) for f in fields}
    there = {f.name: np.ones(total, bool) for f in fields if f.branch is not None}
    for step in range(int(left[0]) if len(left) else 0):
        active = int(np.searchsorted(-left, -step, "left"))
        at, rows = cursor[:active], base[:active] + step
        for f in fields:
            present = None
            if f.branch is not None:
                present = data[at] == 2 * f.branch
                if (~present & (data[at] != 2 * (1 - f.branch))).any():
                    raise DamagedFile(f"no such branch in {f.name}")
                there[f.name][rows] = present
                at = at + 1
            if f.kind in FIXED_WIDTH:
                size = np.full(active, FIXED_WIDTH[f.kind])
                first = at
            else:
                size = stop[np.minimum(at, len(stop) - 1)] - at + 1
                first = at
                if (size > 10).any() and (present is None or (present & (size > 10)).any()):
                    raise DamagedFile(f"no number in {f.name}")
                if f.kind in ("string", "binary"):
                    head = np.minimum(size, 10)
                    size = _varint_at(data, np.minimum(at, len(data) - 11), head)
                    if ((size < 0) & (True if present is None else present)).any():
                        raise DamagedFile(f"negative length in {f.name}")
                    first, at = at + head, (at + head if present is None else np.where(present, at + head, at))
            if present is not None:
                size = np.where(present, size, 0)
            place[f.name][rows], length[f.name][rows] = first, size
            at = at + size
            if (at > limit[:active]).any():
                raise DamagedFile("a record goes beyond its block")
        cursor[:active] = at
    if (cursor != limit).any():
        raise DamagedFile("a block is longer than its records")
    return {f.name: _column(data, place[f.name], length[f.name], there.get(f.name), f.kind) for f in fields if f.name in wanted}


def _column(data: np.ndarray, at: np.ndarray, size: np.ndarray, present: np.ndarray | None, kind: str) -> pa.Array:
    n = len(at)
    if present is not None:
        at = np.where(present, at, 0)
    if kind in ("string", "binary"):
        bounds = np.append(0, np.cumsum(size)).astype(np.int64)
        raw = data[ragged(at, size)]
        wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw.tobytes())])
        out = wide.cast(pa.large_string() if kind == "string" else pa.large_binary()).cast(ARROW_TYPES[kind])
    elif kind in FIXED_WIDTH:
        width = FIXED_WIDTH[kind]
        raw = np.ascontiguousarray(data[at[:, None] + np.arange(width)])
        out = pa.array(raw[:, 0].astype(bool)) if width == 1 else pa.array(raw.view("<f4" if width == 4 else "<f8").ravel())
    else:
        whole = _varint_at(data, at, size)
        out = pa.array(whole)
        out = out.cast(pa.int32()).cast(pa.date32()) if kind == "date" else out.cast(ARROW_TYPES[kind])
    return out if present is None or present.all() else pc.if_else(pa.array(present), out, pa.scalar(None, out.type))


# ---- containers


def _long(value: int) -> bytes:
    return varints(np.array([value]))[0].tobytes()


def _block(batch: pa.RecordBatch, fields: list[Field], sync: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    raw = packer.compress(encode(batch, fields)) + packer.flush()
    return _long(batch.num_rows) + _long(len(raw)) + raw + sync


def _header(schema: str, sync: bytes) -> bytes:
    entries = {"avro.schema": schema.encode(), "avro.codec": b"deflate"}
    body = b"".join(_long(len(k)) + k.encode() + _long(len(v)) + v for k, v in entries.items())
    return MAGIC + _long(len(entries)) + body + _long(0) + sync


class _Input:
    """A file read by varints and byte strings; every short read raises."""

    def __init__(self, file: pa.NativeFile, name: str) -> None:
        self.file, self.name = file, name

    def take(self, n: int) -> bytes:
        raw = self.file.read(n) if n >= 0 else b""
        if n < 0 or len(raw) != n:
            raise DamagedFile(f"{self.name} ends within a block")
        return raw

    def long(self) -> int:
        value = shift = 0
        while True:
            byte = self.take(1)[0]
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7
            if shift > 63:
                raise DamagedFile(f"{self.name}: no number")

    def header(self) -> tuple[str, str, bytes, int]:
        """Schema, codec, sync marker and the place behind them."""
        if self.take(4) != MAGIC:
            raise DamagedFile(f"{self.name} is no Avro container")
        entries: dict[str, bytes] = {}
        while (n := self.long()) != 0:
            if n < 0:
                n = -n
                self.long()
            for _ in range(n):
                key = self.take(self.long()).decode()
                entries[key] = self.take(self.long())
        sync = self.take(16)
        codec = entries.get("avro.codec", b"null").decode()
        if codec not in ("null", "deflate"):
            raise ValueError(f"{self.name}: codec {codec} is not read")
        return entries["avro.schema"].decode(), codec, sync, self.file.tell()


def _after_marker(file: pa.NativeFile, sync: bytes, start: int, size: int) -> int | None:
    """The place behind the first sync marker that begins at or after `start`."""
    at, kept = start, b""
    while at < size:
        file.seek(at)
        chunk = kept + file.read(1 << 20)
        found = chunk.find(sync)
        if found >= 0:
            return at - len(kept) + found + 16
        at, kept = at - len(kept) + len(chunk), chunk[-15:]
    return None


def blocks_of(file: pa.NativeFile, name: str, start: int, end: int) -> Iterator[tuple[str, int, bytes]]:
    """Schema, number of records and raw bytes of the blocks whose preceding sync marker begins in [start, end)."""
    size = file.size()
    source = _Input(file, name)
    schema, codec, sync, first = source.header()
    at = first if start <= first - 16 else _after_marker(file, sync, start, size)
    while at is not None and at < size and at - 16 < end:
        file.seek(at)
        count, length = source.long(), source.long()
        raw = source.take(length)
        if source.take(16) != sync:
            raise DamagedFile(f"{name}: no sync marker behind a block")
        if codec == "deflate":
            try:
                unpacker = zlib.decompressobj(-15)
                raw = unpacker.decompress(raw) + unpacker.flush()
            except zlib.error as error:
                raise DamagedFile(f"{name}: {error}") from error
            if not unpacker.eof:
                raise DamagedFile(f"{name}: a block is cut off")
        yield schema, count, raw
        at = file.tell()


# ---- files


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def _partition_of(path: str, root: str) -> dict[str, str | None]:
    levels = [part.partition("=") for part in path[len(root) :].split("/")[:-1] if "=" in part]
    return {k: None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for k, _, v in levels}


def _files(fs: pafs.FileSystem, root: str) -> list[tuple[str, int, dict[str, str | None]]]:
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size, {})]
    listed = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    hidden = lambda path: any(part.startswith(("_", ".")) for part in path[len(root) :].split("/"))
    found = sorted((i for i in listed if i.type == pafs.FileType.File and not hidden(i.path)), key=lambda i: i.path)
    return [(i.path, i.size, _partition_of(i.path, root)) for i in found]


def _typed(name: str, value: str | None):
    return date.fromisoformat(value) if name == "event_date" and value is not None else value


@dataclass
class Split(ds.InputPartition):
    path: str
    start: int
    end: int
    values: dict


class FlatAvroReader(ds.DataSourceReader):
    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema, self.kept = path, schema, []

    def pushFilters(self, filters):
        """Comparisons of partition columns are answered by leaving files out; Spark keeps all others."""
        names = self._partition_names()
        for f in filters:
            known = isinstance(f, (ds.EqualTo, ds.In, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual, ds.IsNotNull))
            if known and f.attribute[0] in names:
                self.kept.append(f)
            else:
                yield f

    def _partition_names(self) -> set[str]:
        fs, root = _filesystem(self.path)
        return {name for _, _, values in _files(fs, root)[:1] for name in values}

    def _passes(self, values: dict) -> bool:
        for f in self.kept:
            own = _typed(f.attribute[0], values.get(f.attribute[0]))
            if own is None:
                return False
            if isinstance(f, ds.In) and own not in f.value:
                return False
            tests = {ds.EqualTo: "__eq__", ds.GreaterThan: "__gt__", ds.GreaterThanOrEqual: "__ge__", ds.LessThan: "__lt__", ds.LessThanOrEqual: "__le__"}
            if type(f) in tests and getattr(own, tests[type(f)])(f.value) is not True:
                return False
        return True

    def partitions(self):
        fs, root = _filesystem(self.path)
        splits = []
        for path, size, values in _files(fs, root):
            if self._passes(values):
                splits += [Split(path, at, min(at + SPLIT_BYTES, size), values) for at in range(0, size, SPLIT_BYTES)]
        return splits

    def read(self, partition):
        if partition is None:
            return
        fs, _ = _filesystem(self.path)
        names = [f.name for f in self.schema.fields]

        def made(schema: str, blocks: list[tuple[int, bytes]]) -> pa.RecordBatch:
            fields = fields_of(schema)
            columns = decode(blocks, fields, set(names))
            n = sum(count for count, _ in blocks)
            out = []
            for f in self.schema.fields:
                kind = ARROW_TYPES[f.dataType.typeName()]
                if f.name in partition.values:
                    out.append(pa.array([_typed(f.name, partition.values[f.name])] * n, kind))
                elif f.name in columns:
                    out.append(columns[f.name].cast(kind))
                else:
                    out.append(pa.nulls(n, kind))
            return pa.RecordBatch.from_arrays(out, names=names)

        with fs.open_input_file(partition.path) as file:
            held, size, own = [], 0, None
            for schema, count, raw in blocks_of(file, partition.path, partition.start, partition.end):
                held.append((count, raw))
                size, own = size + len(raw), schema
                if size > PASS_BYTES:
                    yield made(own, held)
                    held, size = [], 0
            if held:
                yield made(own, held)


@dataclass
class Written(ds.WriterCommitMessage):
    #: Where a file lies, the folder it belongs into, and its name there.
    files: list[tuple[str, str, str]]


class FlatAvroWriter(ds.DataSourceArrowWriter):
    """Files are written aside and moved by the commit, so a failed or repeated task leaves nothing behind.

    In overwrite mode the files that a touched partition held before go after the new ones have come.
    """

    def __init__(self, path: str, schema: T.StructType, by: list[str], overwrite: bool) -> None:
        self.path, self.by, self.overwrite = path, by, overwrite
        stored = T.StructType([f for f in schema.fields if f.name not in by])
        self.schema, self.columns = avro_schema(stored), [f.name for f in stored.fields]
        self.job = uuid.uuid4().hex

    def _aside(self, root: str) -> str:
        return f"{root}/_temporary-{self.job}"

    def write(self, iterator):
        fs, root = _filesystem(self.path)
        fields, sync = fields_of(self.schema), os.urandom(16)
        fs.create_dir(self._aside(root), recursive=True)
        open_, files = {}, []

        def target(folder: str):
            if folder not in open_:
                if len(open_) >= OPEN_FILES:
                    open_.pop(next(iter(open_))).close()
                name = f"part-{uuid.uuid4().hex}.avro"
                files.append((f"{self._aside(root)}/{name}", folder, name))
                open_[folder] = fs.open_output_stream(files[-1][0])
                open_[folder].write(_header(self.schema, sync))
            return open_[folder]

        for batch in iterator:
            table = pa.Table.from_batches([batch])
            keys = [self._text(table[name].combine_chunks()) for name in self.by]
            edge = np.zeros(batch.num_rows, bool)
            edge[:1] = True
            for key in keys:
                edge[1:] |= key[1:] != key[:-1]
            starts = np.flatnonzero(edge)
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
                out = target("/".join(f"{name}={key[a]}" for name, key in zip(self.by, keys, strict=True)))
                rows = table.select(self.columns).slice(a, b - a).combine_chunks()
                for part in rows.to_batches(max_chunksize=BLOCK_ROWS):
                    out.write(_block(part, fields, sync))
        for file in open_.values():
            file.close()
        return Written(files)

    @staticmethod
    def _text(column: pa.Array) -> np.ndarray:
        texts = column.cast(pa.string()).to_pylist()
        return np.array(["__HIVE_DEFAULT_PARTITION__" if t is None else quote(t, safe=" ,+@") for t in texts], object)

    def commit(self, messages):
        fs, root = _filesystem(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        for folder in {folder for _, folder, _ in files}:
            here = f"{root}/{folder}" if folder else root
            fs.create_dir(here, recursive=True)
            old = [path for path, _, _ in _files(fs, here)] if self.overwrite else []
            for aside, of, name in files:
                if of == folder:
                    fs.move(aside, f"{here}/{name}")
            for path in old:
                fs.delete_file(path)
        fs.delete_dir(self._aside(root)) if fs.get_file_info(self._aside(root)).type == pafs.FileType.Directory else None

    def abort(self, messages):
        fs, root = _filesystem(self.path)
        if fs.get_file_info(self._aside(root)).type == pafs.FileType.Directory:
            fs.delete_dir(self._aside(root))


class FlatAvro(ds.DataSource):
    """Options: ``path``, and for writing ``partitionBy`` (column names, comma-separated)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        fs, root = _filesystem(self.options["path"])
        found = _files(fs, root)
        if not found:
            raise ValueError(f"no files in {self.options['path']}; give a schema")
        path, _, values = found[0]
        with fs.open_input_file(path) as file:
            own = spark_schema(fields_of(_Input(file, path).header()[0]))
        levels = [T.StructField(name, T.DateType() if name == "event_date" else T.StringType()) for name in values]
        return T.StructType([f for f in own.fields if f.name not in values] + levels)

    def reader(self, schema):
        return FlatAvroReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        by = [name for name in self.options.get("partitionby", "").split(",") if name]
        return FlatAvroWriter(self.options["path"], schema, by, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FlatAvro)


def read(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    register(spark)
    reader = spark.read.format(FORMAT)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, by: tuple[str, ...] = (), overwrite: bool = False) -> None:
    """Append, or replace the touched partitions. Rows should come sorted by ``by`` within a task."""
    register(df.sparkSession)
    df.write.format(FORMAT).mode("overwrite" if overwrite else "append").option("partitionBy", ",".join(by)).save(path)
