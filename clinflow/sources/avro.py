"""Avro container files as a Spark data source: ``spark.read.format("avro_files")`` and ``df.write.format("avro_files")``.

A file is a head (schema, codec, sync marker) and blocks of rows; a block is a count, a length, the rows' binary coding
(zigzag numbers, strings with their length before them) and the marker. Tasks write one file each under a name of
their own; the driver puts them in place when all have ended, so that a lost or repeated task leaves nothing behind.
A file is read in ranges of RANGE bytes: a range's reader looks for the marker and takes the blocks that begin in it.

Flat records of strings, longs, ints, doubles, booleans and bytes, each or NULL; null values need a nullable column.
Files lie where ``pyarrow.fs`` can reach them (shared mounts, object stores).
"""

from __future__ import annotations

import io
import json
import os
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# workers need no copy of this repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "avro_files"
#: First bytes of a file; bytes of rows in a block and of a range, about.
MAGIC, BLOCK, RANGE = b"Obj\x01", 64_000, 64 << 20
#: Fixed by the format: its name for each of Spark's types.
KINDS = {"string": "string", "bigint": "long", "int": "int", "double": "double", "boolean": "boolean", "binary": "bytes"}


def record_schema(schema: T.StructType, name: str = "Record") -> dict:
    """The Avro schema of rows; a nullable column is a union with null."""
    kinds = [(f.name, KINDS.get(f.dataType.simpleString()), f.nullable) for f in schema.fields]
    if bad := [n for n, kind, _ in kinds if kind is None]:
        raise ValueError(f"no Avro type for the columns {bad}")
    return {"type": "record", "name": name, "fields": [{"name": n, "type": ["null", kind] if nullable else kind} for n, kind, nullable in kinds]}


def spark_schema(record: dict) -> T.StructType:
    types = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.BinaryType())
    of = {KINDS[t.simpleString()]: t for t in types}
    fields = []
    for f in record["fields"]:
        kind = f["type"]
        nullable = isinstance(kind, list)
        fields.append(T.StructField(f["name"], of[next(k for k in kind if k != "null") if nullable else kind], nullable))
    return T.StructType(fields)


def put_long(out: bytearray, n: int) -> None:
    """Zigzag, seven bits a byte, the lowest first."""
    n = (n << 1) ^ (n >> 63)
    while n & ~0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)


def get_long(data: io.BytesIO) -> int:
    n = shift = 0
    while True:
        byte = data.read(1)
        if not byte:
            raise EOFError("a number ends too early")
        n |= (byte[0] & 0x7F) << shift
        if byte[0] < 0x80:
            return (n >> 1) ^ -(n & 1)
        shift += 7


def _put_bytes(out: bytearray, value: bytes) -> None:
    put_long(out, len(value))
    out += value


def _put(out: bytearray, kind: str, value) -> None:
    if kind in ("long", "int"):
        put_long(out, value)
    elif kind == "string":
        _put_bytes(out, value.encode("utf-8", "surrogatepass"))
    elif kind == "bytes":
        _put_bytes(out, bytes(value))
    elif kind == "double":
        out += struct.pack("<d", value)
    else:
        out.append(1 if value else 0)


def _get(data: io.BytesIO, kind: str):
    if kind in ("long", "int"):
        return get_long(data)
    if kind == "string":
        return data.read(get_long(data)).decode("utf-8", "replace")
    if kind == "bytes":
        return data.read(get_long(data))
    if kind == "double":
        return struct.unpack("<d", data.read(8))[0]
    return data.read(1) == b"\x01"


def _put_row(out: bytearray, fields: list, row) -> None:
    for kind, value in zip(fields, row, strict=True):
        if isinstance(kind, list):
            at = kind.index("null") if value is None else next(k for k, x in enumerate(kind) if x != "null")
            put_long(out, at)
            if value is not None:
                _put(out, kind[at], value)
        elif value is None:
            raise ValueError("a null value in a column that is not nullable")
        else:
            _put(out, kind, value)


def _get_row(data: io.BytesIO, fields: list) -> tuple:
    out = []
    for kind in fields:
        if isinstance(kind, list):
            kind = kind[get_long(data)]
        out.append(None if kind == "null" else _get(data, kind))
    return tuple(out)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else path if path.startswith("file:") else os.path.abspath(path))


@dataclass
class Written(WriterCommitMessage):
    held: str
    rows: int


class Writer(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        self.path, self.overwrite, self.codec = options["path"], overwrite, options.get("codec", "deflate")
        if self.codec not in ("null", "deflate"):
            raise ValueError(f"codec {self.codec}: null and deflate are there")
        self.record = json.loads(options["avroSchema"]) if "avroSchema" in options else record_schema(schema)
        if [f["name"] for f in self.record["fields"]] != schema.names:
            raise ValueError(f"the schema's fields are not the columns {schema.names}")
        self.load = uuid.uuid4().hex

    def _held(self, base: str) -> str:
        return f"{base}/_pending-{self.load}"

    def write(self, iterator: Iterator) -> Written:
        """One file of a task; no rows, no file."""
        files, base = _place(self.path)
        fields, marker = [f["type"] for f in self.record["fields"]], os.urandom(16)
        name, out, block, count, rows = f"{self._held(base)}/part-{uuid.uuid4().hex}.avro", None, bytearray(), 0, 0

        def flush() -> None:
            nonlocal block, count
            data = zlib.compress(bytes(block), wbits=-15) if self.codec == "deflate" else bytes(block)
            head = bytearray()
            put_long(head, count)
            _put_bytes(head, data)
            out.write(bytes(head) + marker)
            block, count = bytearray(), 0

        try:
            for row in iterator:
                if out is None:
                    files.create_dir(self._held(base), recursive=True)
                    out = files.open_output_stream(name)
                    head = bytearray(MAGIC)
                    told = {"avro.schema": json.dumps(self.record).encode(), "avro.codec": self.codec.encode()}
                    put_long(head, len(told))
                    for key, value in told.items():
                        _put_bytes(head, key.encode())
                        _put_bytes(head, value)
                    put_long(head, 0)
                    out.write(bytes(head) + marker)
                _put_row(block, fields, row)
                count, rows = count + 1, rows + 1
                if len(block) >= BLOCK:
                    flush()
            if count:
                flush()
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else "", rows)

    def commit(self, messages: list) -> None:
        files, base = _place(self.path)
        files.create_dir(base, recursive=True)
        if self.overwrite:
            for old in files.get_file_info(fs.FileSelector(base)):
                if old.base_name.endswith(".avro"):
                    files.delete_file(old.path)
        for m in messages:
            if m is not None and m.held:
                files.move(m.held, f"{base}/{m.held.rsplit('/', 1)[1]}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        files, base = _place(self.path)
        if files.get_file_info(self._held(base)).type == fs.FileType.Directory:
            files.delete_dir(self._held(base))


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


def _head(data) -> tuple[dict, str, bytes, int]:
    """Schema, codec, marker and the first block's place."""
    if data.read(4) != MAGIC:
        raise ValueError("not an Avro container file")
    told: dict[str, bytes] = {}
    while n := get_long(data):
        if n < 0:  # a negative count has the bytes after it
            n, _ = -n, get_long(data)
        for _ in range(n):
            key = data.read(get_long(data)).decode()
            told[key] = data.read(get_long(data))
    marker = data.read(16)
    return json.loads(told["avro.schema"]), told.get("avro.codec", b"null").decode(), marker, data.tell()


def read_range(files: fs.FileSystem, part: Range) -> Iterator[tuple]:
    """Rows of the blocks that begin in a range: right after a marker whose first byte lies in it, or after the head."""
    with files.open_input_file(part.path) as data:
        record, codec, marker, first = _head(data)
        fields, size = [f["type"] for f in record["fields"]], data.size()
        at = first
        if part.start > first - 16:
            at, tail = None, b""
            data.seek(part.start)
            base = part.start
            while at is None and base < part.end:
                piece = data.read(1 << 20)
                if not piece:
                    break
                window = tail + piece
                k = window.find(marker)
                if k >= 0:
                    at = base - len(tail) + k + 16
                tail, base = window[-15:], base + len(piece)
            if at is None:
                return
        while at - 16 < part.end and at < size:
            data.seek(at)
            count, length = get_long(data), get_long(data)
            body = data.read(length)
            if codec == "deflate":
                body = zlib.decompress(body, -15)
            elif codec != "null":
                raise ValueError(f"codec {codec}: null and deflate are there")
            if data.read(16) != marker:
                raise ValueError(f"a block of {part.path} doesn't end with the file's marker")
            at, rows = data.tell(), io.BytesIO(body)
            for _ in range(count):
                yield _get_row(rows, fields)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rangeBytes", RANGE))

    def partitions(self) -> list[Range]:
        files, base = _place(self.path)
        found = files.get_file_info(fs.FileSelector(base))
        return [Range(f.path, b, min(b + self.size, f.size)) for f in sorted(found, key=lambda f: f.path) if f.base_name.endswith(".avro") for b in range(0, f.size, self.size)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return read_range(_place(self.path)[0], partition) if partition.path else iter(())


class AvroFiles(DataSource):
    """Options: path; codec (deflate, null); avroSchema (JSON, for writing); rangeBytes (for reading)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        files, base = _place(self.options["path"])
        for f in sorted(files.get_file_info(fs.FileSelector(base)), key=lambda f: f.path):
            if f.base_name.endswith(".avro"):
                with files.open_input_file(f.path) as data:
                    return spark_schema(_head(data)[0])
        raise ValueError(f"{self.options['path']} has no Avro file; give a schema")

    def reader(self, schema: T.StructType) -> Reader:
        return Reader({name: self.options[name] for name in ("path", "rangeBytes") if name in self.options})

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        return Writer(schema, {name: self.options[name] for name in ("path", "codec", "avroSchema") if name in self.options}, overwrite)


def register(spark: SparkSession) -> str:
    """Make the format known to a session; its name."""
    spark.dataSource.register(AvroFiles)
    return NAME
