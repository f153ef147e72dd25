"""Avro files where Spark's own source for them isn't installed.

Spark lists and reads the files, a task a file or some small ones; a file's blocks are then decoded one by one, for the
wanted fields only: what a schema has besides is skipped over. Fields that a file's schema lacks are null, as is a value that
isn't of the wanted kind at all. A broken file is an error of the job.
"""

from __future__ import annotations

import bz2
import json
import lzma
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources import paths

MAGIC = b"Obj\x01"
#: A decoder takes bytes and a place and gives a value and the place behind it.
Decoder = Callable[[bytes, int], tuple[object, int]]


def _long(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        c = b[at]
        at += 1
        n |= (c & 127) << shift
        if c < 128:
            return (n >> 1) ^ -(n & 1), at
        shift += 7


def _bytes(b: bytes, at: int) -> tuple[bytes, int]:
    n, at = _long(b, at)
    return b[at : at + n], at + n


def _string(b: bytes, at: int) -> tuple[str, int]:
    n, at = _long(b, at)
    return b[at : at + n].decode("utf-8", "replace"), at + n


def _packed(code: str) -> Decoder:
    s = struct.Struct(code)
    return lambda b, at: (s.unpack_from(b, at)[0], at + s.size)


_SIMPLE: dict[str, Decoder] = {"null": lambda b, at: (None, at), "boolean": lambda b, at: (b[at] == 1, at + 1), "int": _long, "long": _long, "float": _packed("<f"), "double": _packed("<d"), "bytes": _bytes, "string": _string}
_FITS = {"string": (str,), "binary": (bytes,), "boolean": (bool,), "int": (int,), "bigint": (int,), "float": (float,), "double": (float,)}


def _blocks(item: Callable[[bytes, int, list], int]) -> Decoder:
    """Arrays and maps: counted blocks, of which a negative count has the block's size behind it."""

    def run(b: bytes, at: int) -> tuple[list, int]:
        out: list = []
        while True:
            n, at = _long(b, at)
            if n == 0:
                return out, at
            if n < 0:
                n, (_, at) = -n, _long(b, at)
            for _ in range(n):
                at = item(b, at, out)

    return run


def decoder(schema, want: T.DataType | None, named: dict) -> Decoder:
    """Of a writer's schema; want None: skipped over."""
    if isinstance(schema, list):
        kinds = [decoder(s, want, named) for s in schema]

        def choose(b: bytes, at: int) -> tuple[object, int]:
            k, at = _long(b, at)
            return kinds[k](b, at)

        return choose
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return decoder(kind, want, named)
    if kind in named:
        schema = named[kind]
        kind = schema["type"]
    if isinstance(schema, dict) and "name" in schema:
        named |= {schema["name"]: schema, f"{schema.get('namespace', '')}.{schema['name']}": schema}
    if kind == "record":
        wanted = {f.name: f.dataType for f in want} if isinstance(want, T.StructType) else {}
        fields = [(f["name"] if f["name"] in wanted else None, decoder(f["type"], wanted.get(f["name"]), named)) for f in schema["fields"]]

        def record(b: bytes, at: int) -> tuple[dict | None, int]:
            out = {}
            for name, read in fields:
                value, at = read(b, at)
                if name is not None:
                    out[name] = value
            return (out if wanted else None), at

        return record
    if kind == "array":
        read = decoder(schema["items"], want.elementType if isinstance(want, T.ArrayType) else None, named)

        def item(b: bytes, at: int, out: list) -> int:
            value, at = read(b, at)
            out.append(value)
            return at

        whole = _blocks(item)
        return whole if isinstance(want, T.ArrayType) else lambda b, at: (None, whole(b, at)[1])
    if kind == "map":
        values = decoder(schema["values"], None, named)
        whole = _blocks(lambda b, at, out: values(b, _bytes(b, at)[1])[1])
        return lambda b, at: (None, whole(b, at)[1])
    if kind == "enum":

        def symbol(b: bytes, at: int) -> tuple[str | None, int]:
            k, at = _long(b, at)
            return (schema["symbols"][k] if isinstance(want, T.StringType) else None), at

        return symbol
    if kind == "fixed":
        n = schema["size"]
        return lambda b, at: (b[at : at + n] if isinstance(want, T.BinaryType) else None, at + n)
    read = _SIMPLE[kind]
    if want is None:
        return (lambda b, at: (None, _bytes(b, at)[1])) if kind in ("bytes", "string") else read
    ok = _FITS.get(want.simpleString(), ())

    def fitting(b: bytes, at: int) -> tuple[object, int]:
        value, at = read(b, at)
        return (value if isinstance(value, ok) else None), at

    return fitting


def _unpacked(raw: bytes, codec: str) -> bytes:
    if codec == "null":
        return raw
    if codec == "deflate":
        return zlib.decompress(raw, -15)
    if codec == "bzip2":
        return bz2.decompress(raw)
    if codec == "xz":
        return lzma.decompress(raw)
    if codec == "snappy":  # the size, then the data, then four bytes of a check sum
        n = shift = at = 0
        while True:
            n |= (raw[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if raw[at - 1] < 128:
                break
        return pa.decompress(raw[:-4], n, codec="snappy", asbytes=True)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    raise ValueError(f"unknown codec {codec}")


def records(raw: bytes, want: T.StructType) -> Iterator[list[dict]]:
    """The records of a file, block by block, with the wanted fields that its schema has."""
    if raw[:4] != MAGIC:
        raise ValueError("not an Avro file")
    at, meta = 4, {}
    while True:
        n, at = _long(raw, at)
        if n == 0:
            break
        if n < 0:
            n, (_, at) = -n, _long(raw, at)
        for _ in range(n):
            key, at = _string(raw, at)
            meta[key], at = _bytes(raw, at)
    sync, at = raw[at : at + 16], at + 16
    read, codec = decoder(json.loads(meta["avro.schema"]), want, {}), meta.get("avro.codec", b"null").decode()
    while at < len(raw):
        n, at = _long(raw, at)
        size, at = _long(raw, at)
        block, place, out = _unpacked(raw[at : at + size], codec), 0, []
        for _ in range(n):
            value, place = read(block, place)
            out.append(value)
        at += size
        if raw[at : at + 16] != sync:
            raise ValueError("a block of an Avro file doesn't end with the file's mark")
        at += 16
        yield out


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of all files below a folder, in the columns of schema."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                for block in records(raw.as_py(), schema):
                    yield pa.RecordBatch.from_pylist(block, arrow)

    return spark.read.format("binaryFile").load(paths.literal(path)).select("content").mapInArrow(run, schema)
