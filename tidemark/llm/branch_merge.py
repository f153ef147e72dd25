"""Three-way merge of two branches of a table of documents.

A branch edits by codes: the CRC-32 of "branch:key:name" modulo 11, where name is `row`, a column, or a line's number.
Both branches are laid out flat: the lines of many texts are one buffer of bytes and offsets, the codes of all lines two
arrays, changes and conflicts masks over them. Counts are sums over each document's stretch, and the merged texts are
copied into one new buffer by offsets. Rows that branches add depend on keys and columns alone; they are told from the
codes in SQL and meet by key, as the smallest and the largest of the values that a key has, however many rows add it.

Nulls in columns and texts are empty from the start. A null key is written as nothing in the codes, and the rows added to
it have a null key. Equal rows and rows of one key are merged one by one, a row each. What they add under one key is one
clean insertion if all of it is equal and a conflict otherwise. A row added under a key that the base has too is a row of
its own. An empty text is one empty line. Texts count whole; a long one is a portion of its own. Columns that aren't asked
for are left out. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, slices


@dataclass(frozen=True)
class Params:
    branches: tuple[str, str] = ("L", "R")
    modulus: int = 11
    key: str = "doc_id"
    columns: tuple[str, ...] = ("lang", "source")
    text: str = "text"


#: Codes: 0 drops, 1 and 2 append these to a line or a column, 3 and 4 insert them as a line or a row.
SIGNS = ("!", "?")
COUNTS = ("n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")

_TABLE = np.array([zlib.crc32(bytes((b,)), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
_FULL = np.uint32(0xFFFFFFFF)


def _on(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    """The state of the check sum after one more byte each."""
    return _TABLE[(state ^ np.asarray(byte, np.uint32)) & np.uint32(255)] ^ (state >> np.uint32(8))


def named(state: np.ndarray, name: str, modulus: int) -> np.ndarray:
    """Codes of one name, for the states after "branch:key:"."""
    for b in name.encode():
        state = _on(state, b)
    return (state ^ _FULL) % np.uint32(modulus)


def numbered(state: np.ndarray, number: np.ndarray, modulus: int) -> np.ndarray:
    """Codes of numbers as names."""
    state, digits = state.copy(), np.ones(len(number), np.int8)
    for k in range(1, len(str(int(number.max(initial=0))))):
        digits += number >= 10**k
    for k in range(int(digits.max(initial=1)) - 1, -1, -1):
        has = np.flatnonzero(digits > k)
        state[has] = _on(state[has], 48 + number[has] // 10**k % 10)
    return (state ^ _FULL) % np.uint32(modulus)


def _merge(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(merged change, clean, conflict) of changes; -1 is none."""
    conflict = (left >= 0) & (right >= 0) & (left != right)
    merged = np.where(conflict, -1, np.maximum(left, right))
    return merged, merged >= 0, conflict


@dataclass
class Lines:
    """The lines of many texts: bytes, each line's place, each text's first line."""

    values: np.ndarray
    start: np.ndarray
    size: np.ndarray
    first: np.ndarray
    of: np.ndarray

    @classmethod
    def cut(cls, texts: pa.Array) -> Lines:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        breaks = np.flatnonzero(values == 10)
        n = 1 + np.bincount(np.searchsorted(offsets[1:], breaks, "right"), minlength=len(texts))
        first = np.cumsum(n) - n
        opens, closes = np.zeros(int(n.sum()), bool), np.zeros(int(n.sum()), bool)
        opens[first] = closes[first + n - 1] = True
        start, end = np.empty(len(opens), np.int64), np.empty(len(opens), np.int64)
        start[opens], start[~opens] = offsets[:-1], breaks + 1
        end[closes], end[~closes] = offsets[1:], breaks
        return cls(values, start, end - start, first, np.repeat(np.arange(len(texts)), n))

    def rebuilt(self, change: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, bytes) of the texts with each line dropped (0), longer by a sign (1, 2) or as it is (-1), and with a
        sign (1, 2) as a new line behind it or not (-1)."""
        sign = np.array([0, *(ord(s) for s in SIGNS)], np.uint8)
        stays, new = change != 0, gap > 0
        out = stays.astype(np.int64) + new
        ahead = np.cumsum(out) - out
        ahead -= ahead[self.first][self.of]  # lines of the text that come before
        break_, break_new = stays & (ahead > 0), new & (ahead + stays > 0)
        size = np.where(stays, self.size, 0)
        whole = size + break_ + (change > 0) + new + break_new
        at = np.cumsum(whole) - whole
        made = np.empty(int(whole.sum()), np.uint8)
        made[at[break_]] = 10
        body = at + break_
        shift = np.cumsum(size) - size
        run = np.arange(int(size.sum()))
        made[run + np.repeat(body - shift, size)] = self.values[run + np.repeat(self.start - shift, size)]
        longer = change > 0
        made[(body + size)[longer]] = sign[change[longer]]
        end = body + size + longer
        made[end[break_new]] = 10
        made[(end + break_new)[new]] = sign[gap[new]]
        return np.concatenate(([0], np.cumsum(np.add.reduceat(whole, self.first)))), made


def merged_batch(b: pa.RecordBatch, p: Params) -> pa.RecordBatch:
    """A batch (key, columns, text), nulls filled but for the key, as (key, columns, text, counts)."""
    n = b.num_rows
    keys = ["" if k is None else str(k) for k in b.column(0).to_pylist()]
    lines = Lines.cut(b.column(b.num_columns - 1))
    number = np.arange(len(lines.of)) - lines.first[lines.of]
    rows, cols, edits, gaps, touched = [], [], [], [], []
    for branch in p.branches:
        state = np.fromiter((zlib.crc32(f"{branch}:{k}:".encode()) for k in keys), np.uint32, n) ^ _FULL
        code = numbered(state[lines.of], number, p.modulus).astype(np.int64)
        edits.append(np.where(code <= 2, code, -1))
        gaps.append(np.where((code == 3) | (code == 4), code - 2, -1))
        rows.append(named(state, "row", p.modulus))
        own = []
        for i, c in enumerate(p.columns, 1):
            code = named(state, c, p.modulus).astype(np.int64)
            empty = np.asarray(pc.equal(pc.binary_length(b.column(i)), 0))
            own.append(np.where((code <= 2) & ~((code == 0) & empty), code, -1))
        cols.append(own)
        line = np.logical_or.reduceat((edits[-1] >= 0) | (gaps[-1] >= 0), lines.first)
        touched.append(np.logical_or.reduce([line, *(x >= 0 for x in own)]))

    drops = [r == 0 for r in rows]
    against = (drops[0] & ~drops[1] & touched[1]) | (drops[1] & ~drops[0] & touched[0])
    gone = (drops[0] | drops[1]) & ~against
    whole = ~(gone | against)  # merged part by part

    change, line_clean, line_clash = _merge(*edits)
    gap, gap_clean, gap_clash = _merge(*gaps)
    deletes = line_clash & ((edits[0] == 0) | (edits[1] == 0))
    total = lambda x: np.add.reduceat(x.astype(np.int64), lines.first)
    clean, edit_edit = total(line_clean) + total(gap_clean), total(line_clash & ~deletes)
    out = [b.column(0)]
    absent = pa.array(gone)
    for i in range(len(p.columns)):
        did, ok, clash = _merge(cols[0][i], cols[1][i])
        clean, edit_edit = clean + ok, edit_edit + clash
        did = np.where(whole, did, -1)
        sign = pa.array(["", *SIGNS]).take(pa.array(np.maximum(did, 0)))
        value = pc.if_else(pa.array(did == 0), "", pc.binary_join_element_wise(b.column(i + 1), sign, ""))
        out.append(pc.if_else(absent, pa.scalar(None, pa.string()), value))
    offsets, made = lines.rebuilt(np.where(whole[lines.of], change, np.where(gone[lines.of], 0, -1)), np.where(whole[lines.of], gap, -1))
    bits = pa.py_buffer(np.packbits(~gone, bitorder="little").tobytes())
    out.append(pa.Array.from_buffers(pa.string(), n, [bits, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(made)]))
    counts = (np.where(whole, clean, gone), np.where(whole, edit_edit, 0), np.where(whole, total(deletes), against), np.where(whole, total(gap_clash), 0))
    return pa.RecordBatch.from_arrays([*out, *(pa.array(x.astype(np.int64)) for x in counts)], [*b.schema.names, *COUNTS])


def _filled(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))


def _schema(p: Params) -> str:
    return ", ".join(["_key bigint", *(f"_c{i} string" for i in range(len(p.columns))), "_text string", *(f"{c} bigint" for c in COUNTS)])


def _named(d: DataFrame, p: Params) -> DataFrame:
    names = ["_key", *(f"_c{i}" for i in range(len(p.columns))), "_text"]
    return d.select(*(F.col(a).alias(b) for a, b in zip(names, [p.key, *p.columns, p.text], strict=True)), *COUNTS)


def base_rows(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs merged, those that are gone with nulls; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "_text"):
                yield merged_batch(b, p)

    d = docs.select(F.col(f"`{p.key}`").cast("bigint").alias("_key"), *(_filled(c).alias(f"_c{i}") for i, c in enumerate(p.columns)), _filled(p.text).alias("_text"))
    return _named(in_arrow(d, run, _schema(p)), p)


def added_rows(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows that a branch adds, by key; those in conflict with nulls. Reads keys and columns only."""
    key = F.col(f"`{p.key}`").cast("bigint")
    written = F.coalesce(key.cast("string"), F.lit(""))
    new = []
    for k, branch in enumerate(p.branches, 1):
        code = F.crc32(F.concat(F.lit(f"{branch}:"), written, F.lit(":row"))) % p.modulus
        said = F.when(code == 3, SIGNS[0]).when(code == 4, SIGNS[1])
        value = F.struct(*(_filled(c).alias(f"_c{i}") for i, c in enumerate(p.columns)), said.alias("_text"))
        new.append(F.when(said.isNotNull(), F.struct((F.lit(-k) - key).alias("_key"), value.alias("_v"))))
    d = docs.select(F.explode(F.filter(F.array(*new), lambda x: x.isNotNull())).alias("n")).select("n.*")
    d = d.groupBy("_key").agg(F.min("_v").alias("a"), F.max("_v").alias("z"))
    same = F.col("a") == F.col("z")
    n = [same.cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), (~same).cast("bigint")]
    v = F.when(same, F.col("a"))
    return _named(d.select("_key", *(v[f].alias(f) for f in [*(f"_c{i}" for i in range(len(p.columns))), "_text"]), *(x.alias(c) for x, c in zip(n, COUNTS, strict=True))), p)


def merge(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Every key that the base or a branch has: key, columns and text as merged (null where the row isn't there), and the
    numbers of clean changes and of the three kinds of conflicts."""
    return base_rows(docs, p).unionByName(added_rows(docs, p))
