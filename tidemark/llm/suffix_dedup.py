"""Exact substring dedup by suffix sorting of sampled contexts.

Every window of `length` bytes picks an anchor, the 32-byte gram in it with the least hash (the leftmost of equals):
equal windows pick it at the same place. The windows of a document thus fall into stretches with one anchor each; a
stretch with the bytes of all its windows is the anchor's context. Equal windows have equal grams at their anchors, so
anchors are dealt out by their gram, and all comparing is among the contexts of one gram.

1. Each task folds equal contexts of its batch, and deals the others out by gram, packed: hashes and places, no text.
2. A shard folds equal contexts of all tasks: all but the first are removed whole. What is left are different contexts of
   one gram. A window covers the 64 bytes after its anchor or the 64 around it; contexts of which neither recurs go.
3. The contexts that remain are fetched from the texts, and suffix-sorted, shard by shard, by induced sorting in external
   memory (tidemark.llm.induced), which hands over each suffix with the length of its common prefix with the one before
   it. Neighbours with `length` bytes in common are equal windows; all but the first are removed.

Hot grams (of a passage that very many texts share) would give one shard without bound. A sample of the documents tells
which cells of grams hold far more than the mean; the contexts of these are dealt out window by window, by the window's
own 128-bit hash, each task having folded its equal windows before. That decides the way only: either gives the same
result. Contexts are equal if two 64-bit hashes are; step 3 compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import few, in_arrow, materialise, mix64, released, slices
from tidemark.llm.induced import BLOCK, Store, Text, suffixes


@dataclass(frozen=True)
class Params:
    #: Least bytes of a repeat; 64 + 32 at least.
    length: int = 100
    gram: int = 32
    #: Texts are read in pieces of so many bytes.
    piece: int = 1_000_000
    #: Bytes of context in a shard of step 3.
    shard_bytes: int = 2_000_000
    #: Tuples that a queue of the sorter keeps in memory (32 bytes each), and names that it sorts in memory.
    memory: int = 400_000
    base: int = 1_000_000
    #: A cell of grams is hot if it holds so many contexts, and 4 times the mean, by one document in hot_sample.
    hot_contexts: int = 4096
    hot_sample: int = 16
    #: Hot windows that a task holds before it folds them and deals them out.
    hot_windows: int = 300_000


_U = np.uint64
_MUL = np.full(1, 0x9E3779B97F4A7C15, _U)
_TABLE = mix64(np.arange(1, 257, dtype=_U) * _MUL)
_CELLS = 20
#: A packed anchor: gram and context hashes, document, place, window offsets, hashes of the 64 bytes right and around.
_ENTRY = np.dtype([("gram", "<u8"), ("ctx", "<u8"), ("doc", "<i8"), ("t0", "<i8"), ("t1", "<i8"), ("at", "<u4"), ("kr", "<u2"), ("kl", "<u2"), ("lo", "u1"), ("hi", "u1")])
#: A packed window: its hash, document and place.
_WINDOW = np.dtype([("w0", "<u8"), ("w1", "<u8"), ("doc", "<i8"), ("t0", "<i8"), ("t1", "<i8"), ("at", "<u4")])
#: A document: its id, and 128 bits that tell texts of one id apart (0 where all ids differ).
_DOC = ("doc", "t0", "t1")
#: A context on file: document, first byte, and where it ends in the shard's text.
_CONTEXT = np.dtype([("doc", "<i8"), ("t0", "<i8"), ("t1", "<i8"), ("start", "<i8"), ("stop", "<i8")])


def _pieces(b: pa.RecordBatch, p: Params) -> Iterator[list[tuple[tuple[int, int, int], int, bytes]]]:
    """Batches of (document, offset, bytes). A long text comes in pieces that share length - 1 bytes, so that each window
    is in one piece. Within a batch documents ascend."""
    now: list = []
    size = 0
    col = lambda c: b.column(b.schema.get_field_index(c)).to_pylist()
    for key, raw in sorted(zip(zip(col("doc_id"), col("t0"), col("t1"), strict=True), ((t or "").encode("utf-8", "surrogatepass") for t in col("text")), strict=True)):
        for a in range(0, max(1, len(raw) - p.length + 1), p.piece):
            part = raw[a : a + p.piece + p.length - 1]
            if now and size + len(part) > p.piece:
                yield now
                now, size = [], 0
            now.append((key, a, part))
            size += len(part)
    if now:
        yield now


@dataclass
class Anchors:
    """Contexts of a batch: entries, first window and end within the batch's bytes, and how far places in the batch are
    from those in the document. h64: hashes of the 64 bytes at each place of the batch."""

    entries: np.ndarray
    lo: np.ndarray
    end: np.ndarray
    shift: np.ndarray
    h64: np.ndarray


def _anchors(batch: list[tuple[tuple[int, int, int], int, bytes]], p: Params) -> Anchors | None:
    buf = np.frombuffer(b"".join(x[2] for x in batch), np.uint8)
    if len(buf) < p.length:
        return None
    h, power, width = _TABLE[buf], _MUL, 1
    while width < 64:
        nxt = h[:-width] * power
        nxt += h[width:]
        h, width = nxt, 2 * width
        power = power * power
        if width == p.gram:
            hg = h
    h64 = h
    n = len(hg)
    low = mix64(hg)
    low >>= _U(24)
    low <<= _U(24)
    low |= np.arange(n, dtype=_U)  # places below 2**24: a batch is smaller
    span, width = p.length - p.gram + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: -(span - width)], low[span - width :])
    a = (low & _U(0xFFFFFF)).astype(np.int32)
    del low
    lens = np.array([len(x[2]) for x in batch])
    ends = np.cumsum(lens)
    piece = np.repeat(np.arange(len(lens), dtype=np.int32), lens)[: len(a)]
    s = np.flatnonzero(np.arange(len(a)) + p.length <= ends[piece])
    if not len(s):
        return None
    a, piece = a[s], piece[s]
    head = np.ones(len(s), bool)
    head[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)
    i = np.flatnonzero(head)
    lo, hi, at, piece = s[i], s[np.append(i[1:], len(s)) - 1], a[i].astype(np.int64), piece[i]
    end = hi + p.length
    e = np.zeros(len(i), _ENTRY)
    e["gram"] = mix64(hg[at])
    e["ctx"] = mix64(mix64(h64[lo]) * _U(3) + mix64(h64[np.minimum(lo + 64, end - 64)]) * _U(5) + mix64(h64[end - 64]) * _U(7) + (end - lo).astype(_U) * _MUL)
    right = np.where(at + 64 <= end, h64[np.minimum(at, len(h64) - 1)], _U(0))
    around = np.where(at - 32 >= lo, h64[np.maximum(at - 32, 0)], _U(0))
    e["kr"], e["kl"] = mix64(right) >> _U(48), mix64(around) >> _U(48)
    for k, name in enumerate(_DOC):
        e[name] = np.array([x[0][k] for x in batch], np.int64)[piece]
    shift = np.array([x[1] for x in batch], np.int64)[piece] - (ends - lens)[piece]
    e["at"], e["lo"], e["hi"] = at + shift, at - lo, at - hi
    return Anchors(e, lo, end, shift, h64)


def _cell(gram: np.ndarray) -> np.ndarray:
    """Cells by bits that have no part in the choice of anchors: the upper ones are least, and few cells would hold all."""
    return (gram & _U((1 << _CELLS) - 1)).astype(np.int64)


def hot_cells(docs: DataFrame, p: Params) -> np.ndarray:
    """Which cells of grams are hot, as an array of a fixed size. docs: (doc_id, t0, t1, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _CELLS, np.int64)
        for b in batches:
            for x in slices(b):
                for part in _pieces(x, p):
                    if got := _anchors(part, p):
                        e = got.entries
                        _, once = np.unique(e["ctx"], return_index=True)
                        np.add.at(total, _cell(e["gram"][once]), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["cell", "n"])

    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(p.hot_sample)) == 0) if p.hot_sample > 1 else docs
    n = in_arrow(some, count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    mean = F.broadcast(n.agg((F.sum("n") / (1 << _CELLS)).alias("mean")))  # one row
    hot = n.crossJoin(mean).filter(F.col("n") > 4 * F.col("mean") + p.hot_contexts / p.hot_sample).select("cell")
    out = np.zeros(1 << _CELLS, bool)
    out[[r.cell for r in hot.collect()]] = True  # a row a cell at most
    return out


def _runs(doc: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Intervals, united where they touch within a document. doc: the columns that tell documents."""
    by = np.lexsort((start, *doc[::-1]))
    doc, start, end = [c[by] for c in doc], start[by], end[by]
    if not len(start):
        return doc, start, end
    fresh = np.ones(len(start), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in doc])
    group = np.cumsum(fresh) - 1
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * big) - group * big  # the furthest end so far in the document
    head = fresh.copy()
    head[1:] |= start[1:] > reach[:-1]
    i = np.flatnonzero(head)
    return [c[i] for c in doc], start[i], reach[np.append(i[1:], len(start)) - 1]


_COLS = ["kind", "shard", "doc_id", "t0", "t1", "start", "end", "at", "packed"]
_SCHEMA = "kind int, shard int, doc_id long, t0 long, t1 long, start long, end long, at long, packed binary"


def _batch(kind: int, shard, doc=(None, None, None), start=None, end=None, at=None, packed=None) -> pa.RecordBatch:
    n = len(shard)
    num = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(np.asarray(x, np.int64))
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.int32()), pa.array(np.asarray(shard, np.int32)), *map(num, doc), num(start), num(end), num(at), pa.nulls(n, pa.binary()) if packed is None else pa.array(packed, pa.binary())], _COLS)


SPAN, PACKED, CANDIDATE, HOT = 0, 1, 2, 3


def _spans(e: np.ndarray, start: np.ndarray, end: np.ndarray, shards: int = 1, turn: int = 0) -> pa.RecordBatch:
    """Repeats as rows. e: entries that tell the documents."""
    doc, s, x = _runs([e[c] for c in _DOC], start, end)
    return _batch(SPAN, (np.arange(len(s)) + turn * 7919) % shards, doc, s, x)


def _elsewhere(e: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which entries stand at other places than the entries numbered first: a repeated row has the same places."""
    return np.logical_or.reduce([e[c] != e[c][first] for c in (*_DOC, "at")])


def _packed(kind: int, e: np.ndarray, shard: np.ndarray, shards: int) -> pa.RecordBatch:
    by = np.argsort(shard, kind="stable")
    e, shard = e[by], shard[by]
    cut = np.searchsorted(shard, np.arange(shards + 1))
    some = np.flatnonzero(cut[1:] > cut[:-1])
    return _batch(kind, some, packed=[e[cut[k] : cut[k + 1]].tobytes() for k in some])


def _fold_windows(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each group of equal windows, and the others."""
    w = w[np.lexsort((w["at"], w["t1"], w["t0"], w["doc"], w["w1"], w["w0"]))]
    same = np.concatenate(([False], (w["w0"][1:] == w["w0"][:-1]) & (w["w1"][1:] == w["w1"][:-1])))
    first = np.maximum.accumulate(np.where(~same, np.arange(len(w)), 0))
    return w[~same], w[same & _elsewhere(w, first)]


def sampled(docs: DataFrame, shards: int, hot: np.ndarray, p: Params) -> DataFrame:
    """Step 1: spans that repeat a context of the same batch, packed anchors by shard, and the windows of hot grams, packed
    by shard. docs: (doc_id, t0, t1, text)."""
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(hot))  # of a fixed size

    def windows(got: Anchors, which: np.ndarray) -> Iterator[np.ndarray]:
        """The windows of some contexts."""
        n = (got.end - got.lo - p.length + 1)[which]
        for part in np.array_split(which, max(1, int(n.sum()) // 100_000)):
            n = (got.end - got.lo - p.length + 1)[part]
            of = np.repeat(part, n)
            s = got.lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            w = np.empty(len(of), _WINDOW)
            w["w0"], w["w1"], w["at"] = mix64(got.h64[s]), mix64(got.h64[s + p.length - 64]), s + got.shift[of]
            for c in _DOC:
                w[c] = got.entries[c][of]
            yield w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_hot, turn = np.unpackbits(held.value).astype(bool), 0
        wins: list[np.ndarray] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            w, again = _fold_windows(np.concatenate(wins))
            wins.clear()
            if len(again):
                at = again["at"].astype(np.int64)
                yield _spans(again, at, at + p.length, shards, turn)
            yield _packed(HOT, w, ((w["w0"] >> _U(20)) % _U(shards)).astype(np.int64), shards)

        for b in batches:
            for x in slices(b, limit=p.piece):
                for part in _pieces(x, p):
                    turn += 1
                    if (got := _anchors(part, p)) is None:
                        continue
                    e = got.entries
                    by = np.argsort(e["ctx"], kind="stable")  # documents ascend: the first of equals is the earliest
                    g, c = e["gram"][by], e["ctx"][by]
                    same = np.concatenate(([False], (g[1:] == g[:-1]) & (c[1:] == c[:-1])))
                    if same.any():
                        first = np.maximum.accumulate(np.where(~same, np.arange(len(e)), 0))
                        later = by[same & _elsewhere(e[by], first)]
                        if len(later):
                            yield _spans(e[later], (got.lo + got.shift)[later], (got.end + got.shift)[later], shards, turn)
                    left = np.sort(by[~same])
                    hot_now = is_hot[_cell(e["gram"][left])]
                    if hot_now.any():
                        for w in windows(got, left[hot_now]):
                            wins.append(w)
                            if sum(map(len, wins)) > p.hot_windows:
                                yield from dealt()
                    e = e[left[~hot_now]]
                    if len(e):
                        yield _packed(PACKED, e, ((e["gram"] >> _U(20)) % _U(shards)).astype(np.int64), shards)
        if wins:
            yield from dealt()

    return in_arrow(docs.select("doc_id", "t0", "t1", "text"), run, _SCHEMA)


def _shared(key: np.ndarray, group: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Which rows have a key that another row of their group has; only able rows count."""
    out = np.zeros(len(key), bool)
    i = np.flatnonzero(able)
    _, inv, cnt = np.unique(group[i].astype(_U) << _U(16) | key[i].astype(_U), return_inverse=True, return_counts=True)
    out[i] = cnt[inv] > 1
    return out


def _reduce(blobs: list[bytes], p: Params) -> Iterator[pa.RecordBatch]:
    e = np.concatenate([np.frombuffer(x, _ENTRY) for x in blobs])
    e = e[np.lexsort((e["at"], e["t1"], e["t0"], e["doc"], e["ctx"], e["gram"]))]
    same_gram = np.concatenate(([False], e["gram"][1:] == e["gram"][:-1]))
    same = same_gram & np.concatenate(([False], e["ctx"][1:] == e["ctx"][:-1]))
    # equal places come from repeated rows: they belong to the same, first or later, context
    later = same & _elsewhere(e, np.maximum.accumulate(np.where(~same, np.arange(len(e)), 0)))
    if later.any():
        x = e[later]
        at = x["at"].astype(np.int64)
        yield _spans(x, at - x["lo"], at - x["hi"] + p.length)
    r, group = e[~same], np.cumsum(~same_gram[~same])
    del e
    keep = _shared(r["kr"], group, r["hi"] <= p.length - 64) | _shared(r["kl"], group, r["lo"] >= 32)
    if keep.any():
        r = r[keep]
        at = r["at"].astype(np.int64)
        yield _batch(CANDIDATE, (r["gram"] >> _U(40)).astype(np.int64) & 0x7FFFFF, [r[c] for c in _DOC], at - r["lo"], at - r["hi"] + p.length, at)


def folded(packed: DataFrame, shards: int, docs: DataFrame, p: Params) -> DataFrame:
    """Step 2: spans, and the contexts that have to be sorted."""

    def reduced(kind: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        if kind == PACKED:
            yield from _reduce(blobs, p)
            return
        _, again = _fold_windows(np.concatenate([np.frombuffer(x, _WINDOW) for x in blobs]))
        if len(again):
            at = again["at"].astype(np.int64)
            yield _spans(again, at, at + p.length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for b in batches:
            kind = np.asarray(b.column("kind"))
            if (kind == SPAN).any():
                yield b.filter(pa.array(kind == SPAN))
            b = b.filter(pa.array(kind != SPAN))
            for s, k, x in zip(b.column("shard").to_pylist(), b.column("kind").to_pylist(), b.column("packed").to_pylist(), strict=True):
                if (s, k) != now:
                    if blobs:
                        yield from reduced(now[1], blobs)
                    now, blobs = (s, k), []
                blobs.append(x)
        if blobs:
            yield from reduced(now[1], blobs)

    d = few(packed.repartition(shards, "shard").sortWithinPartitions("shard", "kind"), docs)  # each shard stays in one stretch
    return in_arrow(d, run, _SCHEMA).drop("packed")


class Shard:
    """The contexts of a shard on file, in order of document and place: the text (a byte b is b + 2, 1 ends a context) and
    a table of the contexts."""

    def __init__(self, p: Params):
        self.p, self.store = p, Store(p.memory, p.base)
        self.paths = [self.store.path() for _ in range(3)]
        self.text, self.table, self.stops = (open(x, "wb") for x in self.paths)
        self.n = self.contexts = 0
        self.last: tuple | None = None

    def add(self, b: pa.RecordBatch) -> None:
        """Rows (shard, doc_id, t0, t1, start, bytes); repeated ones count once."""
        t = np.zeros(b.num_rows, _CONTEXT)
        for name, c in zip(("doc", "t0", "t1", "start"), range(1, 5), strict=True):
            t[name] = np.asarray(b.column(c))
        key = ["doc", "t0", "t1", "start"]
        new = np.ones(len(t), bool)
        new[1:] = np.logical_or.reduce([t[c][1:] != t[c][:-1] for c in key])
        new[0] = tuple(t[0][c] for c in key) != self.last
        self.last = tuple(t[-1][c] for c in key)
        t = t[new]
        if not len(t):
            return
        raws = b.column(5).filter(pa.array(new)).to_pylist()
        lens = np.fromiter(map(len, raws), np.int64, len(raws))
        out = np.ones(int(lens.sum()) + len(raws), np.uint16)
        out[np.arange(int(lens.sum())) + np.repeat(np.arange(len(raws)), lens)] = np.frombuffer(b"".join(raws), np.uint8).astype(np.uint16) + 2
        t["stop"] = self.n + np.cumsum(lens + 1) - 1
        out.tofile(self.text)
        t.tofile(self.table)
        t["stop"].copy().tofile(self.stops)
        self.n, self.contexts = self.n + len(out), self.contexts + len(t)

    def spans(self) -> Iterator[pa.RecordBatch]:
        """Windows that repeat an earlier one: places in the text are in the order of documents and places."""
        p = self.p
        np.zeros(p.length + 1, np.uint16).tofile(self.text)
        for f in (self.text, self.table, self.stops):
            f.close()
        text = np.memmap(self.paths[0], np.uint16, "r", shape=(self.n + p.length + 1,))
        table = np.memmap(self.paths[1], _CONTEXT, "r", shape=(self.contexts,))
        flags = self.store.array(self.n, bool)
        lead = -1  # the earliest so far of the group that is not at its end yet
        for pos, lcp in _joined(suffixes(Text(text, self.n, 257), self.store, p.length)):
            head = lcp < p.length
            at = np.flatnonzero(head)
            if not head[0]:
                at = np.append(0, at)
            least = np.minimum.reduceat(pos, at)
            if not head[0]:
                if lead > least[0]:
                    flags[lead] = True
                least[0] = min(lead, int(least[0]))
            later = pos[pos != np.repeat(least, np.diff(np.append(at, len(pos))))]
            flags[later] = True
            lead = int(least[-1])
        stops = np.memmap(self.paths[2], np.int64, "r", shape=(self.contexts,))
        for a in range(0, self.n, 16 * BLOCK):
            at = a + np.flatnonzero(flags[a : a + 16 * BLOCK])
            ctx = np.searchsorted(stops, at)
            # windows that reach over the context's end aren't there, equal or not
            ok = at + p.length <= stops[ctx]
            at, ctx = at[ok], ctx[ok]
            if len(at):
                t = table[ctx]
                start = t["start"] + at - np.where(ctx > 0, stops[ctx - 1] + 1, 0)
                yield _spans(t, start, start + p.length)

    def close(self) -> None:
        for f in (self.text, self.table, self.stops):
            f.close()
        self.store.close()


def _joined(blocks: Iterator[tuple[np.ndarray, np.ndarray]], least: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Small blocks put together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for x in blocks:
        if len(x[0]):
            held.append(x)
            n += len(x[0])
        if n >= least:
            yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
            held, n = [], 0
    if held:
        yield np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])


def sorted_spans(docs: DataFrame, candidates: DataFrame, p: Params) -> DataFrame:
    """Step 3: spans of the windows that recur among the candidates. docs: (doc_id, t0, t1, text)."""
    total = candidates.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0  # one number
    shards = int(total // p.shard_bytes) + 1
    key = ["doc_id", "t0", "t1"]
    c = candidates.groupBy(*key).agg(F.collect_list(F.struct((F.col("shard") % shards).cast("int").alias("shard"), "start", "end")).alias("cs"))
    d = docs.join(c, key).select(*key, "text", "cs")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                cols: list[list] = [[], [], [], [], [], []]
                for doc, t0, t1, text, cs in zip(*(part.column(k).to_pylist() for k in range(5)), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    for x in cs:
                        for col, v in zip(cols, (x["shard"], doc, t0, t1, x["start"], raw[x["start"] : x["end"]]), strict=True):
                            col.append(v)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds, strict=True)], ["shard", *key, "start", "bytes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        try:
            for b in batches:
                own = np.asarray(b.column(0))
                cut = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for x, y in zip(cut, cut[1:]):
                    if y == x:
                        continue
                    if own[x] != now:
                        if shard:
                            yield from shard.spans()
                            shard.close()
                        now, shard = own[x], Shard(p)
                    shard.add(b.slice(x, y - x))
            if shard:
                yield from shard.spans()
        finally:
            if shard:
                shard.close()

    got = in_arrow(d, fetch, "shard int, doc_id long, t0 long, t1 long, start long, bytes binary")
    got = few(got.repartition(shards, "shard").sortWithinPartitions("shard", *key, "start"), docs, 1)
    return in_arrow(got, sort, _SCHEMA).drop("packed")


def spans(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, t0, t1, start, end): byte ranges of repeats; ranges of a document may overlap. docs: (doc_id, t0, t1, text)."""
    spark: SparkSession = docs.sparkSession
    shards = max(8, 4 * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = materialise(folded(sampled(docs, shards, hot_cells(docs, p), p), shards, docs, p), "spans")
    keep = ["doc_id", "t0", "t1", "start", "end"]
    more = materialise(sorted_spans(docs, found.filter(F.col("kind") == CANDIDATE), p).select(*keep), "repeats")
    return found.filter(F.col("kind") == SPAN).select(*keep).unionByName(more)


#: Stands in for a null doc_id: before all others.
_NULL = -(2**63)


def dedup(docs: DataFrame, p: Params = Params(), keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of docs; with keep_text also kept (binary) and
    removed, the maximal removed byte ranges.

    Null and empty texts have no bytes; long ones are read in overlapping pieces. A null doc_id is the smallest id. Rows
    of the same doc_id and text are one document: they don't repeat each other, and give equal rows; rows of the same
    doc_id and different texts are different documents, in the order of 128 bits of hash of their texts (which are left
    out where all ids differ). An empty table gives an empty result. Extra columns, whatever their names, don't matter.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    with released(docs.sparkSession):
        shared = not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
        tie = (lambda k: F.xxhash64(F.lit(k), F.col("text"))) if shared else (lambda k: F.lit(0).cast("long"))
        docs = docs.withColumns({"t0": tie(1), "t1": tie(2)})
        found = spans(docs, p)
    key = ["doc_id", "t0", "t1"]
    repeats = found.groupBy(*key).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    d = docs.join(repeats, key, "left").select("doc_id", "text", "spans")
    extra = ", kept binary, removed array<struct<start:bigint,end:bigint>>" if keep_text else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in slices(whole, limit=2_000_000)):
            cols: list[list] = [[], [], [], [], [], [], []]
            for doc, text, sp in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                cut: list[list[int]] = []
                for x in sorted((s["start"], s["end"]) for s in sp or ()):
                    if cut and x[0] <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], x[1])
                    else:
                        cut.append(list(x))
                kept, at = [], 0
                for s, e in cut:
                    kept.append(raw[at:s])
                    at = e
                kept_raw = b"".join([*kept, raw[at:]])
                row = (None if doc == _NULL else doc, len(raw), len(raw) - len(kept_raw), len(cut), hashlib.sha256(kept_raw).hexdigest(), kept_raw, [{"start": s, "end": e} for s, e in cut])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"]
            n = 7 if keep_text else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:n], kinds, strict=False)], names[:n])

    return in_arrow(few(d, docs), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + extra)
