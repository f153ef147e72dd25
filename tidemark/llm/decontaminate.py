"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the tokens at the fixed positions of a mask and ignores those between, so that a substituted token spoils
only the seeds whose kept positions fall on it. Training seeds are looked up among the benchmark's; each hit names a
diagonal (a document, an item and the shift between them), on which the two texts are compared token by token. An overlap
is a run on a diagonal with enough equal tokens (`min_matches`, or `min_item_share` of a shorter item) that make up at
least `min_identity` of the run's length.

No overlap is without a seed. The three masks hit every run of 16 tokens of which 4 differ, wherever they differ (by
enumeration), and each overlap of 13 equal tokens and an identity of 3/4 holds such a run or a part of one. Items of fewer
than 17 tokens may do with fewer equal ones: they have seeds of 3 adjacent tokens, one of which every overlap holds (by the
number of differing tokens). Items of fewer than 6 tokens have to stand whole.

Tokens are lower-cased words without ASCII punctuation. Items of equal tokens are looked up once. The benchmark travels
to the tasks in blocks of bounded size; a larger benchmark takes more blocks, each a pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, few, in_arrow, materialise, mix64, slices, word_hashes


@dataclass(frozen=True)
class Params:
    #: 1: the token counts, 0: it may differ. Together they hit any 16 tokens of which any 4 differ.
    masks: tuple[str, ...] = ("110111", "1101000011", "100010000111")
    #: A run counts from this many equal tokens on, or from min_item_share of an item with fewer tokens.
    min_matches: int = 13
    min_item_share: float = 0.8
    #: A run's equal tokens against its length.
    min_identity: float = 0.75
    #: Items of fewer tokens than `short` have seeds of 3 adjacent tokens, those of fewer than `whole` have to stand whole.
    short: int = 17
    whole: int = 6
    block_bytes: int = 8_000_000


#: ASCII punctuation and control characters become blanks.
_CLEAN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_BITS = 22
_U = np.uint64


def needed(n: np.ndarray | int, p: Params):
    """Equal tokens that an overlap with an item of n tokens has."""
    return np.where(np.asarray(n) < p.whole, n, np.minimum(p.min_matches, np.ceil(p.min_item_share * np.asarray(n) - 1e-9))).astype(np.int64)


class Index:
    """The seeds of a block of benchmark items, sorted by hash. Items of equal tokens are one text here, in groups."""

    def __init__(self, items: list[tuple[int, str]], p: Params):
        self.p = p
        raws = [(t or "").lower().encode("utf-8", "surrogatepass").translate(_CLEAN) for _, t in items]
        groups: dict[tuple[bytes, ...], list[int]] = {}
        for (i, _), raw in zip(items, raws, strict=True):
            if said := tuple(raw.split()):
                groups.setdefault(said, []).append(i)
        self.ids = [sorted(set(x)) for x in groups.values()]
        texts = [b" ".join(x) for x in groups]
        self.tokens, item, _, _ = word_hashes(texts) if texts else (np.zeros(0, _U), np.zeros(0, np.int64), None, None)
        self.count = np.bincount(item, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        self.kinds = kinds(self.count, p)
        h, at = seeds(self.tokens, item, self.first + self.count, self.kinds, self.count)
        order = np.argsort(h, kind="stable")
        self.hash, self.at, self.item = h[order], at[order], item[at[order]]
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hash >> _U(64 - _BITS)).astype(np.int64)] = True


def kinds(count: np.ndarray, p: Params) -> list[tuple[str, int, int]]:
    """(mask, least and greatest size of the items that have its seeds) for items of these sizes."""
    out = [(m, p.short, 1 << 60) for m in p.masks] if (count >= p.short).any() else []
    if ((count >= p.whole) & (count < p.short)).any():
        out.append(("111", p.whole, p.short - 1))
    return out + [("1" * n, n, n) for n in np.unique(count[count < p.whole]).tolist() if n]


def seeds(tokens: np.ndarray, text: np.ndarray, text_end: np.ndarray, masks: list[tuple[str, int, int]], size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first token of every seed of every mask that fits into its text; with size, the texts' sizes, only the
    seeds that a text of its size has."""
    hs, ats = [], []
    for mask, least, most in masks:
        n = len(tokens) - len(mask) + 1
        if n <= 0:
            continue
        ok = np.arange(n) + len(mask) <= text_end[text[:n]]
        if size is not None:
            ok &= ((size >= least) & (size <= most))[text[:n]]
        at = np.flatnonzero(ok)
        key = mix64(np.array([int(mask, 2) + (len(mask) << 32) + (least << 40)], _U))[0]
        h = np.full(n, key, _U)
        for j, bit in enumerate(mask):
            if bit == "1":
                h += tokens[j : n + j] * (mix64(np.array([key + _U(j + 1)], _U))[0] | _U(1))
        hs.append(mix64(h[at]))
        ats.append(at)
    if not hs:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(hs), np.concatenate(ats)


def lowered(texts: list) -> list:
    return [t.lower() if t else "" for t in texts]


def overlaps(equal: np.ndarray, first: np.ndarray, need: np.ndarray, p: Params) -> tuple[np.ndarray, ...]:
    """(diagonal, start, end, equal tokens) of the longest overlap of each diagonal that has one. equal: which tokens
    agree, diagonal after diagonal; first: where each begins. Every run of a diagonal is considered: for each end, the
    leftmost start from which the identity is reached."""
    q = round(100 * p.min_identity)
    size = np.diff(np.append(first, len(equal)))
    # sums of scores before each token and at the end, a diagonal after the other, each from 0
    seg = np.repeat(np.arange(len(first)), size + 1)
    begin = first + np.arange(len(first))
    score, ones = np.zeros(len(seg), np.int64), np.zeros(len(seg), np.int64)
    inner = np.ones(len(seg), bool)
    inner[begin] = False
    score[inner], ones[inner] = np.where(equal, 100 - q, -q), equal
    score, ones = np.cumsum(score), np.cumsum(ones)
    score -= np.repeat(score[begin], size + 1)
    big = 200 * (int(size.max()) + 2)
    low = np.minimum.accumulate(score - seg * big) + seg * big  # the least sum so far on the diagonal
    start = np.searchsorted(seg * big - low, seg * big - score, "left")  # the first with a sum as low as here
    same = ones - ones[start]
    best = np.maximum.reduceat(same, begin)
    hit = np.flatnonzero(best >= need)
    out = []
    for k in hit.tolist():
        at = begin[k] + int(same[begin[k] : begin[k] + size[k] + 1].argmax())
        run = np.flatnonzero(equal[first[k] + start[at] - begin[k] : first[k] + at - begin[k]])
        a = int(start[at] - begin[k] + run[0])
        out.append((k, a, int(start[at] - begin[k] + run[-1] + 1), len(run)))
    return tuple(np.array(x, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


def find(raws: list[bytes], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item group, first token in the text, run length, equal tokens): the overlap with the most equal tokens of
    each pair of a text and a group of equal items."""
    p = index.p
    wh, doc, _, _ = word_hashes([r.translate(_CLEAN) for r in raws])
    if not len(wh) or not len(index.hash):
        return []
    count = np.bincount(doc, minlength=len(raws))
    first = np.cumsum(count) - count
    h, at = seeds(wh, doc, first + count, index.kinds)
    maybe = index.seen[(h >> _U(64 - _BITS)).astype(np.int64)]
    h, at = h[maybe], at[maybe]
    lo, hi = np.searchsorted(index.hash, h, "left"), np.searchsorted(index.hash, h, "right")
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for part in np.array_split(np.flatnonzero(hi > lo), max(1, int((hi - lo).sum()) // 200_000)):
        n = (hi - lo)[part]
        j = np.repeat(lo[part], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        t = np.repeat(at[part], n)
        d, item = doc[t], index.item[j]
        diagonals = np.unique(np.column_stack((d, item, t - first[d] - index.at[j] + index.first[item])), axis=0)
        for chunk in np.array_split(diagonals, max(1, len(diagonals) // 20_000)):
            if not len(chunk):
                continue
            d, item, shift = chunk.T
            k0 = np.maximum(0, -shift)
            size = np.minimum(index.count[item], count[d] - shift) - k0
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            equal = wh[np.repeat(first[d] + shift + k0, size) + step] == index.tokens[np.repeat(index.first[item] + k0, size) + step]
            for k, a, b, same in zip(*(x.tolist() for x in overlaps(equal, np.cumsum(size) - size, needed(index.count[item], p), p)), strict=True):
                key = int(d[k]), int(item[k])
                run = (same, -(b - a), -int(shift[k] + k0[k] + a))
                if run > best.get(key, (0, 0, 0)):
                    best[key] = run
    return [(d, item, -start, -size, same) for (d, item), (same, size, start) in sorted(best.items())]


def blocks(benchmark: DataFrame, p: Params = Params()) -> Iterator[tuple[Index, bool]]:
    """The benchmark in blocks of about p.block_bytes, by a hash of the item, so that each fits the driver and every task,
    and whether it is the only one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // p.block_bytes) + 1
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = sorted({(r.item_id if r.item_id is not None else -1, r.text) for r in part.collect()})
        yield Index(rows, p), n == 1


def matches(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """A row for each document and item with an overlap: doc_id, item_id, start (the run's first token in the document,
    from 0), run_tokens and matched_tokens, of the overlap with the most equal tokens.

    Null and empty texts match nothing, on either side; null item ids are -1. Repeated documents, and those of null and
    shared ids, give their rows each; repeated items count once. Empty tables give an empty result. Whole texts are
    compared; other columns don't matter. With several blocks each one's rows are written before the next is sent.
    """
    out = None
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for index, only in blocks(benchmark, p):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in (x for whole in batches for x in slices(whole)):
                for ids, raws in chunks(b.column("doc_id").to_pylist(), lowered(b.column("text").to_pylist())):
                    rows = [(ids[t], i, *rest) for t, g, *rest in find(raws, held.value) for i in held.value.ids[g]]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "start", "run_tokens", "matched_tokens"])

        part = in_arrow(d, run, "doc_id long, item_id long, start long, run_tokens long, matched_tokens long")
        if not only:
            part = materialise(part, "matches")
            held.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs without an overlap, all columns as they were, in one pass a block. No join: rows whose ids are
    null or repeated are judged by their own texts. With several blocks what each one leaves is written."""
    for index, only in blocks(benchmark, p):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in (x for whole in batches for x in slices(whole)):
                texts = lowered(b.column(b.schema.get_field_index("text")).to_pylist())
                bad, base = set(), 0
                for _, raws in chunks([None] * len(texts), texts):
                    bad |= {base + m[0] for m in find(raws, held.value)}
                    base += len(raws)
                yield b.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))

        docs = in_arrow(few(docs, docs), run, docs.schema)
        if not only:
            docs = materialise(docs, "clean")
            held.destroy()
    return docs
