"""Ranked lexical search: an inverted index in shards, and document-at-a-time merging of its postings.

index() makes shards of the documents as they are read, without a shuffle: the terms of some MB of text, each with the
numbers of its documents, ascending by doc_id, as differences in bytes of seven bits, with the occurrences. search() reads
the shards. For every query, a heap merges the postings of its terms by document; a second heap holds the best results of
all of a task's shards, by score and then doc_id. Terms that together can't reach the worst of them don't lead to
documents, they are only looked up for those that the others lead to. What the tasks have found is merged by windows.

Null texts have no terms; documents without terms count for nothing. Rows of null or equal ids are documents of their own,
null ids last among equal scores. Queries of one id (null too) are one query, the terms of all of their texts once each; a
query without terms has no results. Texts count whole; of a long one a shard of its own is made. Empty tables give no
rows. Other columns are left out. Scores are integers, so that no order of additions changes them.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, materialise, slices


@dataclass(frozen=True)
class Params:
    k: int = 50
    #: text that goes into one shard
    shard_bytes: int = 8_000_000
    #: queries of so many bytes of text are answered by one pass over the index
    query_bytes: int = 4_000_000


#: In UTF-8 all bytes of characters beyond ASCII are 0x80 and more. Only A-Z are lower-cased by bytes.lower().
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SHARD = "doc_ids array<bigint>, lengths array<int>, terms array<binary>, dfs array<int>, ends array<bigint>, postings binary"
#: Above all ids.
_LAST = 1 << 63


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each value in them): seven bits a byte, the lowest first, the top bit says that more follow."""
    v = values.astype(np.uint64)
    n = 1 + sum((v >= np.uint64(1) << np.uint64(7 * k)).astype(np.int64) for k in range(1, 10))
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(n.max(initial=0))):
        has = np.flatnonzero(n > k)
        out[ends[has] - n[has] + k] = (v[has] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(127) | np.where(n[has] > k + 1, 128, 0).astype(np.uint8)
    return out, ends


def unpacked(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], ends[:-1] + 1))
    place = np.arange(len(raw)) - np.repeat(first, ends - first + 1)
    return np.add.reduceat((raw & np.uint8(127)).astype(np.int64) << (7 * place), first)


class _Codes(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class Shard:
    """What is gathered of the documents of one shard."""

    def __init__(self):
        self.codes, self.docs, self.bytes = _Codes(), [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = terms_of(text)
        self.bytes += len(text or "")
        if found:
            code, tf = np.unique(np.fromiter(map(self.codes.__getitem__, found), np.int32, len(found)), return_counts=True)
            self.docs.append((_LAST if doc_id is None else doc_id, len(self.docs), len(found), code, tf.astype(np.int32)))

    def batch(self) -> pa.RecordBatch:
        self.docs.sort(key=lambda x: x[:2])
        size = np.array([len(x[3]) for x in self.docs])
        doc, code, tf = np.repeat(np.arange(len(size)), size), np.concatenate([x[3] for x in self.docs]), np.concatenate([x[4] for x in self.docs])
        names = sorted(self.codes)
        rank = np.empty(len(names), np.int32)
        rank[[self.codes[t] for t in names]] = np.arange(len(names))
        by = np.argsort(rank[code], kind="stable")
        doc, tf, df = doc[by], tf[by], np.bincount(rank[code], minlength=len(names))
        step = np.diff(doc, prepend=0)
        first = np.cumsum(df) - df
        step[first] = doc[first]
        raw, ends = packed(np.stack([step, tf], axis=1).ravel())
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                one([None if x[0] == _LAST else x[0] for x in self.docs], pa.int64()), one([x[2] for x in self.docs], pa.int32()), one(names, pa.binary()), one(df.astype(np.int32), pa.int32()),
                one(ends[2 * (first + df) - 1], pa.int64()), pa.array([raw.tobytes()], pa.binary()),
            ],
            ["doc_ids", "lengths", "terms", "dfs", "ends", "postings"],
        )


def index(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The shards of docs (doc_id, text), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for whole in batches:
            for b in slices(whole):
                for doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    shard.add(doc_id, text)
                    if shard.bytes >= p.shard_bytes:
                        if shard.docs:
                            yield shard.batch()
                        shard = Shard()
        if shard.docs:
            yield shard.batch()

    return materialise(in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run, SHARD), "lexical-index")


class Best:
    """The k best results so far; equal scores by ascending doc_id."""

    def __init__(self, k: int):
        self.k, self.heap, self.bound = k, [], 0

    def least(self) -> int:
        """Nothing below this can be among the k best."""
        return max(self.bound, self.heap[0][0] if len(self.heap) == self.k else 1)

    def offer(self, score: int, doc_id: int) -> None:
        if len(self.heap) < self.k:
            heappush(self.heap, (score, -doc_id))
        elif (score, -doc_id) > self.heap[0]:
            heapreplace(self.heap, (score, -doc_id))


def merge_postings(lists: list[tuple[list[int], list[int], int]], ids: list[int], best: Best) -> None:
    """Offer the documents of some terms' postings (numbers, scores, largest score), one document at a time."""
    lists = sorted(lists, key=lambda x: x[2])
    reach = [0]
    for _, _, top in lists:
        reach.append(reach[-1] + top)  # of all lists before
    least = best.least()
    lead = next((i for i in range(len(lists)) if reach[i + 1] >= least), len(lists))
    heap = [(docs[0], i, 0) for i, (docs, _, _) in enumerate(lists) if i >= lead]
    heapify(heap)
    at = [0] * len(lists)
    while heap:
        doc, score = heap[0][0], 0
        while heap and heap[0][0] == doc:
            _, i, k = heap[0]
            score += lists[i][1][k]
            k += 1
            if k < len(lists[i][0]):
                heapreplace(heap, (lists[i][0][k], i, k))
            else:
                heappop(heap)
        for i in range(lead - 1, -1, -1):
            if score + reach[i + 1] < least:
                break
            docs = lists[i][0]
            at[i] = k = bisect_left(docs, doc, at[i])
            if k < len(docs) and docs[k] == doc:
                score += lists[i][1][k]
        else:
            if score >= least:
                best.offer(score, ids[doc])
                if best.least() > least:
                    least = best.least()
                    if lead < len(lists) and reach[lead + 1] < least:
                        while lead < len(lists) and reach[lead + 1] < least:
                            lead += 1
                        for _, i, k in heap:
                            at[i] = k
                        heap = [x for x in heap if x[1] >= lead]
                        heapify(heap)


def _weights(df: dict[bytes, int], n: int) -> dict[bytes, int]:
    return {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}


def scored(shard: dict, names: pa.Array, weight: np.ndarray, n: int, total: int, k: int) -> dict[int, tuple[list[int], list[int], int, int]]:
    """Of the query terms that a shard has: (documents, scores, largest score, the k-th largest score) by the term's number."""
    at = pc.index_in(shard["terms"], value_set=names)
    here = np.flatnonzero(np.asarray(pc.is_valid(at)))
    number = np.asarray(at.take(pa.array(here)))
    m = 100 - 50 + 50 * shard["lengths"] * n // total
    raw, ends, out = np.frombuffer(shard["postings"], np.uint8), shard["ends"], {}
    for i, t in zip(here.tolist(), number.tolist(), strict=True):
        if weight[t] <= 0:
            continue
        v = unpacked(raw[ends[i - 1] if i else 0 : ends[i]]).reshape(-1, 2)
        doc, tf = np.cumsum(v[:, 0]), v[:, 1]
        score = weight[t] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        some = score > 0
        if some.any():
            doc, score = doc[some], score[some]
            out[t] = doc.tolist(), score.tolist(), int(score.max()), int(np.partition(score, -k)[-k]) if len(score) >= k else 0
    return out


def _top(found: DataFrame, p: Params) -> DataFrame:
    """The k best of each item, those of parts of the tasks first."""
    by = lambda *c: Window.partitionBy(*c).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    d = found.withColumn("_r", F.row_number().over(by("item", "part"))).filter(F.col("_r") <= p.k)
    return d.withColumn("rank", F.row_number().over(by("item"))).filter(F.col("rank") <= p.k).drop("_r", "part")


def search(shards: DataFrame, queries: DataFrame, p: Params = Params()) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each query (item_id, text), all with a score above 0."""
    spark = shards.sparkSession
    n, total = shards.agg(F.sum(F.size("doc_ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    q = queries.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = q.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if not n or not size:
        return out
    blocks = math.ceil(size / p.query_bytes)
    q = q.withColumn("_b", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    for block in range(blocks):
        items: dict[int | None, set[bytes]] = {}
        for r in q.filter(F.col("_b") == block).select("item_id", "text").collect():  # about query_bytes
            items.setdefault(r.item_id, set()).update(terms_of(r.text))
        out = out.unionByName(_answer(shards, list(items), list(items.values()), n, total, p))
    return out


def _answer(shards: DataFrame, ids: list, wanted: list[set[bytes]], n: int, total: int, p: Params) -> DataFrame:
    """The results of one block of queries."""
    spark = shards.sparkSession
    every = sorted(set().union(*wanted))
    held_terms = spark.sparkContext.broadcast(every)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, df = pa.array(held_terms.value, pa.binary()), np.zeros(len(held_terms.value), np.int64)
        for b in batches:
            at = pc.index_in(b.column(0).flatten(), value_set=names)
            has = np.asarray(pc.is_valid(at))
            df += np.bincount(np.asarray(at.drop_null()), weights=np.asarray(b.column(1).flatten())[has], minlength=len(df)).astype(np.int64)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some])], ["t", "df"])

    rows = in_arrow(shards.select("terms", "dfs"), counted, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df")).collect()  # the queries' terms
    weight = _weights({every[r.t]: r.df for r in rows}, n)
    number = {t: i for i, t in enumerate(every)}
    held = spark.sparkContext.broadcast((every, [weight.get(t, 0) for t in every], [[number[t] for t in sorted(w) if weight.get(t, 0) > 0] for w in wanted]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, weights, wanted = held.value
        names, weight, best = pa.array(every, pa.binary()), np.array(weights, np.int64), [Best(p.k) for _ in wanted]
        part = 0
        for b in batches:
            for i in range(b.num_rows):
                ids, lengths, terms, ends = (b.column(c)[i].values for c in (0, 1, 2, 3))
                part = part or 1 + (ids[0].as_py() or 0) % 64
                shard = {"terms": terms, "lengths": np.asarray(lengths).astype(np.int64), "ends": np.asarray(ends), "postings": b.column(4)[i].as_py()}
                has = scored(shard, names, weight, n, total, p.k)
                doc_ids = [_LAST if x is None else x for x in ids.to_pylist()]
                for own, terms_ in zip(best, wanted, strict=True):
                    lists = [has[t] for t in terms_ if t in has]
                    own.bound = max([own.bound, *(x[3] for x in lists)])
                    merge_postings([x[:3] for x in lists], doc_ids, own)
        found = [(i, part, None if -d == _LAST else -d, s) for i, own in enumerate(best) for s, d in own.heap]
        cols = list(zip(*found, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "part", "doc_id", "score"])

    found = in_arrow(shards.select("doc_ids", "lengths", "terms", "ends", "postings"), run, "item int, part int, doc_id bigint, score bigint")
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")
    return _top(found, p).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
