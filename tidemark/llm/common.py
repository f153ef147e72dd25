"""Helpers shared by the corpus operators: tables, the shared folder, numpy word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.store import drop_table, forget, materialise, released, shared_dir  # noqa: F401

#: The white space of every word definition here: blank and \t \n \v \f \r.
SPACE = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
ODD = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text) -> F.Column:
    """The words of a text column as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


# --- numpy -------------------------------------------------------------------------------------------------

_SPACE_LUT = np.zeros(256, bool)
_SPACE_LUT[[9, 10, 11, 12, 13, 32]] = True
_LOWER_LUT = np.arange(256, dtype=np.uint8)
_LOWER_LUT[65:91] += 32
_BYTE_LUT = (np.random.RandomState(7).randint(1, 2**62, 256).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_POW = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """ODD**0 .. ODD**(n-1) modulo 2**64."""
    global _POW
    if len(_POW) < n:
        p = np.full(max(n, 1024), ODD, np.uint64)
        p[0] = 1
        _POW = np.multiply.accumulate(p)
    return _POW[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(33)
    x *= np.uint64(MIX[1])
    x ^= x >> np.uint64(33)
    return x


#: Rows of a batch that goes to Python, at most: with documents of some KB, a few MB on either side.
BATCH_ROWS = 1000


def in_arrow(d: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """d.mapInArrow(run, schema) in batches of BATCH_ROWS rows (the session's setting is lowered to that), after which the
    Python worker, which Spark keeps for other tasks, returns what memory it has freed: an executor has more workers than
    tasks, and each would keep its own peak."""
    conf, key = d.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def frugal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return d.mapInArrow(frugal, schema)


def few(d: DataFrame, like: DataFrame, times: int = 2) -> DataFrame:
    """d in fewer, longer tasks: one for so many partitions of `like`, one a core at least. What it writes is that many files;
    Hadoop starts two child processes a local file, and listing very many small files is slow anywhere. To be put ahead of
    in_arrow, not behind it: a task keeps the buffers of each Python worker that it has fed until its end."""
    return d.coalesce(max(d.sparkSession.sparkContext.defaultParallelism, like.rdd.getNumPartitions() // times))


def slices(b: pa.RecordBatch, text: str = "text", limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """b in stretches of rows of about `limit` bytes of the text column: what is made of a batch for Python stays small,
    however many bytes Arrow has put into it. A longer text is a stretch of its own."""
    if not b.num_rows:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0)).astype(np.int64)
    total, at = np.cumsum(size), 0
    while at < b.num_rows:
        done = total[at] - size[at]
        end = max(at + 1, int(np.searchsorted(total, done + limit, "right")))
        yield b.slice(at, end - at)
        at = end


def chunks(ids: list, texts: list, limit: int = 2_000_000) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) in groups of about `limit` bytes; a null text is empty. A longer text is a group of its own."""
    a: list = []
    b: list[bytes] = []
    size = 0
    for i, t in zip(ids, texts, strict=True):
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        if b and size + len(raw) > limit:
            yield a, b
            a, b, size = [], [], 0
        a.append(i)
        b.append(raw)
        size += len(raw)
    if b:
        yield a, b


def word_hashes(raws: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of the texts, the index of its text, and its byte range in the texts joined by one
    blank each. With lower, A-Z count as a-z."""
    buf = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    if lower:
        buf = _LOWER_LUT[buf]
    space = _SPACE_LUT[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    lens = ends - starts
    inside = np.flatnonzero(~space)
    offset = np.concatenate(([0], np.cumsum(lens)[:-1]))
    place = np.arange(len(inside)) - np.repeat(offset, lens)
    h = np.add.reduceat(_BYTE_LUT[buf[inside]] * powers(int(lens.max()))[place], offset)
    text_end = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))
    return mix64(h + lens.astype(np.uint64)), np.searchsorted(text_end, starts, side="right"), starts, ends


def shingle_hashes(wh: np.ndarray, doc: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every shingle of `width` words; a text of fewer words gives one shingle of all its
    words, a text without words none. A shingle's hash depends on its words and their number."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    mult = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(ODD)) | np.uint64(1)
    n = len(wh)
    full = np.flatnonzero(np.arange(n) + width <= (first + count)[doc]) if n else np.zeros(0, np.int64)
    h = np.zeros(len(full), np.uint64)
    for j in range(width):
        h += wh[full + j] * mult[j]
    short = np.flatnonzero((count > 0) & (count < width))
    hs = np.zeros(len(short), np.uint64)
    for j in range(width - 1):
        has = count[short] > j
        hs[has] += wh[first[short[has]] + j] * mult[j]
    hs += count[short].astype(np.uint64)
    return mix64(np.concatenate((h, hs))), np.concatenate((doc[full], short))
