"""Document quality from a linear-chain conditional random field over lines.

Every line with a word gets measures of its own and of its neighbours. A two-state chain (bad, good) with one weight
a measure and four transition weights is trained by maximum conditional likelihood, each line of a labelled document
bearing the document's label. A document's score is the mean of the lines' forward-backward marginals of "good",
weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import chunks, few, in_arrow, mix64, powers, slices, word_hashes


@dataclass(frozen=True)
class Params:
    #: The model is fitted on at most so many labelled rows, those of the smallest hashes, and on at most so many lines of
    #: each, evenly spread over the text: some 50 MB on the driver at most.
    max_train_docs: int = 2000
    max_train_lines: int = 200
    steps: int = 100
    l2: float = 0.02
    threshold: float = 0.7
    folds: int = 4
    held_out_fold: int = 2


@dataclass
class Model:
    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: The score of a text without lines.
    prior: float = 0.5


def held_out(p: Params = Params(), doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training. A null id isn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % p.folds == p.held_out_fold, F.lit(False))


#: Counted characters, three classes to a table of 64-bit numbers: 21 bits each.
_CLASSES = (b"#*$%&<>", b"|", b"!?"), (b".,;:", bytes(range(65, 91)), bytes(range(48, 58)))
_TABLES = []
for _group in _CLASSES:
    _t = np.zeros(256, np.int64)
    for _k, _chars in enumerate(_group):
        _t[list(_chars)] = 1 << (21 * _k)
    _TABLES.append(_t)
N_OWN = 12
N_FEATURES = 3 * N_OWN - 1


def _class_counts(buf: np.ndarray, start: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each class its characters in each line."""
    out = []
    for table in _TABLES:
        if longest < 1 << 21:
            c = np.add.reduceat(table[buf], start)
            out += [(c >> (21 * k)) & 0x1FFFFF for k in range(3)]
        else:
            out += [np.add.reduceat((table[buf] >> (21 * k)) & 1, start) for k in range(3)]
    return out


def line_features(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures, text index and weight (bytes) of every line with a word. Bytes stand in for characters."""
    wh, doc_w, ws, we = word_hashes(raws)
    if not len(wh):
        return np.zeros((0, N_FEATURES)), np.zeros(0, np.int64), np.zeros(0)
    buf = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)  # the same places as in word_hashes
    end = np.flatnonzero(buf == 10)
    line_w = np.searchsorted(end, ws)
    head = np.concatenate(([True], line_w[1:] != line_w[:-1]))  # a line's first word
    first = np.flatnonzero(head)
    line = line_w[first]
    n_w = np.diff(np.concatenate((first, [len(wh)])))
    start, stop = np.where(line > 0, end[line - 1] + 1, 0), end[line]
    d = doc_w[first]
    n_solid = np.add.reduceat(we - ws, first)
    bounds = np.column_stack((start, stop)).ravel()
    counts = [c[0::2] for c in _class_counts(buf, bounds, int((stop - start).max()))]
    place = np.arange(len(wh)) - np.repeat(first, n_w)
    key = mix64(np.add.reduceat(wh * powers(int(n_w.max()))[place], first)) ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inv, times = np.unique(key, return_inverse=True, return_counts=True)
    fresh = np.zeros(len(wh), bool)
    fresh[np.unique(wh ^ (doc_w.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), return_index=True)[1]] = True
    n_fresh = np.add.reduceat(fresh.astype(np.int64), first)
    again = np.concatenate(([False], wh[1:] == wh[:-1])) & ~head  # the word before, once more
    n_again = np.add.reduceat(again.astype(np.int64), first)
    own = np.column_stack(
        [np.sqrt(np.minimum(c / n_solid, 1)) for c in counts] + [times[inv] > 1, n_again / n_w, n_fresh / n_w, n_solid / n_w / 10, np.log1p(stop - start) / 5, np.log1p(n_w) / 4]
    )
    prev, nxt = np.zeros_like(own), np.zeros_like(own)
    same = d[1:] == d[:-1]
    prev[1:][same] = own[:-1][same]
    nxt[:-1][same] = own[1:][same]
    return np.hstack((own, prev[:, :-1], nxt[:, :-1], np.ones((len(own), 1)))), d, np.maximum(stop - start, 1).astype(float)


def _marginals(score: np.ndarray, trans: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line and the summed pair marginals. score: the good state's, lines of text after text; lens:
    lines of each text, none 0. All texts advance together, the longest first."""
    order = np.argsort(-lens, kind="stable")
    lens_s = lens[order]
    at = (np.cumsum(lens) - lens)[order]
    e = np.exp(trans - trans.max())
    s = np.clip(score, -40, 40)
    node = np.column_stack((np.ones(len(s)), np.exp(s)))
    node /= node.sum(1, keepdims=True)
    alpha = np.empty_like(node)
    beta = np.ones_like(node)
    longest = int(lens_s[0])
    live = np.searchsorted(-lens_s, -np.arange(1, longest + 1), side="right")
    for t in range(longest):
        i = at[: live[t]] + t
        a = node[i] if t == 0 else node[i] * (alpha[i - 1] @ e)
        alpha[i] = a / a.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        i = at[: live[t + 1]] + t
        b = (beta[i + 1] * node[i + 1]) @ e.T
        beta[i] = b / b.sum(1, keepdims=True)
    m = alpha * beta
    m /= m.sum(1, keepdims=True)
    last = np.zeros(len(s), bool)
    last[np.cumsum(lens) - 1] = True
    k = np.flatnonzero(~last)
    pair = alpha[k][:, :, None] * e[None] * (node[k + 1] * beta[k + 1])[:, None, :]
    pair /= pair.sum((1, 2), keepdims=True)
    return m[:, 1], pair.sum(0)


def fit(features: list[np.ndarray], labels: np.ndarray, p: Params = Params(), prior: float | None = None) -> Model:
    """Maximum conditional likelihood by Adam; documents count alike, whatever their number of lines."""
    pairs = [(f, y) for f, y in zip(features, labels, strict=True) if len(f)]
    prior = float(np.mean(labels)) if prior is None and len(labels) else 0.5 if prior is None else prior
    if not pairs:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), prior=prior)
    x = np.vstack([f for f, _ in pairs]).astype(float)
    lens = np.array([len(f) for f, _ in pairs])
    y = np.repeat(np.array([v for _, v in pairs], float), lens)
    mean, std = x.mean(0), x.std(0)
    mean[std < 1e-9], std[std < 1e-9] = 0, 1
    x = (x - mean) / std
    w8 = np.repeat(1 / lens, lens)
    w, tr = np.zeros(x.shape[1]), np.zeros((2, 2))
    last = np.zeros(len(y), bool)
    last[np.cumsum(lens) - 1] = True
    k = np.flatnonzero(~last)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[k].astype(int), y[k + 1].astype(int)), 1)
    g1 = [np.zeros_like(w), np.zeros_like(tr)]
    g2 = [np.zeros_like(w), np.zeros_like(tr)]
    for step in range(1, p.steps + 1):
        m, pair = _marginals(x @ w, tr, lens)
        grads = [x.T @ ((y - m) * w8) / len(lens) - p.l2 * w / 10, (seen - pair) / len(y) - p.l2 * tr]
        for v, g, a, b in zip((w, tr), grads, g1, g2, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v += 0.1 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model(mean, std, w, tr, prior)


def score_texts(raws: list[bytes], model: Model) -> np.ndarray:
    x, doc, weight = line_features(raws)
    out = np.full(len(raws), model.prior)
    if len(doc):
        lens = np.bincount(doc, minlength=len(raws))
        m, _ = _marginals(((x - model.mean) / model.std) @ model.weights, model.trans, lens[lens > 0])
        total = np.bincount(doc, weights=weight, minlength=len(raws))
        good = np.bincount(doc, weights=weight * m, minlength=len(raws))
        out[lens > 0] = good[lens > 0] / total[lens > 0]
    return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Fit on the labelled rows outside the held-out fold, at most p.max_train_docs. Without any, every score is 0.5.
    Labels other than 0 and 1 and null texts or labels are left out; of several labels of a document each counts, of
    several texts of one id the one of the least hash. Measures are those of whole texts; of a text of more lines than
    p.max_train_lines so many enter the fit."""
    spark = docs.sparkSession
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(p)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(p.max_train_docs)
    ids = spark.createDataFrame(ids.collect(), "doc_id long, quality int")  # p.max_train_docs rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null").join(F.broadcast(ids), "doc_id")
    rows = rows.select("doc_id", "quality", "text", F.xxhash64("text").alias("hash"))
    # repeated rows were copies without bound: one text a label
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct("hash", "text"))["text"].alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = []
            for t in b.column("text").to_pylist():
                x, _, _ = line_features([t.encode("utf-8", "surrogatepass")])
                if len(x) > p.max_train_lines:
                    x = x[np.linspace(0, len(x) - 1, p.max_train_lines).astype(int)]
                f.append(x.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(f, pa.binary())], ["doc_id", "quality", "x"])

    got = in_arrow(rows, measure, "doc_id long, quality int, x binary").collect()  # bounded by p
    got.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    return fit([np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got], np.array([r.quality for r in got], float), p)


def with_score(docs: DataFrame, model: Model, carry: list[str], name: str = "score", text: str = "text") -> DataFrame:
    """The columns named in carry of every row of docs, and the score of its text. Null and empty texts get the
    model's prior. Rows are scored one by one: repeated rows alike, an empty table gives an empty result."""
    held = docs.select(*carry, *([] if text in carry else [text]))
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in slices(whole, text, 400_000)):
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            s = [score_texts(raws, model) for _, raws in chunks([None] * len(texts), texts, 1_000_000)]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in carry] + [pa.array(s, pa.float64())], [*carry, name])

    return in_arrow(few(held, docs), run, schema)


def classify(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs. Rows are judged by their own texts, those of null and
    shared ids too; whole texts are read; other columns, whatever their names, don't matter."""
    d = with_score(docs, train(docs, labels, p), ["doc_id"])
    return d.select("doc_id", held_out(p).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))


def filtered(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of docs that reach the threshold, all columns as they were, whatever their names."""
    name = "_score"
    while name in docs.columns:
        name = "_" + name
    return with_score(docs, train(docs, labels, p), docs.columns, name).filter(F.col(name) >= p.threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
