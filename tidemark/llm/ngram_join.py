"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

Order. n-grams (word shingles) are put into one global order, rare ones first: by the magnitude of their document
count, read from a count sketch of fixed size over all documents, then by hash. The order is cut into fragments.

Candidates. Two sets with Jaccard similarity t or more share an n-gram among the first (1 - t) * size + 1 of each, in
the global order. Only these prefixes are shuffled, as packed arrays, one for each task and range of hashes. Sets that
are equal form a class and count as one. The classes with a common prefix n-gram form a group, cut where sizes are too
far apart for a link; n-grams with the same group give it once. Each member knows the group's pivot (the class of the
least hash) and the next member by size. A bitmap of each class, the parity of its n-grams in twice as many bits as it
has n-grams, bounds every pair's difference from below: pairs that it rules out are not looked at.

Verification. The n-grams of the classes in question are split by fragment. A fragment's part of a pair goes where the
fragment's parts of its two classes are: (fragment, class) is the key that is dealt out, so that a class of very many pairs
spreads over all fragments. The overlaps counted there are summed for each pair, which is a link if they reach the
threshold.

Rounds. First each class is paired with one pivot, so that a group of thousands of near copies takes as many pairs as it
has members. Then members are paired with the other pivots, their neighbours and one member of each group by chance,
where these are of another component still. Last, every pair of different components with a common prefix n-gram that
sizes and bitmaps allow is verified, so that no link that joins components is lost; a group's largest component is not
paired with itself, so that a group of near copies and a few others takes as many pairs as it has members for each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, drop_table, few, in_arrow, materialise, mix64, shingle_hashes, slices, word_hashes
from tidemark.llm.graph import components


@dataclass(frozen=True)
class Params:
    width: int = 5
    #: Least similarity, in hundredths.
    percent: int = 80
    fragments: int = 8
    sketch_bits: int = 22
    #: Tables of so many ids at most are sent to all tasks; larger ones are shuffled.
    broadcast_ids: int = 200_000
    #: Likewise for groups that have members of several components.
    broadcast_groups: int = 30_000


_U = np.uint64


def _sets(raws: list[bytes], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes text after text (sorted by hash), their text index, the sets' sizes and fingerprints."""
    wh, doc, _, _ = word_hashes(raws)
    h, d = shingle_hashes(wh, doc, len(raws), p.width)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    n = np.bincount(d, minlength=len(raws))
    fp = np.zeros(len(raws), _U)
    some = n > 0
    if some.any():
        fp[some] = np.add.reduceat(mix64(h ^ _U(0x5851F42D4C957F2D)), (np.cumsum(n) - n)[some])
    return h, d, n, mix64(fp + n.astype(_U))


@dataclass
class Order:
    """The global n-gram order: a level for each sketch cell, and where each level begins, as a share of all n-grams."""

    level: np.ndarray
    begin: np.ndarray
    share: np.ndarray

    def places(self, h: np.ndarray) -> np.ndarray:
        """Each n-gram's place in the order, as a number: level, then hash."""
        bits = int(np.log2(len(self.level)))
        level = self.level[(h >> _U(64 - bits)).astype(np.int64)].astype(_U)
        return (level << _U(58)) | (mix64(h ^ _U(0x2545F4914F6CDD1D)) >> _U(6))

    def fragment(self, place: np.ndarray, n: int) -> np.ndarray:
        """Which of n ranges of the order, of about as many n-grams each, a place lies in."""
        level = (place >> _U(58)).astype(np.int64)
        within = (place & _U((1 << 58) - 1)).astype(float) / 2.0**58
        return np.minimum(((self.begin[level] + self.share[level] * within) * n).astype(np.int64), n - 1)


def global_order(docs: DataFrame, p: Params = Params()) -> Order:
    """The order, from the document counts of all n-grams, summed up in 2**sketch_bits cells. A cell's level is the
    magnitude of what its count has beyond half the mean. The size is fixed, whatever the number of documents. A task
    sums up several splits, so that the sketches that are shuffled go with the cores, not with the splits."""
    cells, pieces = 1 << p.sketch_bits, 64

    def pack(total: np.ndarray, which) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(which), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in total], pa.binary())], ["piece", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for b in batches:
            for part in slices(b):
                for _, raws in chunks([None] * part.num_rows, part.column(0).to_pylist()):
                    h, _, _, _ = _sets(raws, p)
                    np.add.at(total, (h >> _U(64 - p.sketch_bits)).astype(np.int64), 1)
        yield pack(np.split(total, pieces), range(pieces))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(c), np.int64)
        if sums:
            yield pack(list(sums.values()), sums)

    schema = "piece int, counts binary"
    some = docs.select("text").coalesce(2 * docs.sparkSession.sparkContext.defaultParallelism)
    got = in_arrow(in_arrow(some, run, schema).repartition(pieces, "piece"), add, schema).collect()  # fixed size
    total = np.zeros(cells, np.int64)
    for r in got:
        total[r.piece * (cells // pieces) : (r.piece + 1) * (cells // pieces)] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    mean = max(total.mean(), 1 / 16)
    level = np.minimum(np.floor(np.log2(np.maximum(total - mean / 2, 0) / max(1.0, mean / 4) + 1)), 63).astype(np.uint8)
    share = np.bincount(level, weights=total, minlength=64) / max(total.sum(), 1)
    return Order(level, np.cumsum(share) - share, share)


def _prefix(place: np.ndarray, d: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    """Which of the places, sorted within each text, lie in their text's prefix."""
    length = np.where(n > 0, n + (-p.percent * n // 100) + 1, 0)
    # so few n-grams that a set with one less or one more is too different: only equal sets are partners
    length[(100 * (n - 1) < p.percent * n) & (100 * n < p.percent * (n + 1))] = 0
    first = np.cumsum(n) - n
    return np.arange(len(place)) - first[d] < length[d]


_LONGS = pa.list_(pa.int64())


def _bitmaps(h: np.ndarray, d: np.ndarray, n: np.ndarray) -> pa.Array:
    """The parity bitmap of each set: 64-bit words, so many (a power of two, 16 at least) that bits are twice as many as n-grams.
    Sets differ in as many n-grams, at least, as their bitmaps differ in bits; a bitmap's halves xored give that of half
    the size."""
    words = 1 << np.maximum(4, np.ceil(np.log2(np.maximum(n, 1) / 32)).astype(np.int64))
    first = np.cumsum(words) - words
    bit = (mix64(h ^ _U(0xA0761D6478BD642F)) & (words[d] * 64 - 1).astype(_U)).astype(np.int64)
    at = np.sort(first[d] * 64 + bit)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    i = np.flatnonzero(new)
    odd = np.diff(np.append(i, len(at))) % 2 == 1
    on = at[i[odd]]
    out = np.zeros(int(words.sum()), _U)
    np.bitwise_or.at(out, on >> 6, _U(1) << (on & 63).astype(_U))
    return pa.ListArray.from_arrays(pa.array(np.append(first, len(out)), pa.int32()), pa.array(out.view(np.int64)))


#: SQL for the bits that differ between ba and bb, the larger one folded once.
_FOLD = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (u, v) -> u ^ v)"
_DIFFER = (
    "aggregate(zip_with(case when size(ba) > size(bb) then " + _FOLD.format("ba") + " else ba end, case when size(bb) > size(ba) then " + _FOLD.format("bb") + " else bb end, "
    "(u, v) -> bit_count(u ^ v)), 0, (s, x) -> s + x)"
)


def _near(p: Params, na: str = "na", nb: str = "nb"):
    """Whether the bitmaps allow a link: both sets without their overlap have (1 - t) / (1 + t) of the sizes' sum at most."""
    return F.expr(f"({100 + p.percent}) * ({_DIFFER}) <= ({100 - p.percent}) * ({na} + {nb})")


def signatures(docs: DataFrame, order: Order, shards: int, p: Params = Params()) -> DataFrame:
    """Rows of two kinds: kind 0, a document's doc_id, text_hash, n and class fingerprint fp; kind 1, a shard's packed prefixes
    (place, fp, n) from one batch of texts. Equal sets within a batch give one prefix."""
    held = docs.sparkSession.sparkContext.broadcast(order)
    names = ["kind", "shard", "doc_id", "text_hash", "n", "fp", "packed", "bits"]

    def rows(kind: int, shard: list, ids: list, th: list, n: list, fp: list, packed: list, bits) -> pa.RecordBatch:
        longs = (pa.array(x, pa.int64()) for x in (ids, th, n, fp))
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(shard), pa.int32()), pa.array(shard, pa.int32()), *longs, pa.array(packed, pa.binary()), bits], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for b in batches:
            for x in slices(b):
                raws = [(t or "").encode("utf-8", "surrogatepass") for t in x.column("text").to_pylist()]
                ids = x.column("doc_id").to_pylist()
                h, d, n, fp = _sets(raws, p)
                turn += 1
                at = [(turn * 7919 + i) % shards for i in range(len(ids))]
                yield rows(0, at, ids, x.column("text_hash").to_pylist(), n.tolist(), fp.view(np.int64).tolist(), [None] * len(ids), _bitmaps(h, d, n))
                own = np.zeros(len(raws), bool)
                own[np.unique(fp, return_index=True)[1]] = True
                keep = own[d]
                h, d = h[keep], d[keep]
                place = held.value.places(h)
                by = np.lexsort((place, d))
                place, d = place[by], d[by]
                m = np.where(own, n, 0)
                use = _prefix(place, d, m, p)
                place, d = place[use], d[use]
                shard = ((mix64(place) >> _U(33)) % _U(shards)).astype(np.int64)
                by = np.argsort(shard, kind="stable")
                place, d, shard = place[by], d[by], shard[by]
                cut = np.searchsorted(shard, np.arange(shards + 1))
                some = np.flatnonzero(cut[1:] > cut[:-1]).tolist()
                packed = []
                for s in some:
                    i = slice(cut[s], cut[s + 1])
                    packed.append(place[i].tobytes() + fp[d[i]].tobytes() + n[d[i]].astype(np.int32).tobytes())
                none = [None] * len(some)
                yield rows(1, some, none, none, none, none, packed, pa.nulls(len(some), _LONGS))

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return in_arrow(d, run, "kind int, shard int, doc_id long, text_hash long, n long, fp long, packed binary, bits array<bigint>")


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b, c = [], [], []
    for x in blobs:
        k = len(x) // 20
        a.append(np.frombuffer(x, _U, k))
        b.append(np.frombuffer(x, _U, k, 8 * k))
        c.append(np.frombuffer(x, np.int32, k, 16 * k))
    return np.concatenate(a), np.concatenate(b), np.concatenate(c).astype(np.int64)


def groups(signed: DataFrame, shards: int, docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Kind 0 rows as they are; kind 2 rows (gid, fp, n): the members of each group, once for all prefix n-grams of a
    shard that have these members. gid is a hash of the members. A shard at a time, in sorted partitions."""

    names = ["kind", "gid", "doc_id", "text_hash", "n", "fp", "pivot", "pn", "nxt", "nn", "alt", "an", "bits"]

    def shard_rows(blobs: list[bytes]) -> pa.RecordBatch | None:
        place, fp, n = _unpack(blobs)
        by = np.lexsort((fp, n, place))
        place, fp, n = place[by], fp[by], n[by]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (fp[1:] != fp[:-1])  # equal sets of several batches
        place, fp, n = place[new], fp[new], n[new]
        head = np.ones(len(place), bool)
        head[1:] = (place[1:] != place[:-1]) | (100 * n[:-1] < p.percent * n[1:])
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(place)))
        gid = mix64(np.add.reduceat(mix64(fp ^ _U(0x9FB21C651E98DF25)), at) + size.astype(_U))
        once = np.zeros(len(at), bool)
        once[np.unique(gid, return_index=True)[1]] = True
        keep = np.repeat((size > 1) & once, size)
        if not keep.any():
            return None
        key = mix64(fp ^ _U(0xE7037ED1A0B428DB))
        group = np.repeat(np.arange(len(at)), size)
        pivot = np.repeat(np.lexsort((key, group))[at], size)
        alt = np.repeat(at, size) + (mix64(key + np.repeat(gid, size)) >> _U(11)).astype(np.int64) % np.repeat(size, size)
        nxt = np.where(np.append(head[1:], True), pivot, np.arange(len(fp)) + 1)
        signed = lambda x: pa.array(x[keep].view(np.int64))
        k = int(keep.sum())
        cols = [pa.array([2] * k, pa.int32()), signed(np.repeat(gid, size)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(n[keep]), signed(fp), signed(fp[pivot]), pa.array(n[pivot][keep]), signed(fp[nxt]), pa.array(n[nxt][keep]), signed(fp[alt]), pa.array(n[alt][keep]), pa.nulls(k, _LONGS)]
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for b in batches:
            kind = np.asarray(b.column("kind"))
            docs = b.filter(pa.array(kind == 0))
            if docs.num_rows:
                none = pa.nulls(docs.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([docs.column("kind"), none, docs.column("doc_id"), docs.column("text_hash"), docs.column("n"), docs.column("fp"), none, none, none, none, none, none, docs.column("bits")], names)
            packed = b.filter(pa.array(kind == 1))
            for s, x in zip(packed.column("shard").to_pylist(), packed.column("packed").to_pylist(), strict=True):
                if s != now:
                    if blobs and (out := shard_rows(blobs)):
                        yield out
                    now, blobs = s, []
                blobs.append(x)
        if blobs and (out := shard_rows(blobs)):
            yield out

    d = few(signed.repartition(shards, "shard").sortWithinPartitions("shard"), docs, 4)  # each shard stays in one stretch
    return in_arrow(d, run, "kind int, gid long, doc_id long, text_hash long, n long, fp long, pivot long, pn long, nxt long, nn long, alt long, an long, bits array<bigint>")


def fragments(docs: DataFrame, order: Order, p: Params = Params()) -> DataFrame:
    """(fp, frag, grams) of every document: its n-grams' places, cut where the global order is cut."""
    held = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in slices(whole)):
            for _, raws in chunks([None] * b.num_rows, b.column("text").to_pylist()):
                h, d, n, fp = _sets(raws, p)
                place = held.value.places(h)
                frag = held.value.fragment(place, p.fragments)
                by = np.lexsort((place, frag, d))
                place, frag, d = place[by], frag[by], d[by]
                head = np.ones(len(d), bool)
                head[1:] = (d[1:] != d[:-1]) | (frag[1:] != frag[:-1])
                at = np.flatnonzero(head)
                grams = pa.ListArray.from_arrays(pa.array(np.append(at, len(place)), pa.int32()), pa.array(place.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(fp[d[at]].view(np.int64)), pa.array(frag[at], pa.int32()), grams], ["fp", "frag", "grams"])

    return in_arrow(docs.select("text"), run, "fp long, frag int, grams array<bigint>")


def verified(pairs: DataFrame, parts: DataFrame, p: Params = Params()) -> DataFrame:
    """pairs (a, b, na, nb) with the sum of their fragments' overlaps, both. Pairs meet the parts fragment by fragment."""
    cut = pairs.withColumn("frag", F.explode(F.sequence(F.lit(0), F.lit(p.fragments - 1))))
    left = cut.join(parts.withColumnsRenamed({"fp": "a", "grams": "ga"}), ["frag", "a"])
    return (
        left.join(parts.withColumnsRenamed({"fp": "b", "grams": "gb"}), ["frag", "b"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("part"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("part").alias("both"))
    )


def _links(checked: DataFrame, p: Params) -> DataFrame:
    return checked.filter(100 * F.col("both") >= p.percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _sized(p: Params, na: str = "na", nb: str = "nb"):
    """Sizes that allow a link."""
    return (100 * F.least(na, nb) >= p.percent * F.greatest(na, nb))


def join(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, text_hash) of every row of docs. component names the component where
    ids can't (a hash; null for texts without shingles), text_hash is the text's xxhash64.

    Null, empty and wordless texts have no shingles; each is its own component. Documents of equal sets are linked
    (both have all of the other's). Repeated rows give their rows each. Rows of null or shared ids are linked by their
    own texts; a null doc_id gets the smallest id of its component, which is null if none is known. Whole texts are
    read, however long. An empty table gives an empty result; columns other than doc_id and text don't matter. Sets are
    told apart by a 64-bit fingerprint and their size, n-grams by 64-bit hashes.
    """
    spark: SparkSession = docs.sparkSession
    shards = max(8, 2 * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = global_order(docs, p)
    table = materialise(groups(signatures(docs, order, shards, p), shards, docs, p), "prefixes")
    members = table.filter("kind = 0").select("doc_id", "text_hash", "n", "fp")
    classes = table.filter("kind = 0").groupBy("fp").agg(F.min("doc_id").alias("low"), F.min("text_hash").alias("text_hash"), F.first("bits").alias("bits"))
    classes = materialise(classes, "classes")
    group = materialise(table.filter("kind = 2").select("gid", "fp", "n", "pivot", "pn", "nxt", "nn", "alt", "an").dropDuplicates(["gid", "fp"]), "groups")
    bits = classes.select("fp", "bits")

    def ordered(d: DataFrame) -> DataFrame:
        """Pairs (x, y, nx, ny) as (a, b, na, nb) with a before b."""
        pick = lambda u, v, name: F.when(F.col("x") < F.col("y"), F.col(u)).otherwise(F.col(v)).alias(name)
        return d.filter("x <> y").select(pick("x", "y", "a"), pick("y", "x", "b"), pick("nx", "ny", "na"), pick("ny", "nx", "nb"))

    def tidy(d: DataFrame) -> DataFrame:
        """Pairs the right way round, once, and only those that sizes and bitmaps allow."""
        d = ordered(d).filter(_sized(p)).distinct()
        d = d.join(bits.select(F.col("fp").alias("a"), F.col("bits").alias("ba")), "a").join(bits.select(F.col("fp").alias("b"), F.col("bits").alias("bb")), "b")
        return d.filter(_near(p)).select("a", "b", "na", "nb")

    def links(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are links. One text of each class gives its n-grams."""
        fps = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
        asked = materialise(classes.join(fps, "fp", "left_semi").select("text_hash").distinct(), "asked")
        asked = F.broadcast(asked) if asked.count() <= p.broadcast_ids else asked
        chosen = docs.select("text", F.xxhash64("text").alias("text_hash")).join(asked, "text_hash", "left_semi")
        parts = materialise(few(fragments(chosen, order, p).dropDuplicates(["fp", "frag"]), docs), "fragments")
        found = materialise(_links(verified(pairs, parts, p), p), "links")
        drop_table(parts)
        return found

    def homes(edges: DataFrame) -> DataFrame:
        return components(edges).select(F.col("node").alias("fp"), "root")

    def with_home(d: DataFrame, roots: DataFrame, col: str) -> DataFrame:
        r = roots.select(F.col("fp").alias(col), F.col("root").alias("_r"))
        return d.join(r, col, "left").withColumn(f"home_{col}", F.coalesce("_r", col)).drop("_r")

    pair = lambda x, nx, y, ny: group.select(F.col(x).alias("x"), F.col(nx).alias("nx"), F.col(y).alias("y"), F.col(ny).alias("ny"))
    # round 1: one pivot for each class
    star = pair("fp", "n", "pivot", "pn").filter("x <> y").filter(_sized(p, "nx", "ny"))
    first = star.groupBy("x", "nx").agg(F.min(F.struct(F.xxhash64("y").alias("k"), "y", "ny")).alias("s")).select("x", "nx", "s.y", "s.ny")
    done = materialise(tidy(first), "pairs")
    edges = links(done)
    roots = materialise(homes(edges), "roots")
    # round 2: other pivots, the next by size and one by chance, if still apart
    near = star.unionByName(pair("fp", "n", "nxt", "nn")).unionByName(pair("fp", "n", "alt", "an")).distinct()
    near = with_home(with_home(near, roots, "x"), roots, "y").filter("home_x <> home_y").drop("home_x", "home_y")
    second = materialise(tidy(near).join(done, ["a", "b"], "left_anti"), "pairs")
    edges = edges.unionByName(links(second))
    done = done.unionByName(second)
    roots = materialise(homes(edges), "roots")
    # round 3: what is left across components
    placed = with_home(group.select("gid", "fp", "n"), roots, "fp")
    homes_of = placed.groupBy("gid", "home_fp").agg(F.count(F.lit(1)).alias("k"))
    open_ = homes_of.groupBy("gid").agg(F.count(F.lit(1)).alias("homes"), F.max(F.struct("k", "home_fp"))["home_fp"].alias("big")).filter("homes > 1").select("gid", "big")
    open_ = materialise(open_, "open-groups")
    open_ = F.broadcast(open_) if open_.count() <= p.broadcast_groups else open_
    left = materialise(placed.join(open_, "gid").join(bits, "fp"), "open")
    x = left.filter("home_fp <> big").select("gid", F.col("fp").alias("x"), F.col("n").alias("nx"), F.col("home_fp").alias("hx"), F.col("bits").alias("ba"))
    y = left.select(F.col("gid").alias("g"), F.col("fp").alias("y"), F.col("n").alias("ny"), F.col("home_fp").alias("hy"), F.col("bits").alias("bb"), "big")
    once = (F.col("hy") == F.col("big")) | (F.col("x") < F.col("y"))
    rest = x.join(y, (F.col("gid") == F.col("g")) & (F.col("hx") != F.col("hy")) & once & _sized(p, "nx", "ny") & _near(p, "nx", "ny"))
    rest = rest.select("x", "nx", "y", "ny")
    third = materialise(ordered(rest).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    edges = edges.unionByName(links(third))
    roots = homes(edges)
    both = with_home(classes.select("fp", "low"), roots, "fp").withColumnRenamed("home_fp", "root")
    ids = both.groupBy("root").agg(F.min("low").alias("least"))
    named = both.join(ids, "root").select("fp", "root", "least")
    d = members.join(named, "fp", "left")
    some = F.col("n") > 0
    return d.select("doc_id", F.col("n").alias("n_shingles"), F.when(some, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), F.when(some, F.col("root")).alias("component"), "text_hash")
