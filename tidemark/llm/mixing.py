"""Mixing sources to target weights by hash-random order, range buckets and distributed prefix sums.

A document's key is a hash of its id and a seed: a random number that every run agrees on. The keys of a source are
cut into equal ranges (buckets) of a bounded number of rows; hashes are even, so the ranges need no sampling and a
hot source spreads over as many buckets as it needs. Bucket sums give every bucket's starting offset, a window
inside each bucket gives every document's, and the source's budget is cut exactly there. A budget beyond the source's
size takes whole epochs first; what is left of it is cut in the last epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import few, materialise, n_words, words


@dataclass(frozen=True)
class Params:
    weights: tuple[int, ...] = (5, 2, 1)
    #: The mix's size as a share of all sizes.
    total: float = 1.5
    #: No source gives more than so many times its size.
    max_epochs: int = 2
    seed: int = 42
    bucket_rows: int = 5_000


def targets(sizes: DataFrame, p: Params = Params()) -> DataFrame:
    """(source, source_size, target) for a table (source, source_size) of one row a source.

    Sources in code point order, null last, have the weights in turn. The target is min(weight * level, cap), at the
    level at which targets sum up to the mix's size: what capped sources leave is shared by weight. Sorted by
    cap / weight, the capped sources come first, so that one running sum finds the level.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))  # a row a source, not a document
    w = F.element_at(F.array(*map(F.lit, p.weights)), ((n - 1) % len(p.weights) + 1).cast("int")).cast("double")
    d = sizes.withColumns({"_w": w, "_cap": F.col("source_size") * F.lit(float(p.max_epochs))}).withColumn("_r", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_r", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns(
        {
            "_goal": F.sum("source_size").over(every) * p.total,
            "_caps": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_wsum": F.sum("_w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    # capped while the level that the rest would have reaches this source's own; the first that isn't has the level
    d = d.withColumn("_level", (F.col("_goal") - F.col("_caps")) / F.col("_wsum"))
    first = F.min(F.when(F.col("_level") < F.col("_r"), F.struct("_r", "_level"))).over(every)
    t = F.least(F.col("_w") * first["_level"], F.col("_cap"))  # least() leaves out nulls: without a level all are capped
    return d.select("source", "source_size", t.alias("target"))


_OWN = ("size", "source_size", "target", "taken")


def _measured(docs: DataFrame, carry: list[str], p: Params, text: str) -> DataFrame:
    """(row, source, doc_id, size, key) of every row of docs; row has the columns to carry, whatever their names."""
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in carry))
    key = F.shiftrightunsigned(F.xxhash64(F.lit(p.seed), F.col("doc_id"), F.col(text)), 11)
    return docs.select(row.alias("row"), F.col("source").alias("source"), F.col("doc_id").alias("doc_id"), n_words(F.col(text)).alias("size"), key.alias("key"))


def _taken(rows: DataFrame, sized: DataFrame, p: Params) -> DataFrame:
    """rows (of _measured) with source_size, target and taken. sized: the same, without what isn't needed."""
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    per = materialise(per, "sources")
    goal = targets(per.select("source", "source_size"), p)
    goal = goal.withColumnRenamed("source", "_s").join(per.select(F.col("source").alias("_p"), "n_rows"), same("_s", "_p")).drop("_p")
    n_buckets = F.ceil(F.col("n_rows") / p.bucket_rows)
    share = F.col("key").cast("double") / F.lit(float(2**53))
    bucket = F.least(F.floor(share * n_buckets), n_buckets - 1)
    dealt = lambda d: d.join(goal, same("source", "_s")).drop("_s").withColumn("bucket", bucket)
    sums = dealt(sized).groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    ahead = F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), ahead.alias("ahead"))
    # order inside a source: hash, then id; equal rows are interchangeable
    run = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = dealt(rows).withColumn("before", F.coalesce(F.sum("size").over(run), F.lit(0)))
    d = d.join(sums, same("source", "_s") & (F.col("bucket") == F.col("_b")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(F.lit(0)).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("ahead") - F.col("before")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return d.select("row", "size", "source_size", "target", (epochs * F.col("size") + cut).cast("long").alias("taken"))


def mix(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """Every row of docs without its text, with size, source_size, target and taken, the words that the mix takes.

    A null text has no words; a null source is one source. Whole texts are counted. taken is the size times the whole
    epochs, plus what the last, cut epoch takes: all words of the documents before the cut, none after it, and so many
    first words of the document at the cut that the source gives its target, rounded to whole words. Rows are taken one
    by one, those of null and shared ids too; of equal rows it doesn't matter which. An empty table gives an empty
    result. Columns named like a result column are replaced, all others carried along.
    """
    rest = [c for c in docs.columns if c != text and c.lower() not in _OWN]
    sized = materialise(few(_measured(docs, rest, p, text), docs), "sizes")
    return _taken(sized, sized, p).select(*(F.col("row")[c].alias(c) for c in rest), *_OWN)


def emit(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """The mix itself: the rows of docs that it takes, once an epoch, with the columns epoch (from 0) and words (taken in
    that epoch). The document at a source's cut has its first words only, joined by blanks. Each row is taken as mix()
    says of it. Columns named epoch and words are replaced, all others carried along."""
    rest = [c for c in docs.columns if c.lower() not in ("epoch", "words")]
    sized = materialise(few(_measured(docs, [], p, text).drop("row"), docs), "sizes")
    d = _taken(_measured(docs, rest, p, text), sized, p).filter("taken > 0")
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int"))))
    here = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size")).cast("int")
    whole = F.col("row")[text]
    said = F.when(here == F.col("size"), whole).otherwise(F.array_join(F.slice(words(whole), 1, here), " "))
    return few(d, docs).select(*((said if c == text else F.col("row")[c]).alias(c) for c in rest), "epoch", here.cast("long").alias("words"))
