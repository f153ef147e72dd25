"""Messages, the decision view and the lexicon as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import Expression, check_expression
from tidemark.operators.definitions import terms, with_definition
from tidemark.sources import avro, paths
from tidemark.store import materialise


class NoMessagesFound(Exception):
    """Neither of a dataset's folders is there."""


def tagged(d: DataFrame, dataset_id: str, restricted: bool) -> DataFrame:
    return d.withColumns({"dataset_id": F.lit(dataset_id), "restricted": F.lit(restricted)})


def tolerant(d: DataFrame) -> DataFrame:
    """d with all columns and fields of a message; those that the files lack are null, others are left out."""
    have = {f.name: f.dataType for f in d.schema}

    def pick(col, want, got):
        if got is None:
            return F.lit(None).cast(want)
        if hasattr(want, "fields"):
            inner = {f.name: f.dataType for f in getattr(got, "fields", [])}
            made = F.struct(*(pick(col[f.name] if f.name in inner else None, f.dataType, inner.get(f.name)).alias(f.name) for f in want.fields))
            return F.when(col.isNotNull(), made)
        if hasattr(want, "elementType") and hasattr(want.elementType, "fields"):
            return F.transform(col, lambda x: pick(x, want.elementType, got.elementType))
        return col.cast(want)

    extra = [c for c in ("dataset_id", "restricted") if c in have]
    return d.select(*(pick(F.col(f.name) if f.name in have else None, f.dataType, have.get(f.name)).alias(f.name) for f in schemas.MESSAGE), *extra)


#: Ids of so many rows are sent to all tasks as they are; of more, a filter is.
FEW_IDS = 100_000
#: The filter's blocks of 2**20 bits: 128 KB each, so that it never has more than 64 MB.
MOST_BLOCKS = 512
_BITS, _HASHES = 1 << 20, 7


def id_filter(ids: DataFrame, n: int) -> DataFrame:
    """(block, bits): a Bloom filter of ids (message_id), some ten bits an id, in blocks that are looked up by a join. With more
    ids than MOST_BLOCKS are good for it lets more of the others pass, but never grows."""
    spark = ids.sparkSession
    blocks = max(1, min(MOST_BLOCKS, -(-10 * n // _BITS)))
    own = ids.select(F.pmod(F.xxhash64("message_id"), F.lit(blocks)).alias("block"), F.explode(_places()).alias("p"))
    own = own.select("block", F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("w"))
    words = _BITS // 64
    blank = spark.range(blocks * words).select((F.col("id") / words).cast("int").cast("bigint").alias("block"), (F.col("id") % words).cast("int").alias("word"), F.lit(0).cast("bigint").alias("w"))
    d = own.unionByName(blank).groupBy("block", "word").agg(F.bit_or("w").alias("w"))
    d = d.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "w"))), lambda x: x["w"]).alias("bits"))
    return d.withColumn("blocks", F.lit(blocks))


def _places() -> Column:
    """The bits of message_id within its block."""
    return F.array(*(F.pmod(F.xxhash64("message_id", F.lit(k)), F.lit(_BITS)).cast("int") for k in range(_HASHES)))


def passing(messages: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Messages whose id may be in the filter: no shuffle, right behind the scan."""
    b = F.broadcast(bloom.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    set_ = F.forall(_places(), lambda p: F.get(F.col("_bits"), F.shiftright(p, 6)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), p.bitwiseAND(63))) != 0)
    return messages.join(b, (F.pmod(F.xxhash64("message_id"), F.lit(blocks)) == F.col("_block")) & set_, "left_semi")


def relevant(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """Messages whose id occurs in ids. A few ids are sent to all tasks. Of many, a Bloom filter of bounded size is: what it
    lets through of the others (one in a hundred) is all that is shuffled in vain for the exact join."""
    ids = ids.select("message_id").distinct()
    n = ids.count()
    if n <= FEW_IDS:
        return messages.join(F.broadcast(ids), "message_id", "left_semi")
    bloom = materialise(id_filter(ids, n), "id-filter")
    return passing(messages, bloom, bloom.first().blocks).join(ids, "message_id", "left_semi")


def read_dataset(spark: SparkSession, root: str, dataset_id: str, partition: str, ids: DataFrame | None = None, fmt: str = "parquet") -> DataFrame:
    """A dataset's restricted and unrestricted messages, <root>/<dataset>/<partition>/{restricted,unrestricted}. Either
    folder may be missing; both missing is NoMessagesFound. fmt may be avro."""
    found = []
    for name, restricted in (("restricted", True), ("unrestricted", False)):
        path = f"{root.rstrip('/')}/{dataset_id}/{partition}/{name}"
        if paths.exists(spark, path):
            d = avro.read(spark, path, schemas.MESSAGE) if fmt == "avro" else tolerant(spark.read.format(fmt).load(path))
            found.append(tagged(d, dataset_id, restricted))
    if not found:
        raise NoMessagesFound(f"{root}/{dataset_id}/{partition}")
    d = reduce(DataFrame.unionByName, found)
    return d if ids is None else relevant(d, ids)


def union_messages(parts: list[DataFrame]) -> DataFrame:
    """All datasets' messages; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def view_rows(view: DataFrame, dataset_partition: str, feature_partition: str, process_id: str) -> DataFrame:
    """The view's rows of a run, all of its columns by name: a missing one is an error. The filter reaches the source."""
    keep = (F.col("dataset_partition") == dataset_partition) & (F.col("feature_partition_value") == feature_partition) & (F.col("process_id") == process_id)
    return view.filter(keep).select(*schemas.VIEW_COLUMNS)


def union_views(parts: list[DataFrame]) -> DataFrame:
    """Rows of all datasets' views, columns by name, all of them in each. Nothing to unite is an error."""
    if not parts:
        raise ValueError("no dataset to read a view for")
    return reduce(DataFrame.unionByName, parts)


def one_row_a_message(view: DataFrame) -> DataFrame:
    """(message_id, features): all view rows of a message, in a fixed order."""
    rest = [c for c in view.columns if c != "message_id"]
    return view.groupBy("message_id").agg(F.array_sort(F.collect_list(F.struct("feature_id", *[c for c in rest if c != "feature_id"]))).alias("features"))


def expressions(lexicon: DataFrame, features: list[str] | None = None, limit: int = 1_000_000) -> list[Expression]:
    """The lexicon's expressions (feature, expression_id, pattern, flags, kind), on the driver. A lexicon is written by
    people; one of more than `limit` expressions is an error."""
    d = lexicon.select("feature", "expression_id", "pattern", "flags", "kind").distinct()
    d = d if features is None else d.filter(F.col("feature").isin(features))
    rows = d.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the lexicon has more than {limit} expressions")
    return sorted((Expression(r.feature, r.expression_id, r.pattern, r.flags or "", r.kind or "plain") for r in rows), key=lambda e: (e.feature, e.expression_id))


def features_of(view: DataFrame) -> list[str]:
    """The pattern sets that a view's definitions name, in order: a lexicon's worth, written by people."""
    rows = with_definition(view.select("feature_definition").distinct()).filter("feature is not null").select("feature").distinct().collect()
    return sorted(r.feature for r in rows)


def _files(spark: SparkSession, base: str, names: dict[str, str]) -> DataFrame:
    """(feature, json) for names feature -> path; json is null where there is no file. One listing."""
    there = {p.rsplit("/", 1)[-1] for p in paths.list_objects(spark, base)}
    have = {f: p for f, p in names.items() if p.rsplit("/", 1)[-1] in there}
    every = spark.createDataFrame([(f, p.rsplit("/", 1)[-1]) for f, p in names.items()], "feature string, file string")
    if not have:
        return every.select("feature", F.lit(None).cast("string").alias("json"))
    read = spark.read.text([paths.literal(p) for p in have.values()], wholetext=True).select(paths.file_name(F.col("_metadata.file_path")).alias("_file"), F.col("value").alias("json"))
    return every.join(read, F.col("file") == F.col("_file"), "left").select("feature", "json")


def checked(expressions: list[Expression]) -> tuple[list[Expression], list[tuple[str, str]]]:
    """The expressions that can be matched in bounded time, and (feature, error) of the others."""
    bad = [(e, check_expression(e)) for e in expressions]
    return [e for e, err in bad if err is None], [(e.feature, err) for e, err in bad if err is not None]


def load_lexicon(spark: SparkSession, base: str, limit: int = 1_000_000) -> Callable[[list[str]], tuple[DataFrame, list[Expression]]]:
    """A function of the wanted features: their terms, errors included, and their expressions, from the files of a lexicon
    folder. What can't be read is an error of the feature, not of the job."""

    def load(features: list[str]) -> tuple[DataFrame, list[Expression]]:
        t = terms(_files(spark, base, {f: paths.terms_path(base, f) for f in features}))
        raw = _files(spark, base, {f: paths.expressions_path(base, f) for f in features})
        got = raw.select("feature", F.from_json("json", schemas.EXPRESSIONS)["expressions"].alias("e")).collect()  # the wanted features' own
        found = [Expression(r.feature, e.id, e.pattern, e.flags or "", e.kind or "plain") for r in got for e in r.e or () if e.id is not None and e.pattern]
        if len(found) > limit:
            raise ValueError(f"the lexicon has more than {limit} expressions")
        good, bad = checked(sorted(found, key=lambda e: (e.feature, e.expression_id)))
        bad += [(r.feature, "expressions can't be read") for r in got if r.e is None]
        return with_errors(t, bad), good

    return load


def with_errors(t: DataFrame, errors: list[tuple[str, str]]) -> DataFrame:
    """Terms, and a row for each (feature, error)."""
    if not errors:
        return t
    return t.unionByName(t.sparkSession.createDataFrame(errors, "feature string, error string"), allowMissingColumns=True)


def lexicon_of(t: DataFrame, lexicon: DataFrame) -> Callable[[list[str]], tuple[DataFrame, list[Expression]]]:
    """The same from tables: terms, and (feature, expression_id, pattern, flags, kind)."""

    def load(features: list[str]) -> tuple[DataFrame, list[Expression]]:
        good, bad = checked(expressions(lexicon, features))
        return with_errors(t.filter(F.col("feature").isin(features)), bad), good

    return load
