"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the columns
of docs; the last returns the mix: a row for each document and epoch that it takes, with the words taken.

In every stage a row is judged by its own text, whatever its id: null and shared ids and repeated rows lose nothing but
copies in near_duplicates. Null and empty texts are texts without words. Whole texts count, however long. Empty tables
give empty ones. Extra columns are carried along, whatever their names, but for epoch and words in the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, ngram_join, pii, quality_crf
from tidemark.llm.common import WORD_RE, few, forget, read, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts. Texts without words have the classifier's prior as their score, the
    same for all; so have all texts if nothing is labelled. Repeated rows fare alike."""
    return quality_crf.filtered(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that of the smallest id, a null id last; of several texts of that id, the one of
    the least hash; of several rows of that text, the one whose JSON has the least hash, so that columns may be of any
    type. Texts without words are no copies of each other: all of them stay."""
    cols = docs.columns
    j = ngram_join.join(docs).filter("component is not null")
    keep = j.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k")).select("k.doc_id", "k.text_hash")
    keep = keep.withColumnsRenamed({"doc_id": "kept_id", "text_hash": "kept_hash"})
    row = F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row")
    some = F.coalesce(F.col("text").rlike(WORD_RE), F.lit(False))
    said = docs.filter(some).select(row, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    said = said.join(keep, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    least = F.sha2(F.to_json("row", {"ignoreNullFields": "false"}), 256)
    first = said.groupBy("id", "hash").agg(F.min_by("row", least).alias("row")).select("row.*")
    return few(first.unionByName(docs.filter(~some)), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Repeated rows fare alike; null and empty texts have none."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised or removed from their texts; null texts stay null."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes; a null source is a source. Rows are taken one by one; of equal rows it doesn't
    matter which. Texts without words are never taken."""
    return mixing.emit(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: The classifier is learnt and links are transitive, which SQL can't express; tests/llm compares the stages with
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's table goes when the next one has been written; the last one stays."""
    docs = read(spark, sf_dir, "documents")
    where = f"{shared_dir(spark)}/tidemark/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{k}")
        docs = spark.read.parquet(f"{where}/{k}")
        if k:
            forget(spark, f"{where}/{k - 1}")
    return docs
