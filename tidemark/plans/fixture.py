"""The test tables as messages, a decision view and a lexicon."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import Expression
from tidemark.operators.definitions import terms as parse_terms
from tidemark.schemas import VIEW_COLUMNS

ALL = ["Message Body", "Subject", "Attachment"]
#: feature_id, feature_type, noise flag, operator, name, and its members (sub type, pattern set, terms in all, scope).
FEATURES = [
    ("1", "NoiseReduction", "Y", None, "Rights", [("Lexicon", "nr_rights", 1, ALL)]),
    ("2", "Disclaimer", "N", None, "MIT", [("Lexicon", "disc_mit", 1, ALL)]),
    ("3", "Lexicon", "N", None, "License", [("Lexicon", "lex_license", 3, ["message body", "ATTACHMENT"])]),
    ("4", "Lexicon", "N", "AND", "Token", [("Lexicon", "lex_token", 2, ALL), ("Lexicon", "lex_with", 1, ["Message Body"])]),
    ("5", "Lexicon", "N", "or", "Words", [("Lexicon", "lex_apache", 1, ["Message Body"]), ("Lexicon", "lex_clown", 1, ALL)]),
]
#: pattern set, expression, pattern.
EXPRESSIONS = [
    ("nr_rights", 1, r"all rights reserved"),
    ("disc_mit", 1, r"released under the mit license\."),
    ("lex_license", 1, r"license"),
    ("lex_token", 10, r"token"),
    ("lex_token", 11, r"license"),
    ("lex_with", 1, r"with"),
    ("lex_apache", 1, r"apache license"),
    ("lex_clown", 1, r"clown"),
]
#: pattern set, term, required expressions, excluded ones, shown pattern.
TERMS = [
    ("nr_rights", 1, [1], [], ["all rights reserved"]),
    ("disc_mit", 1, [1], [], ["mit", "license"]),
    ("lex_license", 1, [1], [], []),
    ("lex_token", 3, [10], [11], ["token"]),
    ("lex_with", 1, [1], [], ["with"]),
    ("lex_apache", 1, [1], [], ["apache license"]),
    ("lex_clown", 1, [1], [], ["clown"]),
]


def definition(feature: str, total: int, scope: list[str]) -> str:
    return json.dumps({"featureName": feature, "featureType": "Lexicon", "isNoiseReduction": False, "extra": 1, "body": {"feature": feature, "totalTermsCount": total, "minimumHits": 3, "scope": scope}})


def expressions() -> list[Expression]:
    return [Expression(f, i, p) for f, i, p in EXPRESSIONS]


def lexicon_files() -> dict[str, str]:
    """The lexicon as the files of its folder: name and text."""
    out = {f"{f}-compile-results.json": text for f, text in _metadata()}
    by: dict[str, list] = {}
    for f, i, p in EXPRESSIONS:
        by.setdefault(f, []).append({"id": i, "pattern": p, "flags": "i"})
    return out | {f"{f}-expressions.json": json.dumps({"expressions": e}) for f, e in by.items()} | {"unused-expressions.json": json.dumps({"expressions": [{"id": 1, "pattern": "("}]})}


def metadata(spark: SparkSession) -> DataFrame:
    """Compile results (feature, json)."""
    return spark.createDataFrame(_metadata(), "feature string, json string")


def _metadata() -> list[tuple[str, str]]:
    by: dict[str, list] = {}
    for f, n, req, exc, shown in TERMS:
        by.setdefault(f, []).append({"termId": f"{f}::{n}", "compilationStatus": "pass", "translatedPattern": shown, "requiresExclusionCheck": bool(exc), "hyperscanExpressionId": req[0], "requiredExpressionIds": req if exc else [], "excludedExpressionIds": exc})
    by["lex_license"].append({"termId": "lex_license::2", "compilationStatus": "FAILED", "translatedPattern": ["x"], "hyperscanExpressionId": 2})
    return [(f, json.dumps({"results": r})) for f, r in by.items()]


def terms(spark: SparkSession) -> DataFrame:
    return parse_terms(metadata(spark))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_ATT = "array<struct<metadata:struct<attachment_id:string,parent_attachment_id:string,file_name:string>,content:struct<clean_text:string>>>"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents: subject and body; conversations: the first turn as body, later ones as attachments."""
    none = F.lit(None).cast("string")
    content = lambda raw, subject: F.struct(F.struct(none.alias("header"), raw.alias("raw_text"), subject.alias("subject"), none.alias("clean_text")).alias("content"))
    d = _read(spark, sf_dir, "documents")
    docs = d.select(
        F.concat(F.lit("d"), "doc_id").alias("message_id"), content(F.col("text"), F.substring_index("text", "\n", 1)).alias("message"), F.array().cast(_ATT).alias("attachments"),
        F.lit("docs").alias("dataset_id"), (F.col("doc_id") % 2 == 0).alias("restricted"), F.col("lang").alias("channel"),
    )
    c = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    att = F.transform(F.filter("t", lambda x: x["turn"] > 0), lambda x: F.struct(F.struct(F.concat_ws("-", F.concat(F.lit("c"), F.col("conv_id")), x["turn"]).alias("attachment_id"), none.alias("parent_attachment_id"), none.alias("file_name")).alias("metadata"), F.struct(x["text"].alias("clean_text")).alias("content")))
    body = F.get(F.filter("t", lambda x: x["turn"] == 0), F.lit(0))["text"]
    conv = c.select(F.concat(F.lit("c"), "conv_id").alias("message_id"), content(body, none).alias("message"), att.cast(_ATT).alias("attachments"), F.lit("conv").alias("dataset_id"), (F.col("conv_id") % 2 == 0).alias("restricted"))
    return docs.unionByName(conv, allowMissingColumns=True)


def view(spark: SparkSession, sf_dir: str, kind: str = "all") -> DataFrame:
    """Each message with all members. Every tenth document belongs to another process; some have a group of several
    members that lost its operator."""
    d = _read(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("message_id"), F.col("doc_id").alias("n"), F.lit("docs").alias("set"))
    c = _read(spark, sf_dir, "conversations").select("conv_id").distinct().select(F.concat(F.lit("c"), "conv_id").alias("message_id"), F.col("conv_id").alias("n"), F.lit("conv").alias("set"))
    base = d if kind == "docs" else c if kind == "conv" else d.unionByName(c)
    rows = []
    for fid, ftype, nr, op, name, members in FEATURES:
        for sub, feature, total, scope in members:
            lost = F.when((F.col("set") == "docs") & (F.col("n") % 97 == 5), F.lit(None)).otherwise(F.lit(op)) if fid == "5" else F.lit(op)
            rows.append(F.struct(F.lit(ftype).alias("feature_type"), F.lit(fid).alias("feature_id"), F.lit(name).alias("feature_name"), F.lit(sub).alias("sub_feature_type"), F.lit(feature).alias("features_to_apply"), F.lit(nr).alias("is_noise_reduction"), lost.cast("string").alias("operator"), F.lit(definition(feature, total, scope)).alias("feature_definition")))
    other = (F.col("set") == "docs") & (F.col("n") % 10 == 9)
    e = base.select("message_id", F.when(other, "proc-2").otherwise("proc-1").alias("process_id"), F.concat_ws("-", F.lit("part"), "set").alias("dataset_partition"), F.explode(F.array(*rows)).alias("f"))
    return e.select("*", "f.*").withColumns({"feature_tagging_type": F.lit("tag"), "feature_partition_value": F.lit("2026-08-16"), "policy_engine_id": F.lit("101")}).select(*VIEW_COLUMNS)


def copied_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some stand in both folders, in another text; some in a second dataset, as their first line; and some
    twice as the same row."""
    m = messages(spark, sf_dir).filter("dataset_id = 'docs'")
    n = F.substring("message_id", 2, 20).cast("long")
    text = F.col("message.content.raw_text")
    body = lambda x: F.col("message").withField("content.raw_text", x).withField("content.subject", F.lit(None).cast("string"))
    flipped = m.filter(n % 5 == 0).withColumns({"restricted": ~F.col("restricted"), "message": body(F.replace(text, F.lit("license"), F.lit("token")))})
    second = m.filter(n % 7 == 0).withColumns({"dataset_id": F.lit("conv"), "message": body(F.substring_index(text, "\n", 1))})
    return m.unionByName(flipped).unionByName(second).unionByName(m.filter(n % 11 == 0))
