"""Feature definitions and term metadata: JSON columns as typed, checked columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import is_blank


def with_definition(view: DataFrame) -> DataFrame:
    """view with feature (the pattern set's name), total_terms, scope (lower case; null: none) and definition_error.

    A blank or malformed definition and one without body.feature are errors; unknown keys are ignored. minimumHits is
    read by no one: any match is a hit."""
    d = F.from_json("feature_definition", schemas.DEFINITION)
    out = view.withColumn("_d", d)
    feature = F.col("_d.body.feature")
    return out.withColumns(
        {
            "feature": feature,
            "total_terms": F.coalesce(F.col("_d.body.totalTermsCount"), F.lit(0)).cast("long"),
            "scope": F.transform(F.col("_d.body.scope"), F.lower),
            "definition_error": F.when(is_blank(feature), F.lit("feature_definition is blank, malformed or without body.feature")),
        }
    ).drop("_d")


def has_scope(scope: Column, name: str) -> Column:
    """Whether a scope array names an area, in any case; null has none."""
    return F.coalesce(F.exists(scope, lambda s: F.lower(s) == name.lower()), F.lit(False))


def check_definitions(view: DataFrame) -> None:
    """Raise if any row's definition can't be read: the job fails as a whole, before anything is scanned."""
    bad = with_definition(view).filter("definition_error is not null").select("feature_id").limit(1).collect()
    if bad:
        raise ValueError(f"feature {bad[0][0]}: feature_definition is blank, malformed or without body.feature")


def terms(metadata: DataFrame) -> DataFrame:
    """(feature, term_number, term_id, pattern, required, excluded, error) of compile results (feature, json), for terms
    whose status is PASS.

    term_number follows the last '::'; required is requiredExpressionIds or else the term's one expression; pattern joins
    the translated patterns by ' & '. Malformed JSON, a term number or required ids that can't be had, and an expression
    that two terms of a feature claim are errors of the feature: a row whose error says which."""
    m = metadata.withColumn("_j", F.from_json("json", schemas.TERMS))
    unread = m.filter(is_blank(F.col("json")) | F.col("_j").isNull() | (F.col("_j.results").isNull() & ~F.col("json").rlike(r'^\s*\{\s*(".*)?\}\s*$')))
    t = m.select("feature", F.explode("_j.results").alias("r")).filter(F.upper("r.compilationStatus") == "PASS")
    ids = F.coalesce(F.col("r.requiredExpressionIds"), F.array().cast("array<int>"))
    t = t.select(
        "feature",
        F.when(F.col("r.termId").contains("::"), F.substring_index("r.termId", "::", -1).try_cast("int")).alias("term_number"),
        F.array_join("r.translatedPattern", " & ").alias("pattern"),
        F.when(F.size(ids) > 0, ids).when(F.col("r.hyperscanExpressionId").isNotNull(), F.array("r.hyperscanExpressionId")).alias("required"),
        F.coalesce("r.excludedExpressionIds", F.array().cast("array<int>")).alias("excluded"),
    )
    t = t.withColumn("term_id", term_id("feature", "term_number")).withColumn(
        "error", F.when(F.col("term_number").isNull(), F.lit("termId has no number")).when(F.col("required").isNull(), F.lit("term has no expression"))
    )
    claims = t.select("feature", "term_number", F.explode(F.array_distinct(F.concat("required", "excluded"))).alias("id"))
    twice = claims.groupBy("feature", "id").agg(F.count_distinct("term_number").alias("n")).filter("n > 1").groupBy("feature").agg(F.min("id").alias("id"))
    clash = twice.select("feature", F.concat(F.lit("two terms claim expression "), F.col("id")).alias("error"))
    broken = unread.select("feature", F.lit("term metadata can't be read").alias("error")).unionByName(clash)
    return t.select("feature", "term_number", "term_id", "pattern", "required", "excluded", "error").unionByName(broken, allowMissingColumns=True)


def term_id(feature: str | Column, number: str | Column) -> Column:
    """feature::number; null where either is missing or the feature is blank."""
    f = F.col(feature) if isinstance(feature, str) else feature
    n = F.col(number) if isinstance(number, str) else number
    return F.when(~is_blank(f), F.concat(f, F.lit("::"), n.cast("string")))


def term_counts(t: DataFrame) -> DataFrame:
    """(feature, term_count): a feature's different terms."""
    return t.filter("error is null").groupBy("feature").agg(F.count_distinct("term_number").alias("term_count"))
