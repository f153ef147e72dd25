"""The decision tree as relations: groups, order, term resolution, hits, short circuit and suppression.

copies    a message as one dataset and folder has it; rows of a view go to each copy of their message
members   a row for each copy and feature row, in a fixed order (seq)
groups    members of a copy and feature_id; category 0 noise reduction, 1 disclaimer, 2 other; ord the order of evaluation
raw       matches of expressions in areas

Everything is joined, grouped and windowed by the copy (or by more columns, that one first), so that tables laid out by it
are never shuffled again. Joins are by the copy alone; what else has to be equal is looked up in arrays of one copy's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank, within_size
from tidemark.operators.definitions import has_scope, with_definition

AREAS = {"SUBJECT": "subject", "MESSAGE_BODY": "message body", "ATTACHMENT": "attachment"}


def copies(messages: DataFrame, attachment_limit: int | None = None) -> DataFrame:
    """(copy, message_id, dataset_id, restricted, n_rows, areas): a message of two datasets, or of both folders of one, is two
    copies; rows that are equal in these and in all texts are one copy, with their number. areas are the texts that can
    match, struct(area, area_ord, attachment_id, text). The name of a copy tells what is in it, so that a task that is run
    again gives the same names."""
    d = messages.select("message_id", "dataset_id", "restricted", _areas(attachment_limit).alias("areas"))
    said = F.transform("areas", lambda a: a.withField("text", F.sha2(a["text"], 256)))
    name = F.substring(F.sha2(F.to_json(F.struct("message_id", "dataset_id", "restricted", said.alias("areas")), {"ignoreNullFields": "false"}), 256), 1, 40)
    d = d.groupBy(name.alias("copy")).agg(F.first(F.struct(*d.columns)).alias("d"), F.count(F.lit(1)).alias("n_rows"))
    return d.select("copy", "d.message_id", "d.dataset_id", "d.restricted", "n_rows", "d.areas")


def joined(d: DataFrame, other: DataFrame, how: str = "inner", wide: bool = False) -> DataFrame:
    """d and another table laid out by copy, with one row for each of many copies, so that it is never broadcast, however
    small its files make it look. Bucket by bucket it is hashed; if it is wide, both are sorted and merged."""
    return d.join(other.hint("merge" if wide else "shuffle_hash"), "copy", how)


def members(view: DataFrame, key: str = "message_id") -> DataFrame:
    """View rows with their definitions, is_nr and seq. Rows of a message are ordered by feature_id, features_to_apply,
    sub_feature_type and then the other columns; equal rows stay apart (they count as members) but share same_as, the
    seq of the first of them, under which they are scanned and counted once."""
    d = with_definition(view)
    by = ["feature_id", "features_to_apply", "sub_feature_type", "feature_type", "is_noise_reduction", "operator", "feature_name", "feature_definition"]
    order = Window.partitionBy(key).orderBy(*by, *[c for c in view.columns if c not in (*by, key, "message_id")])
    # rows that are equal in all columns have the rank of the first of them
    return d.withColumns({"seq": F.row_number().over(order), "same_as": F.rank().over(order), "is_nr": F.coalesce(F.col("is_noise_reduction") == "Y", F.lit(False))})


def grouped(m: DataFrame, key: str = "message_id") -> DataFrame:
    """A row for each (key, feature_id): type, is_nr, operator, feature_name, n_members, first_seq, total_terms, members
    (struct(seq, features_to_apply, sub_feature_type), equal rows once), group_error, category and ord. Members must agree
    on type and noise flag, and several members on an operator, which must be there."""
    said = lambda c: F.struct(F.col(c).isNull(), F.coalesce(c, F.lit("")))
    differs = lambda c: F.min(said(c)) != F.max(said(c))
    first = F.col("seq") == F.col("same_as")
    g = m.groupBy(key, "feature_id").agg(
        *([F.min("message_id").alias("message_id")] if key != "message_id" else []),
        F.count(F.lit(1)).alias("n_members"),
        F.min("seq").alias("first_seq"),
        *(F.min_by(c, "seq").alias(c) for c in ("feature_type", "is_nr", "operator", "feature_name")),
        F.sum(F.when(first, F.col("total_terms"))).alias("total_terms"),
        F.sort_array(F.collect_list(F.when(first, F.struct("seq", "features_to_apply", "sub_feature_type")))).alias("members"),
        differs("feature_type").alias("_t"), differs("is_noise_reduction").alias("_n"), differs("operator").alias("_o"),
    )
    several = F.col("n_members") > 1
    error = (
        F.when(F.col("_t"), F.lit("feature_type differs within the group"))
        .when(F.col("_n"), F.lit("is_noise_reduction differs within the group"))
        .when(several & F.col("_o"), F.lit("operator differs within the group"))
        .when(several & is_blank(F.col("operator")), F.lit("several members without an operator"))
        .when(several & ~F.upper("operator").isin("AND", "OR"), F.lit("unknown operator"))
    )
    category = F.when(F.col("is_nr"), 0).when(F.lower("feature_type") == "disclaimer", 1).otherwise(2)
    g = g.withColumns({"group_error": error, "category": category}).drop("_t", "_n", "_o")
    return g.withColumn("ord", F.row_number().over(Window.partitionBy(key).orderBy("category", "first_seq")))


def _areas(attachment_limit: int | None) -> Column:
    """Of a message, struct(area, area_ord, attachment_id, text) of every text that can match: subject, raw body, attachments, in
    this order. Blank texts and attachments above the limit (bytes of UTF-8) are left out."""
    c = F.col("message.content")
    one = lambda name, o, att, text: F.struct(F.lit(name).alias("area"), o.alias("area_ord"), att.cast("string").alias("attachment_id"), text.alias("text"))
    attached = F.transform(
        "attachments",
        lambda a, i: one("ATTACHMENT", (i + 2).cast("int"), a["metadata"]["attachment_id"], a["content"]["clean_text"]),
    )
    own = F.array(one("SUBJECT", F.lit(0), F.lit(None), c["subject"]), one("MESSAGE_BODY", F.lit(1), F.lit(None), c["raw_text"]))
    every = F.when(F.col("attachments").isNull(), own).otherwise(F.concat(own, attached))
    return F.filter(every, lambda a: ~is_blank(a["text"]) & ((a["area"] != "ATTACHMENT") | within_size(a["text"], attachment_limit)))


def areas(messages: DataFrame, attachment_limit: int | None = None) -> DataFrame:
    """(message_id, area, area_ord, attachment_id, text) of every text that can match."""
    return messages.select("message_id", F.explode(_areas(attachment_limit)).alias("a")).select("message_id", "a.*")


def in_scope(scope: Column, area: Column) -> Column:
    e = F.lit(False)
    for name, said in AREAS.items():
        e = e | ((area == name) & has_scope(scope, said))
    return e


def asking(m: DataFrame) -> DataFrame:
    """(copy, message_id, process_id, own): a row a copy, with what its members ask for, equal ones once: struct(seq, feature_id,
    feature, is_nr, scopes). The process is that of the first member."""
    scopes = F.struct(*(has_scope(F.col("scope"), s).alias(a) for a, s in AREAS.items()))
    own = F.sort_array(F.collect_list(F.struct("seq", "feature_id", "feature", "is_nr", scopes.alias("scopes"))))
    return m.filter("seq = same_as").groupBy("copy").agg(F.min("message_id").alias("message_id"), F.min_by("process_id", "seq").alias("process_id"), own.alias("own"))


def of_kind(own: DataFrame, noise: bool) -> DataFrame:
    """Copies with members that are noise reduction, or aren't, with these alone."""
    return own.withColumn("own", F.filter("own", lambda x: x["is_nr"] == F.lit(noise))).filter(F.size("own") > 0)


def requests(own: DataFrame) -> DataFrame:
    """(copy, wants): by area, the distinct pattern sets that some member asks for there."""
    said = lambda a: F.array_sort(F.array_distinct(F.array_compact(F.transform(F.filter("own", lambda x: x["scopes"][a]), lambda x: x["feature"])))).alias(a)
    return own.select("copy", F.struct(*map(said, AREAS)).alias("wants"))


def asked(copies: DataFrame, wants: DataFrame, candidates: DataFrame) -> DataFrame:
    """The texts to scan: (copy, area, area_ord, attachment_id, text, features, candidates). A text travels once, for all of
    its pattern sets; the tables are laid out by copy."""
    d = copies.select("copy", "areas").join(wants.hint("shuffle_hash"), "copy").join(candidates.hint("shuffle_hash"), "copy", "left")
    d = d.select("copy", "wants", F.col("candidates").alias("_c"), F.explode("areas").alias("a")).select("copy", "a.*", "wants", "_c")
    pick = F.coalesce(*(F.when(F.col("area") == a, F.col("wants")[a]) for a in AREAS))
    own = F.transform(F.filter(F.coalesce("_c", F.array().cast("array<struct<area_ord:int,expression:int>>")), lambda x: x["area_ord"] == F.col("area_ord")), lambda x: x["expression"])
    return d.withColumns({"features": pick, "candidates": own}).drop("wants", "_c").filter(F.size("features") > 0)


def member_matches(own: DataFrame, raw: DataFrame) -> DataFrame:
    """Raw matches of every member (copy, seq, feature_id), within its scope; equal members once."""
    d = joined(raw.filter("scan_error is null").drop("scan_error"), own.select("copy", "message_id", "own"), wide=True)
    there = lambda x: F.coalesce(*(F.when(F.col("area") == a, x["scopes"][a]) for a in AREAS))
    d = d.withColumn("x", F.explode(F.filter("own", lambda x: (x["feature"] == F.col("feature")) & there(x)))).drop("own")
    return d.select("copy", "message_id", "x.seq", "x.feature_id", *(c for c in raw.columns if c not in ("copy", "scan_error")))


def term_matches(matches: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of resolved terms: (copy, message_id, seq, feature_id, feature, term_number, term_id, pattern, req_pos, area,
    area_ord, attachment_id, start, end, text).

    A term is resolved for a member if all its required expressions matched somewhere in the member's scope, and not
    all of its excluded ones, if it has any. Its occurrences are those of the required expressions. Expressions that no
    term has are left out. The display pattern falls back on the first required expression's text."""
    t = terms.filter("error is null").select("feature", "term_number", "term_id", "pattern", F.size("required").alias("n_req"), F.size("excluded").alias("n_exc"), "required", "excluded")
    part = lambda c, no: t.select("feature", "term_number", "term_id", "pattern", "n_req", "n_exc", F.posexplode(c).alias("req_pos", "expression_id"), F.lit(no).alias("no"))
    d = matches.join(part("required", False).unionByName(part("excluded", True)), ["feature", "expression_id"])
    own = Window.partitionBy("copy", "seq", "feature", "term_number")
    seen = lambda no: F.size(F.collect_set(F.when(F.col("no") == no, F.col("expression_id"))).over(own))
    d = d.withColumns({"_r": seen(False), "_e": seen(True)}).filter((~F.col("no")) & (F.col("_r") == F.col("n_req")) & ((F.col("n_exc") == 0) | (F.col("_e") < F.col("n_exc"))))
    shown = F.when(F.col("pattern") != "", F.col("pattern")).otherwise(F.col("text")).alias("pattern")
    return d.select("copy", "message_id", "seq", "feature_id", "feature", "term_number", "term_id", shown, "req_pos", "area", "area_ord", "attachment_id", "start", "end", "text")


def group_hits(groups: DataFrame, found: DataFrame) -> DataFrame:
    """groups with hit, and their members with it. One member decides alone; else the operator does."""
    hits = found.groupBy("copy").agg(F.collect_set("seq").alias("_seqs"))
    g = joined(groups, hits, "left")
    told = F.transform("members", lambda x: x.withField("hit", F.coalesce(F.array_contains(F.col("_seqs"), x["seq"]), F.lit(False))))
    g = g.withColumn("members", told).drop("_seqs")
    any_, all_ = F.exists("members", lambda x: x["hit"]), F.forall("members", lambda x: x["hit"])
    return g.withColumn("hit", F.when(F.col("n_members") == 1, any_).when(F.upper("operator") == "AND", all_).otherwise(any_))


def evaluated(groups: DataFrame) -> DataFrame:
    """The groups up to the first noise reduction group that is hit, that one included; with short_circuited."""
    stop = F.min(F.when(F.col("is_nr") & F.col("hit"), F.col("ord"))).over(Window.partitionBy("copy"))
    d = groups.withColumn("_stop", stop).withColumn("short_circuited", F.col("_stop").isNotNull())
    return d.filter(F.col("_stop").isNull() | (F.col("ord") <= F.col("_stop"))).drop("_stop")


def with_contained(occurrences: DataFrame, is_disclaimer: Column) -> DataFrame:
    """The occurrences that aren't a disclaimer's, with contained: whether one of a disclaimer contains it, in the same copy,
    area and attachment. In order of starts, the furthest end of the disclaimers so far tells; no pairs are made."""
    d = occurrences.withColumn("_d", is_disclaimer)
    order = Window.partitionBy("copy", "area", "attachment_id").orderBy("start", F.desc("_d")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    far = F.max(F.when(F.col("_d"), F.col("end"))).over(order)
    return d.withColumn("contained", F.coalesce(far >= F.col("end"), F.lit(False))).filter("not _d").drop("_d")
