"""The scan from end to end, and its output tables.

messages -> copies; view -> members and groups of each copy -> candidates -> raw matches (noise reduction first; the rest
only for copies that it doesn't stop) -> term occurrences -> hits -> evaluated groups -> tables.

Bodies are shuffled once, when the copies are laid out; everything behind that is laid out by the copy too, and neither
joined, grouped nor windowed by anything that would need another shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas, store
from tidemark.functions.text import Expression, Lexicon, scan
from tidemark.operators import decide
from tidemark.operators.candidates import FEW_LITERALS, candidates, found_directly, index
from tidemark.sources import paths


@dataclass
class Result:
    """messages: copy, message_id, process_id, restricted, dataset_id, n_rows and error; the others, by copy, have no failed
    message."""

    messages: DataFrame
    groups: DataFrame
    found: DataFrame
    raw: DataFrame | None = None

    @classmethod
    def of(cls, messages: DataFrame, groups: DataFrame, found: DataFrame, raw: DataFrame | None = None) -> Result:
        """Of tables laid out by copy; groups of messages that failed, and what was found in them, are left out."""
        good = messages.filter("error is null").select("copy")
        out = cls(messages, decide.joined(groups, good, "left_semi"), decide.joined(found, good, "left_semi"), raw)
        out._tables = {"messages": messages, "groups": groups, "found": found}
        return out

    def keep(self, path: str) -> None:
        """Leave the evaluation to later runs: its tables, and where they are in a file written last."""
        spark = self.messages.sparkSession
        told = {n: {"path": store.keep(d), "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)} for n, d in self._tables.items()}
        paths.write_text(spark, path, json.dumps({"buckets": store.buckets(spark), "tables": told}))

    @classmethod
    def kept(cls, spark: SparkSession, path: str) -> Result | None:
        """What keep() has left, if all of it is there."""
        if not paths.exists(spark, path):
            return None
        told = json.loads(paths.read_text(spark, path))
        if not all(paths.exists(spark, t["path"]) for t in told["tables"].values()):
            return None
        return cls.of(**{n: store.registered(spark, t["path"], t["schema"], "copy", told["buckets"]) for n, t in told["tables"].items()})

    def drop(self, path: str) -> None:
        """Delete what keep() has left: the file first."""
        spark = self.messages.sparkSession
        store.forget(spark, path)
        for d in self._tables.values():
            store.drop_kept(spark, d._tidemark_path)


def evaluate(messages: DataFrame, view: DataFrame, terms: DataFrame, expressions: list[Expression], attachment_limit: int | None = None) -> Result:
    """Everything up to the evaluated groups. Each copy of a message is evaluated by itself."""
    lexicon, laid, joined = Lexicon(expressions), store.layout, decide.joined
    copies = laid(decide.copies(messages, attachment_limit), "copies", "copy")
    ids = copies.select("copy", "message_id")
    members = decide.members(store.deal(view.join(ids, "message_id"), "copy"), "copy")
    # without what nobody reads any more
    m = laid(members.drop("feature_definition", "definition_error", *(c for c in ("feature_tagging_type", "feature_partition_value", "policy_engine_id", "dataset_partition") if c in view.columns)), "members", "copy", dealt=True)
    g = laid(decide.grouped(m, "copy"), "grouped", "copy", dealt=True)
    bad = g.filter("group_error is not null").groupBy("copy").agg(F.min_by("group_error", "ord").alias("error"))
    own = laid(joined(decide.asking(m), bad, "left"), "asking", "copy", dealt=True)
    base = joined(copies.drop("areas"), own.select("copy", "process_id", "error"))
    good = own.filter("error is null")
    texts = copies.select("copy", F.explode("areas").alias("a")).select("copy", "a.area_ord", "a.text")
    few = len(lexicon.literals()) <= FEW_LITERALS
    may = found_directly(texts, lexicon, "copy") if few else candidates(texts, store.materialise(index(texts, lexicon), "index"), "copy")
    may = laid(may, "candidates", "copy", dealt=True)

    def raw(of: DataFrame, name: str) -> DataFrame:
        return laid(scan(decide.asked(copies, decide.requests(of), may), lexicon, "copy"), name, "copy", dealt=True)

    # stage one: noise reduction
    nr = decide.of_kind(good, True)
    raw_nr = raw(nr, "raw-nr")
    found_nr = decide.term_matches(decide.member_matches(nr, raw_nr), terms)
    stopped = laid(decide.group_hits(g.filter("is_nr"), found_nr).filter("hit").select("copy").distinct(), "stopped", "copy", dealt=True)
    # stage two: the others, for copies that go on
    go = joined(decide.of_kind(good, False), stopped, "left_anti")
    raw_more = raw(go, "raw")
    found = laid(found_nr.unionByName(decide.term_matches(decide.member_matches(go, raw_more), terms)), "found", "copy", dealt=True)
    groups = laid(decide.evaluated(decide.group_hits(g, found)), "groups", "copy", dealt=True)
    every = raw_nr.unionByName(raw_more)
    # errors that only a scanned or evaluated group can meet
    bad_scan = every.filter("scan_error is not null").groupBy("copy").agg(F.min_by("scan_error", "area_ord").alias("_scan"))
    bad_terms = terms.filter("error is not null").groupBy("feature").agg(F.min("error").alias("_e"))
    reached = groups.groupBy("copy").agg(F.collect_set(F.coalesce("feature_id", F.lit(""))).alias("_reached"), F.min(F.when(F.col("feature_id").try_cast("bigint").isNull(), F.concat(F.lit("feature_id is no number: "), F.coalesce("feature_id", F.lit("null"))))).alias("_id"))
    sets = own.select("copy", F.transform("own", lambda x: F.struct(F.coalesce(x["feature_id"], F.lit("")).alias("id"), x["feature"].alias("feature"))).alias("_sets"))
    named = joined(reached, sets).select("copy", F.explode(F.array_distinct(F.transform(F.filter("_sets", lambda x: F.array_contains(F.col("_reached"), x["id"])), lambda x: x["feature"]))).alias("feature"))
    bad_lexicon = named.join(bad_terms, "feature").groupBy("copy").agg(F.min(F.concat_ws(": ", "feature", "_e")).alias("_lex"))
    base = joined(joined(joined(base, bad_lexicon, "left"), bad_scan, "left"), reached.select("copy", "_id"), "left")
    base = laid(base.withColumn("error", F.coalesce("error", "_lex", "_scan", "_id")).drop("_lex", "_scan", "_id"), "messages", "copy", dealt=True)
    return Result.of(base, groups, found, every)


def _each(d: DataFrame) -> DataFrame:
    """A row for each of the equal rows that a copy stands for."""
    return d.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows")))).drop("_")


def by_category(r: Result, *categories: int) -> DataFrame:
    """Occurrences in evaluated groups of some categories, with category, of copies that weren't stopped; is the group hit or
    not."""
    own = r.groups.filter(F.col("category").isin(*categories) & ~F.col("short_circuited")).groupBy("copy").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("feature_id", F.lit("")), "category"))).alias("_c"))
    d = decide.joined(r.found, own, wide=True).withColumn("category", F.try_element_at("_c", F.coalesce("feature_id", F.lit(""))))
    return d.filter("category is not null").drop("_c")


def _judged(r: Result) -> DataFrame:
    """Lexicon occurrences with contained."""
    return decide.with_contained(by_category(r, 1, 2), F.col("category") == 1)


def final_matches(r: Result) -> DataFrame:
    """What goes into the hit details: occurrences of category 2 that no disclaimer contains, of messages that weren't
    stopped; whether the group as a whole is hit doesn't matter."""
    return _judged(r).filter("not contained").drop("contained", "category")


def suppressed_counts(r: Result) -> DataFrame:
    """(copy, message_id, suppressed) of every copy that wasn't stopped and has lexicon occurrences: how many of them a
    disclaimer contains."""
    return _judged(r).groupBy("copy", "message_id").agg(F.count_if("contained").alias("suppressed"))


def hit_summary(r: Result, exec_id: str, created_by: str, created_ts: Column) -> DataFrame:
    """lexicon-hit-summary: a row for every message that didn't fail, with an entry for each evaluated group; counts are
    those before suppression."""
    t = r.found.groupBy("copy", "feature_id", "term_id").agg(F.min_by("pattern", F.struct("req_pos", "area_ord", "end", "start")).alias("p"), F.count(F.lit(1)).alias("n"))
    t = t.groupBy("copy", "feature_id").agg(F.array_sort(F.collect_list(F.struct("term_id", F.col("p").alias("term_regex_pattern"), F.col("n").alias("regex_match_hit_count")))).alias("term_dtls"))
    t = t.groupBy("copy").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("feature_id", F.lit("")), "term_dtls"))).alias("t"))
    g = r.groups.groupBy("copy").agg(F.sort_array(F.collect_list(F.struct("ord", F.col("feature_id").alias("id"), F.col("feature_name").alias("name"), F.col("total_terms").alias("total_terms_count")))).alias("g"))
    dtls = lambda x: F.coalesce(F.try_element_at("t", F.coalesce(x["id"], F.lit(""))), F.array().cast("array<struct<term_id:string,term_regex_pattern:string,regex_match_hit_count:bigint>>"))
    e = decide.joined(g, t, "left", wide=True).select("copy", F.transform("g", lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), x["total_terms_count"].alias("total_terms_count"), F.size(dtls(x)).cast("long").alias("regex_hit_count"), dtls(x).alias("term_dtls"))).alias("evaluated_lexicons"))
    d = _each(decide.joined(r.messages.filter("error is null"), e, "left", wide=True))
    none = F.array().cast(schemas.LEXICON_HIT_SUMMARY["evaluated_lexicons"].dataType)
    return d.select("message_id", "process_id", F.lit(exec_id).alias("pipeline_exec_id"), F.coalesce("evaluated_lexicons", none).alias("evaluated_lexicons"), F.lit(created_by).alias("created_by"), created_ts.alias("created_ts"))


def matched_text() -> Column:
    """Aggregate: the JSON of a term's surviving occurrences, by area, attachments in order of appearance. Lengths are
    those in the original text, texts the stripped ones."""
    order = ("req_pos", "area_ord", "end", "start")
    part = lambda area: F.transform(
        F.sort_array(F.collect_list(F.when(F.col("area") == area, F.struct(*order, "text", F.col("start").alias("_s"), (F.col("end") - F.col("start")).alias("length"))))),
        lambda x: F.struct(x["text"].alias("text"), x["_s"].alias("start"), x["length"].alias("length")),
    )
    att = F.sort_array(F.collect_list(F.when(F.col("area") == "ATTACHMENT", F.struct(*order, "attachment_id", "text", (F.col("end") - F.col("start")).alias("length")))))
    ids = F.array_distinct(F.transform(att, lambda x: x["attachment_id"]))
    grouped = F.transform(
        ids,
        lambda i: F.struct(i.alias("attachment_id"), F.transform(F.filter(att, lambda x: x["attachment_id"] == i), lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["length"].alias("length"))).alias("att_text")),
    )
    return F.to_json(F.struct(F.array(F.struct(F.col("message_id"), part("MESSAGE_BODY").alias("msg_text"), part("SUBJECT").alias("subject"), grouped.alias("attachment_text"))).alias("hit_details_hs")))


def hit_detail(r: Result, exec_id: str, created_by: str, created_ts: Column, partition: Column | None = None) -> DataFrame:
    """lexicon-hit-detail of restricted and unrestricted messages, with the column restricted: a copy's row has what was found
    in that copy's texts. The partition value is the dataset's id unless another column is given. Messages without a
    surviving occurrence have no row."""
    f = final_matches(r).groupBy("copy", "message_id", "feature_id", "term_id").agg(matched_text().alias("matched_text"))
    f = f.groupBy("copy", "feature_id").agg(F.array_sort(F.collect_list(F.struct("term_id", "matched_text"))).alias("term_dtls"))
    f = f.groupBy("copy").agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("feature_id", F.lit("")), "term_dtls"))).alias("t"))
    g = r.groups.groupBy("copy").agg(F.sort_array(F.collect_list(F.struct("ord", "feature_id"))).alias("g"))
    dtls = lambda x: F.try_element_at("t", F.coalesce(x["feature_id"], F.lit("")))
    f = decide.joined(f, g, wide=True).select("copy", F.transform(F.filter("g", lambda x: dtls(x).isNotNull()), lambda x: F.struct(x["feature_id"].alias("id"), dtls(x).alias("term_dtls"))).alias("e"))
    d = _each(decide.joined(r.messages.filter("error is null"), f, wide=True))
    return d.select(
        "message_id", "process_id", F.lit(exec_id).alias("pipeline_exec_id"), (F.col("dataset_id") if partition is None else partition).alias("dataset_partition_value"),
        F.col("e").alias("evaluated_lexicons"), F.lit(created_by).alias("created_by"), created_ts.alias("created_ts"), "restricted",
    )


def feature_hit_summary(r: Result, hit_type: Column, exec_id: str, created_by: str, created_ts: Column) -> DataFrame:
    """feature-hit-summary: a row a message, an entry for each evaluated group, sub-features where it has several members.
    hit_type is a column of r.messages or a literal."""
    sub = F.transform("members", lambda x: F.struct(x["sub_feature_type"].alias("type"), x["features_to_apply"].alias("name"), x["hit"].alias("hit_status")))
    entry = F.struct(
        "ord", F.col("feature_id").try_cast("bigint").alias("id"), F.col("feature_name").alias("name"), F.col("feature_type").alias("type"),
        F.col("is_nr").alias("is_noise_reduction"), F.col("hit").alias("hit_status"), F.when(F.col("n_members") > 1, sub).alias("sub_features"),
    )
    e = r.groups.groupBy("copy").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    d = _each(decide.joined(r.messages.filter("error is null"), e, "left", wide=True))
    none = F.array().cast(schemas.FEATURE_HIT_SUMMARY["features"].dataType)
    return d.select(
        "message_id", F.col("dataset_id").alias("dataset_partition_value"), F.lit(exec_id).alias("pipeline_exec_id"), "process_id", hit_type.alias("feature_hit_type"),
        F.coalesce(F.transform("e", lambda x: x.dropFields("ord")), none).alias("features"), F.lit(created_by).alias("created_by"), created_ts.alias("created_ts"),
    )


def record_audit(r: Result, trigger_type: str, exec_id: str, stage: str, created_by: str, day: Column, created_ts: Column) -> DataFrame:
    """A row for each failed message."""
    return _each(r.messages.filter("error is not null")).select(
        "process_id", F.lit(trigger_type).alias("trigger_type"), F.lit(exec_id).alias("pipelinex_exec_id"), F.lit(stage).alias("stage_name"), F.col("message_id").alias("record_id"),
        F.lit("FAILED").alias("status"), F.lit(1).alias("return_code"), F.col("error").alias("error_message"), day.alias("execution_date"), F.lit(created_by).alias("created_by"), created_ts.alias("created_ts"),
    )


def csv_mirror(detail: DataFrame) -> DataFrame:
    """Restricted details with the nested column as JSON."""
    return detail.filter("restricted").drop("restricted").withColumn("evaluated_lexicons", F.to_json("evaluated_lexicons"))
