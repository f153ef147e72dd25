"""Registered queries over the test tables, and their DuckDB equivalents. Nested results are flattened for comparison."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas, store
from tidemark.functions import sql as fs
from tidemark.functions import text as tx
from tidemark.operators import decide
from tidemark.operators import definitions as df
from tidemark.plans import fixture, job, outputs, sinks
from tidemark.sources import paths, tables

EXEC, BY, STAGE = "pe-1", "tidemark", "SCAN"

FEATURE_PARTITION = "2026-08-16"


def _ts():
    return F.to_timestamp(F.lit("2026-08-16 10:00:00"))


def view_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [tables.view_rows(fixture.view(spark, sf_dir), f"part-{s}", FEATURE_PARTITION, "proc-1") for s in ("docs", "conv")]
    return tables.union_views(parts)


_results: dict[tuple, outputs.Result] = {}
_jobs: dict[tuple, str] = {}


def forget() -> None:
    """Evaluate anew from now on."""
    _results.clear()
    _jobs.clear()


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    """The session and the state of the tables that the evaluation reads."""
    at = []
    for t in ("documents", "conversations"):
        path, fs = paths.file_system(spark, f"{sf_dir}/{t}.parquet")
        s = fs.getFileStatus(path)
        at.append((s.getModificationTime(), s.getLen()))
    return (spark.sparkContext.applicationId, sf_dir, *at)


def evaluated(spark: SparkSession, sf_dir: str) -> outputs.Result:
    """The evaluation that the result tables share, once for each session and state of the tables."""
    key = _key(spark, sf_dir)
    if key not in _results:
        view = view_of(spark, sf_dir)
        _results[key] = outputs.evaluate(fixture.messages(spark, sf_dir), view, store.materialise(fixture.terms(spark), "terms"), fixture.expressions())
    return _results[key]


def evaluation(spark, sf_dir):
    """The evaluation alone: matches by pattern set."""
    r = evaluated(spark, sf_dir)
    return r.raw.filter("scan_error is null").groupBy("feature", "area").agg(F.count(F.lit(1)).alias("n"))


def copies_evaluated(spark: SparkSession, sf_dir: str) -> outputs.Result:
    """The same for messages that stand in several datasets and folders."""
    key = ("copies", *_key(spark, sf_dir))
    if key not in _results:
        view = tables.view_rows(fixture.view(spark, sf_dir, "docs"), "part-docs", FEATURE_PARTITION, "proc-1")
        _results[key] = outputs.evaluate(fixture.copied_messages(spark, sf_dir), view, store.materialise(fixture.terms(spark), "terms"), fixture.expressions())
    return _results[key]


def copies_detail(spark, sf_dir):
    """Details of each copy by itself: what a restricted copy says is in no unrestricted row."""
    return _flat_detail(outputs.hit_detail(copies_evaluated(spark, sf_dir), EXEC, BY, _ts()), "restricted")


def copies_summary(spark, sf_dir):
    """Evaluated groups and matches of each copy; equal rows count one by one."""
    d = _flat_summary(outputs.hit_summary(copies_evaluated(spark, sf_dir), EXEC, BY, _ts()))
    return d.groupBy("message_id", "id", "term_id", "pattern", "hits").agg(F.count(F.lit(1)).alias("n_copies"))


def posix_patterns(spark, sf_dir):
    """POSIX classes: runs of letters before digits, at all ends; three digits; capitals within words."""
    e = [tx.Expression("f", 1, "[[:alpha:]]+[[:digit:]]+"), tx.Expression("f", 2, "[[:digit:]]{3}"), tx.Expression("f", 3, "[[:lower:]][[:upper:]]{2}", "")]
    m = fixture.messages(spark, sf_dir).filter("dataset_id = 'docs'")
    a = decide.areas(m).filter("area = 'MESSAGE_BODY'").withColumn("features", F.array(F.lit("f")))
    return tx.scan(a, e).select("message_id", "expression_id", F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"), "text", "scan_error")


def deployed(spark: SparkSession, sf_dir: str) -> str:
    """The test tables as a deployment's folders, with the job run over them: the folder below which its tables are."""
    key = _key(spark, sf_dir)
    if key not in _jobs:
        base = f"{store.shared_dir(spark)}/tidemark/deployed-{uuid.uuid4().hex}"
        m = fixture.messages(spark, sf_dir).drop("channel")
        for ds in ("docs", "conv"):
            for name, flag in (("restricted", True), ("unrestricted", False)):
                part = m.filter((F.col("dataset_id") == ds) & (F.col("restricted") == flag)).drop("dataset_id", "restricted")
                part.write.parquet(f"{base}/live/{ds}/part-{ds}/{name}")
        fixture.view(spark, sf_dir).write.parquet(f"{base}/feature_decision_view")
        for folder in ("20260101_101", "20260816_101", "20260901_7"):
            for name, text in fixture.lexicon_files().items() if folder == "20260816_101" else [("empty.json", "{}")]:
                paths.write_text(spark, f"{base}/lexicon/{folder}/{name}", text)
        names = "feature_decision_view lexicon_hit_summary lexicon_hit_restricted lexicon_hit_unrestricted feature_hit_summary pipeline_stage_audit pipeline_record_audit csv_mirror".split()
        args = {"dataset_details": [{"dataset_id": d, "dataset_partition_value": f"part-{d}"} for d in ("docs", "conv")], "feature_partition_value": FEATURE_PARTITION, "pipeline_exec_id": EXEC, "policy_engine_id": "101", "process_id": "proc-1", "trigger_type": "policy-alert-live"}
        files = {"args": args, "tables": {n: f"{base}/{n}" for n in names}, "settings": {"message_roots": {"policy-alert-live": f"{base}/live"}, "lexicon_root": f"{base}/lexicon"}}
        for n, x in files.items():
            paths.write_text(spark, f"{base}/{n}.json", json.dumps(x))
        parsed = [kind.parse(paths.read_text(spark, f"{base}/{n}.json")) for n, kind in zip(files, (paths.RuntimeArgs, paths.TableConfig, paths.Settings), strict=True)]
        job.run_files(spark, *parsed, now=lambda: dt.datetime(2026, 8, 16, 10))
        _jobs[key] = base
    return _jobs[key]


def view_filter(spark, sf_dir):
    d = tables.view_rows(fixture.view(spark, sf_dir, "docs"), "part-docs", FEATURE_PARTITION, "proc-1")
    return d.groupBy("feature_id", "feature_type").agg(F.count(F.lit(1)).alias("n"), F.min("message_id").alias("first_id"))


def view_union(spark, sf_dir):
    return view_of(spark, sf_dir).groupBy("dataset_partition", "process_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("message_id").alias("messages"))


def relevant_messages(spark, sf_dir):
    d = tables.relevant(fixture.messages(spark, sf_dir), view_of(spark, sf_dir))
    return d.select("message_id", "dataset_id", "restricted", F.length("message.content.raw_text").cast("long").alias("n_chars"), F.size("attachments").cast("long").alias("n_attachments"))


def group_view(spark, sf_dir):
    d = tables.one_row_a_message(view_of(spark, sf_dir))
    return d.select("message_id", F.size("features").cast("long").alias("n"), F.array_join(F.transform("features", lambda x: F.concat_ws(":", x["feature_id"], x["features_to_apply"])), ",").alias("members"))


def latest_folder(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), (F.col("o_orderkey") % 7).cast("string")).alias("name"))
    return paths.latest_folder(n, "3")


def feature_definition_json(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"))
    j = F.concat(F.lit('{"featureName":"f","x":[1],"body":{"feature":"lex-'), F.col("k") % 9, F.lit('","totalTermsCount":'), F.col("k") % 5, F.lit(',"scope":["Subject","MESSAGE body"]}}'))
    j = F.when(F.col("k") % 11 == 0, F.lit("{bad")).when(F.col("k") % 11 == 1, F.lit(" ")).when(F.col("k") % 11 == 2, F.lit('{"body":{"totalTermsCount":3}}')).when(F.col("k") % 11 == 3, F.lit(None)).otherwise(j)
    d = df.with_definition(v.withColumn("feature_definition", j))
    ok = F.col("definition_error").isNull()
    return d.select("k", F.when(ok, F.col("feature")).alias("feature"), F.when(ok, F.col("total_terms")).alias("total_terms"), F.array_join("scope", "|").alias("scope"), (~ok).alias("bad"))


def scope_predicate(spark, sf_dir):
    m = decide.members(view_of(spark, sf_dir))
    return m.groupBy("features_to_apply").agg(*(F.count_if(df.has_scope(F.col("scope"), s)).alias(a.lower()) for a, s in decide.AREAS.items()))


def attachment_size(spark, sf_dir):
    d = decide.areas(fixture.messages(spark, sf_dir), 300)
    return d.groupBy("area").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


def html_strip(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select("page_id", F.md5(tx.strip_markup(F.col("html"))).alias("stripped_md5"), F.length(tx.strip_markup(F.col("html"))).cast("long").alias("n"))


def literal_positions(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return tx.literal_positions(d, "license").select("doc_id", F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"))


def _part_terms(spark, sf_dir):
    """The terms of compile results as the parts would have them: a brand's results, a term a part, every fifth with an
    exclusion and every seventh failed."""
    k = F.col("p_partkey")
    ids = lambda *c: F.array(*c).cast("array<bigint>")
    one = F.struct(
        F.concat_ws("::", F.col("p_brand"), k).alias("termId"), F.when(k % 7 == 0, "FAILED").when(k % 2 == 0, "pass").otherwise("PASS").alias("compilationStatus"), F.split("p_name", " ").alias("translatedPattern"),
        (k % 5 == 0).alias("requiresExclusionCheck"), (3 * k).alias("hyperscanExpressionId"), F.when(k % 5 == 0, ids(3 * k + 1, 3 * k)).otherwise(ids()).alias("requiredExpressionIds"),
        F.when(k % 5 == 0, ids(3 * k + 2)).otherwise(ids()).alias("excludedExpressionIds"), F.lit("x").alias("more"),
    )
    d = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.col("p_brand").alias("feature")).agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("json"))
    return df.terms(d)


def term_metadata(spark, sf_dir):
    ids = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return _part_terms(spark, sf_dir).select("feature", F.col("term_number").cast("long").alias("term_number"), "term_id", "pattern", ids("required"), ids("excluded"), "error")


def and_not(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return r.found.filter("feature = 'lex_token'").groupBy("message_id", "term_id").agg(F.count(F.lit(1)).alias("n"))


def group_hit(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return r.groups.groupBy("feature_id", "hit").agg(F.count(F.lit(1)).alias("n"))


def category_order(spark, sf_dir):
    g = decide.grouped(decide.members(view_of(spark, sf_dir)))
    return g.select("message_id", "feature_id", F.col("category").cast("long").alias("category"), F.col("ord").cast("long").alias("ord"), F.col("group_error").isNotNull().alias("bad"))


def short_circuit(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return r.groups.groupBy("copy", "message_id").agg(F.max("short_circuited").alias("short_circuited"), F.count(F.lit(1)).alias("n_groups")).drop("copy")


def suppression(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    d = outputs.final_matches(r).filter("feature_id = '3'")
    return d.select("message_id", "area", "attachment_id", F.col("start").cast("long").alias("start_pos"), F.col("end").cast("long").alias("end_pos"))


def hit_summary(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return _flat_summary(outputs.hit_summary(r, EXEC, BY, _ts()))


def _flat_summary(d):
    d = d.select("message_id", "process_id", F.explode("evaluated_lexicons").alias("e"), "created_ts")
    return d.select("message_id", "process_id", F.col("e.id").alias("id"), F.col("e.name").alias("name"), F.col("e.total_terms_count").alias("total_terms"), F.col("e.regex_hit_count").alias("n_terms"), F.explode_outer("e.term_dtls").alias("t"), "created_ts").select("message_id", "process_id", "id", "name", "total_terms", "n_terms", F.col("t.term_id").alias("term_id"), F.col("t.term_regex_pattern").alias("pattern"), F.col("t.regex_match_hit_count").alias("hits"), "created_ts")


def _detail(spark, sf_dir, restricted):
    r = evaluated(spark, sf_dir)
    return _flat_detail(outputs.hit_detail(r, EXEC, BY, _ts()).filter(F.col("restricted") == restricted))


def _flat_detail(d, *more):
    """A row for each occurrence, with more of d's columns: the areas' are put together first, so that d is made once."""
    own = ("message_id", "dataset_partition_value", *more)
    d = d.select(*own, F.explode("evaluated_lexicons").alias("e")).select(*own, F.col("e.id").alias("id"), F.explode("e.term_dtls").alias("t"))
    hit = "array<struct<text:string,start:bigint,length:bigint>>"
    j = F.from_json("t.matched_text", f"hit_details_hs array<struct<message_id:string,msg_text:{hit},subject:{hit},attachment_text:array<struct<attachment_id:string,att_text:{hit}>>>>")["hit_details_hs"][0]
    d = d.withColumn("j", j)
    said = lambda hits, area, att: F.transform(F.coalesce(hits, F.array().cast(hit)), lambda x: F.struct(F.lit(area).alias("area"), att.cast("string").alias("attachment_id"), F.lower(x["text"]).alias("said"), x["start"].alias("start_pos"), x["length"].alias("length")))
    attached = F.flatten(F.transform(F.coalesce("j.attachment_text", F.array().cast(f"array<struct<attachment_id:string,att_text:{hit}>>")), lambda a: said(a["att_text"], "ATTACHMENT", a["attachment_id"])))
    every = F.concat(said(F.col("j.msg_text"), "MESSAGE_BODY", F.lit(None)), said(F.col("j.subject"), "SUBJECT", F.lit(None)), attached)
    return d.select(*own, "id", F.col("t.term_id").alias("term_id"), F.explode(every).alias("x")).select("message_id", "dataset_partition_value", "id", "term_id", "x.*", *more)


def hit_detail_restricted(spark, sf_dir):
    return _detail(spark, sf_dir, True)


def hit_detail_unrestricted(spark, sf_dir):
    return _detail(spark, sf_dir, False)


def feature_hit_summary(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return _flat_features(outputs.feature_hit_summary(r, F.lit("tag"), EXEC, BY, _ts()))


def _flat_features(d):
    d = d.select("message_id", "dataset_partition_value", "feature_hit_type", F.explode("features").alias("f"))
    sub = F.array_join(F.transform(F.coalesce("f.sub_features", F.array().cast("array<struct<type:string,name:string,hit_status:boolean>>")), lambda x: F.concat_ws(":", x["name"], x["hit_status"].cast("string"))), ",")
    return d.select("message_id", "dataset_partition_value", "feature_hit_type", F.col("f.id").alias("id"), F.col("f.name").alias("name"), F.col("f.type").alias("type"), F.col("f.is_noise_reduction").alias("is_nr"), F.col("f.hit_status").alias("hit"), sub.alias("subs"))


def record_audit(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return outputs.record_audit(r, "policy-alert-live", EXEC, STAGE, BY, F.to_date(F.lit("2026-08-16")), _ts())


def stage_audit(spark, sf_dir):
    """The audit of a run an event, of which the errors failed and the signups are still running."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    runs = e.select(
        F.concat(F.lit("proc-"), "user_id").alias("process_id"), F.col("event_type").alias("trigger_type"), F.concat(F.lit("pe-"), "event_id").alias("exec_id"), F.col("ts").alias("start_time"),
        F.when(F.col("event_type") != "signup", F.col("ts") + F.expr("interval 5 minutes")).alias("end_time"), F.when(F.col("event_type") == "error", F.concat(F.lit("ValueError: "), "props")).alias("error"),
    )
    return sinks.stage_rows(runs, STAGE)


def csv_mirror(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return outputs.csv_mirror(outputs.hit_detail(r, EXEC, BY, _ts()))


def union_messages(spark, sf_dir):
    m = fixture.messages(spark, sf_dir)
    d = tables.union_messages([m.filter("dataset_id = 'docs'"), m.filter("dataset_id = 'conv'").drop("channel")])
    return d.groupBy("dataset_id", "channel").agg(F.count(F.lit(1)).alias("n"))


def regex_all_ends(spark, sf_dir):
    """Patterns of variable length: every end counts."""
    e = [tx.Expression("f", 1, "th[a-z]{1,3}d"), tx.Expression("f", 2, "[0-9]{4,6}"), tx.Expression("f", 3, "mit\x00license", kind="combination")]
    a = decide.areas(fixture.messages(spark, sf_dir)).withColumn("features", F.array(F.lit("f")))
    return tx.scan(a, e)


def lateral_matches(spark, sf_dir):
    """The same as regex_all_ends from SQL: a table function in a LATERAL join."""
    fs.register(spark)
    lexicon = json.dumps([{"feature": "f", "id": 1, "pattern": "th[a-z]{1,3}d"}, {"feature": "f", "id": 2, "pattern": "[0-9]{4,6}"}, {"feature": "f", "id": 3, "pattern": "mit\x00license", "kind": "combination"}])
    return spark.sql(
        "SELECT a.message_id, a.area, a.area_ord, a.attachment_id, m.feature, m.expression_id, m.start, m.end, m.text, CAST(NULL AS STRING) AS scan_error FROM {areas} a, LATERAL scan_matches(a.text, :lexicon) m",
        args={"lexicon": lexicon}, areas=decide.areas(fixture.messages(spark, sf_dir)),
    )


def suppressed_count(spark, sf_dir):
    r = evaluated(spark, sf_dir)
    return outputs.suppressed_counts(r).select("message_id", "suppressed")


def term_count(spark, sf_dir):
    return df.term_counts(_part_terms(spark, sf_dir))


def term_errors(spark, sf_dir):
    """Compile results that can't be read, and terms that clash: a feature a supplier, of one of ten cases each."""
    ok = {"compilationStatus": "PASS", "hyperscanExpressionId": 1}
    cases = [
        "{oops", " ", None, json.dumps({"results": []}), json.dumps({"results": [ok | {"termId": "x", "compilationStatus": "FAILED"}]}), json.dumps({"results": [ok | {"termId": "unnumbered"}]}),
        json.dumps({"results": [ok | {"termId": "worded::one"}]}), json.dumps({"results": [{"termId": "bare::1", "compilationStatus": "Pass"}]}),
        json.dumps({"results": [ok | {"termId": "clash::1"}, ok | {"termId": "clash::2", "hyperscanExpressionId": 3, "requiredExpressionIds": [2, 1]}]}), json.dumps({"results": [ok | {"termId": "a::b::7", "extra": 1}]}),
    ]
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), "s_suppkey").alias("feature"), F.element_at(F.array(*map(F.lit, cases)), (F.col("s_suppkey") % 10 + 1).cast("int")).alias("json"))
    t = df.terms(s)
    return t.select("feature", F.col("term_number").cast("long").alias("term_number"), "term_id", F.array_join(F.col("required").cast("array<string>"), ",").alias("required"), "error")


def duplicate_members(spark, sf_dir):
    """Equal view rows count as members but share same_as."""
    v = view_of(spark, sf_dir)
    m = decide.members(v.unionByName(v.filter(F.substring("message_id", -1, 1) == "3")))
    g = decide.grouped(m).select("message_id", "feature_id", "n_members", F.col("group_error").isNotNull().alias("bad"))
    n = m.groupBy("message_id", "feature_id").agg(F.count_distinct("same_as").alias("n_different"))
    return g.join(n, ["message_id", "feature_id"])


def message_errors(spark, sf_dir):
    """Failures that only a scanned or evaluated group can meet: attachments without an id, feature ids that are no numbers,
    pattern sets with an error; and those of groups, which come first. Conversations alone."""
    m = fixture.messages(spark, sf_dir).filter("dataset_id = 'conv'")
    n = F.substring("message_id", 2, 20).cast("long")
    lost = F.transform("attachments", lambda a: a.withField("metadata.attachment_id", F.when(n % 3 == 0, F.lit(None)).otherwise(a["metadata"]["attachment_id"])))
    v = tables.view_rows(fixture.view(spark, sf_dir, "conv"), "part-conv", FEATURE_PARTITION, "proc-1").filter("feature_id = '4'")
    v = v.withColumns({"operator": F.when(n % 7 == 0, "XOR").otherwise(F.col("operator")), "feature_id": F.when(n % 5 == 0, "four").otherwise(F.col("feature_id"))})
    v = v.withColumn("feature_definition", F.when((n % 11 == 0) & (F.col("features_to_apply") == "lex_with"), F.replace("feature_definition", F.lit("lex_with"), F.lit("broken"))).otherwise(F.col("feature_definition")))
    t = tables.with_errors(fixture.terms(spark), [("broken", "it is")])
    r = outputs.evaluate(m.withColumn("attachments", lost), v, store.materialise(t, "terms"), fixture.expressions())
    return r.messages.select("message_id", "error")


def path_functions(spark, sf_dir):
    """Pages as objects of a store: buckets and objects of their URIs, the paths of a lexicon's files, and the latest folder
    of each bucket."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    k = F.col("page_id")
    d = p.select("page_id", paths.uri_parts(F.when(k % 9 == 0, F.col("url")).otherwise(F.concat(F.when(k % 9 == 1, "gs:/").otherwise("gs://"), F.substring_index("url", "//", -1)))).alias("u"))
    base = F.when(k % 4 == 0, F.concat("u.bucket", F.lit("/"), "u.object")).otherwise(F.concat("u.bucket", F.lit("/")))
    feature = F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("lex "), k))
    return d.select(
        "page_id", "u.bucket", "u.object", paths.below(base, feature, ".hdb").alias("patterns"), paths.below(base, feature, "-compile-results.json").alias("terms"),
        paths.file_name(F.concat(F.lit("file:/x/"), F.replace(F.concat(feature, F.lit("+é")), F.lit(" "), F.lit("%20")))).alias("file"),
    )


def dataset_reader(spark, sf_dir):
    """Messages from their folders, restricted and not, with all fields, those of the view's ids only."""
    base = deployed(spark, sf_dir)
    ids = store.materialise(view_of(spark, sf_dir).select("message_id").distinct(), "ids")  # each dataset reads them several times
    d = tables.union_messages([tables.read_dataset(spark, f"{base}/live", ds, f"part-{ds}", ids) for ds in ("docs", "conv")])
    return d.select("message_id", "dataset_id", "restricted", F.length("message.content.raw_text").cast("long").alias("n_chars"), F.size("attachments").cast("long").alias("n_attachments"), (F.col("source").isNull() & F.col("processing").isNull()).alias("absent_is_null"))


def job_hit_summary(spark, sf_dir):
    return _flat_summary(sinks.read(spark, f"{deployed(spark, sf_dir)}/lexicon_hit_summary", schemas.LEXICON_HIT_SUMMARY))


def job_hit_restricted(spark, sf_dir):
    return _flat_detail(sinks.read(spark, f"{deployed(spark, sf_dir)}/lexicon_hit_restricted", schemas.LEXICON_HIT_DETAIL))


def job_hit_unrestricted(spark, sf_dir):
    return _flat_detail(sinks.read(spark, f"{deployed(spark, sf_dir)}/lexicon_hit_unrestricted", schemas.LEXICON_HIT_DETAIL))


def job_feature_summary(spark, sf_dir):
    return _flat_features(sinks.read(spark, f"{deployed(spark, sf_dir)}/feature_hit_summary", schemas.FEATURE_HIT_SUMMARY))


def job_record_audit(spark, sf_dir):
    return sinks.read(spark, f"{deployed(spark, sf_dir)}/pipeline_record_audit", schemas.RECORD_AUDIT)


def job_stage_audit(spark, sf_dir):
    d = spark.read.parquet(f"{deployed(spark, sf_dir)}/pipeline_stage_audit")
    return d.withColumn("end_time", F.when(F.col("end_time").isNotNull(), F.col("end_time") + F.expr("interval 5 minutes")))


def job_csv(spark, sf_dir):
    d = spark.read.option("header", True).csv(f"{deployed(spark, sf_dir)}/csv_mirror")
    return d.withColumn("created_ts", F.to_timestamp("created_ts"))


_ALL = [
    view_filter, view_union, relevant_messages, group_view, latest_folder, feature_definition_json, scope_predicate, attachment_size, html_strip, literal_positions, term_metadata, and_not,
    group_hit, category_order, short_circuit, suppression, suppressed_count, hit_summary, hit_detail_restricted, hit_detail_unrestricted, feature_hit_summary, record_audit, stage_audit, csv_mirror, union_messages, regex_all_ends, lateral_matches,
    copies_detail, copies_summary, posix_patterns, evaluation, term_count, term_errors, duplicate_members, message_errors, path_functions, dataset_reader, job_hit_summary, job_hit_restricted, job_hit_unrestricted, job_feature_summary, job_record_audit, job_stage_audit, job_csv,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


# --- DuckDB ------------------------------------------------------------------------------------------------------

_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}]"
_RUN = rf"(?:<[^>]*>|{_WS})+"
_MESSAGES = """msgs AS (
  SELECT 'd' || doc_id AS message_id, doc_id AS n, 'docs' AS ds, doc_id % 2 = 0 AS restricted, text AS body, split_part(text, chr(10), 1) AS subject, lang AS channel FROM documents
  UNION ALL SELECT 'c' || conv_id, conv_id, 'conv', conv_id % 2 = 0, max(CASE WHEN turn = 0 THEN text END), NULL, NULL FROM conversations GROUP BY conv_id),
atts AS (SELECT 'c' || conv_id AS message_id, 'c' || conv_id || '-' || turn AS attachment_id, text FROM conversations WHERE turn > 0),
areas AS (SELECT * FROM (
  SELECT message_id, 'SUBJECT' AS area, NULL AS attachment_id, subject AS text FROM msgs UNION ALL SELECT message_id, 'MESSAGE_BODY', NULL, body FROM msgs
  UNION ALL SELECT message_id, 'ATTACHMENT', attachment_id, text FROM atts) WHERE trim(coalesce(text, '')) <> '')"""


#: One message a copy, its name the message's and what tells the copies apart.
_COPIES = """src AS (SELECT doc_id, text, split_part(text, chr(10), 1) AS line, doc_id % 2 = 0 AS r FROM documents),
msgs AS (
  SELECT 'd' || doc_id || ':1' AS message_id, doc_id AS n, 'docs' AS ds, r AS restricted, text AS body, line AS subject, NULL AS channel, CASE WHEN doc_id % 11 = 0 THEN 2 ELSE 1 END AS times FROM src
  UNION ALL SELECT 'd' || doc_id || ':2', doc_id, 'docs', NOT r, replace(text, 'license', 'token'), NULL, NULL, 1 FROM src WHERE doc_id % 5 = 0
  UNION ALL SELECT 'd' || doc_id || ':3', doc_id, 'conv', r, line, NULL, NULL, 1 FROM src WHERE doc_id % 7 = 0),
areas AS (SELECT * FROM (
  SELECT message_id, 'SUBJECT' AS area, CAST(NULL AS VARCHAR) AS attachment_id, subject AS text FROM msgs UNION ALL SELECT message_id, 'MESSAGE_BODY', NULL, body FROM msgs) WHERE trim(coalesce(text, '')) <> '')"""


def _view_sql() -> str:
    rows = []
    for fid, ftype, nr, op, name, members in fixture.FEATURES:
        for k, (_, feature, total, scope) in enumerate(members):
            has = ", ".join(str(s in [x.lower() for x in scope]).lower() for s in decide.AREAS.values())
            cat = 0 if nr == "Y" else 1 if ftype.lower() == "disclaimer" else 2
            rows.append(f"('{fid}', '{ftype}', '{nr}', {f"'{op}'" if op else 'NULL'}, '{name}', '{feature}', {total}, {len(members)}, {k}, {cat}, {has})")
    return (
        "feats(feature_id, feature_type, nr, op, name, feature, total, n_members, k, category, in_subject, in_body, in_att) AS (VALUES " + ", ".join(rows) + "),\n"
        "view_all AS (SELECT m.message_id, m.n, m.ds, CASE WHEN m.ds = 'docs' AND m.n % 10 = 9 THEN 'proc-2' ELSE 'proc-1' END AS process_id, 'part-' || m.ds AS dataset_partition, "
        "f.*, f.feature_id = '5' AND m.ds = 'docs' AND m.n % 97 = 5 AS lost FROM msgs m CROSS JOIN feats f),\n"
        "v AS (SELECT * FROM view_all WHERE process_id = 'proc-1')"
    )


def _scan_sql() -> str:
    parts = []
    for f, i, p in fixture.EXPRESSIONS:
        pattern = "(?i)" + p.replace(" ", _RUN)
        parts.append(
            f"SELECT message_id, area, attachment_id, '{f}' AS feature, {i} AS expr, ms, pc, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS ms, "
            f"string_split_regex(text, '{pattern}') AS pc FROM areas WHERE regexp_matches(text, '{pattern}'))"
        )
    return (
        "hits_ AS (" + "\nUNION ALL ".join(parts) + "),\n"
        "raw AS (SELECT message_id, area, attachment_id, feature, expr, ms[i] AS said, CAST(list_sum(list_transform(pc[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, "
        "length(ms[i]) AS len FROM hits_),\n"
        # matches of each member within its scope; failed messages have none
        "ok AS (SELECT message_id FROM v GROUP BY message_id HAVING NOT bool_or(lost)),\n"
        "mm AS (SELECT v.message_id, v.feature_id, v.category, r.* EXCLUDE (message_id) FROM v JOIN ok USING (message_id) JOIN raw r ON r.message_id = v.message_id AND r.feature = v.feature "
        "WHERE CASE r.area WHEN 'SUBJECT' THEN in_subject WHEN 'MESSAGE_BODY' THEN in_body ELSE in_att END),\n"
        "stopped AS (SELECT DISTINCT message_id FROM mm WHERE category = 0),\n"
        "found AS (SELECT * FROM mm WHERE expr <> 11 AND NOT (feature = 'lex_token' AND EXISTS (SELECT 1 FROM mm x WHERE x.message_id = mm.message_id AND x.feature = 'lex_token' AND x.expr = 11)) "
        "AND (category = 0 OR message_id NOT IN (SELECT message_id FROM stopped))),\n"
        "mem AS (SELECT v.*, EXISTS (SELECT 1 FROM found f WHERE f.message_id = v.message_id AND f.feature_id = v.feature_id AND f.feature = v.feature) AS hit FROM v JOIN ok USING (message_id)),\n"
        "grp AS (SELECT message_id, any_value(ds) AS ds, feature_id, any_value(feature_type) AS feature_type, any_value(nr) AS nr, any_value(name) AS name, any_value(category) AS category, sum(total) AS total, any_value(n_members) AS n_members, "
        "CASE WHEN upper(any_value(op)) = 'AND' THEN bool_and(hit) ELSE bool_or(hit) END AS hit, string_agg(feature || ':' || CASE WHEN hit THEN 'true' ELSE 'false' END, ',' ORDER BY feature) AS subs FROM mem GROUP BY message_id, feature_id),\n"
        "ev AS (SELECT g.* FROM grp g WHERE category = 0 OR message_id NOT IN (SELECT message_id FROM stopped)),\n"
        "fin AS (SELECT * FROM found l WHERE category = 2 AND NOT EXISTS (SELECT 1 FROM found d WHERE d.category = 1 AND d.message_id = l.message_id AND d.area = l.area AND d.attachment_id IS NOT DISTINCT FROM l.attachment_id "
        "AND d.s <= l.s AND l.s + l.len <= d.s + d.len))"
    )


def _detail_sql(restricted: bool) -> str:
    return (
        f"SELECT f.message_id, m.ds AS dataset_partition_value, f.feature_id AS id, f.feature || '::' || t.n AS term_id, f.area, f.attachment_id, lower(regexp_replace(f.said, '{_RUN}', ' ', 'g')) AS said, "
        f"f.s AS start_pos, CAST(f.len AS BIGINT) AS length FROM fin f JOIN msgs m USING (message_id) JOIN terms t ON t.feature = f.feature WHERE m.restricted = {str(restricted).lower()}"
    )


def _csv_sql() -> str:
    """Restricted details as JSON, as the mirror has them."""
    hit = "{'text': said, 'start': s, 'length': len}"
    none = "CAST([] AS STRUCT(\"text\" VARCHAR, \"start\" BIGINT, \"length\" BIGINT)[])"
    return (
        f", occ AS (SELECT f.message_id, m.ds, f.feature_id, f.feature || '::' || t.n AS term_id, f.area, f.attachment_id, regexp_replace(f.said, '{_RUN}', ' ', 'g') AS said, f.s, CAST(f.len AS BIGINT) AS len "
        "FROM fin f JOIN msgs m USING (message_id) JOIN terms t ON t.feature = f.feature WHERE m.restricted),\n"
        f"att AS (SELECT message_id, feature_id, term_id, attachment_id, list({hit} ORDER BY s) AS att_text FROM occ WHERE area = 'ATTACHMENT' GROUP BY ALL),\n"
        "attl AS (SELECT message_id, feature_id, term_id, list({'attachment_id': attachment_id, 'att_text': att_text} ORDER BY CAST(split_part(attachment_id, '-', 2) AS INTEGER)) AS l FROM att GROUP BY ALL),\n"
        f"part AS (SELECT message_id, any_value(ds) AS ds, feature_id, term_id, list({hit} ORDER BY s) FILTER (WHERE area = 'MESSAGE_BODY') AS b, list({hit} ORDER BY s) FILTER (WHERE area = 'SUBJECT') AS u FROM occ GROUP BY message_id, feature_id, term_id),\n"
        "said AS (SELECT p.message_id, p.ds, p.feature_id, p.term_id, CAST(to_json({'hit_details_hs': [{'message_id': p.message_id, "
        f"'msg_text': coalesce(b, {none}), 'subject': coalesce(u, {none}), 'attachment_text': coalesce(l, CAST([] AS STRUCT(attachment_id VARCHAR, att_text STRUCT(\"text\" VARCHAR, \"start\" BIGINT, \"length\" BIGINT)[])[]))}}]}}) AS VARCHAR) AS matched_text "
        "FROM part p LEFT JOIN attl USING (message_id, feature_id, term_id)),\n"
        "byf AS (SELECT message_id, any_value(ds) AS ds, feature_id, list({'term_id': term_id, 'matched_text': matched_text} ORDER BY term_id, matched_text) AS term_dtls FROM said GROUP BY message_id, feature_id)\n"
        "SELECT message_id, 'proc-1' AS process_id, 'pe-1' AS pipeline_exec_id, any_value(ds) AS dataset_partition_value, CAST(to_json(list({'id': feature_id, 'term_dtls': term_dtls} ORDER BY feature_id)) AS VARCHAR) AS evaluated_lexicons, "
        "'tidemark' AS created_by, TIMESTAMPTZ '2026-08-16 10:00:00+00' AS created_ts FROM byf GROUP BY message_id"
    )


def _all_ends_sql() -> str:
    """All starts and lengths of the patterns' matches within runs of letters and digits, between tags."""
    cut = lambda name, source, text, pattern: (
        f"{name}_ AS (SELECT * EXCLUDE ({text}), string_split_regex({text}, '{pattern}') AS pc, regexp_extract_all({text}, '{pattern}') AS ms FROM {source})"
    )
    before = "CAST(coalesce(list_sum(list_transform(pc[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    ahead = "CAST(coalesce(list_sum(list_transform(pc[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    run = "[0-9A-Za-z]*([tT][hH][A-Za-z]{1,3}[dD]|[0-9]{4})[0-9A-Za-z]*"
    keys = "message_id, area, area_ord, attachment_id"
    word = lambda name, pattern: f"{cut(name, 'pieces', 'piece', pattern)},\n{name} AS (SELECT {keys}, off + {before} AS off, ms[i] AS w FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM {name}_))"
    one = lambda k, pattern: (
        f"SELECT {keys}, {k} AS expression_id, min(s) AS s, e FROM (SELECT {keys}, off + i - 1 AS s, off + i - 1 + l AS e FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM runs) a, (VALUES (4), (5), (6)) v(l) "
        f"WHERE i + l - 1 <= length(w) AND regexp_full_match(substr(w, i, l), '{pattern}')) GROUP BY {keys}, e"
    )
    return (
        ", texts AS (SELECT message_id, 'SUBJECT' AS area, 0 AS area_ord, CAST(NULL AS VARCHAR) AS attachment_id, subject AS text, subject AS whole FROM msgs UNION ALL SELECT message_id, 'MESSAGE_BODY', 1, NULL, body, body FROM msgs "
        "UNION ALL SELECT message_id, 'ATTACHMENT', CAST(1 + row_number() OVER (PARTITION BY message_id ORDER BY CAST(split_part(attachment_id, '-', 2) AS INTEGER)) AS INTEGER), attachment_id, text, text FROM atts),\n"
        f"{cut('tagged', '(SELECT * EXCLUDE (whole) FROM texts WHERE text IS NOT NULL)', 'text', '<[^>]*>')},\n"
        f"pieces AS (SELECT {keys}, {ahead} AS off, pc[i] AS piece FROM (SELECT *, unnest(range(1, len(pc) + 1)) AS i FROM tagged_)),\n"
        f"{word('runs', run)},\n{word('mit', '(?i)mit')},\n{word('lic', '(?i)license')},\n"
        f"ends AS ({one(1, '(?i)th[a-z]{1,3}d')} UNION ALL {one(2, '[0-9]{4,6}')} UNION ALL "
        f"SELECT {keys}, 3, s, e FROM (SELECT m.message_id, m.area, m.area_ord, m.attachment_id, least(min(m.off), min(l.off)) AS s, greatest(max(m.off) + 3, max(l.off) + 7) AS e "
        "FROM mit m JOIN lic l ON l.message_id = m.message_id AND l.area_ord = m.area_ord GROUP BY m.message_id, m.area, m.area_ord, m.attachment_id))\n"
        f"SELECT e.message_id, e.area, CAST(e.area_ord AS INTEGER) AS area_ord, e.attachment_id, 'f' AS feature, CAST(expression_id AS INTEGER) AS expression_id, CAST(s AS INTEGER) AS \"start\", CAST(e AS INTEGER) AS \"end\", "
        f"regexp_replace(substr(t.whole, s + 1, e - s), '{_RUN}', ' ', 'g') AS text, CAST(NULL AS VARCHAR) AS scan_error FROM ends e JOIN texts t ON t.message_id = e.message_id AND t.area_ord = e.area_ord"
    )


def _copies_sql() -> dict[str, str]:
    terms = "terms(feature, n, shown) AS (VALUES " + ", ".join(f"('{f}', {n}, '{' & '.join(shown)}')" for f, n, _, _, shown in fixture.TERMS) + ")"
    # a view of documents alone, whatever dataset a copy is in
    view = _view_sql().replace("m.ds = 'docs' AND ", "").replace("'part-' || m.ds", "'part-docs'")
    full = f"WITH {_COPIES},\n{view},\n{_scan_sql()},\n{terms}"
    return {
        "copies_detail": f"{full} SELECT split_part(f.message_id, ':', 1) AS message_id, m.ds AS dataset_partition_value, f.feature_id AS id, f.feature || '::' || t.n AS term_id, f.area, f.attachment_id, lower(regexp_replace(f.said, '{_RUN}', ' ', 'g')) AS said, "
        "f.s AS start_pos, CAST(f.len AS BIGINT) AS length, m.restricted FROM fin f JOIN msgs m USING (message_id) JOIN terms t ON t.feature = f.feature, unnest(range(m.times))",
        "copies_summary": f"{full}, x AS (SELECT message_id, feature_id, feature, count(*) AS hits, arg_min(said, (CASE area WHEN 'SUBJECT' THEN 0 ELSE 1 END, s)) AS said FROM found GROUP BY ALL) "
        "SELECT split_part(e.message_id, ':', 1) AS message_id, e.feature_id AS id, x.feature || '::' || t.n AS term_id, CASE WHEN t.shown = '' THEN x.said ELSE t.shown END AS pattern, x.hits, CAST(sum(m.times) AS BIGINT) AS n_copies "
        "FROM ev e JOIN msgs m USING (message_id) LEFT JOIN x USING (message_id, feature_id) LEFT JOIN terms t ON t.feature = x.feature GROUP BY ALL",
    }


def _posix_sql() -> str:
    """The matches within pieces between tags, each run's ends unfolded."""
    before = "CAST(coalesce(list_sum(list_transform(pc[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    ahead = "CAST(coalesce(list_sum(list_transform(pc[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    cut = lambda text, pattern: f"string_split_regex({text}, '{pattern}') AS pc, regexp_extract_all({text}, '{pattern}') AS ms"
    runs = lambda pattern: f"SELECT message_id, off + {before} AS off, ms[i] AS w FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT message_id, off, {cut('piece', pattern)} FROM pieces))"
    windows = lambda k, run, pattern: (
        f"SELECT message_id, {k} AS expression_id, off + i - 1 AS s, off + i + 2 AS e, substr(w, i, 3) AS text FROM (SELECT *, unnest(range(1, length(w) - 1)) AS i FROM ({runs(run)}) WHERE length(w) > 2) WHERE regexp_full_match(substr(w, i, 3), '{pattern}')"
    )
    return (
        f"WITH pieces AS (SELECT message_id, {ahead} AS off, pc[i] AS piece FROM (SELECT *, unnest(range(1, len(pc) + 1)) AS i FROM (SELECT 'd' || doc_id AS message_id, {cut('text', '<[^>]*>')} FROM documents WHERE text IS NOT NULL)))\n"
        "SELECT message_id, CAST(expression_id AS INTEGER) AS expression_id, s AS start_pos, e AS end_pos, text, CAST(NULL AS VARCHAR) AS scan_error FROM ("
        f"SELECT message_id, 1 AS expression_id, off AS s, off + i AS e, substr(w, 1, i) AS text FROM (SELECT *, unnest(range(length(regexp_extract(w, '^[A-Za-z]+')) + 1, length(w) + 1)) AS i FROM ({runs('[A-Za-z]+[0-9]+')}))\n"
        f"UNION ALL {windows(2, '[0-9]+', '[0-9]{3}')}\nUNION ALL {windows(3, '[A-Za-z]+', '[a-z][A-Z]{2}')})"
    )


_PARTS = "p AS (SELECT p_brand AS feature, p_partkey AS k, p_name FROM part WHERE p_partkey % 7 <> 0)"
_CASES = (
    "(0, NULL, NULL, NULL, 'term metadata can''t be read'), (1, NULL, NULL, NULL, 'term metadata can''t be read'), (2, NULL, NULL, NULL, 'term metadata can''t be read'), (5, NULL, NULL, '1', 'termId has no number'), "
    "(6, NULL, NULL, '1', 'termId has no number'), (7, 1, '::1', NULL, 'term has no expression'), (8, NULL, NULL, NULL, 'two terms claim expression 1'), (8, 1, '::1', '1', NULL), (8, 2, '::2', '2,1', NULL), (9, 7, '::7', '1', NULL)"
)


def _more_sql(base: str, full: str, direct: dict[str, str]) -> dict[str, str]:
    conv = "c AS (SELECT message_id, n FROM msgs WHERE ds = 'conv')"
    # a message fails at the first of: its group, its pattern sets, its texts, its feature ids
    has = lambda what, where: f"EXISTS (SELECT 1 FROM areas a WHERE a.message_id = c.message_id AND {where} AND regexp_matches(a.text, '(?i){what}'))"
    hit = f"({has('token', 'a.area = ' + chr(39) + 'ATTACHMENT' + chr(39))} OR {has('license', 'a.area = ' + chr(39) + 'ATTACHMENT' + chr(39))})"
    return {
        **_copies_sql(),
        "posix_patterns": _posix_sql(),
        "csv_mirror": full + _csv_sql(),
        "job_csv": full + _csv_sql(),
        "regex_all_ends": f"WITH {_MESSAGES}" + _all_ends_sql(),
        "lateral_matches": f"WITH {_MESSAGES}" + _all_ends_sql(),
        "evaluation": f"{full} SELECT feature, area, count(*) AS n FROM (SELECT DISTINCT r.* EXCLUDE (said), v.in_subject, v.in_body, v.in_att FROM v JOIN ok USING (message_id) JOIN raw r ON r.message_id = v.message_id AND r.feature = v.feature "
        "WHERE (v.category = 0 OR v.message_id NOT IN (SELECT message_id FROM stopped)) AND CASE r.area WHEN 'SUBJECT' THEN in_subject WHEN 'MESSAGE_BODY' THEN in_body ELSE in_att END) GROUP BY feature, area",
        "suppressed_count": f"{full} SELECT f.message_id, count(*) - coalesce(any_value(k), 0) AS suppressed FROM found f LEFT JOIN (SELECT message_id, count(*) AS k FROM fin GROUP BY message_id) USING (message_id) WHERE f.category = 2 GROUP BY f.message_id",
        "term_count": f"WITH {_PARTS} SELECT feature, count(*) AS term_count FROM p GROUP BY feature",
        "term_errors": f"SELECT 's' || s_suppkey AS feature, CAST(n AS BIGINT) AS term_number, 's' || s_suppkey || id AS term_id, r AS required, e AS error FROM supplier JOIN (VALUES {_CASES}) t(c, n, id, r, e) ON s_suppkey % 10 = c",
        "duplicate_members": f"{base} SELECT message_id, feature_id, count(*) * CASE WHEN right(message_id, 1) = '3' THEN 2 ELSE 1 END AS n_members, any_value(op) IS NULL AND right(message_id, 1) = '3' OR bool_or(lost) AS bad, count(*) AS n_different FROM v GROUP BY message_id, feature_id",
        "message_errors": f"WITH {_MESSAGES}, {conv} SELECT message_id, CASE WHEN n % 7 = 0 THEN 'unknown operator' WHEN n % 11 = 0 THEN 'broken: it is' WHEN n % 3 = 0 AND {hit} THEN 'ValueError: an attachment with a match has no id' "
        "WHEN n % 5 = 0 THEN 'feature_id is no number: four' END AS error FROM c",
        "path_functions": "WITH u AS (SELECT page_id, CASE WHEN page_id % 9 > 1 AND contains(rest, '/') AND split_part(rest, '/', 1) <> '' AND length(rest) > strpos(rest, '/') THEN split_part(rest, '/', 1) END AS bucket, "
        "substr(rest, strpos(rest, '/') + 1) AS o FROM (SELECT page_id, list_last(string_split(url, '//')) AS rest FROM pages)), b AS (SELECT page_id, bucket, CASE WHEN bucket IS NOT NULL THEN o END AS object, CASE WHEN page_id % 5 = 0 THEN ' ' ELSE 'lex ' || page_id END AS f FROM u), "
        "c AS (SELECT *, CASE WHEN page_id % 4 = 0 THEN bucket || '/' || object ELSE bucket || '/' END AS base FROM b), d AS (SELECT *, page_id % 5 <> 0 AND base LIKE '%/' AS ok FROM c) "
        "SELECT page_id, bucket, object, CASE WHEN ok THEN base || f || '.hdb' END AS patterns, CASE WHEN ok THEN base || f || '-compile-results.json' END AS terms, f || '+é' AS file FROM d",
        "dataset_reader": f"SELECT *, true AS absent_is_null FROM ({direct['relevant_messages']})",
        "job_hit_summary": direct["hit_summary"],
        "job_hit_restricted": direct["hit_detail_restricted"],
        "job_hit_unrestricted": direct["hit_detail_unrestricted"],
        "job_feature_summary": direct["feature_hit_summary"],
        "job_record_audit": direct["record_audit"],
        "job_stage_audit": "SELECT 'proc-1' AS process_id, 'policy-alert-live' AS trigger_type, 'pe-1' AS pipelinex_exec_id, 'SCAN' AS stage_name, CAST(NULL AS VARCHAR) AS composer_dag_name, CAST(NULL AS VARCHAR) AS composer_dag_path, "
        "CAST(NULL AS VARCHAR) AS dproc_dag_name, CAST(NULL AS VARCHAR) AS dproc_dag_path, TIMESTAMPTZ '2026-08-16 10:00:00+00' AS start_time, e AS end_time, s AS job_status, CAST(NULL AS VARCHAR) AS error_count, CAST(NULL AS VARCHAR) AS error_message, "
        "CAST(NULL AS VARCHAR) AS additional_info, DATE '2026-08-16' AS execution_date FROM (VALUES ('IN_PROGRESS', CAST(NULL AS TIMESTAMPTZ)), ('SUCCESS', TIMESTAMPTZ '2026-08-16 10:05:00+00')) t(s, e)",
    }


def oracle_sql() -> dict[str, str]:
    direct = _direct_sql()
    base = f"WITH {_MESSAGES},\n{_view_sql()}"
    terms = "terms(feature, n, shown) AS (VALUES " + ", ".join(f"('{f}', {n}, '{' & '.join(shown)}')" for f, n, _, _, shown in fixture.TERMS) + ")"
    return direct | _more_sql(base, f"{base},\n{_scan_sql()},\n{terms}\n", direct)


def _direct_sql() -> dict[str, str]:
    terms = "terms(feature, n, shown) AS (VALUES " + ", ".join(f"('{f}', {n}, '{' & '.join(shown)}')" for f, n, _, _, shown in fixture.TERMS) + ")"
    base = f"WITH {_MESSAGES},\n{_view_sql()}"
    full = f"{base},\n{_scan_sql()},\n{terms}\n"
    run = _RUN.replace("'", "''")
    ts = "TIMESTAMPTZ '2026-08-16 10:00:00+00'"
    return {
        "view_filter": f"{base} SELECT feature_id, feature_type, count(*) AS n, min(message_id) AS first_id FROM v WHERE ds = 'docs' GROUP BY ALL",
        "view_union": f"{base} SELECT dataset_partition, process_id, count(*) AS n, count(DISTINCT message_id) AS messages FROM v GROUP BY ALL",
        "relevant_messages": f"{base} SELECT message_id, ds AS dataset_id, restricted, length(body) AS n_chars, (SELECT count(*) FROM atts a WHERE a.message_id = m.message_id) AS n_attachments FROM msgs m WHERE message_id IN (SELECT message_id FROM v)",
        "group_view": f"{base} SELECT message_id, count(*) AS n, string_agg(feature_id || ':' || feature, ',' ORDER BY feature_id, feature_type, feature) AS members FROM v GROUP BY message_id",
        "latest_folder": "SELECT max(name) AS folder FROM (SELECT strftime(o_orderdate, '%Y%m%d') || '_' || (o_orderkey % 7) AS name FROM orders) WHERE name LIKE '%\\_3' ESCAPE '\\'",
        "feature_definition_json": "SELECT c_custkey AS k, CASE WHEN NOT bad THEN 'lex-' || (c_custkey % 9) END AS feature, CASE WHEN NOT bad THEN c_custkey % 5 END AS total_terms, CASE WHEN NOT bad THEN 'subject|message body' END AS scope, bad FROM (SELECT *, c_custkey % 11 IN (0, 1, 2, 3) AS bad FROM customer)",
        "scope_predicate": f"{base} SELECT feature AS features_to_apply, count_if(in_subject) AS subject, count_if(in_body) AS message_body, count_if(in_att) AS attachment FROM v GROUP BY feature",
        "attachment_size": f"{base} SELECT area, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM areas WHERE area <> 'ATTACHMENT' OR strlen(text) <= 300 GROUP BY area",
        "html_strip": f"SELECT page_id, md5(x) AS stripped_md5, length(x) AS n FROM (SELECT page_id, regexp_replace(coalesce(html, ''), '{run}', ' ', 'g') AS x FROM pages)",
        "literal_positions": "SELECT doc_id, CAST(list_sum(list_transform(pc[1:i], lambda x: length(x))) + (i - 1) * 7 AS BIGINT) AS start_pos, CAST(list_sum(list_transform(pc[1:i], lambda x: length(x))) + i * 7 AS BIGINT) AS end_pos FROM "
        "(SELECT doc_id, string_split_regex(text, '(?i)license') AS pc, unnest(range(1, len(regexp_extract_all(text, '(?i)license')) + 1)) AS i FROM documents WHERE regexp_matches(text, '(?i)license'))",
        "term_metadata": f"WITH {_PARTS} SELECT feature, k AS term_number, feature || '::' || k AS term_id, replace(p_name, ' ', ' & ') AS pattern, CASE WHEN k % 5 = 0 THEN (3 * k + 1) || ',' || (3 * k) ELSE CAST(3 * k AS VARCHAR) END AS required, CASE WHEN k % 5 = 0 THEN CAST(3 * k + 2 AS VARCHAR) ELSE '' END AS excluded, CAST(NULL AS VARCHAR) AS error FROM p",
        "and_not": f"{full} SELECT message_id, 'lex_token::3' AS term_id, count(*) AS n FROM found WHERE feature = 'lex_token' GROUP BY message_id",
        "group_hit": f"{full} SELECT feature_id, hit, count(*) AS n FROM ev GROUP BY ALL",
        "category_order": f"{base} SELECT message_id, feature_id, CAST(any_value(category) AS BIGINT) AS category, row_number() OVER (PARTITION BY message_id ORDER BY any_value(category), feature_id) AS ord, bool_or(lost) AS bad FROM v GROUP BY message_id, feature_id",
        "short_circuit": f"{full} SELECT message_id, message_id IN (SELECT message_id FROM stopped) AS short_circuited, count(*) AS n_groups FROM ev GROUP BY message_id",
        "suppression": f"{full} SELECT message_id, area, attachment_id, s AS start_pos, s + len AS end_pos FROM fin WHERE feature_id = '3'",
        "hit_summary": f"{full} SELECT e.message_id, 'proc-1' AS process_id, e.feature_id AS id, e.name, CAST(e.total AS BIGINT) AS total_terms, (SELECT count(DISTINCT feature) FROM found f WHERE f.message_id = e.message_id AND f.feature_id = e.feature_id) AS n_terms, "
        f"x.feature || '::' || t.n AS term_id, CASE WHEN t.shown = '' THEN x.said ELSE t.shown END AS pattern, x.hits, {ts} AS created_ts FROM ev e LEFT JOIN (SELECT message_id, feature_id, feature, count(*) AS hits, "
        "arg_min(said, (CASE area WHEN 'SUBJECT' THEN 0 WHEN 'MESSAGE_BODY' THEN 1 ELSE 2 END, coalesce(attachment_id, ''), s)) AS said FROM found GROUP BY ALL) x USING (message_id, feature_id) LEFT JOIN terms t ON t.feature = x.feature",
        "hit_detail_restricted": full + _detail_sql(True),
        "hit_detail_unrestricted": full + _detail_sql(False),
        "feature_hit_summary": f"{full} SELECT message_id, ds AS dataset_partition_value, 'tag' AS feature_hit_type, CAST(feature_id AS BIGINT) AS id, name, feature_type AS type, nr = 'Y' AS is_nr, hit, CASE WHEN n_members > 1 THEN subs ELSE '' END AS subs FROM ev",
        "record_audit": f"{base} SELECT DISTINCT process_id, 'policy-alert-live' AS trigger_type, 'pe-1' AS pipelinex_exec_id, 'SCAN' AS stage_name, message_id AS record_id, 'FAILED' AS status, CAST(1 AS INTEGER) AS return_code, "
        f"'several members without an operator' AS error_message, DATE '2026-08-16' AS execution_date, 'tidemark' AS created_by, {ts} AS created_ts FROM v WHERE lost",
        "stage_audit": "SELECT 'proc-' || user_id AS process_id, event_type AS trigger_type, 'pe-' || event_id AS pipelinex_exec_id, 'SCAN' AS stage_name, CAST(NULL AS VARCHAR) AS composer_dag_name, CAST(NULL AS VARCHAR) AS composer_dag_path, "
        "CAST(NULL AS VARCHAR) AS dproc_dag_name, CAST(NULL AS VARCHAR) AS dproc_dag_path, ts AT TIME ZONE 'UTC' AS start_time, CASE WHEN s = 'END' THEN (ts + INTERVAL 5 MINUTE) AT TIME ZONE 'UTC' END AS end_time, "
        "CASE WHEN s <> 'END' THEN s WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS job_status, CASE WHEN s = 'END' AND event_type = 'error' THEN '0' END AS error_count, CASE WHEN s = 'END' AND event_type = 'error' THEN 'ValueError: ' || props END AS error_message, "
        "CAST(NULL AS VARCHAR) AS additional_info, CAST(ts AS DATE) AS execution_date FROM events, (VALUES ('IN_PROGRESS'), ('END')) t(s) WHERE s <> 'END' OR event_type <> 'signup'",
        "union_messages": f"{base} SELECT ds AS dataset_id, channel, count(*) AS n FROM msgs GROUP BY ALL",
    }
