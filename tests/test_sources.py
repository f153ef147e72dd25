import dataclasses
import datetime as dt
import json
import struct
import zlib

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.test_decide import lexicon, messages, view
from tidemark import __main__ as main
from tidemark import schemas
from tidemark.functions.text import Expression
from tidemark.operators.definitions import term_counts, term_id, terms
from tidemark.plans import fixture, job, outputs, sinks
from tidemark.sources import avro, paths, tables
from tidemark.streaming.scan import scan_stream


def test_uris_and_paths(spark, tmp_path):
    assert paths.parse_uri("gs://b/x/y") == ("b", "x/y")
    for bad in ("gs://b", "s3://b/x", None):
        with pytest.raises(ValueError):
            paths.parse_uri(bad)
    assert paths.patterns_path("b/", "f") == "b/f.hdb" and paths.terms_path("b/", "f") == "b/f-compile-results.json"
    with pytest.raises(ValueError):
        paths.patterns_path("b", "f")
    for n in ("20260101_101", "20260301_101", "20260401_102"):
        (tmp_path / n).mkdir()
    (tmp_path / "20260101_101" / "t.json").write_text("é")
    assert paths.resolve_base(spark, str(tmp_path), "101").endswith("/20260301_101/")
    with pytest.raises(FileNotFoundError):
        paths.resolve_base(spark, str(tmp_path), "9")
    assert len(paths.list_objects(spark, str(tmp_path))) == 1
    assert paths.read_text(spark, str(tmp_path / "20260101_101" / "t.json")) == "é" and paths.read_bytes(spark, str(tmp_path / "20260101_101" / "t.json")) == "é".encode()


def test_arguments():
    a = paths.RuntimeArgs.parse(json.dumps({"dataset_details": [{"dataset_id": "d", "dataset_partition_value": "p"}], "feature_partition_value": "f", "pipeline_exec_id": "e", "policy_engine_id": "1", "process_id": "q", "trigger_type": "t", "more": 1}))
    assert a.dataset_details[0].dataset_id == "d"
    with pytest.raises(KeyError):
        paths.RuntimeArgs.parse("{}")
    assert paths.message_bucket({"t": "b"}, "t") == "b"
    with pytest.raises(ValueError):
        paths.message_bucket({}, "t")
    with pytest.raises(KeyError):
        paths.TableConfig.parse("{}")["x"]


def test_terms(spark):
    t = fixture.terms(spark)
    assert t.filter("error is not null").count() == 0 and {x.feature: x.term_count for x in term_counts(t).collect()}["lex_token"] == 1
    bad = terms(spark.createDataFrame([("a", "x"), ("b", None), ("c", json.dumps({"results": [{"termId": "c", "compilationStatus": "PASS", "hyperscanExpressionId": 1}]})), ("d", '{"results":[]}')], "feature string, json string"))
    assert {x.feature for x in bad.filter("error is not null").collect()} == {"a", "b", "c"}
    d = spark.createDataFrame([("f", 3), (" ", 1)], "f string, n int").select(term_id("f", "n").alias("t"))
    assert [x.t for x in d.collect()] == ["f::3", None]


def test_datasets(spark, tmp_path):
    m = messages(spark, [("a", "s", "b", []), ("b", None, "c", [("x", "y")])])
    m.drop("dataset_id", "restricted", "processing").write.parquet(str(tmp_path / "ds/p/restricted"))
    d = tables.read_dataset(spark, str(tmp_path), "ds", "p", spark.createDataFrame([("b",), ("b",)], "message_id string"))
    row = d.collect()
    assert len(row) == 1 and row[0].restricted and row[0].processing is None and row[0].attachments[0].metadata.attachment_id == "x"
    with pytest.raises(tables.NoMessagesFound):
        tables.read_dataset(spark, str(tmp_path), "ds", "q")
    with pytest.raises(ValueError):
        tables.union_views([])


def test_job(spark, tmp_path):
    """The whole job: all tables, both audits, failure raised again."""
    rows = view(spark, [("a", "1", "Lexicon", "N", None, "lex"), ("z", "1", "Lexicon", "N", None, "lex"), ("z", "1", "Lexicon", "N", None, "lex2")])
    m = messages(spark, [("a", None, "a bomb", []), ("z", None, "x", []), ("other", None, "bomb", [])])
    e = spark.createDataFrame([("lex", 1, "bomb", "i", "plain")], "feature string, expression_id int, pattern string, flags string, kind string")
    args = paths.RuntimeArgs((paths.Dataset("ds", "part"),), "fp", "e", "101", "p", "t")
    names = ["lexicon_hit_summary", "lexicon_hit_restricted", "lexicon_hit_unrestricted", "feature_hit_summary", "pipeline_stage_audit", "pipeline_record_audit", "csv_mirror"]
    config = paths.TableConfig({n: str(tmp_path / n) for n in names})
    now = lambda: dt.datetime(2026, 8, 16, 10)
    read = lambda ds, part, ids: tables.relevant(m, ids)
    load = tables.lexicon_of(lexicon(spark, {"lex": [(1, [1], [])]}), e)
    job.run(spark, args, config, lambda: rows, read, load, now=now)
    got = {n: spark.read.parquet(config[n]) for n in names[:1] + names[2:6]}
    assert {x.message_id for x in got["lexicon_hit_summary"].collect()} == {"a"} and got["lexicon_hit_unrestricted"].count() == 1
    assert [x.record_id for x in got["pipeline_record_audit"].collect()] == ["z"] and got["feature_hit_summary"].first().feature_hit_type == "tag"
    assert sorted(x.job_status for x in got["pipeline_stage_audit"].collect()) == ["IN_PROGRESS", "SUCCESS"]
    # the same run again: each row once, but for the audit of the attempts; another run's rows are added
    before = {n: sorted(map(str, got[n].collect())) for n in got if n != "pipeline_stage_audit"}
    job.run(spark, args, config, lambda: rows, read, load, now=now)
    assert {n: sorted(map(str, spark.read.parquet(config[n]).collect())) for n in before} == before
    job.run(spark, dataclasses.replace(args, pipeline_exec_id="7"), config, lambda: rows, read, load, now=now, created_by="someone")
    both = sinks.read(spark, config["lexicon_hit_summary"], schemas.LEXICON_HIT_SUMMARY)
    assert sorted((x.pipeline_exec_id, x.created_by) for x in both.collect()) == [("7", "someone"), ("e", "tidemark")] and both.columns == schemas.LEXICON_HIT_SUMMARY.names
    with pytest.raises(ValueError):
        job.run(spark, args, config, lambda: rows.withColumn("feature_definition", F.lit("")), read, load, now=now)
    last = spark.read.parquet(config["pipeline_stage_audit"]).filter("job_status = 'FAILED'").collect()
    assert len(last) == 1 and last[0].error_count == "0" and "ValueError" in last[0].error_message


def test_main(spark, tmp_path):
    """From JSON files and folders alone: bucket by trigger, the latest lexicon folder, only the features that the view
    names; a feature without files and one with a pattern of unbounded cost fail their own messages."""
    (tmp_path / "lex/20260101_101").mkdir(parents=True)
    new = tmp_path / "lex/20260301_101"
    new.mkdir()
    term = lambda f: json.dumps({"results": [{"termId": f"{f}::1", "compilationStatus": "PASS", "translatedPattern": ["p"], "hyperscanExpressionId": 1}]})
    for f, pattern in (("lex", "bomb"), ("slow", r"(?:a+)+(?=b)"), ("other", "(")):
        (new / f"{f}-compile-results.json").write_text(term(f))
        (new / f"{f}-expressions.json").write_text(json.dumps({"expressions": [{"id": 1, "pattern": pattern, "flags": "i"}]}))
    ids = [("a", "lex"), ("b", "slow"), ("c", "none"), ("r", "lex")]
    view(spark, [(m, "1", "Lexicon", "N", None, f) for m, f in ids]).write.parquet(str(tmp_path / "view"))
    for name, keep in (("unrestricted", ("a", "b", "c")), ("restricted", ("r",))):
        messages(spark, [(m, None, "a Bomb aab", []) for m in keep]).drop("dataset_id", "restricted").write.parquet(str(tmp_path / f"live/ds/part/{name}"))
    names = ["lexicon_hit_summary", "lexicon_hit_restricted", "lexicon_hit_unrestricted", "feature_hit_summary", "pipeline_stage_audit", "pipeline_record_audit", "csv_mirror"]
    files = {
        "args": {"dataset_details": [{"dataset_id": "ds", "dataset_partition_value": "part"}], "feature_partition_value": "fp", "pipeline_exec_id": "e", "policy_engine_id": "101", "process_id": "p", "trigger_type": "live"},
        "tables": {n: str(tmp_path / n) for n in names} | {"feature_decision_view": str(tmp_path / "view")},
        "settings": {"message_roots": {"live": str(tmp_path / "live")}, "lexicon_root": str(tmp_path / "lex")},
    }
    for n, x in files.items():
        (tmp_path / f"{n}.json").write_text(json.dumps(x))
    argv = [str(tmp_path / f"{n}.json") for n in files]
    assert main.main(argv, spark) == 0 and main.main([], spark) == 2
    got = {n: spark.read.parquet(str(tmp_path / n)).collect() for n in names[:-1]}
    assert {x.message_id for x in got["lexicon_hit_unrestricted"]} == {"a"} and {x.message_id for x in got["lexicon_hit_restricted"]} == {"r"}
    errors = {x.record_id: x.error_message for x in got["pipeline_record_audit"]}
    assert set(errors) == {"b", "c"} and "looks around" in errors["b"] and "can't be read" in errors["c"]
    assert sorted(x.job_status for x in got["pipeline_stage_audit"]) == ["IN_PROGRESS", "SUCCESS"]
    (tmp_path / "args.json").write_text(json.dumps(files["args"] | {"policy_engine_id": "9"}))
    with pytest.raises(FileNotFoundError):
        main.main(argv, spark)
    assert "FAILED" in {x.job_status for x in spark.read.parquet(str(tmp_path / "pipeline_stage_audit")).collect()}


def test_run_stopped_between_sinks(spark, tmp_path, monkeypatch):
    """A run that dies after some of its tables, and in the midst of one, then runs again."""
    rows = view(spark, [(m, "1", "Lexicon", "N", None, "lex") for m in ("a", "b")])
    m = messages(spark, [("a", None, "a bomb", []), ("b", None, "bomb bomb", [])])
    e = spark.createDataFrame([("lex", 1, "bomb", "i", "plain")], "feature string, expression_id int, pattern string, flags string, kind string")
    args = paths.RuntimeArgs((paths.Dataset("ds", "part"),), "fp", "1", "101", "p", "t")
    names = ["lexicon_hit_summary", "lexicon_hit_restricted", "lexicon_hit_unrestricted", "feature_hit_summary", "pipeline_stage_audit", "pipeline_record_audit", "csv_mirror"]
    config = paths.TableConfig({n: str(tmp_path / n) for n in names})
    load = tables.lexicon_of(lexicon(spark, {"lex": [(1, [1], [])]}), e)
    go = lambda: job.run(spark, args, config, lambda: rows, lambda *x: m, load)

    def dies(d, target, fmt="parquet"):
        sinks.write_run(d.limit(1), target, schemas.FEATURE_HIT_SUMMARY, fmt)  # some of it is there already
        raise KeyboardInterrupt  # no audit row: the process is gone

    with monkeypatch.context() as p:
        p.setattr(sinks, "write_feature_hit_summary", dies)
        with pytest.raises(KeyboardInterrupt):
            go()
    go()
    for n, s in (("lexicon_hit_summary", schemas.LEXICON_HIT_SUMMARY), ("lexicon_hit_unrestricted", schemas.LEXICON_HIT_DETAIL), ("feature_hit_summary", schemas.FEATURE_HIT_SUMMARY)):
        assert sorted(x.message_id for x in sinks.read(spark, config[n], s).collect()) == ["a", "b"], n
    assert sorted(x.job_status for x in spark.read.parquet(config["pipeline_stage_audit"]).collect()) == ["IN_PROGRESS", "IN_PROGRESS", "SUCCESS"]


def test_run_goes_on_behind_its_evaluation(spark, tmp_path, monkeypatch):
    """A job that failed in a sink scans nothing when it is run again; one whose inputs have changed does."""
    (tmp_path / "lex/20260101_101").mkdir(parents=True)
    at = tmp_path / "lex/20260101_101"
    (at / "lex-compile-results.json").write_text(json.dumps({"results": [{"termId": "lex::1", "compilationStatus": "PASS", "translatedPattern": ["p"], "hyperscanExpressionId": 1}]}))
    (at / "lex-expressions.json").write_text(json.dumps({"expressions": [{"id": 1, "pattern": "bomb"}]}))
    view(spark, [(m, "1", "Lexicon", "N", None, "lex") for m in ("a", "b")]).write.parquet(str(tmp_path / "view"))
    messages(spark, [("a", None, "a bomb", []), ("b", None, "none", [])]).drop("dataset_id", "restricted").write.parquet(str(tmp_path / "live/ds/part/unrestricted"))
    names = ["lexicon_hit_summary", "lexicon_hit_restricted", "lexicon_hit_unrestricted", "feature_hit_summary", "pipeline_stage_audit", "pipeline_record_audit", "csv_mirror"]
    config = paths.TableConfig({n: str(tmp_path / n) for n in names} | {"feature_decision_view": str(tmp_path / "view")})
    args, settings = paths.RuntimeArgs((paths.Dataset("ds", "part"),), "fp", "e", "101", "p", "live"), paths.Settings({"live": str(tmp_path / "live")}, str(tmp_path / "lex"))
    scans = []
    evaluate = outputs.evaluate
    monkeypatch.setattr(outputs, "evaluate", lambda *a, **k: scans.append(1) or evaluate(*a, **k))
    with monkeypatch.context() as p:
        p.setattr(sinks, "write_hit_detail", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run_files(spark, args, config, settings)
    job.run_files(spark, args, config, settings)
    assert len(scans) == 1
    got = sinks.read(spark, config["lexicon_hit_unrestricted"], schemas.LEXICON_HIT_DETAIL).collect()
    assert [x.message_id for x in got] == ["a"] and sinks.read(spark, config["lexicon_hit_summary"], schemas.LEXICON_HIT_SUMMARY).count() == 2
    job.run_files(spark, args, config, settings)  # it succeeded: nothing is left to go on from
    assert len(scans) == 2
    with monkeypatch.context() as p:
        p.setattr(sinks, "write_csv_mirror", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run_files(spark, args, config, settings)
    (at / "lex-expressions.json").write_text(json.dumps({"expressions": [{"id": 1, "pattern": "none"}]}))
    job.run_files(spark, args, config, settings)
    assert len(scans) == 4 and [x.message_id for x in sinks.read(spark, config["lexicon_hit_unrestricted"], schemas.LEXICON_HIT_DETAIL).collect()] == ["b"]


def test_features_of_any_name(spark, tmp_path):
    """Names with blanks and with what readers take for patterns."""
    names = ["lex market", "lex[1]", "a+b", "50% {x}", "q?*", "é"]
    for f in names:
        (tmp_path / f"{f}-compile-results.json").write_text(json.dumps({"results": [{"termId": f"{f}::1", "compilationStatus": "PASS", "translatedPattern": ["p"], "hyperscanExpressionId": 1}]}))
        (tmp_path / f"{f}-expressions.json").write_text(json.dumps({"expressions": [{"id": 1, "pattern": "bomb"}]}))
    t, e = tables.load_lexicon(spark, f"{tmp_path}/")(names)
    assert {(x.feature, x.error) for x in t.collect()} == {(f, None) for f in names} and sorted(x.feature for x in e) == sorted(names)


def test_relevant_by_filter(spark, monkeypatch):
    """Of many ids a filter lets few others pass, right behind the scan; the join behind it is exact."""
    m = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("message_id"), F.col("id").alias("body"))
    ids = m.filter("body % 10 = 3").select("message_id")
    want = {f"m{k}" for k in range(3, 20_000, 10)}
    got = tables.relevant(m, ids.unionByName(ids))
    assert {x.message_id for x in got.collect()} == want and got.count() == 2000
    monkeypatch.setattr(tables, "FEW_IDS", 10)
    got = tables.relevant(m, ids)
    assert {x.message_id for x in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [pmod(xxhash64(message_id" in plan
    for n, blocks in ((2000, 1), (300_000, 3)):
        bloom = tables.id_filter(ids, n)
        assert bloom.count() == blocks and bloom.first().blocks == blocks
        through = {x.message_id for x in tables.passing(m, bloom, blocks).collect()}
        assert want <= through and len(through) < 2000 + 0.02 * 18_000
    assert tables.relevant(m.withColumn("message_id", F.lit(None).cast("string")), ids).count() == 0


def test_stand_in_format(spark, tmp_path):
    """Messages in another format than Parquet: the format is a parameter, as an Avro source's name would be."""
    messages(spark, [("a", "s", "b", [("x", "y")])]).drop("dataset_id", "restricted").write.format("orc").save(str(tmp_path / "ds/p/unrestricted"))
    row = tables.read_dataset(spark, str(tmp_path), "ds", "p", fmt="orc").first()
    assert row.message_id == "a" and not row.restricted and row.attachments[0].content.clean_text == "y"


def _zigzag(n):
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes((n,)))


META = {"type": "record", "name": "meta", "fields": [{"name": "attachment_id", "type": ["null", "string"]}, {"name": "size", "type": "double"}]}


def _encoded(schema, x):
    schema = META if schema == "meta" else schema  # named before
    if isinstance(schema, list):
        k = next(k for k, s in enumerate(schema) if (s == "null") == (x is None))
        return _zigzag(k) + _encoded(schema[k], x)
    kind = schema["type"] if isinstance(schema, dict) else schema
    if kind == "record":
        return b"".join(_encoded(f["type"], x[f["name"]]) for f in schema["fields"])
    if kind == "array":
        return (_zigzag(len(x)) + b"".join(_encoded(schema["items"], y) for y in x) if x else b"") + _zigzag(0)
    if kind == "map":
        body = b"".join(_encoded("string", k) + _encoded(schema["values"], v) for k, v in x.items())
        return (_zigzag(-len(x)) + _zigzag(len(body)) + body if x else b"") + _zigzag(0)
    if kind == "string":
        return _zigzag(len(x.encode())) + x.encode()
    return {"null": lambda: b"", "boolean": lambda: bytes((x,)), "int": lambda: _zigzag(x), "long": lambda: _zigzag(x), "double": lambda: struct.pack("<d", x), "enum": lambda: _zigzag(schema["symbols"].index(x)) if kind == "enum" else b""}[kind]()


def avro_file(schema, rows, codec, block=2):
    sync = bytes(range(16))
    out = avro.MAGIC + _zigzag(2) + b"".join(_encoded("string", k) + _encoded("string", v) for k, v in (("avro.schema", json.dumps(schema)), ("avro.codec", codec))) + _zigzag(0) + sync
    for k in range(0, len(rows), block):
        raw = b"".join(_encoded(schema, r) for r in rows[k : k + block])
        if codec == "deflate":
            raw = zlib.compress(raw)[2:-4]
        if codec == "snappy":
            raw = pa.compress(raw, codec="snappy", asbytes=True) + b"crc!"
        if codec == "zstandard":
            raw = zstandard.compress(raw)
        out += _zigzag(len(rows[k : k + block])) + _zigzag(len(raw)) + raw + sync
    return out


@pytest.mark.parametrize("codec", ["null", "deflate", "snappy", "zstandard"])
def test_avro(spark, tmp_path, codec):
    """Messages from Avro folders, restricted and not, as from Parquet: fields that a message lacks are left out, absent ones
    are null."""
    text = ["null", "string"]
    content = {"type": "record", "name": "content", "fields": [{"name": n, "type": text} for n in ("header", "raw_text", "subject")] + [{"name": "n", "type": "long"}]}
    att = {"type": "record", "name": "att", "fields": [{"name": "metadata", "type": META}, {"name": "content", "type": ["null", {"type": "record", "name": "ac", "fields": [{"name": "clean_text", "type": text}]}]}]}
    schema = {
        "type": "record", "name": "message", "namespace": "x", "fields": [
            {"name": "kind", "type": {"type": "enum", "name": "kind", "symbols": ["a", "b"]}}, {"name": "message_id", "type": "string"}, {"name": "tags", "type": {"type": "map", "values": "string"}},
            {"name": "message", "type": {"type": "record", "name": "body", "fields": [{"name": "content", "type": content}]}}, {"name": "attachments", "type": ["null", {"type": "array", "items": att}]}, {"name": "again", "type": ["null", "meta"]},
        ],
    }
    def row(k):
        return {
            "kind": "b", "message_id": f"m{k}", "tags": {"k": "v"} if k % 2 else {}, "message": {"content": {"header": None, "raw_text": f"é {k}", "subject": None if k % 3 else "s", "n": -k * 10**9}},
            "attachments": None if k % 4 == 0 else [{"metadata": {"attachment_id": f"a{j}", "size": 0.5}, "content": {"clean_text": "t"} if j else None} for j in range(k)], "again": None if k % 2 else {"attachment_id": "z", "size": 1.0},
        }

    for name, ks in (("restricted", range(3)), ("unrestricted", range(3, 8))):
        (tmp_path / f"ds/p/{name}").mkdir(parents=True)
        (tmp_path / f"ds/p/{name}/part.avro").write_bytes(avro_file(schema, [row(k) for k in ks], codec))
    d = tables.read_dataset(spark, str(tmp_path), "ds", "p", fmt="avro")
    assert d.schema["message"].dataType == schemas.MESSAGE["message"].dataType
    got = {x.message_id: x for x in d.collect()}
    assert set(got) == {f"m{k}" for k in range(8)}
    for k in range(8):
        x, want = got[f"m{k}"], row(k)
        assert x.restricted == (k < 3) and x.source is None and x.processing is None
        assert (x.message.content.raw_text, x.message.content.subject, x.message.content.clean_text) == (f"é {k}", want["message"]["content"]["subject"], None)
        assert (x.attachments is None) == (want["attachments"] is None)
        assert [(a.metadata.attachment_id, a.content and a.content.clean_text) for a in x.attachments or ()] == [(a["metadata"]["attachment_id"], a["content"] and "t") for a in want["attachments"] or ()]
    (tmp_path / "ds/p/restricted/bad.avro").write_bytes(b"no avro")
    with pytest.raises(Exception, match="not an Avro file"):
        tables.read_dataset(spark, str(tmp_path), "ds", "p", fmt="avro").count()


def test_stream(spark, tmp_path):
    m = messages(spark, [("a", "bomb", "a bomb", [])])
    m.write.parquet(str(tmp_path / "in"))
    s = scan_stream(spark.readStream.schema(m.schema).parquet(str(tmp_path / "in")), [Expression("lex", 1, "bomb")], ["lex"])
    q = s.writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert spark.table("found").count() == 2


def test_csv_mirror(spark, tmp_path):
    d = spark.createDataFrame([("a", [("1",)], True), ("b", [("2",)], False)], "message_id string, evaluated_lexicons array<struct<id:string>>, restricted boolean")
    for _ in range(2):
        sinks.write_csv_mirror(d, str(tmp_path / "m.csv"))
    got = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "m.csv")).collect()
    assert len(got) == 1 and "1" in got[0].evaluated_lexicons


def test_the_readers_ids_are_written_once(spark, monkeypatch):
    """Each dataset counts, filters and joins the ids: they are a table by then, not the view again."""
    from tidemark.plans import catalog

    seen = []
    monkeypatch.setattr(catalog, "deployed", lambda *x: "nowhere")
    monkeypatch.setattr(tables, "read_dataset", lambda s, root, ds, part, ids: seen.append(ids) or tables.tagged(spark.createDataFrame([], schemas.MESSAGE), ds, True))
    catalog.dataset_reader(spark, "/root/testdata/sf0.001")
    assert len(seen) == 2 and all(hasattr(d, "_tidemark_path") and d.columns == ["message_id"] for d in seen)
