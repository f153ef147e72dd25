import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import Expression, Lexicon
from tidemark.operators import decide
from tidemark.operators.definitions import check_definitions, terms, with_definition
from tidemark.plans import catalog, outputs



def stamp():
    return F.to_timestamp(F.lit("2026-08-16 10:00:00"))


def definition(feature, scope=("Message Body", "subject", "Attachment"), total=2):
    return json.dumps({"body": {"feature": feature, "totalTermsCount": total, "scope": list(scope)}})


def view(spark, rows):
    """rows: (message_id, feature_id, type, nr, operator, pattern set, scope)."""
    out = []
    for mid, fid, kind, nr, op, feature, *scope in rows:
        out.append(("p", mid, "part", "tag", kind, fid, f"n{fid}", "Lexicon", feature, nr, op, definition(feature, *scope), "fp", "101"))
    return spark.createDataFrame(out, schemas.VIEW)


def messages(spark, rows):
    """rows: (message_id, subject, body, [(attachment id, text)])."""
    out = [(m, None, ((None, body, subject, None),), [((a, None, None), (t,)) for a, t in att], None, "ds", False) for m, subject, body, att in rows]
    from pyspark.sql import types as T

    return spark.createDataFrame(out, T.StructType([*schemas.MESSAGE.fields, T.StructField("dataset_id", T.StringType()), T.StructField("restricted", T.BooleanType())]))


def lexicon(spark, feature_terms):
    """feature -> [(term, required, excluded)]."""
    rows = []
    for f, ts in feature_terms.items():
        r = [{"termId": f"{f}::{n}", "compilationStatus": "PASS", "translatedPattern": [f"p{n}"], "requiredExpressionIds": req, "excludedExpressionIds": exc} for n, req, exc in ts]
        rows.append((f, json.dumps({"results": r})))
    return terms(spark.createDataFrame(rows, "feature string, json string"))


@pytest.fixture(scope="module")
def run(spark):
    def go(m, v, t, e, limit=None):
        vv = view(spark, v)
        r = outputs.evaluate(messages(spark, m), vv, lexicon(spark, t), e, limit)
        return r

    return go


def test_tree(run):
    """Short circuit, suppression by containment in the same area, AND NOT across areas, partial AND groups, failures."""
    e = [Expression("nr", 1, "spam"), Expression("disc", 1, "this is confidential information"), Expression("lex", 1, "information"), Expression("lex", 2, "bomb"), Expression("an", 5, "insider"), Expression("an", 6, "disclosed")]
    t = {"nr": [(1, [1], [])], "disc": [(1, [1], [])], "lex": [(1, [1], []), (2, [2], [])], "an": [(3, [5], [6])]}
    base = lambda m: [(m, "1", "NoiseReduction", "Y", None, "nr"), (m, "2", "DISCLAIMER", "N", None, "disc"), (m, "3", "Lexicon", "N", None, "lex"), (m, "4", "Lexicon", "N", "AND", "an"), (m, "4", "Lexicon", "N", "AND", "nr")]
    m = [
        ("stop", None, "spam bomb", []),
        ("sup", None, "This is confidential information. bomb information", [("a1", "information")]),
        ("not", "disclosed", "insider", []),
        ("fires", None, "insider trading", []),
        ("bad", None, "bomb", []),
    ]
    v = [x for k in ("stop", "sup", "not", "fires") for x in base(k)] + [("bad", "9", "Lexicon", "N", None, "lex"), ("bad", "9", "Lexicon", "N", None, "an")]
    r = run(m, v, t, e)
    g = {(x.message_id, x.feature_id): x for x in r.groups.collect()}
    assert [k for k in g if k[0] == "stop"] == [("stop", "1")] and g["stop", "1"].short_circuited
    assert not g["not", "4"].hit and not g["fires", "4"].hit and g["sup", "3"].hit
    final = {(x.message_id, x.feature, x.area, x.start) for x in outputs.final_matches(r).collect()}
    assert final == {("sup", "lex", "MESSAGE_BODY", 34), ("sup", "lex", "MESSAGE_BODY", 39), ("sup", "lex", "ATTACHMENT", 0), ("fires", "an", "MESSAGE_BODY", 0)}
    assert {x.message_id: x.error for x in r.messages.collect() if x.error} == {"bad": "several members without an operator"}
    s = {x.message_id: x.evaluated_lexicons for x in outputs.hit_summary(r, "e", "b", stamp()).collect()}
    counts = {t.term_id: t.regex_match_hit_count for x in s["sup"] if x.id == "3" for t in x.term_dtls}
    assert counts == {"lex::1": 3, "lex::2": 1} and set(s) == {"stop", "sup", "not", "fires"}  # before suppression
    d = {x.message_id: x for x in outputs.hit_detail(r, "e", "b", stamp()).collect()}
    assert set(d) == {"sup", "fires"}
    j = json.loads(d["sup"].evaluated_lexicons[0].term_dtls[0].matched_text)["hit_details_hs"][0]
    assert j["msg_text"] == [{"text": "information", "start": 39, "length": 11}] and j["subject"] == []
    assert j["attachment_text"] == [{"attachment_id": "a1", "att_text": [{"text": "information", "start": 0, "length": 11}]}]
    f = {x.message_id: x.features for x in outputs.feature_hit_summary(r, F.lit("tag"), "e", "b", stamp()).collect()}
    assert [x.id for x in f["sup"]] == [1, 2, 3, 4] and [y.hit_status for y in f["sup"][3].sub_features] == [False, False] and f["sup"][0].sub_features is None
    audit = outputs.record_audit(r, "t", "e", "S", "b", F.current_date(), stamp()).collect()
    assert [(x.record_id, x.status, x.return_code) for x in audit] == [("bad", "FAILED", 1)]


def test_scope_limit_and_required(run):
    e = [Expression("lex", 7, "bomb"), Expression("dec", 10, "one"), Expression("dec", 11, "two"), Expression("dec", 13, "no")]
    t = {"lex": [(7, [7], [])], "dec": [(9, [10, 11], [13])]}
    m = [("a", "bomb", "bomb one", [("x", "bomb two")]), ("b", None, "one", [])]
    v = [("a", "1", "Lexicon", "N", None, "lex", ("Message Body",)), ("a", "2", "Lexicon", "N", None, "lex"), ("a", "3", "Lexicon", "N", None, "dec"), ("b", "3", "Lexicon", "N", None, "dec")]
    r = run(m, v, t, e)
    n = r.found.groupBy("message_id", "feature_id").count().collect()
    assert {(x.message_id, x.feature_id): x["count"] for x in n} == {("a", "1"): 1, ("a", "2"): 3, ("a", "3"): 2}
    r = run(m, v, t, e, 5)
    assert {x.area for x in r.found.collect()} == {"MESSAGE_BODY", "SUBJECT"}


def test_errors(run, spark):
    e = [Expression("lex", 1, "bomb")]
    v = [("a", "x1", "Lexicon", "N", None, "lex"), ("b", "1", "Lexicon", "N", None, "two"), ("c", "1", "Lexicon", "N", "OR", "lex"), ("c", "1", "Other", "N", "OR", "lex"), ("d", "1", "Lexicon", "N", None, "lex")]
    m = [("a", None, "bomb", []), ("b", None, "bomb", []), ("c", None, "bomb", []), ("d", None, "ok", [(None, "bomb")])]
    r = run(m, v, {"lex": [(1, [1], [])], "two": [(1, [4], []), (2, [4], [])]}, e)
    err = {x.message_id: x.error for x in r.messages.collect()}
    assert err["a"].startswith("feature_id is no number") and "two terms claim expression 4" in err["b"] and err["c"].startswith("feature_type differs") and "no id" in err["d"]
    bad = spark.createDataFrame([("f", None), ("g", "{oops"), ("h", '{"body":{}}')], "feature_id string, feature_definition string")
    assert with_definition(bad).filter("definition_error is null").count() == 0
    with pytest.raises(ValueError):
        check_definitions(bad)


def test_order_and_duplicates(spark):
    v = view(spark, [("m", "1", "Lexicon", "N", None, "a"), ("m", "2", "disclaimer", "N", None, "b"), ("m", "3", "X", "Y", "OR", "c"), ("m", "3", "X", "Y", "OR", "c"), ("m", "4", "NoiseReduction", "y", None, "d")])
    m = decide.members(v)
    g = sorted(decide.grouped(m).collect(), key=lambda x: x.ord)
    assert [x.feature_id for x in g] == ["3", "2", "1", "4"] and g[0].n_members == 2 and g[0].group_error is None
    assert m.filter("seq <> same_as").count() == 1


def test_copies_apart(run, spark):
    """One id in two datasets and in both folders: each copy is judged by its own texts."""
    e, t = [Expression("lex", 1, "bomb"), Expression("disc", 1, "no bomb here")], {"lex": [(1, [1], [])], "disc": [(1, [1], [])]}
    v = view(spark, [("m", "1", "Lexicon", "N", None, "lex"), ("m", "2", "Disclaimer", "N", None, "disc")])
    base = messages(spark, [("m", None, "a bomb", [])])
    said = lambda text, ds, flag: messages(spark, [("m", None, text, [])]).withColumns({"dataset_id": F.lit(ds), "restricted": F.lit(flag)})
    m = base.withColumn("restricted", F.lit(True)).unionByName(said("nothing", "ds", False)).unionByName(said("no bomb here", "other", False)).unionByName(said("x bomb", "other", True)).unionByName(said("x bomb", "other", True))
    r = outputs.evaluate(m, v, lexicon(spark, t), e)
    d = sorted((x.dataset_partition_value, x.restricted, json.loads(x.evaluated_lexicons[0].term_dtls[0].matched_text)["hit_details_hs"][0]["msg_text"][0]["start"]) for x in outputs.hit_detail(r, "e", "b", stamp()).collect())
    assert d == [("ds", True, 2), ("other", True, 2), ("other", True, 2)]
    s = [sum(y.regex_hit_count for y in x.evaluated_lexicons) for x in outputs.hit_summary(r, "e", "b", stamp()).collect()]
    assert sorted(s) == [0, 1, 1, 1, 2] and outputs.feature_hit_summary(r, F.lit("t"), "e", "b", stamp()).count() == 5
    assert [x.suppressed for x in outputs.suppressed_counts(r).collect() if x.suppressed] == [1]


def test_containment_without_pairs(spark):
    """As by all pairs; and a hundred thousand spans of either kind in one text."""
    r = random.Random(3)
    spans = [(f"m{r.randint(0, 3)}", r.choice(["B", "A"]), r.choice([None, "x"]), a := r.randint(0, 30), a + r.randint(1, 9), r.random() < 0.4) for _ in range(300)]
    d = spark.createDataFrame(spans, "copy string, area string, attachment_id string, start int, end int, d boolean")
    got = sorted(map(str, ((x.copy, x.area, x.attachment_id, x.start, x.end, x.contained) for x in decide.with_contained(d, F.col("d")).collect())))
    assert got == sorted(map(str, ((*s[:5], any(o[5] and o[:3] == s[:3] and o[3] <= s[3] and s[4] <= o[4] for o in spans)) for s in spans if not s[5])))
    n = 100_000
    k = spark.range(2 * n).select(F.lit("m").alias("copy"), F.lit("B").alias("area"), F.lit(None).cast("string").alias("attachment_id"), (F.col("id") / 2).cast("int").alias("start"), ((F.col("id") / 2).cast("int") + F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 6)).cast("int").alias("end"), (F.col("id") % 2 == 0).alias("d"))
    found = decide.with_contained(k, F.col("d"))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == n


def test_one_layout(run, spark):
    """Behind the copies' layout nothing is shuffled by the copy again, neither for the tables of results nor in them."""
    e, t = [Expression("lex", 1, "bomb"), Expression("disc", 1, "no bomb")], {"lex": [(1, [1], [])], "disc": [(1, [1], [])]}
    r = run([("a", None, "a bomb", [])], [("a", "1", "Lexicon", "N", None, "lex"), ("a", "2", "Disclaimer", "N", None, "disc")], t, e)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for d in (outputs.hit_summary(r, "e", "b", stamp()), outputs.hit_detail(r, "e", "b", stamp()), outputs.feature_hit_summary(r, F.lit("t"), "e", "b", stamp()), outputs.suppressed_counts(r)):
            assert "Exchange" not in d._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_few_literals_need_no_index(run, monkeypatch):
    monkeypatch.setattr(outputs, "index", lambda *x: pytest.fail("the words of all texts are counted"))
    r = run([("a", None, "a BOMB <b> here", [("x", "no")])], [("a", "1", "Lexicon", "N", None, "lex")], {"lex": [(1, [1], []), (2, [2], [])]}, [Expression("lex", 1, "bomb"), Expression("lex", 2, "[0-9]+ here")])
    assert [(x.term_id, x.start, x.end) for x in r.found.collect()] == [("lex::1", 2, 6)]


def test_nothing_by_copy_is_broadcast(run, spark):
    """However small the tables look: rows of all copies stay where they are."""
    e, t = [Expression("lex", 1, "bomb"), Expression("disc", 1, "no bomb")], {"lex": [(1, [1], [])], "disc": [(1, [1], [])]}
    r = run([("a", None, "a bomb", [])], [("a", "1", "Lexicon", "N", None, "lex"), ("a", "2", "Disclaimer", "N", None, "disc")], t, e)
    for d in (r.groups, r.found, outputs.hit_summary(r, "e", "b", stamp()), outputs.hit_detail(r, "e", "b", stamp()), outputs.feature_hit_summary(r, F.lit("t"), "e", "b", stamp()), outputs.suppressed_counts(r)):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan


def test_texts_go_for_what_their_features_ask(spark):
    lex = Lexicon([Expression("nr", 1, "rights"), Expression("lex", 1, "bomb"), Expression("lex", 2, "with")])
    d = spark.createDataFrame([(["nr"], [1, 2]), (["lex"], [0, 2]), ([], [0])], "features array<string>, candidates array<int>")
    assert [x[0] for x in d.select(lex.asked_for(F.col("candidates"), F.col("features"))).collect()] == [[], [2], []]
    assert [x[0] for x in d.select(lex.asked_for(F.col("candidates"), F.col("features"), 2)).collect()] == [[1, 2], [0, 2], [0]]


def test_flat_details_are_made_once(run):
    """Occurrences of all areas in one pass over the details, other columns along with them."""
    e, t = [Expression("lex", 1, "bomb")], {"lex": [(1, [1], [])]}
    r = run([("a", "Bomb", "a bomb, bomb", [("x", "the BOMB"), ("y", "no")]), ("b", None, "nothing", [])], [("a", "1", "Lexicon", "N", None, "lex"), ("b", "1", "Lexicon", "N", None, "lex")], t, e)
    d = catalog._flat_detail(outputs.hit_detail(r, "e", "b", stamp()), "restricted")
    assert d.columns == ["message_id", "dataset_partition_value", "id", "term_id", "area", "attachment_id", "said", "start_pos", "length", "restricted"]
    assert sorted((x.area, x.attachment_id or "", x.said, x.start_pos, x.length) for x in d.collect()) == [("ATTACHMENT", "x", "bomb", 4, 4), ("MESSAGE_BODY", "", "bomb", 2, 4), ("MESSAGE_BODY", "", "bomb", 8, 4), ("SUBJECT", "", "bomb", 0, 4)]
    assert d._jdf.queryExecution().optimizedPlan().toString().count("tidemark_found") == 1
