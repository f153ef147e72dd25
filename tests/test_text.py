import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import patterns, sql
from tidemark.functions.text import JAVA_SPACE, Expression, Lexicon, Stripped, all_ends, check_expression, is_blank, literal_positions, scan, scan_text, strip_markup, within_size
from tidemark.operators.candidates import candidates, folded, found_directly, index


def test_strip_and_places():
    s = Stripped("<p>Enjoy</p>\n<p>Happy Birthday</p>")
    assert s.text == " Enjoy Happy Birthday "
    i = s.text.index("Enjoy Happy")
    assert (s.original(i), s.original(i + 11)) == (3, 21)
    assert Stripped("a < b").text == "a < b" and Stripped(None).text == "" and Stripped("<a><b> <c>").text == " "
    assert Stripped("x\xa0\xa0y").text == "x\xa0\xa0y"  # no-break spaces are text


def test_strip_column_equals_kernel(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["<", ">", "<b>", "</p>", " ", "\n", "\x1c", " ", "\xa0", "a", "é"]) for _ in range(r.randint(0, 30))) for _ in range(300)] + [None, ""]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", strip_markup(F.col("t")).alias("s"))
    assert {x.i: x.s for x in d.collect()} == {i: Stripped(t).text for i, t in enumerate(texts)}


def brute(text, pattern):
    p = re.compile(pattern, re.I)
    ends = {}
    for b in range(1, len(text) + 1):
        for a in range(b):
            if p.fullmatch(text, a, b):
                ends[b] = a
                break
    return sorted(((a, b) for b, a in ends.items()), key=lambda x: x[1])


def test_all_ends_against_brute_force():
    assert all_ends("aaa", "a+") == [(0, 1), (0, 2), (0, 3)]
    assert all_ends("aaaa", "aa") == [(0, 2), (1, 3), (2, 4)]
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice("abAB ") for _ in range(r.randint(0, 14)))
        for pattern in ("a+b", "ab", "a|ab", "[ab]{2,3}", "b.?a", "aa"):
            assert all_ends(text, pattern) == brute(text, pattern), (text, pattern)


PATTERNS = ["a+b", "ab|ba", "(a|ab)(b|a)?", "[ab]{2,3}", "a.?b", "(?:a|b)+b", "(a+)+b", "a*b*a", "^a+", "[^b]+", "(?:ab){1,2}", "x{0}a", r"\w+ \w+", "(?:a+b?)*a", "(?:ab|b+a?)+", "(?:(?:ab)*b )+", "a(?:b|ba|aab)*b"]


def test_automaton_against_brute_force():
    r = random.Random(5)
    for _ in range(150):
        text = "".join(r.choice("abAB \n") for _ in range(r.randint(0, 12)))
        for pattern in PATTERNS:
            assert patterns.linear_ends(text, pattern, "i") == brute(text, pattern) == all_ends(text, pattern), (text, pattern)


def test_automaton_places():
    """Conditions on places hold in the whole text."""
    for pattern, text, want in ((r"\bab", "ab xab ab", [(0, 2), (7, 9)]), ("a+$", "aa aa\n", [(3, 5)]), (r"a+\Z", "aa aa", [(3, 5)]), (r"a\B", "ab a", [(0, 1)]), ("(?:^|,)a", "a,a", [(0, 1), (1, 3)])):
        assert patterns.linear_ends(text, pattern, "i") == want, pattern


def test_no_pattern_explodes():
    start = time.time()
    assert all_ends("a" * 3000 + "!", "(a+)+$") == [] and len(all_ends("ab" * 500, "(a|b|ab)*c?")) == 1000
    # a megabyte, one unbounded repeat
    assert len(all_ends("a" * 1_000_000, "[a-z]+")) == 1_000_000
    text = "buy " + "some words here " * 62_500 + "x"
    assert all_ends(text, "buy.*x") == [(0, len(text))] and all_ends("no " + text[4:], "buy.*x") == []
    words = "some words here " * 62_500
    assert all_ends(words + "x", r"(?:\w+\s?)+x") == [(0, 1_000_001)] and all_ends("!" + words, r"(?:[a-z]+ )*here ,") == []
    assert all_ends("a" * 200_000 + "b", "(a|a){30}b") == [(199_970, 200_001)] and all_ends("a" * 100_000, "((a{1,200}){1,200})*b") == []
    assert time.time() - start < 20
    for bad in (r"(a+)+\1", "(?:a*)*(?=b)", "(", "a++b", "[[:nothing:]]", r"\p{Nothing}"):
        assert check_expression(Expression("f", 1, bad)) is not None, bad
    assert check_expression(Expression("f", 1, r"a+\.b")) is None


CLASSES = {"alpha": str.isalpha, "digit": str.isdigit, "alnum": str.isalnum, "upper": str.isalpha, "lower": str.isalpha, "space": str.isspace, "punct": lambda c: c in "!-]_", "blank": lambda c: c in " \t", "xdigit": lambda c: c in "0123456789abcdefABCDEF"}


def test_posix_classes():
    """Against the same patterns with each class written out, and by the filter and the scan as by the matcher."""
    some = "aZ9 \t\n!-]_éf"
    r = random.Random(8)
    for name, has in CLASSES.items():
        inside = "".join(re.escape(c) for c in some if has(c) and c.isascii())
        for pattern, plain in ((f"[[:{name}:]]{{2}}", f"[{inside}]{{2}}"), (f"[[:{name}:]]+[[:digit:]]+", f"[{inside}]+[0-9]+"), (f"a[^[:{name}:]-]?Z", f"a[^{inside}-]?Z"), (f"[x[:^{name}:]]+", f"[^{inside}]+"), (f"[][:{name}:]]+", f"[\\]{inside}]+")):
            for _ in range(30):
                text = "".join(r.choice(some) for _ in range(r.randint(0, 12)))
                got = all_ends(text, pattern)
                assert got == brute(text, plain) == patterns.linear_ends(text, pattern, "i"), (text, pattern)
                squeezed = Stripped(text).text
                assert [x[3] for x in scan_text(text, [Expression("f", 1, pattern)])] == ([squeezed[a:b] for a, b in all_ends(squeezed, pattern)] if text.strip() else []), (text, pattern)


def test_other_syntax():
    for pattern, text, want in (
        (r"\p{Lu}\p{L}+", "x Éa", [(2, 4)]), (r"\P{L}", "aé1", [(2, 3)]), (r"[\p{Greek}x]+", "αxβ", [(0, 1), (0, 2), (0, 3)]), (r"\Qa+b\E", "aab a+b", [(4, 7)]), (r"\x{e9}t", "été", [(0, 2)]), (r"a\hb", "a\xa0b", [(0, 3)]),
        ("a{e}", "a{e}", [(0, 4)]), ("[a&&b]", "&", [(0, 1)]), ("[[a]", "[", [(0, 1)]), (r"a\z", "ba", [(1, 2)]), ("(?i:A)b", "ab aB", [(0, 2)]),
    ):
        assert all_ends(text, pattern, "") == want, pattern


def test_required_literals():
    need = lambda p, f="i": patterns.required(p, f)
    assert need(r"mit license\.") == ("license.",) and need("(foo|barn)x+") == ("barn", "foo") and need("a?") is None and need(r"\d+") is None
    assert need("(?:abc){2}d*") == ("abc",) and need("Straße") == ("Straße",) and need("x| ") is None
    # a match implies the literal, whatever the case
    assert all_ends("\u017fecret \u212ane", "secret") == [(0, 6)] and scan_text("the \u017fecret", [Expression("f", 1, "secret")]) == [(1, 4, 10, "\u017fecret")]
    r = random.Random(6)
    for _ in range(300):
        text = "".join(r.choice("abAB k\u212a\u017fs") for _ in range(r.randint(0, 14)))
        for pattern in ("a+b", "ab ks", "(?:ab|ba)k", "s[ab]k+", "kk|ss"):
            if all_ends(text, pattern):
                assert any(patterns.fold(w) in patterns.fold(text) for w in patterns.required(pattern, "i"))


def test_filter_ahead(spark):
    """What the filter ahead of Python keeps out has no match."""
    r = random.Random(7)
    e = [Expression("f", 5, "stra\u00dfe a"), Expression("f", 6, "\u0130x."), Expression("f", 1, "secret key"), Expression("f", 2, "mit\x00license", kind="combination"), Expression("g", 3, r"tok(en|ens)\b"), Expression("h", 4, r"\d{3}")]
    texts = ["".join(r.choice(["stra\u00dfe a", "STRA\u1e9eE a", "\u0130x.", "ix.", "secret", "SECRET", "\u017fecret", " ", "<b>", "key", "mit", "licen\u017fe", "token", "12", "3", "\n"]) for _ in range(r.randint(0, 8))) for _ in range(300)]
    rows = [(str(i), "MESSAGE_BODY", 1, None, t, fs) for i, t in enumerate(texts) for fs in (["f"], ["g"], ["f", "h"])]
    d = spark.createDataFrame(rows, "message_id string, area string, area_ord int, attachment_id string, text string, features array<string>")
    got = sorted((x.message_id, x.expression_id, x.start, x.end, x.text) for x in scan(d, e).collect())
    want = sorted((m, *x) for m, _, _, _, t, fs in rows for x in scan_text(t, [y for y in e if y.feature in fs]))
    assert got == want and want
    # the same by the index of literals
    every = spark.createDataFrame([(str(i), 1, t) for i, t in enumerate(texts)], "message_id string, area_ord int, text string")
    may = candidates(every, index(every, Lexicon(e)), "message_id")
    d = d.join(may.withColumn("candidates", F.transform("candidates", lambda x: x["expression"])), "message_id", "left")
    assert sorted((x.message_id, x.expression_id, x.start, x.end, x.text) for x in scan(d, e).collect()) == want
    many = [Expression("f", k, f"word{k}x") for k in range(200)] + e[2:3]
    assert scan_text("a word7x and word77x, secret key", many) == [(7, 2, 8, "word7x"), (77, 13, 20, "word77x"), (1, 22, 32, "secret key")]


def test_scan_text():
    e = [Expression("f", 1, "insider"), Expression("f", 2, "mit\x00license", kind="combination")]
    assert scan_text("an Insider  <b>x</b> MIT license", e) == [(1, 3, 10, "Insider"), (2, 21, 32, "MIT license")]
    assert scan_text(" \n", e) == [] and scan_text(None, e) == []


def test_small_predicates(spark):
    d = spark.createDataFrame([(1, None), (2, " \t"), (3, "é"), (4, "abc")], "i int, t string")
    rows = {x.i: (x.b, x.w) for x in d.select("i", is_blank(F.col("t")).alias("b"), within_size(F.col("t"), 2).alias("w")).collect()}
    assert rows == {1: (True, True), 2: (True, True), 3: (False, True), 4: (False, False)}


def test_literal_positions(spark):
    d = spark.createDataFrame([(1, "License é license"), (2, "none"), (3, None)], "i int, text string")
    assert sorted(tuple(x) for x in literal_positions(d, "license").collect()) == [(1, 0, 7), (1, 10, 17)]


def test_folding(spark):
    """Letters that match in any case are folded to the same: what the matcher takes as equal meets in the index."""
    pairs = [("\u00df", "\u1e9e"), ("k", "\u212a"), ("s", "\u017f"), ("i", "\u0130"), ("\u03c3", "\u03c2"), ("\u03a3", "\u03c2"), ("\u00b5", "\u03bc"), ("\u00e5", "\u212b"), ("\u03b8", "\u03d1"), ("\u1e61", "\u1e9b"), ("\ufb05", "\ufb06"), ("\u03b9", "\u1fbe"), ("\u0390", "\u1fd3"), ("A", "a"), ("\u01c4", "\u01c6")]
    every = [chr(c) for c in range(0x20, 0x2fff) if chr(c).isalpha()]
    pairs += [(c, d) for c in every for d in {c.lower(), c.upper()} if len(d) == 1 and d != c and re.fullmatch(c, d, re.I)]
    d = spark.createDataFrame([(f"x{a}y {a}", f"x{b}y {b}") for a, b in pairs], "a string, b string").select("a", "b", folded(F.col("a")).alias("fa"), folded(F.col("b")).alias("fb"))
    assert d.filter("fa <> fb").collect() == []


def test_many_expressions(spark):
    """Thousands of expressions: what the index lets through is what a full scan finds."""
    r = random.Random(9)
    syllable = lambda: "".join(r.choice("bcdfgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3)))
    vocabulary = [syllable() for _ in range(2000)]
    e = [Expression(f"f{k % 7}", k, r.choice(["{}", r"\b{}\b", "{}[a-z]*", "({}|{})x?", "{} {}", "{}.{{0,9}}{}", "[0-9]+ {}"]).format(*(r.choice(vocabulary) for _ in range(2)))) for k in range(3000)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 25))) for _ in range(60)]
    rows = [(str(i), "MESSAGE_BODY", 1, None, t, ["f1", "f4", "f6"]) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "message_id string, area string, area_ord int, attachment_id string, text string, features array<string>")
    lexicon = Lexicon(e)
    may = candidates(d, index(d, lexicon), "message_id").withColumn("candidates", F.transform("candidates", lambda x: x["expression"]))
    n = may.select(F.explode("candidates")).count()
    got = sorted((x.message_id, x.expression_id, x.start, x.end) for x in scan(d.join(may, "message_id", "left"), lexicon).collect())
    own = [x for x in e if x.feature in ("f1", "f4", "f6")]
    assert got == sorted((str(i), x.expression_id, a, z) for i, t in enumerate(texts) for x in own for a, z in all_ends(t, x.pattern)) and len(got) > 500
    assert n < 0.2 * len(e) * len(texts)


def test_sql_surface(spark):
    """The table function's columns follow its arguments, its lexicon is checked at analysis; the function of columns."""
    sql.register(spark)
    lexicon = json.dumps([{"feature": "f", "id": 7, "pattern": "b[a-z]m"}, {"feature": "g", "id": 8, "pattern": "in{2}\x00bam", "kind": "combination"}])
    d = spark.createDataFrame([(1, "a Bom <b> bam"), (2, None), (3, "inn bam")], "i int, t string")
    got = spark.sql("SELECT i, m.* FROM {d} d, LATERAL scan_matches(t, :l) m", args={"l": lexicon}, d=d)
    rows = [(1, "f", 7, 2, 5, "Bom"), (1, "f", 7, 10, 13, "bam"), (3, "f", 7, 4, 7, "bam"), (3, "g", 8, 0, 7, "inn bam")]
    assert got.columns == ["i", "feature", "expression_id", "start", "end", "text"] and sorted(tuple(x) for x in got.collect()) == rows
    assert spark.sql("SELECT m.* FROM {d} d, LATERAL scan_matches(t, :l, with_text => false) m", args={"l": lexicon}, d=d).columns == ["feature", "expression_id", "start", "end"]
    for bad in ('[{"id": 1, "pattern": "("}]', "[{]"):
        with pytest.raises(Exception):
            spark.sql("SELECT * FROM scan_matches('x', :l)", args={"l": bad}).collect()
    by = sql.matcher([Expression("f", 7, "b[a-z]m"), Expression("g", 8, "in{2}\x00bam", kind="combination")])
    got = d.select("i", F.inline(by(F.col("t")))).collect()
    assert sorted(tuple(x) for x in got) == rows


def test_lengths_apart(monkeypatch):
    """Patterns of few lengths are searched for length by length: the matches are those of all places at once."""
    some = ["th[a-z]{1,3}d", "[0-9]{4,6}", "a(?:b|ba)?b", "(?:ab|b)a?", r"\ba{1,2}b?", "a?b$", "^a?b", "[^a]{1,2}b", "(?:a.){1,2}b", "(?:x|ab{0,2})a", "a{0,1}[aA]b"]
    r = random.Random(12)
    for _ in range(150):
        text = "".join(r.choice("abAB \n") for _ in range(r.randint(0, 14))) + r.choice(["", "12345678", "thadthxxd", "Thd thaad\n"])
        for pattern in some:
            for flags in ("i", "", "im", "is"):
                assert all_ends(text, pattern, flags) == patterns.linear_ends(text, pattern, flags), (text, pattern, flags)
    dense = "a" * 2000
    assert all_ends(dense, "a{2,4}") == patterns.linear_ends(dense, "a{2,4}", "i")
    # a long text in which little matches isn't carried through place by place
    monkeypatch.setattr(patterns, "linear_ends", lambda *x: pytest.fail("all places at once"))
    assert all_ends("no such words " * 5000 + "third 12345", "th[a-z]{1,3}d") == [(70_000, 70_005)]


def test_single_blanks_stand_for_themselves():
    """Against the plain rule: each run of tags and white space becomes one blank, at its own place."""
    r = random.Random(13)
    runs = re.compile(rf"(?:<[^>]*>|[{re.escape(JAVA_SPACE)}])+")
    for _ in range(2000):
        text = "".join(r.choice(["<", ">", "<b>", " ", " ", "\n", "\x1c", "\xa0", "a", "\u2003"]) for _ in range(r.randint(0, 14)))
        s = Stripped(text)
        assert s.text == runs.sub(" ", text)
        at = [k for m in re.finditer(rf"{runs.pattern}|(?s:.)", text) for k in [m.start()]]
        assert [s.original(k) for k in range(len(s.text))] == at and s.original(len(s.text)) == len(text), text
    assert len(Stripped("word " * 1000)._at) < 5  # one entry a blank before


def test_few_literals(spark):
    """A lexicon of few literals is looked for in the texts themselves: no word is counted, and every match is a candidate."""
    e = [Expression("f", 1, "stra\u00dfe a"), Expression("f", 2, "mit\x00license", kind="combination"), Expression("g", 3, "(?:foo|barn)x+"), Expression("h", 4, r"\d{3}"), Expression("h", 5, "\u0130x")]
    r = random.Random(14)
    texts = ["".join(r.choice(["stra\u00dfe a", "STRA\u1e9eE a", "ix", "I\u0307X", "mit", "licen\u017fe", "License", " ", "<b>", "FOOx", "barn", "xx", "123", "\n"]) for _ in range(r.randint(0, 8))) for _ in range(300)]
    d = spark.createDataFrame([(str(i), 1, t) for i, t in enumerate([*texts, None])], "message_id string, area_ord int, text string")
    got = {x.message_id: {c.expression for c in x.candidates} for x in found_directly(d, Lexicon(e), "message_id").collect()}
    keys = {k: x.expression_id for k, x in enumerate(e)}
    for i, t in enumerate(texts):
        assert {x[0] for x in scan_text(t, e) if x[0] != 4} <= {keys[k] for k in got[str(i)]}, t
    assert got[str(len(texts))] == set() and sum(map(len, got.values())) < 4 * len(texts)
