"""Branch merge, lexical search and byte-level BPE against brute force, on nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns of clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import branch_merge, byte_bpe, lexical
from tidemark.llm.queries import op11_branch_merge, op12_lexical_search, op13_byte_bpe

DOCS = "doc_id long, text string, lang string, source string, ids string, decoded string, _text string, score int"


def table(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source); with extra columns of clashing names."""
    return spark.createDataFrame([(r[0], r[1], *(r[2:] or ("en", "s")), "x", "y", "z", 1) for r in rows], DOCS).repartition(3)


@pytest.fixture
def stored(spark, tmp_path):
    """Tables as the queries read them."""

    def put(docs, benchmark=()):
        table(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return put


# --- 11


def code(branch, doc_id, name):
    return zlib.crc32(f"{branch}:{'' if doc_id is None else doc_id}:{name}".encode()) % 11


def merged(rows):
    """The contract, row by row and unit by unit."""
    out, added = [], defaultdict(lambda: defaultdict(set))
    for doc_id, text, lang, source in ((a, b or "", c or "", d or "") for a, b, c, d in rows):
        row = [code(b, doc_id, "row") for b in "LR"]
        n = Counter()
        lines, new = text.split("\n"), []
        changes = [0, 0]

        def unit(base, left, right, kind, n=n, changes=changes):
            changes[0] += left != base
            changes[1] += right != base
            if left == right or right == base:
                n["clean"] += left != base
                return left
            if left == base:
                n["clean"] += 1
                return right
            n[kind(left, right)] += 1
            return base

        def column(value, c):
            return "" if c == 0 else value + "!" if c == 1 else value + "?" if c == 2 else value

        cols = [unit(v, *(column(v, code(b, doc_id, name)) for b in "LR"), lambda x, y: "ee") for name, v in (("lang", lang), ("source", source))]
        for k, line in enumerate(lines):
            cs = [code(b, doc_id, k) for b in "LR"]
            got = unit(line, *(None if c == 0 else line + "!" if c == 1 else line + "?" if c == 2 else line for c in cs), lambda x, y: "ed" if x is None or y is None else "ee")
            gap = unit(None, *("!" if c == 3 else "?" if c == 4 else None for c in cs), lambda x, y: "ii")
            new += [x for x in (got, gap) if x is not None]
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        if 0 in row:
            if (row[0] == 0 and row[1] != 0 and changes[1]) or (row[1] == 0 and row[0] != 0 and changes[0]):
                out.append((doc_id, lang, source, sha(text), 0, 0, 1, 0))
            else:
                out.append((doc_id, None, None, None, 1, 0, 0, 0))
        else:
            out.append((doc_id, *cols, sha("\n".join(new)), n["clean"], n["ee"], n["ed"], n["ii"]))
        for k, c in enumerate(row):
            if c in (3, 4):
                added[None if doc_id is None else -1 - k - doc_id][k].add((lang, source, "!?"[c - 3]))
    for key, by in added.items():
        values = set().union(*by.values())
        out.append((key, *next(iter(values))[:2], hashlib.sha256(next(iter(values))[2].encode()).hexdigest(), 1, 0, 0, 0) if len(values) == 1 else (key, None, None, None, 0, 0, 0, 1))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_branch_merge(spark, stored):
    r = random.Random(1)
    text = lambda: "\n".join(r.choice(["", "a", "é ü", "x" * 40, "\r"]) for _ in range(r.choice([1, 1, 2, 3, 12, 130])))
    rows = [(i, text(), r.choice(["en", "", None]), r.choice(["s", None])) for i in range(600)]
    rows += [(1000, None, None, None), (1001, "", "", ""), (1002, "\n", "de", "s"), (1003, "\n\n\n", "de", "s"), (None, "a\nb", "en", "s"), (None, "c", "en", "s"), (-7, "neg", "en", "s")]
    rows += [(5, "other text\nof a known id", "fr", "t")] + rows[10:40] + [(2000, "\n".join(map(str, range(20_000))), "en", "long")]
    got = [tuple(x) for x in op11_branch_merge(spark, stored(rows)).collect()]
    want = merged(rows)
    assert order(got) == order(want)
    assert all(any(x[k] for x in want) for k in (4, 5, 6, 7)) and sum(x[3] is None for x in want) > 5


def test_branch_merge_texts(spark):
    """The operator's own texts, columns by name, empty tables, and equal additions under one key."""
    assert branch_merge.merge(table(spark, [])).count() == 0
    d = table(spark, [(3, "a\nb\nc", "en", "s")])
    got = branch_merge.merge(d).filter("doc_id = 3").first()
    assert got.text == "a\nb\n!\nc" and (got.source, got.n_clean) == ("", 2)
    p = branch_merge.Params(branches=("one", "one"))
    same = branch_merge.merge(d, p).filter("doc_id = 3").first()
    assert same.n_edit_edit == same.n_edit_delete == same.n_insert_insert == 0
    keyed = branch_merge.merge(d.withColumnRenamed("lang", "label"), branch_merge.Params(columns=("label",)))
    assert keyed.columns == ["doc_id", "label", "text", *branch_merge.COUNTS]
    rows = [(k, "t", "en", "s" if k % 3 else "t") for k in range(400)]  # what L adds for k meets what R adds for k - 1
    want = merged(rows)[400:]
    assert order(tuple(x)[:3] for x in branch_merge.added_rows(table(spark, rows)).collect()) == order(x[:3] for x in want) and {x[7] for x in want} == {0, 1}
    assert sum(x[4] for x in want) < sum(code(b, k, "row") in (3, 4) for b in "LR" for k in range(400)) - 2 * sum(x[7] for x in want)  # equal ones count once


# --- 12

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def searched(rows, items, k=50):
    lower = lambda t: [x for x in TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))]
    docs = [(a, Counter(lower(t))) for a, t in rows]
    docs = [x for x in docs if x[1]]
    n, total, df = len(docs), sum(sum(c.values()) for _, c in docs), Counter(t for _, c in docs for t in c)
    want = defaultdict(set)
    for i, t in items:
        want[i].update(lower(t))
    out = []
    for i, terms in want.items():
        got = []
        for a, c in docs:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                got.append((-s, (a is None, a or 0)))
        out += [(i, r, None if a[0] else a[1], -s) for r, (s, a) in enumerate(sorted(got)[:k], 1)]
    return out


@pytest.mark.parametrize("shard", [400, 8_000_000])
def test_lexical_search(spark, shard):
    r = random.Random(2)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "ÜNÏ", "A1", "a1", "the", "THE"]
    text = lambda: r.choice([" ", ", ", "\n"]).join(words[min(int(r.expovariate(0.12)), len(words) - 1)] for _ in range(r.choice([0, 1, 3, 20, 60])))
    rows = [(i, text()) for i in range(500)] + [(7, "w1 w2"), (None, "w1 w2 w3"), (None, "w59"), (900, None), (901, "... --"), (902, "w0 " * 5000)]
    rows += [(1000 + i, "tie w58 tie") for i in range(80)]  # more than k equal scores
    items = [(i, text()) for i in range(30)] + [(30, "tie"), (31, None), (32, "..."), (33, "nowhere"), (None, "w1"), (None, "W2"), (34, "w1 w1 w1"), (34, "w5")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    p = lexical.Params(shard_bytes=shard, query_bytes=500)
    got = [tuple(x) for x in lexical.search(lexical.index(d, p), spark.createDataFrame(items, "item_id long, text string"), p).collect()]
    want = searched(rows, items)
    assert order(got) == order(want) and len(want) > 1000
    few = lexical.Params(k=3, shard_bytes=shard)
    got = [tuple(x) for x in lexical.search(lexical.index(d, few), spark.createDataFrame(items, "item_id long, text string"), few).collect()]
    assert order(got) == order(searched(rows, items, 3))


def test_lexical_search_query(spark, stored):
    rows = [(i, f"Alpha beta{i % 3} gamma{i}") for i in range(90)]
    at = stored(rows, [(1, "alpha BETA1"), (2, "gamma7 beta2")])
    assert order(tuple(x) for x in op12_lexical_search(spark, at).collect()) == order(searched(rows, [(1, "alpha BETA1"), (2, "gamma7 beta2")]))


def test_lexical_search_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.index(table(spark, [])), some).count() == 0
    assert lexical.search(lexical.index(table(spark, [(1, "a")])), none).count() == 0
    assert lexical.search(lexical.index(table(spark, [(1, None), (2, "-")])), some).count() == 0


def test_packed_numbers():
    v = np.concatenate([np.arange(300), 2 ** np.arange(62), [127, 128, 16383, 16384]])
    raw, ends = lexical.packed(v)
    assert lexical.unpacked(raw).tolist() == v.tolist() and ends[-1] == len(raw)
    assert lexical.unpacked(lexical.packed(np.zeros(0, np.int64))[0]).tolist() == []


# --- 13

PARAMS = byte_bpe.Params(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load(open(PARAMS.path, "rb").read())


def odd_texts(r, n):
    some = [" ", "  ", "a", "the", "ing", "é", "中文", "😀", "\n", "\t", "123", "'s", "<|endoftext|>", "==", " " * 9, "ZZ", "\xa0", "́", "0x"]
    return ["".join(r.choice(some) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_transducer(ranks):
    """As the library encodes, with few states kept too; and brute force for a small vocabulary."""
    own = tiktoken.Encoding("own", pat_str=PARAMS.pattern, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    texts = [*odd_texts(r, 300), " " * 3000, "a" * 5000, "ab" * 2000, "".join(r.choice("abcdefghij") for _ in range(8000))]
    cut = byte_bpe.regex.compile(PARAMS.pattern).findall
    for states in (100_000, 50):
        pieces = byte_bpe.Pieces(byte_bpe.Transducer(ranks, states), states)
        for t in texts:
            assert np.frombuffer(b"".join(map(pieces.__getitem__, cut(t))), "<u4").tolist() == own.encode_ordinary(t)
        assert len(pieces.machine.known) <= states
    small = {bytes((b,)): b for b in range(256)}
    for merge in (b"ab", b"bc", b"abc", b"ca", b"cab", b"aa", b"aab", b"bb", b"aabb"):
        small[merge] = len(small)
    small[b"cccc"] = len(small)  # no merges lead to it
    machine = byte_bpe.Transducer(small)
    for _ in range(3000):
        raw = "".join(r.choice("abc") for _ in range(r.randint(1, 14))).encode()
        want = [small[raw]] if raw in small else [small[x] for x in byte_bpe.merged(raw, small)]
        assert np.frombuffer(machine.encode(raw), "<u4").tolist() == want


def test_bounded_lookahead(ranks):
    """A state's open tokens stay few however long a piece is."""
    machine, s = byte_bpe.Transducer(ranks), None
    s = machine.start
    for b in b"ab" * 3000:
        s = machine.step(s, b)[1]
        assert max(len(w) for w, _, _ in s.guesses) < 10


def test_utf8_machine(ranks):
    r = random.Random(4)
    for _ in range(3000):
        x = bytes(r.choice([r.randint(0, 255), 0x41, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xF4, 0x90]) for _ in range(r.randint(0, 10)))
        u, k = byte_bpe.Utf8(), r.randint(0, 10)
        assert (u.feed(x[:k]) + u.feed(x[k:]) + u.finish()).decode() == x.decode("utf-8", "replace")
    d = byte_bpe.Decoder(ranks)
    tokens = {i: t for t, i in ranks.items()}
    for _ in range(300):
        ids = np.array([r.randrange(len(ranks)) for _ in range(r.randint(0, 12))], np.int64)
        k = r.randint(0, 12)
        assert (d.feed(ids[:k]) + d.feed(ids[k:]) + d.finish()).decode() == b"".join(tokens[i] for i in ids.tolist()).decode("utf-8", "replace")
    with pytest.raises(ValueError):
        d.feed(np.array([60_000]))


def test_decoding_by_places(ranks, monkeypatch):
    """Whole-character tokens are copied by their places, and only open ones, up to the next border, take the machine."""
    d, fed = byte_bpe.Decoder(ranks), []
    feed = byte_bpe.Utf8.feed
    monkeypatch.setattr(byte_bpe.Utf8, "feed", lambda u, raw: fed.append(raw) or feed(u, raw))
    ids = np.array([ranks[b"the"], ranks[b"\xf0"], ranks[b"\x9f"], ranks[b"\x98"], ranks[b"\x80"], ranks[b"a"], ranks[b"\x80"], ranks[b"the"], ranks[b"\xf0"]])
    assert (d.feed(ids) + d.feed(ids[:1]) + d.finish()).decode() == "the\U0001f600a\ufffdthe\ufffdthe"
    assert fed == [b"\xf0", b"\x9f", b"\x98", b"\x80", b"\x80", b"\xf0", b"the"]
    assert d.feed(np.zeros(0, np.int64)) == b"" and byte_bpe.Decoder({}).feed(np.zeros(0, np.int64)) == b""


def test_a_token_is_merged_once(ranks, monkeypatch):
    """The halves of a token tell that it is their merge."""
    n, merged = [0], byte_bpe.merged
    monkeypatch.setattr(byte_bpe, "merged", lambda *x: n.__setitem__(0, n[0] + 1) or merged(*x))
    machine = byte_bpe.Transducer(ranks)
    assert n[0] == sum(len(t) > 1 for t in ranks) and all(merged(t, ranks) == [t] for t, i in list(ranks.items())[256::500] if i in machine.halves)


def test_byte_bpe_query(spark, stored, ranks):
    own = tiktoken.Encoding("own", pat_str=PARAMS.pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, t) for i, t in enumerate(odd_texts(random.Random(5), 60))] + [(100, None), (101, ""), (None, "a"), (None, "a"), (102, "long words " * 30_000)]
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert order(tuple(x) for x in op13_byte_bpe(spark, stored(rows)).collect()) == order(want)
    assert byte_bpe.decode(byte_bpe.encode(table(spark, []), PARAMS), PARAMS).count() == 0
    d = byte_bpe.decode(byte_bpe.encode(table(spark, rows), PARAMS, keep=("doc_id", "decoded")).withColumnRenamed("decoded", "was"), PARAMS, portion=7)
    assert order((x.doc_id, x.t) for x in d.select("doc_id", F.decode("decoded", "utf-8").alias("t")).collect()) == order((i, t or "") for i, t in rows)
