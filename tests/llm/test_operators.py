"""Each operator against a brute-force version on small tables with nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, html_extract, induced, licenses, mixing, ngram_join, pii, quality_crf, quality_rules, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kind string, words string"


def docs(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source); with two extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


# --- 1


def common(a, b, cap):
    n = 0
    while n < min(cap, len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("fan", [3, 512])
def test_suffix_order(monkeypatch, fan):
    """Order and common prefixes, with everything recursive and on disk too."""
    monkeypatch.setattr(induced.Queue, "FAN", fan)
    r = np.random.RandomState(0)
    for _ in range(150):
        t = r.randint(0, r.choice([1, 2, 5, 60]) + 1, r.randint(1, 70))
        x = t.tolist()
        want = sorted(range(len(x)), key=lambda i: x[i:])
        lcp = [0, *(common(x[a:], x[b:], 7) for a, b in zip(want, want[1:]))]
        for memory, base in ((10**6, 10**6), (3, 0), (30, 0)):
            order, got = induced.suffix_order(t, memory, base, 7)
            assert order.tolist() == want and got.tolist() == lcp


def test_external_shard(monkeypatch):
    """A shard of forty times the memory: tuples go to disk, and memory holds a part of what the shard's tuples take."""
    monkeypatch.setattr(induced, "BLOCK", 1 << 12)
    r = np.random.RandomState(1)
    peaks = []
    for n in (100_000, 400_000):
        store = induced.Store(10_000, 20_000)
        text = induced.as_text(r.randint(0, 4, n), store, 8)
        tracemalloc.start()
        total = 0
        for pos, _ in induced.suffixes(text, store, 8):
            total += len(pos)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert total == n and store.spilled > n
        store.close()
    assert peaks[1] < 3 * peaks[0] and peaks[1] < 0.4 * n * induced.TUPLE.itemsize


def brute_dedup(rows, length=100):
    """rows: (doc_id, text, tie)."""
    seen, out = {}, {}
    for d, tie, x in sorted({(-1 if r[0] is None else r[0], r[2] if len(r) > 2 else 0, r[1] or "") for r in rows}):
        raw = x.encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                mark[s : s + length] = b"\1" * length
            seen[w] = 1
        kept = bytes(b for b, m in zip(raw, mark) if not m)
        out[d, x] = (len(raw), len(raw) - len(kept), sum(1 for i in range(len(raw)) if mark[i] and not (i and mark[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark):
    r = random.Random(3)
    parts = ["a", "bb", "\n", "the of and", "x" * 50, "é", "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 50)))) for i in range(120)]
    rows += [(900, "z" * 5000), (901, None), (902, ""), (903, "ab" * 3000), (904, "z" * 99), (905, "z" * 100), (None, "q" * 150), rows[5], rows[5]]
    got = suffix_dedup.dedup(docs(spark, rows)).collect()
    want = {d: v for (d, _), v in brute_dedup([(*x, x[1] or "") for x in rows]).items()}
    assert len(got) == len(rows)
    for x in got:
        assert tuple(x)[1:] == want[-1 if x.doc_id is None else x.doc_id], x.doc_id
    # small pieces and shards; everything on disk; every gram hot
    for small in (suffix_dedup.Params(piece=700, shard_bytes=500, memory=50, base=10), suffix_dedup.Params(hot_contexts=-1000, hot_sample=1, hot_windows=100), suffix_dedup.Params(hot_contexts=3, hot_sample=1)):
        assert sorted(map(str, suffix_dedup.dedup(docs(spark, rows), small).collect())) == sorted(map(str, got))
    assert suffix_dedup.dedup(docs(spark, rows).limit(0)).count() == 0
    k = suffix_dedup.dedup(docs(spark, [(1, "w" * 120)]), keep_text=True).first()
    assert bytes(k.kept) == b"" and [(s.start, s.end) for s in k.removed] == [(0, 120)] or (k.n_removed, [(s.start, s.end) for s in k.removed]) == (119, [(1, 120)])


def test_suffix_dedup_shared_ids(spark):
    """Texts of one id, or of none, are documents of their own, in the order of their texts' hashes."""
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = [(r.choice([None, None, 7, 8, i + 100]), f"{i} " + passage[r.randint(0, 200) :][: r.randint(50, 250)] + f" {i}") for i in range(60)]
    ties = {x.text: (x.a, x.b) for x in docs(spark, rows).selectExpr("text", "xxhash64(1, text) a", "xxhash64(2, text) b").collect()}
    want = brute_dedup([(d, t, ties[t]) for d, t in rows])
    d = docs(spark, rows).repartition(1).sortWithinPartitions("n_chars", "text")
    got = suffix_dedup.dedup(d, keep_text=True).collect()
    assert sorted((-1 if x.doc_id is None else x.doc_id, *tuple(x)[1:5]) for x in got) == sorted((k[0], *v) for k, v in want.items())


def test_suffix_dedup_hot_cells(spark):
    """Only a gram that many contexts share makes its cell hot, however many grams there are."""
    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz "
    texts = ["".join(r.choices(letters, k=5000)) for _ in range(400)]
    passage = "".join(r.choices(letters, k=100))
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").selectExpr("doc_id", "0L t0", "0L t1", "text")
    p = suffix_dedup.Params(hot_contexts=8, hot_sample=1)
    assert not suffix_dedup.hot_cells(frame(texts), p).any()
    hot = suffix_dedup.hot_cells(frame([x[:2500] + passage + x[2500:] for x in texts]), p)
    assert 0 < hot.sum() <= len(passage) - p.gram + 1  # a cell a gram of the passage at most


def test_suffix_dedup_disk(spark, monkeypatch):
    """When the result is read, nothing of the steps before it is on disk any more but their tables, each repeat once."""
    r = random.Random(5)
    passage = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = [(i, f"{i} " + passage[r.randint(0, 200) :][: r.randint(50, 250)] + f" {i}") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    written = {}
    monkeypatch.setattr(suffix_dedup, "materialise", lambda df, name, f=suffix_dedup.materialise: written.setdefault(name, f(df, name)))
    was, conf = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = suffix_dedup.dedup(d)
    until = time.time() + 20
    while (left := shuffled() - was) and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == conf
    spans = written["spans"].filter(F.col("kind") == suffix_dedup.SPAN).select("doc_id", "start", "end")
    assert spans.count() and not spans.intersect(written["repeats"].select("doc_id", "start", "end")).count()
    want = brute_dedup([(*x, x[1]) for x in rows])
    assert sorted((x.doc_id, *tuple(x)[1:5]) for x in out.collect()) == sorted((k[0], *v) for k, v in want.items())


# --- 2

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_groups(rows):
    s = {}
    for d, x in rows:
        w = WORD.findall((x or "").translate(LOWER))
        s[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    root = {d: d for d in s}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s[d]), find(d)) for d in s}


def test_ngram_join(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        words = [r.choice(vocabulary) for _ in range(r.choice([3, 5, 6, 30, 80, 200]))]
        for _ in range(12):
            w = list(words)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.3:
                w += [r.choice(vocabulary) for _ in range(r.randint(0, len(w) // 6 + 1))]
            rows.append((len(rows), " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "a b c d e"), (906, "A b c d e"), (907, "a b c d e f")]
    got = ngram_join.join(docs(spark, rows + [rows[3], rows[3]])).collect()
    want = brute_groups(rows)
    assert len(got) == len(rows) + 2
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert ngram_join.join(docs(spark, rows).limit(0)).count() == 0
    # null and shared ids: linked by their texts, through texts of no id too
    words = [f"v{i}" for i in range(60)]
    say = lambda k: " ".join(words[:k] + [f"u{k}"] + words[k + 1 :])
    chain = [(5, say(3)), (None, " ".join(words)), (6, say(40)), (6, "quite another text of six words"), (None, None), (None, "alone in the world it is")]
    got = {(x.doc_id, x.n_shingles): x for x in ngram_join.join(docs(spark, chain)).collect()}
    assert {k: x.component_id for k, x in got.items()} == {(5, 56): 5, (None, 56): 5, (6, 56): 5, (6, 2): 6, (None, 0): None, (None, 2): None}
    assert len({got[k].component for k in ((5, 56), (None, 56), (6, 56))}) == 1 and got[None, 0].component is None
    few = ngram_join.Params(broadcast_ids=0, broadcast_groups=0, sketch_bits=8, fragments=3)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join(docs(spark, rows), few).collect()} == want


# --- 3


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing(spark):
    r = random.Random(7)
    rows = [(i, None if i % 17 == 0 else " ".join("w" * r.randint(0, 30)), "en", r.choice(["a", "b", "b", "b", "É", "z", None])) for i in range(400)] + [(1, "x y z", "en", "a")] * 3
    d = docs(spark, rows)
    p = mixing.Params(bucket_rows=7)
    got = mixing.mix(d, p).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = brute_targets(sizes), Counter()
    assert len(got) == len(rows)
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source]) and 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    assert sorted(map(str, mixing.mix(d.repartition(5), p).select("doc_id", "taken").collect())) == sorted(map(str, mixing.mix(d, p).select("doc_id", "taken").collect()))
    # the mix itself, row by row: rows of null and shared ids, clashing names
    odd = rows[:400] + [(None, "a b c", "en", "a"), (None, "z", "en", "a"), (None, "z", "en", None), (3, "one two", "en", "b"), (3, "one", "en", "b"), *[(None, "k k", "en", "b")] * 5]
    d = docs(spark, odd).withColumns({"_key": F.lit(1), "row": F.lit(2), "bucket": F.lit(3), "size": F.lit(4), "epoch": F.lit(5)})
    mixed = mixing.mix(d, p)
    assert {"_key", "row", "bucket", "epoch", "words"} < set(mixed.columns) and mixed.first()._key == 1 and mixed.first().bucket == 3
    want = Counter()
    for x in mixed.collect():
        want[x.doc_id, x.n_chars, x.source] += x.taken
    got = Counter()
    for x in mixing.emit(d, p).collect():
        assert x.words == len(WORD.findall(x.text)) and x.row == 2
        got[x.doc_id, x.n_chars, x.source] += x.words
    assert got == +want and mixing.emit(d, p).columns == [*[c for c in d.columns if c not in ("epoch", "words")], "epoch", "words"]
    # the cut is where the hashes' order puts it: whole documents before it, none after
    for s in sizes:
        epochs = {(x.taken // x.size, x.taken % x.size > 0) for x in mixed.filter(F.col("source").eqNullSafe(F.lit(s))).collect() if x.size}
        assert len({e for e, part in epochs if not part}) <= 2 and sum(part for _, part in epochs) <= 1
    assert mixing.mix(d.limit(0)).count() == 0 == mixing.emit(d.limit(0)).count()


# --- 4


def tokens(text):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", (text or "").lower()).split()


def brute_overlap(doc, item):
    """The most equal tokens of a run on a diagonal that counts as an overlap; all runs of all diagonals."""
    x, y = tokens(doc), tokens(item)
    need, best = len(y) if len(y) < 6 else min(13, -(-8 * len(y) // 10)), 0
    for shift in range(-len(y) + 1, len(x)):
        k0, k1 = max(0, -shift), min(len(y), len(x) - shift)
        eq = [x[shift + k] == y[k] for k in range(k0, k1)]
        if sum(eq) < need:
            continue
        for i in range(len(eq)):
            n = 0
            for j in range(i, len(eq)):
                n += eq[j]
                if n >= need and 4 * n >= 3 * (j + 1 - i):
                    best = max(best, n)
    return best


def test_masks():
    """Every 16 tokens of which any 4 differ have a seed; every overlap with a short item has 3 equal tokens in a row."""
    masks = [[k for k, b in enumerate(m) if b == "1"] for m in decontaminate.Params().masks]
    for differ in itertools.combinations(range(16), 4):
        assert any(all(a + k not in differ for k in m) for m in masks for a in range(16 - m[-1]))
    for n in range(6, 17):
        need = int(decontaminate.needed(n, decontaminate.Params()))
        for size in range(need, min(n, int(need / 0.75)) + 1):
            for differ in itertools.combinations(range(size), size - need):
                assert any(not {a, a + 1, a + 2} & set(differ) for a in range(size - 2))


def test_decontaminate(spark):
    """Against all runs of all diagonals, with substitutions of any density, the period of 4 included."""
    r = random.Random(9)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    fill = lambda n: " ".join(r.sample(words, n))
    items = [(i, fill(n)) for i, n in enumerate([1, 2, 3, 5, 6, 7, 9, 12, 15, 16, 17, 18, 20, 25, 30, 40, 50, 60] * 2)] + [(90, None), (90, ""), (91, "!?"), (92, "Two tokens"), (93, "two, tokens."), (None, fill(20))]
    rows = [(i, fill(r.randint(0, 60))) for i in range(40)] + [(900, None), (901, ""), (902, "a " * 3000), (903, "we say two tokens"), (904, "two such tokens"), (905, items[4][1].rsplit(" ", 1)[0])]
    for i, (_, text) in enumerate(items):
        for share in (0, 4, 5, 3, None):
            t = (text or "").split()
            for k in range(len(t)):
                if share and k % share == share - 1 or share is None and r.random() < 0.22:
                    t[k] = r.choice(words)
            cut = r.choice([0, 0, len(t) // 4])
            rows.append((1000 + 10 * i + (9 if share is None else share), fill(r.randint(0, 9)) + ". " + " ".join(t[cut:]).upper() + "! " + fill(r.randint(0, 9))))
    rows += [rows[60], (None, rows[61][1]), (1000, "another text of a shared id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(docs(spark, rows), bench).collect()
    want = Counter()
    for d, t in rows:
        for i, text in {(-1 if i is None else i, x) for i, x in items if x}:
            if n := brute_overlap(t, text):
                want[d, i, n] += 1
    assert Counter((x.doc_id, x.item_id, x.matched_tokens) for x in got) == want and len(want) > 150
    text, said = {d: t for d, t in rows if d}, dict(items)
    for x in got:
        if x.doc_id not in (None, 1000) and x.item_id >= 0 and x.item_id < 90:
            run = tokens(text[x.doc_id])[x.start : x.start + x.run_tokens]
            y = tokens(said[x.item_id])
            assert any(sum(a == b for a, b in zip(run, y[k : k + len(run)])) == x.matched_tokens for k in range(len(y) - len(run) + 1))
    many = decontaminate.Params(block_bytes=1000)
    assert sorted(map(str, decontaminate.matches(docs(spark, rows), bench, many).collect())) == sorted(map(str, got))
    found = {d for d, _, _ in want}
    for p in (many, decontaminate.Params()):
        kept = decontaminate.clean(docs(spark, rows), bench, p)
        assert Counter(x.doc_id for x in kept.collect()) == Counter(d for d, t in rows if not any(brute_overlap(t, i[1]) for i in items if i[1])) and kept.columns == docs(spark, rows).columns
    assert found and decontaminate.matches(docs(spark, rows), bench.limit(0)).count() == 0 == decontaminate.matches(docs(spark, rows).limit(0), bench).count()


def test_hot_seeds():
    """Equal items and a passage that repeats within a text: diagonals are compared at once, equal items once."""
    item = " ".join(f"w{k}" for k in range(50))
    index = decontaminate.Index([(i, item) for i in range(300)] + [(i, item + f" x{i}") for i in range(300, 400)], decontaminate.Params())
    start = time.time()
    got = decontaminate.find([((item + " ") * 40).encode()], index)
    assert len(got) == 101 and time.time() - start < 20


# --- 5


def brute_licenses(text):
    low = lambda s: re.findall(r"[^\W_]+", s.lower())
    grams = lambda s: {(a, b) for a, b in zip(low(s), low(s)[1:])}
    found = {}
    bits = [text, *re.split(r"\n[ \t\r\x0b\x0c]*\n", text), *text.split("\n")]
    bits += [x for line in text.split("\n") for x in re.split(r"(?<=[.!?])(?=[ \t\r])", line)]
    for part in bits:
        a = grams(part)
        for name, t in licenses.TEMPLATES:
            b = grams(t)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.85:
                found[name] = max(found.get(name, 0), 2 * len(a & b) / (len(a) + len(b)))
    return found


def test_licenses(spark):
    r = random.Random(11)
    rows = [(0, None), (1, ""), (2, "the license of the software in the world " * 50)]
    for i in range(60):
        t = r.choice(licenses.TEMPLATES)[1].split()
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = r.choice(["the", "of", "xx", "license"])
        rows.append((10 + i, r.choice(["", "Intro text here. ", "First line\n", "Para\n\n"]) + r.choice([" ", "\n"]).join(t) + r.choice(["", " More words follow.", "\nmore"])))
    got = {}
    for x in licenses.scan(docs(spark, rows + [rows[12]]), licenses.Params(resolve=False)).collect():
        got.setdefault(x.doc_id, {})[x.license] = pytest.approx(x.dice)
    assert got == {i: f for i, t in rows if (f := brute_licenses(t or ""))}
    assert licenses.scan(docs(spark, rows).limit(0)).count() == 0


def brute_windows(text):
    """The best of all windows over the words, for each licence."""
    low = lambda s: re.findall(r"[^\W_]+", s.lower())
    w, found = low(text), {}
    grams = list(zip(w, w[1:]))
    for name, t in licenses.TEMPLATES:
        b = list(zip(low(t), low(t)[1:]))
        for i in range(len(grams)):
            seen = set()
            for j in range(i, min(len(grams), i + int(len(b) * 1.15 / 0.85 + 1e-9))):
                seen.add(grams[j])
                dice = 2 * len(seen & set(b)) / (len(seen) + len(set(b)))
                if dice >= 0.85:
                    found[name] = max(found.get(name, 0), dice)
    return found


def test_license_families(spark):
    """Each template, wrapped amid prose, is found as itself, not as its relatives."""
    rows = []
    for i, (name, t) in enumerate(licenses.TEMPLATES):
        w = f"some prose before it {t} and code after it".split()
        rows.append((i, "".join(x + ("\n// " if k % 9 == 8 else " ") for k, x in enumerate(w))))
    got = {}
    for x in licenses.scan(docs(spark, rows), licenses.Params(windows=True)).collect():
        got.setdefault(x.doc_id, []).append(x.license)
    assert got == {i: [name] for i, (name, _) in enumerate(licenses.TEMPLATES)}


def test_license_windows(spark):
    r = random.Random(12)
    fill = lambda: " ".join(r.choice(["some", "wrapped", "prose", "of", "the", "license", "or", "software"]) for _ in range(r.randint(0, 25)))
    rows = [(0, None), (1, ""), (2, "We wrote this. It was\nReleased under\nthe MIT License. Then more\nprose follows here.")]
    for i in range(40):
        t = licenses.TEMPLATES[i % len(licenses.TEMPLATES)][1].split()
        for _ in range(r.randint(0, 4)):
            t.insert(r.randrange(len(t)), r.choice(["the", "of", "xx"]))
        w = f"{fill()} {' '.join(t)} {fill()}".split()
        rows.append((10 + i, "".join(x + ("\n" if k % 9 == 8 else " ") for k, x in enumerate(w))))
    got = {}
    for x in licenses.scan(docs(spark, rows), licenses.Params(windows=True, resolve=False)).collect():
        got.setdefault(x.doc_id, {})[x.license] = pytest.approx(x.dice)
    want = {}
    for i, t in rows:
        a, b = brute_licenses(t or ""), brute_windows(t or "")
        if a or b:
            want[i] = {k: max(a.get(k, 0), b.get(k, 0)) for k in a | b}
    assert got == want and "MIT" in got[2] and not brute_licenses(rows[2][1])


# --- 6


def test_chat(spark):
    r = random.Random(13)
    says = ["", None, "hi", "</s>[INST] ok [/INST]", "back\\slash\\", "<<SYS>> x <</SYS>>", "[", "<", "a\\", "<<ROLE:x>>", "é\n"]
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant"]) if r.random() < 0.8 else r.choice(["system", None, "tool>\\"]), "same start" if t == 0 and c % 3 else r.choice(says)))
    rows += [(61 + k, t, x, "copy") for k in range(20) for t, x in enumerate(["user", "assistant"])] + [(99, t, "user", f"long {t}") for t in range(300)]
    d = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, node string")
    nodes, leaves = chat.pack(d)
    got = {x.conv_id: x for x in chat.read_back(nodes, leaves).collect()}
    conv = {}
    for c, _, role, text in sorted(rows, key=lambda x: x[:2]):
        conv.setdefault(c, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(conv)
    for c, turns in conv.items():
        x, loss = got[c], "".join(t for role, t in turns if role == "assistant")
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss))
    packed = sorted(nodes.collect(), key=lambda x: x.place)
    assert len(packed) == len({tuple(t[: k + 1]) for t in conv.values() for k in range(len(t))})
    at = 0
    for x in packed:  # one stream without gaps; what a node attends to is what stands before it in its conversations
        assert x.place == at and sum(s.end - s.start for s in x.attends) == x.position_id
        assert all(s.end <= x.place for s in x.attends) and all(a.end < b.start for a, b in zip(x.attends, x.attends[1:]))
        at += x.n_tokens
    assert chat.read_back(*chat.pack(d.limit(0))).count() == 0


# --- 7


def brute_measures(t):
    w = WORD.findall(t or "")
    tri = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(again)


def test_quality_rules(spark):
    r = random.Random(15)
    rows = [(0, None, None, None), (1, "", "en", "s"), (2, " \n\t", "en", "s"), (3, "a b c " * 4000, "en", "s"), (4, "#" * 300, "en", None)]
    for i in range(400):
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(r.randint(40, 90))]
        rows.append((10 + i, " ".join(x + ("###" if i % 10 == 0 else r.choice(["", "", "\n", ","])) for x in w), "en", r.choice("st")))
    rows += [rows[20]] * 2
    got = quality_rules.judge(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {x[0]: x[1] for x in rows}
    for x in got:
        want = brute_measures(text[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (x.base_failed and x.kept)
    long = {x.doc_id: x.kept for x in got if not x.base_failed}
    assert not any(k for d, k in long.items() if d >= 10 and (d - 10) % 10 == 0)  # junk goes
    assert sum(not k for d, k in long.items() if d >= 10 and (d - 10) % 10) <= 0.03 * len(long)  # the rest stays
    assert quality_rules.judge(docs(spark, rows).limit(0)).count() == 0
    assert {x.doc_id for x in quality_rules.filtered(docs(spark, rows)).collect()} == {d for d, k in long.items() if k}
    # null and shared ids are judged by their own texts; names may clash
    odd = docs(spark, [(None if x[0] % 2 else 1, *x[1:]) for x in rows]).withColumns({"_t": F.lit(1), "max_mean_word": F.lit(2), "symbol_ratio": F.lit(3)})
    assert quality_rules.filtered(odd).count() == sum(x.kept for x in got) and quality_rules.filtered(odd).columns == odd.columns
    j = quality_rules.judge(odd)
    assert j.filter("kept").count() == sum(x.kept for x in got) and j.first().asDict().items() >= {"_t": 1, "max_mean_word": 2, "symbol_ratio": 3}.items()


def test_quality_limits(spark):
    """Against exact quantiles: a limit is blended of the group's, the language's and the corpus's, by documents."""
    r = random.Random(16)
    rows = [(i, " ".join("w" * r.randint(2, 9) for _ in range(60)), lang, src) for i, (lang, src) in enumerate([("en", "s")] * 300 + [("en", "t")] * 30 + [("de", None)] * 8)]
    p = quality_rules.Params(sketch_k=4000)  # exact at this size
    m = quality_rules.measures(docs(spark, rows)).select("lang", "source", "mean_word").cache()
    got = {(x.lang, x.source): x.max_mean_word for x in quality_rules.limits(quality_rules.measures(docs(spark, rows)), p).collect()}
    every = [tuple(x) for x in m.collect()]

    def exact(keep):
        v = sorted(x[2] for x in every if keep(x))
        q = lambda rank: v[max(0, int(np.ceil(rank * len(v))) - 1)]
        return len(v), q(0.5) + max(q(0.5) - q(0.1), 1.0) * 5.0

    blend = lambda n, own, other: (n * own + 200 * other) / (n + 200)
    for (lang, src), limit in got.items():
        _, corpus = exact(lambda x: True)
        of_lang = blend(*exact(lambda x: x[0] == lang), corpus)
        assert limit == pytest.approx(blend(*exact(lambda x: x[:2] == (lang, src)), of_lang), rel=0.01)


def test_quality_limits_repeat(spark):
    """The same limits to the last bit, however the rows are dealt out."""
    r = random.Random(17)
    rows = [(i, " ".join("w#A"[r.randint(0, 2)] * r.randint(2, 9) for _ in range(60)), r.choice(["en", "de", None]), r.choice("st")) for i in range(300)]
    d = docs(spark, rows)
    got = [sorted(map(str, quality_rules.limits(quality_rules.measures(d.repartition(n))).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 6


# --- 8

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(x):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, x or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(v) > 255 for v in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark):
    r = random.Random(17)
    bits = ["a", ".", "@", "b-", "1", "2 ", "+", "(", "_", "%", " ", "255", "300", "@x.y", "4111111111111111", "4111 1111 1111 1111", "+49 170 1234567", "1.2.3.4", "\n", "é", "\U0001d4b3"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 50)))) for i in range(500)]
    rows += [(900, None), (901, ""), (902, "1" * 20000), (903, "a" * 20000), (904, "1." * 10000), (905, "+1 " * 10000), (906, "a@b.c " * 2000), rows[7], rows[7]]
    # a name that stands with one address alone, in texts that differ otherwise, tells it; common words don't
    rows += [(1000 + i, f"note {i} x{i} from Zebulon zeb@corp.example the day {i}") for i in range(5)] + [(2000 + i, f"the day from note {i} y{i}") for i in range(300)]
    got = {x.doc_id: x for x in pii.find(docs(spark, rows)).collect()}
    for d, t in rows:
        b = brute_pii(t)
        x = got[d]
        assert x.base_sha256 == hashlib.sha256(",".join(b).encode()).hexdigest(), (d, t)
        assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(sum(s.startswith(k) for s in b) for k in PATTERNS)
        assert d < 1000 or d >= 2000 or (x.spans.count("term:") == 1 and t[int(x.spans.split(":")[-2]) : int(x.spans.split(":")[-1])] == "Zebulon")
        assert d < 2000 or x.spans == ""
    s = {x.doc_id: x for x in pii.sanitise(docs(spark, rows)).collect()}
    assert s[1000].text == "note 0 x0 from [TERM] [EMAIL] the day 0" and s[1000].n_chars == len(s[1000].text) and s[900].text is None and s[2000].text == rows[-300][1]
    assert all(not brute_pii(s[d].text) or d < 500 for d, _ in rows)
    odd = docs(spark, rows[-400:]).withColumns({c: F.lit(c) for c in ("terms", "fp", "_t", "_base", "_row", "_all", "_new")})
    assert pii.sanitise(odd).columns == odd.columns and all(x.terms == "terms" and x.fp == "fp" and x._t == "_t" and x._base == "_base" and x._row == "_row" for x in pii.sanitise(odd).collect())
    assert pii.find(docs(spark, rows).limit(0)).count() == 0


def test_pii_rare_entities(spark):
    """An address found in one text alone, with a name found nowhere else; with few texts that is no evidence yet."""
    rows = [(i, f"the day from note {i} y{i}") for i in range(40_000)] + [(50_000, "the day from Zebulon zeb@corp.example note"), (50_001, "note from Alma +49 170 1234567 the day")]
    got = {x.doc_id: x.spans for x in pii.find(docs(spark, rows)).collect()}
    assert got[50_000].split(",")[1:] == ["term:13:20"] and got[50_001].split(",")[1:] == ["term:10:14"] and not any(got[i] for i in range(40_000))
    assert not any("term" in x.spans for x in pii.find(docs(spark, rows[-8:])).collect())


def test_pii_copies(spark):
    """Copies of one of the texts with the name are no evidence against it."""
    rows = [(i, f"the day from note {i} y{i}") for i in range(400)] + [(1000 + max(0, i - 200), f"{max(0, i - 200)} from Zebulon zeb@corp.example the day note") for i in range(206)]
    spans = [x.spans for x in pii.find(docs(spark, rows)).collect() if x.doc_id >= 1000]
    assert len(spans) == 206 and all(x.endswith("term:7:14") for x in spans)


def test_pii_whole_texts(spark):
    """A disclosing term goes wherever it stands: far from the address, again in its text, and in texts without it."""
    fill = "the day from note " * 20
    rows = [(i, f"the day from note {i} y{i}") for i in range(400)] + [(1000 + i, f"Zebulon {fill}{i} zeb@corp.example {fill} ZEBULON") for i in range(12)]
    rows += [(2000, f"{fill} zebulon, and Zebulons")]
    got = {x.doc_id: x.spans for x in pii.find(docs(spark, rows)).collect()}
    text = dict(rows)
    for d in range(1000, 1012):
        assert [text[d][int(a) : int(b)] for k, a, b in (x.split(":") for x in got[d].split(",")) if k == "term"] == ["Zebulon", "ZEBULON"]
    assert got[2000] == f"term:{len(fill) + 1}:{len(fill) + 8}" and not any(got[i] for i in range(400))
    assert "ebulon," not in pii.sanitise(docs(spark, rows)).filter("doc_id = 2000").first().text


# --- 9


@pytest.fixture(scope="module")
def model():
    return html_extract.fit(html_extract.labelled_pages(200))


def test_html(spark, model):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy.</div>'
        "<article><h1>Head &amp; line</h1><p><b>First\n  <i>one</i>.<br><p>Second&nbsp;two &eacute;</p><ul><li>x<li>y</ul></article><div class='comments'><p>I like it a lot, thanks.</p></div><footer>&copy; site</footer></body></html>"
    )
    rows = [(1, "u", page, "z"), (2, None, None, "z"), (3, "u", "", "z"), (4, "u", "<p", "z"), (5, "u", page, "z"), (5, "u", page, "z"), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 10, "z"), (7, "u", "<script>never closed <p>a</p>", "z")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.main_text(d, model).collect()
    want = "Head & line\nFirst one.\nSecond two é\nx\ny"
    assert len(got) == len(rows) and all(x.text == want and x.n_chars == len(want) for x in got if x.page_id in (1, 5))
    assert all(x.text == "" and x.n_chars == 0 for x in got if x.page_id in (2, 3, 7))
    assert html_extract.main_text(d.limit(0), model).count() == 0


def test_html_slash_ends_no_raw_element():
    """A slash in the tag ends elements of foreign content only; what stands in others is never shown."""
    shown = lambda x: html_extract.parse(x).texts
    assert shown('<p>a</p><script src="a.js"/>var hidden=1;</script><p>b</p>') == ["a", "b"]
    assert shown("<p>a</p><iframe src=http://x/>fallback</iframe><p>b</p>") == ["a", "b"]
    assert shown("<p>a<svg/>b</p><p>c<svg><text>d</text></svg>e</p>") == ["ab", "ce"]


def test_html_is_linear(model):
    """Tags and quotes that never end, raw elements that never close, deep nests."""
    zero = html_extract.Model(np.zeros(html_extract.N_FEATURES), np.zeros((2, 2, 2)))
    for x in ("<a " * 300_000, '<a ">"' * 150_000, '<a "' * 200_000, "<script>" + "</script" * 100_000, "<div>" * 30_000 + "<li>x" * 30_000, "<div>" * 50_000 + "</b1>" * 100_000):
        start = time.time()
        html_extract.extract([x], zero)
        assert time.time() - start < 10
    assert html_extract.parse("<p a='>'>x<p b=\"y>z").texts == ["x", "z"] and html_extract.parse("a <b c <!-- d").texts == ["a <b c"]


def test_html_model(model):
    """Held-out generated pages, and sum-product against enumeration."""
    wrong = total = 0
    for h in html_extract.labelled_pages(80, 99):
        p = html_extract.parse(h)
        x, parent, depth, kind = html_extract.matrix([p])
        b, _, _ = html_extract.sum_product(x @ model.weights, parent, depth, kind, model.pair)
        y = np.array([v for v, k in zip(p.label, kind) if k == 1])
        wrong, total = wrong + int(((b[kind == 1] >= 0) != (y == 1)).sum()), total + len(y)
    assert wrong <= 0.04 * total
    r = np.random.RandomState(1)
    parent, depth, kind = np.array([-1, 0, 0, 1, 1]), np.array([0, 1, 1, 2, 2]), np.array([0, 0, 1, 1, 1])
    u, pair = r.randn(5), r.randn(2, 2, 2)
    weight = np.zeros((5, 2))
    for k in range(32):
        y = [(k >> i) & 1 for i in range(5)]
        weight[range(5), y] += np.exp(sum(u[i] * y[i] for i in range(5)) + sum(pair[kind[i]][y[parent[i]]][y[i]] for i in range(1, 5)))
    assert np.allclose(html_extract.sum_product(u, parent, depth, kind, pair)[0], np.log(weight[:, 1] / weight[:, 0]))


# --- 10


def test_quality_crf(spark):
    r = random.Random(19)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(500)]
    line = lambda: " ".join(r.sample(vocabulary, r.randint(3, 15))).capitalize() + "."
    rows, labels = [], []
    for i in range(400):
        good = r.random() < 0.7
        rows.append((i, "\n".join(line() if good else line().upper().replace(" ", "!! ") for _ in range(r.randint(1, 8)))))
        labels.append((i, int(good), 0))
    rows += [(900, None), (901, ""), (902, " \n\n"), (903, "word " * 20000), rows[3]]
    lab = spark.createDataFrame(labels + [(901, None, 0), (902, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality_crf.classify(docs(spark, rows), lab).collect()
    truth = {d: q for d, q, _ in labels}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert len(got) == len(rows) and len(held) > 50 and sum(x.predicted == truth[x.doc_id] for x in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got)
    assert len({x.score for x in got if x.doc_id in (900, 901, 902)}) == 1
    kept = quality_crf.filtered(docs(spark, rows), lab)
    assert sorted(x.doc_id for x in kept.collect()) == sorted(x.doc_id for x in got if x.predicted) and kept.columns == docs(spark, rows).columns
    assert {x.score for x in quality_crf.classify(docs(spark, rows), lab.limit(0)).collect()} == {0.5}
    assert quality_crf.classify(docs(spark, rows).limit(0), lab).count() == 0


def test_crf_marginals():
    """Forward-backward against enumeration."""
    r = np.random.RandomState(2)
    s, tr, lens = r.randn(6), r.randn(2, 2), np.array([1, 3, 2])
    m, pair = quality_crf._marginals(s, tr, lens)
    want, want_pair, at = [], np.zeros((2, 2)), 0
    for n in lens:
        w, z, q = np.zeros(n), 0.0, np.zeros((2, 2))
        for k in range(2**n):
            y = [(k >> i) & 1 for i in range(n)]
            e = np.exp(sum(s[at + i] * y[i] for i in range(n)) + sum(tr[y[i], y[i + 1]] for i in range(n - 1)))
            z, w = z + e, w + e * np.array(y)
            for i in range(n - 1):
                q[y[i], y[i + 1]] += e
        want += list(w / z)
        want_pair += q / z
        at += n
    assert np.allclose(m, want) and np.allclose(pair, want_pair)


def planted_people(r, apart, n_people=60, n_other=3000):
    """Texts of a made-up vocabulary; each person's surname stands in four to seven texts, the address in all of these but
    `apart`. Returns the rows and the surnames."""
    syllables = ["ka", "lo", "mi", "ter", "en", "sta", "ru", "vel", "do", "sin", "bar", "ne"]
    vocabulary = list({"".join(r.choice(syllables) for _ in range(r.randint(2, 3))) for _ in range(1500)})
    said = lambda n: [vocabulary[min(int(r.expovariate(0.004)), len(vocabulary) - 1)] for _ in range(n)]
    rows, names = [], []
    for k in range(n_people):
        name = "Zq" + "".join(chr(97 + int(c)) for c in f"{k:03d}") + "son"
        names.append(name)
        for j in range(r.randint(4, 7)):
            text = said(40)
            text.insert(r.randint(0, 39), name)
            if j >= apart:
                text.insert(r.randint(0, 39), f"p{k}@mail{k % 9}.example.com")
            rows.append(" ".join(text))
    rows += [" ".join(said(40)) for _ in range(n_other)]
    return [(i, t) for i, t in enumerate(rows)], names


@pytest.mark.parametrize("apart, recall", [(0, 0.95), (1, 0.7), (2, 0.4)])
def test_terms_of_planted_people(spark, apart, recall):
    """Precision and recall of the terms that disclose an entity, over all places: the less often a name stands with the
    address, the less it tells."""
    rows, names = planted_people(random.Random(21), apart)
    text = dict(rows)
    marked, right, planted = 0, 0, 0
    for x in pii.find(docs(spark, rows)).collect():
        spans = [tuple(map(int, s.split(":")[1:])) for s in x.spans.split(",") if s.startswith("term:")]
        words_ = [text[x.doc_id][a:z] for a, z in spans]
        marked += len(words_)
        right += sum(w in names for w in words_)
        planted += sum(w in names for w in text[x.doc_id].split())
    print("marked, right, planted", marked, right, planted)
    assert planted > 300 and right / marked >= 0.95 and right / planted >= recall, (marked, right, planted)
