"""The pipeline on a small corpus: each stage against a brute-force version, on what its predecessor kept."""

import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import WORD, brute_groups, brute_pii, brute_targets


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    r = random.Random(23)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(800)]
    line = lambda: " ".join(r.sample(vocabulary, r.randint(8, 15))).capitalize() + "."
    items = [(i, " ".join(r.sample(vocabulary, 25))) for i in range(8)]
    rows, labels = [], []
    for i in range(160):
        good = i % 5 > 0
        text = "\n".join(line() if good else line().upper().replace(" ", "!! ") for _ in range(r.randint(3, 7)))
        if good and i % 7 == 0:
            text += "\n" + items[i % 8][1]
        if good and i % 11 == 0:
            text += f"\nWrite to a{i}@b.example or 10.0.0.{i}."
        rows.append((i, text, "en", r.choice("abc"), len(text)))
        labels.append((i, int(good), 0))
    for i in range(160, 200):  # copies, exact and near
        old = rows[r.randrange(160)]
        text = old[1] if i % 2 else old[1].replace(".", " indeed.", 1)
        rows.append((i, text, "en", old[3], len(text)))
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0)]
    d = tmp_path_factory.mktemp("sf")
    for name, table, cols in (("documents", rows, "doc_id text lang source n_chars"), ("labels", labels, "doc_id quality toxic"), ("benchmark", items, "item_id text")):
        pq.write_table(pa.table({c: [x[k] for x in table] for k, c in enumerate(cols.split())}), d / f"{name}.parquet")
    return str(d)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, columns = [docs.collect()], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(docs.collect())
        assert k == 4 or docs.columns == columns
    ids = [sorted(x.doc_id for x in rows) for rows in kept]
    assert all("!!" not in (x.text or "") for x in kept[1]) and {i for i in range(160) if i % 5} <= set(ids[1])
    groups = brute_groups([(x.doc_id, x.text) for x in kept[1]])
    assert ids[2] == sorted(d for d, (_, root) in groups.items() if d == root)
    items = [x.text for x in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert ids[3] == [x.doc_id for x in sorted(kept[2], key=lambda x: x.doc_id) if not any(i in (x.text or "") for i in items)]
    assert ids[4] == ids[3] and not any(brute_pii(x.text) for x in kept[4])
    before = {x.doc_id: x for x in kept[3]}
    assert all(x == before[x.doc_id] or brute_pii(before[x.doc_id].text) for x in kept[4])
    sizes, taken = {}, {}
    for x in kept[4]:
        sizes[x.source] = sizes.get(x.source, 0) + len(WORD.findall(x.text or ""))
    for x in kept[5]:
        taken[x.source] = taken.get(x.source, 0) + x.words
        assert len(WORD.findall(x.text)) == x.words
    want = brute_targets({s: n for s, n in sizes.items()})
    assert all(abs(taken.get(s, 0) - t) <= 0.5 for s, t in want.items())


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, terms string, fp long, component string, size long, taken long, _score double"


def odd_rows():
    """Null ids, shared ids, repeated rows, null, empty and long texts, a hot id, nulls in any column."""
    r = random.Random(29)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(400)]
    say = lambda n: " ".join(r.sample(vocabulary, n)).capitalize() + "."
    base = [say(30) for _ in range(12)]
    rows = [(None, base[0], "en", "a"), (None, base[0], "en", "a"), (None, base[1], None, None), (7, base[2], "en", "a"), (7, base[3], "en", "b"), (7, base[3], "en", "b"), (8, base[3].replace(".", " too."), "en", "b")]
    rows += [(None, None, None, None), (9, None, "en", "a"), (9, "", "en", "a"), (10, " \n\t", "en", "a"), (10, " \n\t", "en", "a"), (11, say(390) * 60, "en", "c"), (None, base[4], "en", "a"), (12, base[4], "en", "a"), (13, base[5], "en", None)]
    rows += [(14, base[6] + " Mail me at zoe@corp.example now.", "en", "a"), (None, base[7] + " Call 10.0.0.1 now.", "en", "a")] + [(20, base[8], "en", "a")] * 5
    return [(*x, None if x[1] is None else len(x[1]), "r", "t", 1, "c", 2, 3, 0.5) for x in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_odd_rows(spark, sf_dir, odd, name, stage):
    """Each stage keeps, drops or changes each row by its own text, whatever its id, and carries clashing columns along; an
    empty table gives an empty one; a second run gives the same rows."""
    got = stage(spark, odd, sf_dir).collect()
    assert Counter(map(str, got)) == Counter(map(str, stage(spark, odd.repartition(5), sf_dir).collect()))
    empty = stage(spark, odd.limit(0), sf_dir)
    assert empty.count() == 0
    rows = [tuple(x) for x in odd.collect()]
    if name != "mixture":
        assert empty.columns == odd.columns and all(tuple(x)[5:] == ("r", "t", 1, "c", 2, 3, 0.5) for x in got)
    texts = Counter((x.doc_id, x.text, x.source) for x in got)
    before = Counter((x[0], x[1], x[3]) for x in rows)
    if name == "quality":
        assert not texts - before and all(texts[k] in (0, n) for k, n in before.items())  # repeated rows fare alike
        assert len({k in texts for k in before if not (k[1] or "").strip()}) == 1  # texts without words too
    if name == "near_duplicates":
        groups = brute_groups([(i, x[1]) for i, x in enumerate(rows)])
        root = {i: g for i, (n, g) in groups.items() if n}
        kept = {g: min(((rows[i][0] is None, rows[i][0] or 0) for i in root if root[i] == g)) for g in set(root.values())}
        assert sum(n for (_, t, _), n in texts.items() if not (t or "").strip()) == sum(not (x[1] or "").strip() for x in rows)
        assert sum(n for (_, t, _), n in texts.items() if (t or "").strip()) == len(kept)
        for (d, t, _), n in texts.items():
            if (t or "").strip():
                g = next(root[i] for i, x in enumerate(rows) if x[1] == t)
                assert n == 1 and (d is None, d or 0) == kept[g]
    if name == "decontamination":
        assert texts == before
    if name == "personal_data":
        assert Counter((x.doc_id, x.source) for x in got) == Counter((x[0], x[3]) for x in rows)
        said = {x.text for x in got}
        assert not any(brute_pii(t) for t in said) and None in said and any("[EMAIL]" in (t or "") for t in said) and any("[IP]" in (t or "") for t in said)
        assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in got)
    if name == "mixture":
        sizes = Counter()
        for x in rows:
            sizes[x[3]] += len(WORD.findall(x[1] or ""))
        taken = Counter()
        for x in got:
            taken[x.source] += x.words
            assert len(WORD.findall(x.text)) == x.words > 0 and x.size == 2 and x.row == "r"
        assert all(abs(taken[s] - t) <= 0.5 for s, t in brute_targets(sizes).items())


def test_near_duplicates_of_any_type(spark, sf_dir):
    """Columns without an order: the row that stays doesn't depend on how rows are dealt out."""
    text = "one two three four five six seven"
    d = spark.range(6).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"), F.array(F.create_map(F.col("id"), F.lit(None).cast("string"))).alias("a"), F.encode(F.col("id").cast("string"), "utf-8").alias("b"),
    )
    got = [[str(x) for x in corpus_pipeline.near_duplicates(spark, d.repartition(n), sf_dir).collect()] for n in (1, 4)]
    assert len(got[0]) == 1 and got[0] == got[1]


def test_run_of_empty_tables(spark, sf_dir, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        table = pq.read_table(f"{sf_dir}/{t}.parquet")
        pq.write_table(table.slice(0, 0), tmp_path / f"{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
