"""Quality rules with adaptive thresholds from mergeable quantile sketches, by SQL functions alone.

Every text gets a handful of measures. A sketch of each measure is built per (language, source): how many values fall
into each step of a fixed geometric grid. Sketches merge by adding, whatever the order, so that a rerun or a lost executor
gives the same limits to the last bit; a quantile is off by no more than half a step. They are merged into their language's
and then into the corpus's. A sketch's limit is its median plus a multiple of the spread
between its lower decile and its median (so up to half of a group may be junk without moving the limit). A group's limit
is blended of its own and its language's, which is blended of the language's own and the corpus's, each weighing as its
documents to `prior_docs`: a small group leans on the larger one, and no number of documents switches over. A join brings
the limits back to the documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, few, materialise, words

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A measure is too high beyond median + factor * max(median - lower decile, least_spread)."""

    measure: str
    least_spread: float
    factor: float = 5.0


@dataclass(frozen=True)
class Params:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: The larger group weighs like so many documents of the smaller one.
    prior_docs: int = 200
    #: A step of the grid is one k-th of its values wide.
    sketch_k: int = 200
    rules: tuple[Rule, ...] = field(
        default=(
            Rule("symbol_ratio", 0.006),
            Rule("upper_ratio", 0.02),
            Rule("dup_line_ratio", 0.05),
            Rule("repeat_ratio", 0.05),
            Rule("mean_word", 1.0),
        )
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


#: Words in repeated windows, from the sorted windows. n log n in a text's words.
_REPEATED = """
aggregate(
  sort_array(transform(
    filter(_sorted, (x, i) -> coalesce(x.h = get(_sorted, i - 1).h, false) or coalesce(x.h = get(_sorted, i + 1).h, false)),
    x -> x.i)),
  named_struct('last', -3, 'n', 0L),
  (a, x) -> named_struct('last', x, 'n', a.n + least(3, x - a.last)),
  a -> a.n)
"""


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without its text, with the counts and ratios of each text. Null text counts as empty."""
    d = docs.withColumns({"_t": F.coalesce(F.col(text), F.lit("")), "_w": words(F.col(text))}).drop(text)
    d = d.withColumns(
        {
            "_lines": F.expr(r"filter(split(_t, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
            "_windows": F.expr(
                """case when size(_w) < 3 then cast(array() as array<bigint>)
                   else transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) end"""
            ),
        }
    )
    d = d.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": _count(F.col("_t"), f"[{SYMBOLS}]"),
            "n_upper": _count(F.col("_t"), r"\p{Lu}"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            # most texts repeat no window: only the others are sorted
            "_sorted": F.expr(
                """case when size(array_distinct(_windows)) < size(_windows)
                   then sort_array(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))) end"""
            ),
        }
    ).drop("_t", "_lines", "_w", "_windows")
    d = d.withColumn("n_repeat_words", F.coalesce(F.expr(_REPEATED), F.lit(0)).cast("long")).drop("_sorted")
    nw, nc, nl = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return d.withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / nc,
            "upper_ratio": F.col("n_upper") / nc,
            "dup_line_ratio": F.col("n_dup_lines") / nl,
            "repeat_ratio": F.col("n_repeat_words") / nw,
            "mean_word": F.col("word_chars") / nw,
        }
    )


#: Values up to this share a step.
_SMALLEST = 1e-6


def _step(x: Column, p: Params) -> Column:
    """The number of a value's step; its logarithm is the same on every machine."""
    return F.when(x <= _SMALLEST, 0).otherwise(1 + F.floor(F.log(x / _SMALLEST) / math.log1p(1 / p.sketch_k))).cast("int")


def _value(step: Column, p: Params) -> Column:
    return F.when(step == 0, 0.0).otherwise(_SMALLEST * F.exp((step - 0.5) * math.log1p(1 / p.sketch_k)))


def sketches(measured: DataFrame, p: Params = Params()) -> DataFrame:
    """(lang, source, rule, step, n): a few thousand steps of each rule at most, however many documents there are."""
    every = F.array(*(F.struct(F.lit(k).alias("rule"), _step(F.col(r.measure), p).alias("step")) for k, r in enumerate(p.rules)))
    return measured.select("lang", "source", F.explode(every).alias("x")).groupBy("lang", "source", "x.rule", "x.step").agg(F.count(F.lit(1)).alias("n"))


def _limits_of(sketch: DataFrame, by: list[str], p: Params) -> DataFrame:
    """(by, n, limits): the merged sketches' numbers of documents and limits, those in the order of the rules."""
    merged = sketch.groupBy(*by, "rule", "step").agg(F.sum("n").alias("n"))
    steps = merged.groupBy(*by, "rule").agg(F.sort_array(F.collect_list(F.struct("step", "n"))).alias("s"), F.sum("n").alias("n"))

    def quantile(rank: float) -> Column:
        # the step at which the running count gets there
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("at"))
        there = F.ceil(F.col("n") * rank)
        on = F.aggregate("s", start, lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.when((a["at"] < 0) & (a["n"] + x["n"] >= there), x["step"]).otherwise(a["at"]).alias("at")), lambda a: a["at"])
        return _value(on, p)

    spread = F.element_at(F.array(*(F.lit(r.least_spread) for r in p.rules)), F.col("rule") + 1)
    factor = F.element_at(F.array(*(F.lit(r.factor) for r in p.rules)), F.col("rule") + 1)
    limit = F.col("q5") + F.greatest(F.col("q5") - F.col("q1"), spread) * factor
    d = steps.withColumns({"q5": quantile(0.5), "q1": quantile(0.1)}).withColumn("limit", limit)
    return d.groupBy(*by).agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("rule", "limit"))), lambda x: x["limit"]).alias("limits"))


def limits(measured: DataFrame, p: Params = Params()) -> DataFrame:
    """One row for each (lang, source): the limit of every rule."""
    sketch = materialise(sketches(measured, p), "sketches")  # read three times below
    tagged = lambda by, t: _limits_of(sketch, by, p).withColumnsRenamed({c: f"{t}{c}" for c in (*by, "n", "limits")})
    full = tagged(["lang", "source"], "g_").join(tagged(["lang"], "l_"), F.col("g_lang").eqNullSafe(F.col("l_lang"))).crossJoin(F.broadcast(tagged([], "a_")))  # one row
    own = lambda n: F.col(n) / (F.col(n) + p.prior_docs)
    out = []
    for k, r in enumerate(p.rules):
        at = lambda t, k=k: F.col(f"{t}limits")[k]
        of_lang = own("l_n") * at("l_") + (1 - own("l_n")) * at("a_")
        out.append((own("g_n") * at("g_") + (1 - own("g_n")) * of_lang).alias(f"max_{r.measure}"))
    return full.select(F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), *out)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _apart(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """(_row, lang, source, text): the columns to carry in one, where names can't clash."""
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in carry))
    return docs.select(row.alias("_row"), F.col("lang").alias("lang"), F.col("source").alias("source"), F.col(text).alias("_said"))


def _verdict(measured: DataFrame, lim: DataFrame, p: Params) -> DataFrame:
    """measured with base_failed and kept."""
    lim = lim.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    d = measured.join(lim, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    base = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words"))
    ok = ~base
    for r in p.rules:
        ok = ok & (F.col(r.measure) <= F.col(f"max_{r.measure}"))
    return d.withColumns({"base_failed": base, "kept": F.coalesce(ok, F.lit(False))})


def judge(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """Every row of docs, without its text, with its counts, base_failed and kept.

    A null or empty text has no words and fails the base rule. Null languages and sources are groups of their
    own. Whole texts are measured. Repeated rows are judged alike, each on its own, whatever their ids. An empty table
    gives an empty result. Columns of docs that are named like a result column are replaced, all others carried along.
    """
    own = (*_COUNTS, "base_failed", "kept")
    carried = [c for c in docs.columns if c != text and c.lower() not in own]
    measured = materialise(few(measures(_apart(docs, carried, text), "_said"), docs), "measures")
    d = _verdict(measured, limits(measured, p), p)
    return d.select(*(F.col("_row")[c].alias(c) for c in carried), *own)


def filtered(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """The rows of docs whose verdict is to keep, all columns as they were: each row by its own text, whatever its id.
    Texts are measured twice, for the limits and for the verdict, instead of being written."""
    measured = materialise(few(measures(_apart(docs, [], text), "_said").drop("_row"), docs), "measures")
    d = _verdict(measures(_apart(docs, docs.columns, text), "_said"), limits(measured, p), p)
    return d.filter("kept").select(*(F.col("_row")[c].alias(c) for c in docs.columns))
