"""Which expressions may match which texts: an inverted index of the literals that matches need.

The words of all texts are counted once. Literals meet the different words by three letters, and an expression is filed
under the words that hold one of the literals of its rarest leaf. The texts' own words then lead to the expressions. However
many expressions there are, a text is looked at for those that one of its words leads to, and no body is shuffled: what is
joined is a word, and the index is the lexicon's words, broadcast where it is small and shuffled where it isn't.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import Lexicon, strip_markup
from tidemark.store import materialise

GRAM = 3
#: A lexicon of so many literals needs no index: each text is looked through for them.
FEW_LITERALS = 200


def folded(text: Column) -> Column:
    """A text with characters that match each other in any case made equal, letter by letter."""
    # the dot of a dotted i goes; also, Spark would take one change of case right after another for needless
    undotted = lambda x: F.replace(x, F.lit("\u0307"), F.lit(""))
    every = F.replace(F.lower(undotted(F.upper(undotted(F.lower(text))))), F.lit("\u03c2"), F.lit("\u03c3"))
    # ASCII letters have one other case only
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(every)


def words(text: Column) -> Column:
    """The different words of a stripped text, folded."""
    return F.array_distinct(F.split(folded(strip_markup(text)), " "))


def _grams(seen: DataFrame, size: int) -> DataFrame:
    """(word, n, gram): each word's stretches of so many letters; a shorter word's is itself."""
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.length("word") - size + 1, F.lit(1))))
    return seen.select("word", "n", at.alias("_i")).select("word", "n", F.substring("word", F.col("_i"), F.lit(size)).alias("gram"))


def index(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(word, expressions) of the words of texts (text) that hold a literal."""
    spark = texts.sparkSession
    literals = spark.createDataFrame(lexicon.literals(), "expression int, leaf int, literal string").withColumn("literal", folded(F.col("literal"))).filter("literal <> ''")
    literals = literals.withColumn("gram", F.substring("literal", 1, GRAM))
    seen = texts.select(F.explode(words(F.col("text"))).alias("word")).filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # the beginnings of literals of fewer letters too
    sizes = sorted({min(len(w), GRAM) for _, _, w in lexicon.literals()} | {GRAM})
    grams = reduce(DataFrame.unionByName, (_grams(seen, k) for k in sizes))
    found = grams.join(literals, "gram").filter(F.contains("word", "literal"))
    found = materialise(found.select("word", "n", "expression", "leaf").distinct(), "literal-words")  # read twice
    # an expression of which a leaf has no literal in any text matches none
    cost = found.groupBy("expression", "leaf").agg(F.sum("n").alias("n"))
    every = literals.select("expression", "leaf").distinct().join(cost, ["expression", "leaf"], "left")
    best = every.groupBy("expression").agg(F.min_by("leaf", F.struct(F.coalesce("n", F.lit(0)), "leaf")).alias("leaf"))
    return found.join(best, ["expression", "leaf"]).groupBy("word").agg(F.collect_set("expression").alias("expressions"))


def candidates(texts: DataFrame, indexed: DataFrame, key: str) -> DataFrame:
    """(key, candidates): for each of a key's texts (key, area_ord, text), struct(area_ord, expression) of the expressions that
    may match there."""
    d = texts.select(key, "area_ord", F.explode(words(F.col("text"))).alias("word")).join(indexed, "word")
    d = d.select(key, "area_ord", F.explode("expressions").alias("expression"))
    return d.groupBy(key).agg(F.collect_set(F.struct("area_ord", "expression")).alias("candidates"))


def found_directly(texts: DataFrame, lexicon: Lexicon, key: str) -> DataFrame:
    """The same for a lexicon of few literals: each is looked for in the folded text, which is gone through once, and no word
    leaves its row. A literal has no white space, so that it stands in a text as it does in the stripped one."""
    needs: dict[int, dict[int, list[Column]]] = {}
    for k, leaf, word in lexicon.literals():
        needs.setdefault(k, {}).setdefault(leaf, []).append(F.contains(F.col("_folded"), folded(F.lit(word))))
    may = [F.when(reduce(Column.__and__, (reduce(Column.__or__, some) for some in leaves.values())), F.lit(k)) for k, leaves in needs.items()]
    d = texts.select(key, "area_ord", folded(F.coalesce("text", F.lit(""))).alias("_folded"))
    d = d.select(key, "area_ord", F.array_compact(F.array(*may).cast("array<int>")).alias("e"))
    own = F.transform("e", lambda x: F.struct("area_ord", x.alias("expression")))
    return d.groupBy(key).agg(F.flatten(F.collect_list(own)).alias("candidates"))
