"""The matcher for SQL: a table function for LATERAL joins and a function of columns, in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tidemark.functions.text import Expression, Lexicon, _scan, check_expression

_HIT = T.StructType([T.StructField("feature", T.StringType()), T.StructField("expression_id", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType())])


@lru_cache(64)
def parse_lexicon(text: str) -> Lexicon:
    """From JSON, a list of {feature, id, pattern, flags, kind}, the last two with the defaults of an Expression. A pattern that
    can't be matched is an error."""
    found = [Expression(x.get("feature") or "", int(x["id"]), x["pattern"], x.get("flags", "i"), x.get("kind", "plain")) for x in json.loads(text)]
    for e in found:
        if error := check_expression(e):
            raise ValueError(error)
    return Lexicon(found)


class ScanMatches:
    """scan_matches(text, lexicon [, with_text => false]): the matches of one text. The lexicon is a constant, read and checked
    when the query is analysed; the columns are those of _HIT, without the matched text where it isn't wanted."""

    @staticmethod
    def analyze(text: AnalyzeArgument, lexicon: AnalyzeArgument, with_text: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not lexicon.isConstantExpression or lexicon.value is None:
            raise ValueError("scan_matches takes its lexicon as a constant")
        if not isinstance(text.dataType, (T.StringType, T.NullType)):
            raise ValueError("scan_matches takes a text")
        if with_text is not None and with_text.value is None:
            raise ValueError("with_text is a constant")
        parse_lexicon(lexicon.value)
        return AnalyzeResult(T.StructType(_HIT.fields if with_text is None or with_text.value else _HIT.fields[:-1]))

    def eval(self, text: str | None, lexicon: str, with_text: bool = True) -> Iterator[tuple]:
        known = parse_lexicon(lexicon)
        for hit in _scan(text, known, sorted(known.by)):
            yield hit if with_text else hit[:-1]


def matcher(expressions: list[Expression]) -> Callable[[Column | str], Column]:
    """A function of a text column: array<struct> of its matches, by feature. Expressions are sent with the function."""

    @F.arrow_udf(T.ArrayType(_HIT))
    def matches(texts: pa.Array) -> pa.Array:
        known = Lexicon(expressions)
        kind = pa.list_(pa.struct([("feature", pa.string()), ("expression_id", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        found = ([dict(zip(_HIT.names, x, strict=True)) for x in _scan(t, known, sorted(known.by))] for t in texts.to_pylist())
        return pa.array(list(found), kind)

    return matches


def register(spark: SparkSession) -> None:
    """scan_matches as a table function of the session's SQL."""
    spark.udtf.register("scan_matches", F.udtf(ScanMatches, useArrow=True))
