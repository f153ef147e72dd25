"""Markup stripping, the map from stripped to original places, and the multi-pattern matching kernel.

A maximal run of tags and white space becomes one space. White space is the JVM's: no-break spaces are text. Places are
code points. A pattern is reported once for every place where a match ends, with the leftmost start for that end.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import patterns

try:
    import ahocorasick
except ImportError:
    ahocorasick = None

#: The characters that the JVM counts as white space.
JAVA_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
JAVA_SPACE += "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
_SPACE = f"[{re.escape(JAVA_SPACE)}]"
#: Runs of tags and white space, but for a single blank, which stands for itself.
_SEPARATORS = re.compile(rf"(?: (?=<|{_SPACE})|(?! )(?:<[^>]*>|{_SPACE}))(?:<[^>]*>|{_SPACE})*")
#: The same class for Spark's regular expressions.
SPACE_CLASS = r"[\t-\r\x1c-\x1f\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]"


def strip_markup(text: Column) -> Column:
    """The stripped text as a column; null is empty. Two passes: one nested pattern would recurse once a tag."""
    tagless = F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]*>", " ")
    return F.regexp_replace(tagless, SPACE_CLASS + "+", " ")


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(F.rlike(text, F.lit("[^" + SPACE_CLASS[1:])), F.lit(False))


def within_size(text: Column, limit: int | None) -> Column:
    """Whether a text's UTF-8 form has at most `limit` bytes; no limit and null texts pass."""
    return F.lit(True) if limit is None else F.coalesce(F.octet_length(text) <= limit, F.lit(True))


class Stripped:
    """A stripped text and its map back."""

    def __init__(self, text: str | None):
        text = text or ""
        self.length = len(text)
        pieces, self._at, self._orig = [], [0], [0]
        done = size = 0
        for m in _SEPARATORS.finditer(text):
            pieces += [text[done : m.start()], " "]
            size += m.start() - done
            # the run's own place, then what follows it
            self._at += [size, size + 1]
            self._orig += [m.start(), m.end()]
            size += 1
            done = m.end()
        pieces.append(text[done:])
        self.text = "".join(pieces)

    def original(self, place: int) -> int:
        """Where a place of the stripped text, its end included, lies in the original."""
        if place == len(self.text):
            return self.length
        k = bisect_right(self._at, place) - 1
        return self._orig[k] + place - self._at[k]


@dataclass(frozen=True)
class Expression:
    feature: str
    expression_id: int
    pattern: str
    flags: str = "i"
    #: plain, or combination: one match a text, from the first leaf's start to the last one's end, if all leaves match.
    kind: str = "plain"


def all_ends(text: str, pattern: str, flags: str = "i") -> list[tuple[int, int]]:
    """(start, end) of each match end with its leftmost start, by end; empty matches don't count. No limit of time:
    nothing is tried twice."""
    return patterns.compiled(pattern, flags)(text)


def _leaves(e: Expression) -> list[str]:
    return e.pattern.split("\x00") if e.kind == "combination" else [e.pattern]


def _needs(e: Expression) -> list[tuple[str, ...]]:
    return [r for x in _leaves(e) if (r := patterns.required(x, e.flags)) is not None]


def check_expression(e: Expression) -> str | None:
    """What is wrong with an expression, if anything: a pattern that can't be read, or not be followed."""
    try:
        for x in _leaves(e):
            patterns.compiled(x, e.flags)
    except (ValueError, RecursionError) as err:
        return f"expression {e.expression_id}: {err}"
    return None


class Lexicon:
    """The expressions by feature, with the literals that tell which of them may match a text."""

    def __init__(self, expressions: list[Expression]):
        self.all = list(expressions)
        #: for each expression, the literals of each leaf that is known to need one; all of the leaves have to match
        self.needs = [[tuple(map(patterns.fold, r)) for r in _needs(e)] for e in self.all]
        self.by: dict[str, list[int]] = {}
        for k, e in enumerate(self.all):
            self.by.setdefault(e.feature, []).append(k)
        #: by feature, the expressions that need no literal
        self.open = {f: own for f, ks in self.by.items() if (own := [k for k in ks if not self.needs[k]])}
        self.words = sorted({w for needs in self.needs for r in needs for w in r})
        self._finder = None

    def literals(self) -> list[tuple[int, int, str]]:
        """(expression, leaf, word): a text with a match has one of the words of each leaf, in some case."""
        return [(k, j, w) for k, e in enumerate(self.all) for j, r in enumerate(_needs(e)) for w in r]

    def said(self, folded: str) -> set[str]:
        """Those of the literals that a folded text holds."""
        if len(self.words) <= 64 or ahocorasick is None:
            return {w for w in self.words if w in folded}
        if self._finder is None:
            self._finder = ahocorasick.Automaton()
            for w in self.words:
                self._finder.add_word(w, w)
            self._finder.make_automaton()
        return {w for _, w in self._finder.iter(folded)}

    def wanted(self, text: str, features: list[str], among: list[int] | None) -> list[Expression]:
        """The expressions of some features that may match a text: of those known to be candidates, or of all."""
        folded = patterns.fold(text)
        if among is None:
            said = self.said(folded)
            return [self.all[k] for f in features for k in self.by.get(f, ()) if all(any(w in said for w in r) for r in self.needs[k])]
        own = set(features)
        some = [k for k in among if self.all[k].feature in own and all(any(w in folded for w in r) for r in self.needs[k])]
        return [self.all[k] for k in sorted({*some, *(k for f in features for k in self.open.get(f, ()))})]

    def maybe(self, texts: Column, features: Column, most: int = 500) -> Column:
        """Whether a text may match an expression of its features, as SQL, where no candidates are known (a stream can't look
        at its texts twice): always true with more literals than a regular expression is good for."""
        filters = {w for e in self.all if (needs := _needs(e)) for w in min(needs, key=lambda r: (-min(map(len, r)), r))}
        words = sorted(set(map(patterns.in_any_case, filters)))
        if len(words) > most or len(self.open) > most:
            return F.lit(True)
        some = texts.rlike("(?isu)" + "|".join(words)) if words else F.lit(False)
        return self.unfiltered(features) | some if self.open else some  # the cheap one first

    def asked_for(self, candidates: Column, features: Column, most: int = 500) -> Column:
        """Of some candidates those of a text's features; all of them with more expressions than a literal array is good for
        (wanted() looks at the features in any case)."""
        if len(self.all) > most:
            return candidates
        names = F.array(*(F.lit(e.feature) for e in self.all))
        return F.filter(candidates, lambda k: F.array_contains(features, F.get(names, k)))

    def unfiltered(self, features: Column) -> Column:
        """Whether one of the features has an expression that needs no literal."""
        return F.arrays_overlap(features, F.array(*map(F.lit, sorted(self.open)))) if self.open else F.lit(False)


def _scan(text: str | None, lexicon: Lexicon, features: list[str], among: list[int] | None = None) -> list[tuple[str, int, int, int, str]]:
    """(feature, expression_id, start, end, matched stripped text) in original places."""
    if not text or not text.strip(JAVA_SPACE):
        return []
    todo = lexicon.wanted(text, features, among)
    if not todo:
        return []
    s = Stripped(text)
    out = []
    for e in todo:
        if e.kind == "combination":
            leaves = [all_ends(s.text, leaf, e.flags) for leaf in _leaves(e)]
            spans = [(min(a for x in leaves for a, _ in x), max(b for x in leaves for _, b in x))] if all(leaves) else []
        else:
            spans = all_ends(s.text, e.pattern, e.flags)
        out += [(e.feature, e.expression_id, s.original(a), s.original(b), s.text[a:b]) for a, b in spans]
    return out


def scan_text(text: str | None, expressions: list[Expression]) -> list[tuple[int, int, int, str]]:
    """(expression_id, start, end, matched stripped text) in original places; a text of white space has none."""
    lexicon = Lexicon(expressions)
    return [x[1:] for x in _scan(text, lexicon, list(lexicon.by))]


RAW_SCHEMA = "message_id string, area string, area_ord int, attachment_id string, feature string, expression_id int, start int, end int, text string, scan_error string"


def scan(areas: DataFrame, expressions: list[Expression] | Lexicon, key: str = "message_id") -> DataFrame:
    """Raw matches of areas (key, area, area_ord, attachment_id, text, features): every text is stripped once and scanned for
    each of its features' expressions. An error in a text gives one row with scan_error, and no matches. A column
    candidates tells which expressions may match (by their place in the lexicon); without it, one regular expression
    keeps texts from Python that hold none of the literals.

    expressions is a lexicon, of a size that the driver has read and checked; it is sent to each executor once."""
    lexicon = expressions if isinstance(expressions, Lexicon) else Lexicon(expressions)
    held = areas.sparkSession.sparkContext.broadcast(lexicon)
    schema = RAW_SCHEMA.replace("message_id", key)
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int32() if c.split()[1] == "int" else pa.string() for c in schema.split(", ")]
    known = "candidates" in areas.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            among = b.column(6).to_pylist() if known else [None] * b.num_rows
            for mid, area, o, att, text, feats, some in zip(*(b.column(k).to_pylist() for k in range(6)), among, strict=True):
                try:
                    got = _scan(text, held.value, sorted(feats or []), (some or []) if known else None)
                    if got and area == "ATTACHMENT" and not (att or "").strip():
                        raise ValueError("an attachment with a match has no id")
                    rows += [(mid, area, o, att, f, i, a, z, t, None) for f, i, a, z, t in got]
                except Exception as e:  # the message fails, not the task
                    rows.append((mid, area, o, att, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    d = areas.select(key, "area", "area_ord", "attachment_id", "text", "features", *([lexicon.asked_for(F.col("candidates"), F.col("features")).alias("candidates")] if known else []))
    may = (F.size("candidates") > 0) | lexicon.unfiltered(F.col("features")) if known else lexicon.maybe(F.col("text"), F.col("features"))
    return d.filter(may).mapInArrow(run, schema)


def literal_positions(texts: DataFrame, literal: str, text: str = "text") -> DataFrame:
    """texts without its text, with start and end of every occurrence of a literal that doesn't overlap itself, in any
    case; by SQL functions alone: the pieces between the occurrences, summed up."""
    pattern = "(?i)" + re.escape(literal)
    d = texts.withColumn("_m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).filter(F.size("_m") > 0)
    d = d.withColumn("_p", F.split(text, pattern, -1)).drop(text)
    d = d.withColumn(
        "_s",
        F.expr("""aggregate(case when size(_m) > 0 then sequence(0, size(_m) - 1) else cast(array() as array<int>) end, named_struct('at', 0, 'l', cast(array() as array<struct<start:int,end:int>>)),
          (a, i) -> named_struct('at', a.at + length(get(_p, i)) + length(get(_m, i)),
             'l', array_append(a.l, named_struct('start', a.at + length(get(_p, i)), 'end', a.at + length(get(_p, i)) + length(get(_m, i))))), a -> a.l)"""),
    )
    return d.withColumn("_s", F.explode("_s")).select(*[c for c in texts.columns if c != text], "_s.start", "_s.end")
