"""Personal data: patterns, and information-theoretic sanitisation of the terms that go with them, by SQL functions alone.

The patterns find e-mail addresses, IP addresses, card and phone numbers: the protected entities. Sanitisation asks what
the other words of their texts give away. Over all texts it counts how often a term stands in a text with an entity, how
often the entity is found, and in how many texts the term occurs at all. The share of the entity's information
that the term discloses is PMI(term; entity) / IC(entity): 1 where the term occurs only with the entity, near 0 for
words found anywhere. No pair is left out for being rare: small counts are corrected, as the share of the term's texts
that have the entity is taken at the lower end of its (Wilson) confidence interval. Terms beyond the threshold are personal data too: all
their occurrences, in whatever text, are removed; the entities are generalised to their kind. Equal texts count once:
copies are no evidence. The letters of an address itself are no terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few, materialise


@dataclass(frozen=True)
class Params:
    min_letters: int = 3
    #: Standard deviations to the lower end of a share's confidence interval: 99.5 % one-sided.
    deviations: float = 2.6
    least_disclosure: float = 0.8
    #: Tables of fewer rows than this (of some 100 bytes) are sent to all tasks; larger ones are shuffled.
    broadcast_rows: int = 50_000


#: The kinds in their order. The patterns match what the plain ones match, leftmost first, in linear time:
#: a run is tried from its start (or from the last match's end) only, and nothing that can't help is given back.
_LOCAL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_SPAN = "array<struct<kind:int,start:int,stop:int,value:string>>"


def _valid(kind: str) -> str:
    """SQL for whether the match x counts."""
    if kind == "ip":
        return r"forall(split(x, '\\.'), q -> coalesce(try_cast(q as bigint) <= 255, false))"
    if kind == "card":
        digits = "replace(replace(x, ' ', ''), '-', '')"
        return f"""case when length({digits}) between 16 and 19 then
            aggregate(sequence(1, length({digits})), 0, (a, i) -> a +
              case when i % 2 = 1 then cast(substring({digits}, length({digits}) - i + 1, 1) as int)
                   else cast(substring('0246813579', cast(substring({digits}, length({digits}) - i + 1, 1) as int) + 1, 1) as int) end) % 10 = 0
            else false end"""
    if kind == "phone":
        return r"length(regexp_replace(x, '[^0-9]', '')) between 8 and 15"
    return "true"


def _with_base(d: DataFrame) -> DataFrame:
    """d, with a text column _t that is not null, and _base: the spans of all kinds, sorted, with value."""
    for k, (kind, pattern) in enumerate(KINDS.items()):
        some = F.col("_t").contains("@") if kind == "email" else F.col("_t").rlike(_HINT[kind])
        d = d.withColumn(f"_m{k}", F.when(some, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))))
        d = d.withColumn(f"_p{k}", F.when(F.size(f"_m{k}") > 0, F.split("_t", pattern, -1)))
    out = []
    for k, kind in enumerate(KINDS):
        out.append(
            f"""coalesce(filter(aggregate(_m{k}, named_struct('at', 0, 'i', 0, 'l', cast(array() as {_SPAN})),
              (a, x) -> named_struct(
                'at', a.at + length(_p{k}[a.i]) + length(x), 'i', a.i + 1,
                'l', case when {_valid(kind)} then array_append(a.l, named_struct(
                   'kind', {k}, 'start', a.at + length(_p{k}[a.i]), 'stop', a.at + length(_p{k}[a.i]) + length(x), 'value', x)) else a.l end),
              a -> a.l), s -> true), cast(array() as {_SPAN}))"""
        )
    d = d.withColumn("_base", F.concat(*map(F.expr, out)))
    return d.drop(*(f"_{c}{k}" for c in "mp" for k in range(len(KINDS))))


def _joined(spans: Column) -> Column:
    """kind:start:end, comma-joined. Kind 4 is a term."""
    names = F.array(*map(F.lit, [*KINDS, "term"]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


_LETTERS = r"\p{L}+"


def _terms(p: Params) -> Column:
    """The different terms of _t: its letter runs in lower case, without those of addresses."""
    free = F.when(F.col("_t").contains("@"), F.regexp_replace("_t", KINDS["email"], " ")).otherwise(F.col("_t"))
    return F.filter(F.array_distinct(F.split(F.lower(free), r"[^\p{L}]+")), lambda x: F.length(x) >= p.min_letters)


def _marked() -> Column:
    """Where the letter runs of _t (_r, with the pieces _q around them) are among the texts' own terms _own."""
    return F.expr(f"""aggregate(_r, named_struct('at', 0, 'i', 0, 'l', cast(array() as {_EMPTY})),
          (a, x) -> named_struct('at', a.at + length(_q[a.i]) + length(x), 'i', a.i + 1,
            'l', case when array_contains(_own, lower(x)) then array_append(a.l, named_struct(
              'kind', {len(KINDS)}, 'start', a.at + length(_q[a.i]), 'stop', a.at + length(_q[a.i]) + length(x))) else a.l end),
          a -> a.l)""")


def _small(d: DataFrame, p: Params) -> DataFrame:
    """d, to be broadcast if it has been counted to be small."""
    return F.broadcast(d) if d.count() <= p.broadcast_rows else d


_SIEVE_BITS = 23


def _sieve(terms: DataFrame) -> DataFrame:
    """One row, bits: a bitmap of fixed size of the terms' hashes. What it lets through are the terms and, while they are
    some hundred thousand, few others; with very many terms it lets everything through, to the same result."""
    h = F.pmod(F.xxhash64("term"), F.lit(1 << _SIEVE_BITS))
    words = terms.select(F.shiftright(h, 6).alias("id"), (h % 64).cast("int").alias("bit"))
    words = words.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("w"))
    every = terms.sparkSession.range(1 << (_SIEVE_BITS - 6)).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "w"))), lambda x: x["w"]).alias("bits"))


def _passes() -> Column:
    """Whether the row's bits let its term through; in generated code, so that the bits are not copied row by row."""
    h = F.pmod(F.xxhash64("term"), F.lit(1 << _SIEVE_BITS))
    return F.get("bits", F.shiftright(h, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (h % 64).cast("int"))) != 0


def _least_share(k: Column, n: Column, p: Params) -> Column:
    """The lower end of the Wilson interval of k of n. It falls as n grows."""
    z, k = p.deviations**2, F.least(k, n)
    return (k + z / 2 - p.deviations * F.sqrt(k * (n - k) / n + z / 4)) / (n + z)


def term_spans(docs: DataFrame, found: DataFrame, p: Params, text: str) -> DataFrame:
    """(fp, terms): for each text with disclosing terms their spans. found: (fp, _base, _w), a row a document."""
    held = found.filter(F.size("_base") > 0)
    who = materialise(held.select("fp", F.explode("_base").alias("s")).select("fp", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity")).distinct(), "entities")
    # entities of the same texts are alike: one of them stands for all, or the pairs would be the product of the two
    alike = who.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("who"))
    who = materialise(who.join(alike, "entity").select("fp", "who", "n_e").distinct(), "entity-texts")
    near = materialise(held.select("fp", F.explode("_w").alias("term")).distinct(), "near")
    total = F.broadcast(found.agg(F.countDistinct("fp").alias("n")))  # one row
    # a term occurs in as many texts as have it beside entities, at least: if these are too many, it tells too little
    often = near.groupBy("term").agg(F.count(F.lit(1)).alias("n_w"))
    enough = F.pow(F.col("n_e") / F.col("n"), F.lit(1 - p.least_disclosure)) * 0.999999
    seen = near.join(often, "term").join(who, "fp").crossJoin(total)
    seen = seen.filter(_least_share(F.col("n_e"), F.col("n_w"), p) >= enough)
    pair = seen.groupBy("who", "n_e", "term", "n_w", "n").agg(F.count(F.lit(1)).alias("n_et"))
    pair = materialise(pair.filter(_least_share(F.col("n_et"), F.col("n_w"), p) >= enough).drop("n_w"), "pairs")
    asked = materialise(pair.select("term").distinct(), "terms")
    # before they are shuffled, all texts' terms pass a bitmap of those that are asked for
    sieve = F.broadcast(materialise(_sieve(asked), "sieve"))  # one row of 1 MB
    said = _prepared(docs.select(text), text).select("fp", F.explode(_terms(p)).alias("term"))
    said = said.crossJoin(sieve).filter(_passes()).select("fp", "term")
    said = materialise(few(said.join(_small(asked, p), "term").distinct(), docs), "term-texts")
    pair = pair.join(said.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")), "term")
    pmi = F.log2(_least_share(F.col("n_et"), F.greatest("n_t", "n_et"), p) * F.col("n") / F.col("n_e"))
    share = pmi / F.greatest(F.log2(F.col("n") / F.col("n_e")), F.lit(1e-9))
    tells = materialise(pair.filter(share >= p.least_disclosure).select("term").distinct(), "disclosing")
    own = _small(materialise(said.join(_small(tells, p), "term").groupBy("fp").agg(F.collect_list("term").alias("_own")), "own-terms"), p)
    d = _prepared(docs.select(text), text).join(own, "fp").dropDuplicates(["fp"])
    d = d.withColumn("_r", F.regexp_extract_all("_t", F.lit(_LETTERS), F.lit(0))).withColumn("_q", F.split("_t", _LETTERS, -1))
    return materialise(d.select("fp", _marked().alias("terms")), "term-spans")


_EMPTY = "array<struct<kind:int,start:int,stop:int>>"


def _spans(d: DataFrame, terms: DataFrame, p: Params) -> DataFrame:
    """d (fp, _base, ...) with _all: base spans and terms that don't overlap one."""
    d = d.join(_small(terms, p), "fp", "left")
    free = "filter(coalesce(terms, cast(array() as {0})), t -> not exists(_base, b -> b.start < t.stop and t.start < b.stop))".format(_EMPTY)
    return d.withColumn("_all", F.expr(f"concat(transform(_base, b -> named_struct('kind', b.kind, 'start', b.start, 'stop', b.stop)), {free})")).drop("terms")


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("fp", F.xxhash64("_t"))


def find(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of docs.

    A null text is empty and has no spans. Repeated rows give equal rows. An empty table gives an empty result.
    Other columns of docs, whatever their names, don't matter. Places are code points, ends exclusive; spans has the
    kinds in order, each by start, and disclosing terms last, as kind term.
    """
    docs = docs.select("doc_id", text)
    found = materialise(few(_with_base(_prepared(docs, text)), docs).select("doc_id", "fp", "_base", F.when(F.size("_base") > 0, _terms(p)).alias("_w")), "found")
    d = _spans(found.drop("_w"), term_spans(docs, found, p, text), p)
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return d.select("doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)), F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_all")).alias("spans"))


def sanitise(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """docs with every entity in its text generalised to [EMAIL], [IP], [CARD] or [PHONE], and disclosing terms
    removed ([TERM]); overlapping spans become one, of the first one's kind. All rows and columns stay, whatever the
    columns' names; repeated rows fare alike, an empty table stays empty. A null text stays null, n_chars, where there
    is one, becomes the new text's length. Whole texts are read."""
    found = materialise(few(_with_base(_prepared(docs.select(text), text)), docs).select("fp", "_base", F.when(F.size("_base") > 0, _terms(p)).alias("_w")), "found")
    terms = term_spans(docs, found, p, text)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    d = _spans(_with_base(docs.select(row, F.col(text).alias("_said")).transform(_prepared, "_said")), terms, p)
    names = ", ".join(f"'[{k.upper()}]'" for k in [*KINDS, "term"])
    new = F.expr(
        f"""case when size(_all) = 0 then _t else
          aggregate(array_sort(transform(_all, s -> named_struct('start', s.start, 'stop', s.stop, 'kind', s.kind))),
            named_struct('at', 0, 'out', ''),
            (a, s) -> case when s.start < a.at then named_struct('at', greatest(a.at, s.stop), 'out', a.out)
                      else named_struct('at', s.stop, 'out', concat(a.out, substring(_t, a.at + 1, s.start - a.at), array({names})[s.kind])) end,
            a -> concat(a.out, substring(_t, a.at + 1))) end"""
    )
    d = d.select("_row", F.when(F.col("_said").isNotNull(), new).alias("_new"))

    def column(c: str) -> Column:
        old = F.col("_row")[c]
        if c == text:
            return F.col("_new").alias(c)
        if c == "n_chars":
            old = F.when(F.col("_new").isNotNull(), F.length("_new").cast(docs.schema[c].dataType)).otherwise(old)
        return old.alias(c)

    return few(d.select(*map(column, docs.columns)), docs)
