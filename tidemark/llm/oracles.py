"""DuckDB SQL for those corpus queries that SQL can express, over whole tables.

The others are tested against brute force: substring dedup (one string a window of 100 bytes is too much for SQL here), the
mix (its order is that of a hash that DuckDB lacks), licences (all windows), quality rules (sketches), extraction and the
classifier (learnt).
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

#: Shingle sets, all pairs with a common shingle, links, and their closure.
NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
low AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
"""

_NOT_ALNUM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: All runs of all diagonals of all pairs of a document and an item: those that begin and end with equal tokens.
DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '{_NOT_ALNUM}'), lambda x: x <> '') AS ws FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '{_NOT_ALNUM}'), lambda x: x <> '') AS ws FROM benchmark WHERE text IS NOT NULL),
dt AS (SELECT doc_id, unnest(ws) AS t, unnest(range(0, len(ws))) AS k FROM d),
it AS (SELECT item_id, unnest(ws) AS t, unnest(range(0, len(ws))) AS k FROM i),
need AS (SELECT item_id, CASE WHEN len(ws) < 6 THEN len(ws) ELSE least(13, CAST(ceil(0.8 * len(ws) - 1e-9) AS BIGINT)) END AS need FROM i),
eq AS (SELECT doc_id, item_id, dt.k - it.k AS shift, dt.k AS k FROM dt JOIN it ON dt.t = it.t),
hits AS (SELECT doc_id, item_id, shift, any_value(need) AS need, list_sort(list(k)) AS ks FROM eq JOIN need USING (item_id) GROUP BY doc_id, item_id, shift HAVING count(*) >= any_value(need)),
m AS (SELECT doc_id, item_id, shift, need, unnest(ks) AS k, unnest(range(0, len(ks))) AS r FROM hits),
runs AS (SELECT a.doc_id, a.item_id, a.shift, a.k AS start, b.k - a.k + 1 AS size, b.r - a.r + 1 AS same FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.shift = b.shift AND b.r - a.r + 1 >= a.need
         WHERE 4 * (b.r - a.r + 1) >= 3 * (b.k - a.k + 1)),
one AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY same DESC, start + size) = 1)
SELECT doc_id, item_id, start, size AS run_tokens, same AS matched_tokens FROM one QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY same DESC, size, start) = 1
"""

#: What is read back equals what went in; the formatted length is that of the turns' control strings, and a backslash for
#: each backslash and control string in a text.
CHAT_TREE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) t(conv_id, turn, role, text)),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\|\[/?INST\]|</?s>|<</?SYS>>|<<ROLE:|<</ROLE>>'))
  + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 18 + length(role) + len(regexp_extract_all(role, '[\\>]')) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def _kind(k: int, name: str, pattern: str, valid: str) -> str:
    """Matches of one kind: the pieces between them, summed up."""
    return (
        f"k{k} AS (SELECT doc_id, fp, {k} AS kind, ms[i] AS x, CAST(list_sum(list_transform(pc[1:i], lambda q: length(q))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda q: length(q))), 0) AS BIGINT) AS s "
        f"FROM (SELECT doc_id, fp, ms, pc, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, fp, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS pc FROM d WHERE regexp_matches(t, '{pattern}')))),\n"
        f"v{k} AS (SELECT doc_id, fp, kind, '{name}' AS name, x, s, s + length(x) AS e FROM k{k} WHERE {valid})"
    )


_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_KINDS = [
    ("email", _EMAIL, "true"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(x, '.'), lambda q: coalesce(TRY_CAST(q AS BIGINT), 999) > 255)) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j: CASE WHEN j % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), j, 1) AS INTEGER) ELSE CAST(substr('0246813579', CAST(substr(reverse({_DIGITS}), j, 1) AS INTEGER) + 1, 1) AS INTEGER) END)) % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
]


def pii(min_letters: int, deviations: float, least: float) -> str:
    """Base spans, and the terms whose PMI with an entity reaches a share of its information, by the lower end of Wilson's
    interval; over different texts."""
    low = f"((least(n_et, n_t) + {deviations**2 / 2} - {deviations} * sqrt(least(n_et, n_t) * (n_t - least(n_et, n_t)) / n_t + {deviations**2 / 4})) / (n_t + {deviations**2}))"
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS fp FROM documents),\n"
        + ",\n".join(_kind(k, *x) for k, x in enumerate(_KINDS))
        + f""",
b AS (SELECT * FROM v0 UNION ALL SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3),
texts AS (SELECT fp, any_value(t) AS t FROM d GROUP BY fp),
total AS (SELECT count(*) AS n FROM texts),
terms AS (SELECT DISTINCT fp, unnest(list_filter(regexp_extract_all(lower(regexp_replace(t, '{_EMAIL}', ' ', 'g')), '\\p{{L}}+'), lambda x: length(x) >= {min_letters})) AS term FROM texts),
ent AS (SELECT DISTINCT fp, name || ':' || lower(x) AS entity FROM b),
n_e AS (SELECT entity, count(*) AS n_e FROM ent GROUP BY entity),
n_t AS (SELECT term, count(*) AS n_t FROM terms WHERE term IN (SELECT term FROM terms WHERE fp IN (SELECT fp FROM ent)) GROUP BY term),
n_et AS (SELECT entity, term, count(*) AS n_et FROM ent JOIN terms USING (fp) GROUP BY entity, term),
tells AS (SELECT DISTINCT term FROM n_et JOIN n_e USING (entity) JOIN n_t USING (term), total WHERE log2({low} * n / n_e) / greatest(log2(n / n_e), 1e-9) >= {least}),
runs AS (SELECT fp, ms[i] AS x, CAST(list_sum(list_transform(pc[1:i], lambda q: length(q))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda q: length(q))), 0) AS BIGINT) AS s
  FROM (SELECT fp, ms, pc, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT fp, regexp_extract_all(t, '\\p{{L}}+') AS ms, string_split_regex(t, '\\p{{L}}+') AS pc FROM texts WHERE fp IN (SELECT fp FROM terms JOIN tells USING (term))))),
own AS (SELECT r.fp, s, s + length(x) AS e FROM runs r JOIN tells ON tells.term = lower(x) JOIN (SELECT DISTINCT fp, term FROM terms) q ON q.fp = r.fp AND q.term = lower(x)),
free AS (SELECT DISTINCT fp, s, e FROM own o WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.fp = o.fp AND b.s < o.e AND o.s < b.e)),
base AS (SELECT doc_id, any_value(fp) AS fp, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip, count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
  string_agg(name || ':' || s || ':' || e, ',' ORDER BY kind, s) AS said FROM b GROUP BY doc_id),
more AS (SELECT fp, string_agg('term:' || s || ':' || e, ',' ORDER BY s) AS said FROM free GROUP BY fp)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base.said, '')) AS base_sha256,
  concat_ws(',', base.said, more.said) AS spans FROM d LEFT JOIN base USING (doc_id) LEFT JOIN more ON more.fp = d.fp
"""
    )


_CRC = "xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda s, b: xor(t[xor(s, b) % 256 + 1], s // 256)), 4294967295) % 11"

#: Codes by a check sum from its table; lines, gaps, columns and rows as contracted.
BRANCH_MERGE = f"""
WITH tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT rid, doc_id, unnest(['row', 'lang', 'source'] || list_transform(range(len(ls)), lambda i: CAST(i AS VARCHAR))) AS name, unnest(['', lang, source] || ls) AS val, unnest(range(-3, len(ls))) AS n FROM d),
k AS (SELECT *, 'L:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || name AS kl, 'R:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || name AS kr FROM u),
c AS (SELECT rid, doc_id, name, val, n, (SELECT {_CRC} FROM (SELECT kl AS k)) AS l, (SELECT {_CRC} FROM (SELECT kr AS k)) AS r FROM k, tab),
e AS (SELECT *, CASE WHEN n < -2 THEN NULL WHEN l IN (1, 2) OR l = 0 AND (n >= 0 OR val <> '') THEN l END AS le, CASE WHEN n < -2 THEN NULL WHEN r IN (1, 2) OR r = 0 AND (n >= 0 OR val <> '') THEN r END AS re,
  CASE WHEN n >= 0 AND l IN (3, 4) THEN l END AS lg, CASE WHEN n >= 0 AND r IN (3, 4) THEN r END AS rg FROM c),
m AS (SELECT *, le <> re AS clash, CASE WHEN le <> re THEN NULL ELSE coalesce(le, re) END AS ch, lg <> rg AS gclash, CASE WHEN lg <> rg THEN NULL ELSE coalesce(lg, rg) END AS g FROM e),
o AS (SELECT *, CASE ch WHEN 0 THEN CASE WHEN n < 0 THEN '' END WHEN 1 THEN val || '!' WHEN 2 THEN val || '?' ELSE val END AS v, CASE g WHEN 3 THEN '!' WHEN 4 THEN '?' END AS nv FROM m),
a AS (SELECT rid, any_value(doc_id) AS doc_id, max(l) FILTER (n = -3) AS lr, max(r) FILTER (n = -3) AS rr, bool_or(coalesce(le, lg) IS NOT NULL) AS lt, bool_or(coalesce(re, rg) IS NOT NULL) AS rt,
  max(v) FILTER (n = -2) AS lang, max(val) FILTER (n = -2) AS blang, max(v) FILTER (n = -1) AS source, max(val) FILTER (n = -1) AS bsource,
  coalesce(array_to_string(flatten(list([v, nv] ORDER BY n) FILTER (n >= 0)), chr(10)), '') AS text, array_to_string(list(val ORDER BY n) FILTER (n >= 0), chr(10)) AS btext,
  count(ch) + count(g) AS ok, coalesce(count_if(clash AND (n < 0 OR le <> 0 AND re <> 0)), 0) AS ee, coalesce(count_if(clash AND n >= 0 AND (le = 0 OR re = 0)), 0) AS ed, coalesce(count_if(gclash), 0) AS ii FROM o GROUP BY rid),
s AS (SELECT *, lr = 0 AND rr <> 0 AND rt OR rr = 0 AND lr <> 0 AND lt AS against, lr = 0 OR rr = 0 AS dropped FROM a),
base AS (SELECT doc_id, CASE WHEN against THEN blang WHEN dropped THEN NULL ELSE lang END AS lang, CASE WHEN against THEN bsource WHEN dropped THEN NULL ELSE source END AS source,
  CASE WHEN against THEN sha256(btext) WHEN dropped THEN NULL ELSE sha256(text) END AS text_sha256, CASE WHEN against THEN 0 WHEN dropped THEN 1 ELSE ok END AS n_clean, CASE WHEN dropped THEN 0 ELSE ee END AS n_edit_edit,
  CASE WHEN against THEN 1 WHEN dropped THEN 0 ELSE ed END AS n_edit_delete, CASE WHEN dropped THEN 0 ELSE ii END AS n_insert_insert FROM s),
new AS (SELECT -1 - doc_id AS doc_id, blang, bsource, CASE lr WHEN 3 THEN '!' ELSE '?' END AS v FROM s WHERE lr IN (3, 4) UNION ALL SELECT -2 - doc_id, blang, bsource, CASE rr WHEN 3 THEN '!' ELSE '?' END FROM s WHERE rr IN (3, 4)),
one AS (SELECT doc_id, count(DISTINCT {{'a': blang, 'b': bsource, 'c': v}}) = 1 AS same, any_value(blang) AS lang, any_value(bsource) AS source, any_value(v) AS v FROM new GROUP BY doc_id)
SELECT doc_id, lang, source, text_sha256, CAST(n_clean AS BIGINT) AS n_clean, CAST(n_edit_edit AS BIGINT) AS n_edit_edit, CAST(n_edit_delete AS BIGINT) AS n_edit_delete, CAST(n_insert_insert AS BIGINT) AS n_insert_insert FROM base
UNION ALL SELECT doc_id, CASE WHEN same THEN lang END, CASE WHEN same THEN source END, CASE WHEN same THEN sha256(v) END, CAST(same AS BIGINT), 0, 0, CAST(NOT same AS BIGINT) FROM one
"""

#: All scores of all items, in 64-bit integers.
LEXICAL_SEARCH = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '{_NOT_ALNUM}'), lambda x: x <> '') AS ws FROM documents),
q AS (SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '{_NOT_ALNUM}'), lambda x: x <> '')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS all_terms FROM t WHERE len(ws) > 0),
f AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM t) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM f, s GROUP BY term),
m AS (SELECT rid, doc_id, 100 - 50 + (50 * len(ws) * n_docs) // all_terms AS m FROM t, s WHERE len(ws) > 0),
r AS (SELECT item_id, rid, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, rid) AS rank FROM r WHERE score > 0) WHERE rank <= 50
"""
