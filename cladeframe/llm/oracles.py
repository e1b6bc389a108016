"""SQL, for another engine, of the rows that the queries return over whole tables.

Substring dedup by bytes, PII, HTML extraction and SimHash are not here: tests hold them against brute force.
"""

import re

from .licenses import MIN_COVER, PHRASES, notices, parsed
from .quality import CAPITAL, FUNCTION_WORD, ITEM, LIST_WORDS, MAX_REPEAT_PERCENT, MENU, MENU_CHARS, MIN_WORDS, NOTICE, NOTICE_CHARS, PROSE_WORDS, SENTENCE_END, SEPARATORS, SHOUT, SYMBOLS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TOKENS = rf"regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def count(pattern: str, x: str = "x") -> str:
    return f"len(regexp_extract_all({x}, {quoted(pattern)}))"


SUBSTRING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT r, k, array_to_string(w[k + 1 : k + 35], ' ') AS s FROM (SELECT r, w, unnest(range(len(w) - 34)) AS k FROM d WHERE len(w) >= 35)),
rep AS (SELECT r, k FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, k + j AS p FROM (SELECT r, k, unnest(range(35)) AS j FROM rep)),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (SELECT words.r, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p WHERE gone.r IS NULL GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, i, trim(x, {SPACE}) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE trim(x, {SPACE}) <> ''),
w AS (SELECT doc_id, k, t || chr(10) || lead(t, 1) OVER o || chr(10) || lead(t, 2) OVER o AS s FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
later AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s ORDER BY doc_id, k) AS q FROM w WHERE s IS NOT NULL) WHERE q > 1),
gone AS (SELECT DISTINCT doc_id, k + j AS k FROM (SELECT doc_id, k, unnest(range(3)) AS j FROM later)),
marked AS (SELECT l.doc_id, l.x, l.i, gone.k IS NOT NULL AS out FROM l LEFT JOIN n ON n.doc_id = l.doc_id AND n.i = l.i LEFT JOIN gone ON gone.doc_id = n.doc_id AND gone.k = n.k),
s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed, string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT out) AS t FROM marked GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
"""

ENDS = f"regexp_matches(x, {quoted(SENTENCE_END)})"
FAILS = f"""(n >= 3 AND 2 * {count(CAPITAL)} > length(x)) OR ({count(SYMBOLS)} >= 3 AND 2 * {count(SYMBOLS)} > n) OR ({count(SHOUT)} >= 3 AND 2 * {count(SHOUT)} > n)
 OR {count(SEPARATORS)} >= 3 OR (length(x) <= {MENU_CHARS} AND regexp_matches(lower(x), {quoted(MENU)})) OR (n >= {LIST_WORDS} AND NOT {ENDS} AND NOT regexp_matches(lower(x), {quoted(FUNCTION_WORD)}))
 OR (length(x) <= {NOTICE_CHARS} AND regexp_matches(lower(x), {quoted(NOTICE)}))"""
SHORT = f"n > 0 AND n < {PROSE_WORDS} AND NOT {ENDS} AND NOT regexp_matches(x, {quoted(ITEM)})"
QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
e AS (SELECT r, doc_id, text, {WORDS} AS w FROM d),
lines AS (SELECT r, i, l, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT r, i, l, trim(l, {SPACE}) AS x FROM (SELECT r, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM d))),
facts AS (SELECT r, i, l, x, x <> '' AND ({FAILS}) AS fails, {SHORT} AS short FROM lines),
runs AS (SELECT r, i, l, x, fails OR (short AND ((coalesce(lag(short, 1) OVER o, false) AND coalesce(lag(short, 2) OVER o, false)) OR (coalesce(lag(short, 1) OVER o, false) AND coalesce(lead(short, 1) OVER o, false))
 OR (coalesce(lead(short, 1) OVER o, false) AND coalesce(lead(short, 2) OVER o, false)))) AS gone FROM facts WINDOW o AS (PARTITION BY r ORDER BY i)),
j AS (SELECT r, count(*) FILTER (WHERE x <> '') - count(DISTINCT l) FILTER (WHERE x <> '') AS n_dup_lines, string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept_text FROM runs GROUP BY 1),
g AS (SELECT r, k, w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3] AS s FROM (SELECT r, w, unnest(range(len(w) - 2)) AS k FROM e WHERE len(w) >= 3)),
t AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, s) AS c FROM g) WHERE c > 1),
m AS (SELECT r, count(DISTINCT k + o) AS n FROM (SELECT r, k, unnest(range(3)) AS o FROM t) GROUP BY 1),
b AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(text) - {count(r"[\x20\x09-\x0D]", "text")} AS word_chars, {count(SYMBOLS, "text")} AS n_symbols, n_dup_lines, coalesce(n, 0) AS n_repeat_words, length(text) AS chars, length(coalesce(kept_text, '')) AS kept_chars
 FROM e JOIN j USING (r) LEFT JOIN m USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 2 * (chars - kept_chars) <= chars AS kept FROM f
"""

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TOKENS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS rw, item_id, w FROM (SELECT DISTINCT item_id, {TOKENS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT rw, item_id, a0, w[a0 + 1 : a0 + 10] AS x FROM (SELECT rw, item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS a0 FROM b)),
sizes AS (SELECT DISTINCT len(x) AS n FROM bw),
dw AS (SELECT r, p, n, array_to_string(w[p + 1 : p + n], ' ') AS s FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT r, p, n, item_id FROM dw JOIN (SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS s FROM bw) USING (n, s)),
cover AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, item_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1),
tok AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS p FROM d),
freq AS (SELECT term, count(*) AS n FROM tok GROUP BY 1),
parts AS (SELECT rw, item_id, a0, a0 + i AS o, term, coalesce(n, 0) AS n, i FROM (SELECT rw, item_id, a0, unnest(x) AS term, unnest(range(len(x))) AS i FROM bw) LEFT JOIN freq USING (term)),
need AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rw, a0 ORDER BY n, term, i) AS k FROM parts) WHERE k <= 2),
posts AS (SELECT rw, a0, item_id, k, r, p - o AS line FROM need JOIN tok USING (term)),
maybe AS (SELECT DISTINCT x.rw, x.a0, x.item_id, x.r, x.line FROM posts x JOIN posts y ON x.rw = y.rw AND x.a0 = y.a0 AND x.r = y.r AND x.k = 1 AND y.k = 2 AND y.line BETWEEN x.line - 2 AND x.line + 2),
lens AS (SELECT rw, a0, count(*) AS size FROM parts GROUP BY ALL),
near AS (SELECT DISTINCT r, item_id FROM (SELECT m.r, m.item_id, m.rw, m.a0, m.line, count(DISTINCT parts.o) AS met FROM maybe m JOIN parts USING (rw, a0) JOIN tok ON tok.r = m.r AND tok.term = parts.term AND tok.p - parts.o BETWEEN m.line - 2 AND m.line + 2 GROUP BY ALL) JOIN lens USING (rw, a0) WHERE met >= 0.8 * size),
only_near AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM (SELECT r, item_id FROM near EXCEPT SELECT r, item_id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN cover USING (r) LEFT JOIN found USING (r) LEFT JOIN only_near USING (r)
"""

MIX = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(k - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(source_size * 2 AS DOUBLE) AS most FROM s),
o AS (SELECT *, most / weight AS ratio FROM w),
l AS (SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS n FROM o),
f AS (SELECT level AS found FROM l WHERE level <= ratio ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN found IS NULL THEN most ELSE least(most, found * weight) END AS target FROM l LEFT JOIN f ON true),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(CAST(floor(target / source_size) AS BIGINT), 2) END AS epochs FROM t),
p AS (SELECT d.r, d.doc_id, d.size, e.source_size, e.target, e.epochs, CAST(floor(e.target) AS BIGINT) - e.epochs * e.source_size AS rest,
 sum(d.size) OVER (PARTITION BY d.source, d.key) AS here, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - here < rest THEN floor((rest - (upto - here)) * size / here) ELSE 0 END AS BIGINT) AS taken FROM p
"""

TEMPLATE_ROWS = ", ".join(f"({n}, '{label}', '{' '.join(parsed(body, 3)[0])}', '{' '.join(re.findall(r'\[(.*)\]', body))}')" for n, (label, body) in enumerate(notices()))
PHRASE_ROWS = ", ".join(f"('{text}', '{label}')" for text, label in PHRASES.items())
#: Notices by another way than voting: each template aligned word by word at every place where three words of it in a row
#: stand in the text, with none inserted or missing; a share of its words may differ, the name may not.
LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TOKENS} AS w FROM documents),
ph AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {PHRASE_ROWS}) v(p, label)),
base AS (SELECT r, i, label FROM (SELECT r, w, p, label, unnest(range(len(w) - len(p) + 1)) AS i FROM d, ph WHERE len(w) >= len(p) AND list_contains(w, p[1])) WHERE w[i + 1 : i + len(p)] = p),
b AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS base FROM base GROUP BY 1),
t AS (SELECT template, label, string_split(body, ' ') AS w, name FROM (VALUES {TEMPLATE_ROWS}) v(template, label, body, name)),
tg AS (SELECT template, array_to_string(w[a0 + 1 : a0 + 3], ' ') AS g, a0 FROM (SELECT template, w, unnest(range(len(w) - 2)) AS a0 FROM t)),
dg AS (SELECT r, i, array_to_string(w[i + 1 : i + 3], ' ') AS g FROM (SELECT r, w, unnest(range(len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
pl AS (SELECT DISTINCT r, template, i - a0 AS s FROM dg JOIN tg USING (g)),
al AS (SELECT pl.r, pl.template, s, label, len(t.w) AS n, name, list_filter(range(len(t.w)), lambda q: s + q >= 0 AND d.w[s + q + 1] = t.w[q + 1]) AS same, array_to_string(d.w[greatest(s, 0) + 1 : s + len(t.w)], ' ') AS span FROM pl JOIN d USING (r) JOIN t USING (template)),
ok AS (SELECT r, list(DISTINCT label) AS own, max(len(same) / n) AS cover FROM al WHERE len(same) / n >= {MIN_COVER} AND contains(' ' || span || ' ', ' ' || name || CASE WHEN name = '' THEN '' ELSE ' ' END) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(base, ','), '') AS base_labels,
 coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(cover, 0.0) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN ok USING (r)
"""

EXACT = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOW} AS t FROM documents) WINDOW g AS (PARTITION BY t)
"""

AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS} AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
 || CASE WHEN 100 * {count("[A-Z]", "t")} > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS bad FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, bad, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
v AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM v a, v b, v c, v d, v e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[:step - 1] AS earlier FROM o, range(1, 6) r(step)),
x AS (SELECT part, filter_order, step, own, n, good, toxic, bad, contains(bad, own) AS fails, translate(bad, earlier, '') <> bad AS gone FROM m, s),
g AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE fails AND gone), 0) AS redundant,
 coalesce(sum(n) FILTER (WHERE bad = own), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
 CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g
"""

CRC = """list_reduce(list_concat([4294967295::BIGINT], range(8 * length(s))::BIGINT[]), lambda c, i: CASE WHEN (xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[(i // 8 + 1)::INT]) ELSE 0 END) & 1) = 1
 THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[(i // 8 + 1)::INT]) ELSE 0 END) >> 1, 3988292384::BIGINT) ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(s[(i // 8 + 1)::INT]) ELSE 0 END) >> 1 END)"""


def leaf_of(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


def tree_levels(name: str, n: int) -> str:
    """Levels 1 to n over {name}0 (g, i, h, c), c the nodes of g on the level: a node of one alone goes up as it is."""
    return "".join(
        f"{name}{k} AS (SELECT g, i // 16 AS i, CASE WHEN c > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h, (c + 15) // 16 AS c FROM {name}{k - 1} GROUP BY g, i // 16, c),\n" for k in range(1, n + 1)
    )


def tree_paths(name: str, n: int) -> str:
    """{name}p (g, i, path): what stands left and right of the i-th leaf on each of n levels that has more than one node."""
    sides = "".join(
        f"{name}s{k} AS (SELECT x.g, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r FROM {name}{k} x JOIN {name}{k} y ON x.g = y.g AND x.i // 16 = y.i // 16 AND x.c > 1 GROUP BY ALL),\n"
        for k in range(n)
    )
    joins = " ".join(f"LEFT JOIN {name}s{k} s{k} ON s{k}.g = z.g AND s{k}.i = z.i // {16**k}" for k in range(n))
    pairs = ", ".join(f"CASE WHEN s{k}.g IS NULL THEN NULL ELSE {{'l': s{k}.l, 'r': s{k}.r}} END" for k in range(n))
    return f"{sides}{name}p AS (SELECT z.g, z.i, list_filter([{pairs}], lambda q: q IS NOT NULL) AS path FROM {name}0 z {joins})"


#: 16^5 rows a source and 16^3 sources; ids of a source are distinct.
MERKLE = f"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf_of("text")} AS leaf, {leaf_of("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low, CAST(doc_id AS VARCHAR) AS s FROM documents),
n AS (SELECT doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, CASE WHEN xor({CRC}, 4294967295::BIGINT) % 5 = 0 THEN low ELSE leaf END AS start FROM d),
a0 AS (SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS c FROM n),
{tree_levels("a", 5)}b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS c, g AS own FROM a5),
{tree_levels("b", 3)}{tree_paths("a", 5)},
{tree_paths("b", 3)},
x AS (SELECT n.doc_id, n.leaf, n.start, b0.h AS subroot, b3.h AS root, list_concat(ap.path, bp.path) AS path FROM n JOIN ap USING (g, i) JOIN b0 ON b0.own = n.g JOIN bp ON bp.i = b0.i CROSS JOIN b3),
y AS (SELECT *, list_reduce(list_concat([{{'l': start, 'r': ''}}], path), lambda q, p: {{'l': sha256(p.l || q.l || p.r), 'r': ''}}).l AS folded_root FROM x)
SELECT doc_id, leaf, subroot, root, sha256(list_reduce(list_concat([''], list_transform(path, lambda p: p.l || p.r)), lambda q, p: q || p)) AS proof_sha256, folded_root, folded_root = root AS verified FROM y
"""

SQL: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING,
    "op2_line_dedup": LINES,
    "op3_quality_rules": QUALITY,
    "op4_decontaminate": CONTAMINATION,
    "op9_mix_sources": MIX,
    "op10_license_scan": LICENSES,
    "op11_merkle_manifest": MERKLE,
    "op12_filter_audit": AUDIT,
    "op13_exact_dedup": EXACT,
}
