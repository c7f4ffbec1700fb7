"""The queries in DuckDB SQL, written by hand from the contract."""

from __future__ import annotations

from corpusloom.llm import licences

SQL: dict[str, str] = {}

SQL["op2_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
p AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT r, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS twice FROM g),
k AS (SELECT r, twice OR coalesce(lag(twice) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit
  FROM c WINDOW o AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, count(*) FILTER (WHERE hit) AS n_repeat_words FROM k GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN n USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits FROM b
"""

SQL["op3_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
  SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT r, n, i, item_id FROM dw JOIN bw USING (n, win)),
c AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM (SELECT r, i, unnest(generate_series(0, n - 1)) AS j FROM h) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
"""

SQL["op4_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
f AS (SELECT page_id, n, sha256(html) AS digest, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

SQL["op9_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (
  SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, m AS component_id, doc_id = m AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) USING (doc_id)
"""

SQL["op5_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS site, text, string_split(text, chr(10)) AS l FROM documents),
e AS (SELECT r, site, unnest(l) AS raw, generate_subscripts(l, 1) AS i FROM d WHERE text IS NOT NULL),
t AS (SELECT r, site, raw, i, trim(translate(raw, chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS t FROM e),
c AS (SELECT site, t, count(DISTINCT r) AS n FROM t WHERE t <> '' GROUP BY ALL),
p AS (SELECT site, count(*) AS pages FROM d GROUP BY site),
b AS (SELECT site, t FROM c JOIN p USING (site) WHERE n >= 3 AND 100 * n > 10 * pages),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE b.t IS NOT NULL) AS n_dropped,
  coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE b.t IS NULL), '') AS text
  FROM t LEFT JOIN b USING (site, t) GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, k.text FROM d LEFT JOIN k USING (r)
"""

def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canon(column: str) -> str:
    """Small letters, copyright lines out, one spelling, words parted by one space."""
    out = f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = rf"regexp_replace({out}, '(?m)^[ \t#*/;%-]*(copyright\b|\(c\)|©)[^\n]*(19|20)[0-9][0-9][^\n]*$', ' ', 'g')"
    for a, b in (("licence", "license"), ("sub-licens", "sublicens"), ("non-commercial", "noncommercial")):
        out = f"replace({out}, '{a}', '{b}')"
    out = f"replace(replace({out}, 'organisation', 'organization'), 'organise', 'organize')"
    out = f"replace(replace(replace({out}, 'favour', 'favor'), 'merchantibility', 'merchantability'), 'https://', 'http://')"
    return rf"trim(regexp_replace({out}, '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'))"


_WHOLE = ", ".join(f"({_text(name)}, {_text(t)})" for name, texts in licences.KNOWN.items() for t in texts)
_NAMED = ", ".join(f"({_text(x)}, {_text(name)})" for x, names in licences.NAMES.items() for name in [*names, x])
SQL["op6_license_scan"] = rf"""
WITH written(license, text) AS (
  SELECT * FROM (VALUES {_WHOLE}) UNION ALL
  SELECT x, b || v || ' under ' || a || name FROM (VALUES {_NAMED}) n(x, name),
    (VALUES (''), ('This work is '), ('This project is '), ('This software is '), ('This file is ')) whole(b),
    (VALUES ('licensed'), ('released'), ('distributed')) verbs(v), (VALUES (''), ('the '), ('a ')) articles(a) UNION ALL
  SELECT x, 'SPDX-License-Identifier: ' || name FROM (VALUES {_NAMED}) n(x, name)),
known AS (SELECT min(license) AS license, {_canon("text")} AS canon FROM written GROUP BY canon),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT r, 0 AS line, text AS u FROM d UNION ALL
  SELECT r, i, l[i] FROM (SELECT r, string_split(text, chr(10)) AS l, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM d)
  WHERE len(l) > 1),
f AS (SELECT r, line, license FROM u JOIN known ON {_canon("u")} = canon),
g AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(*) FILTER (WHERE line > 0) AS n_notices,
  max(license) FILTER (WHERE line = 0) AS whole_text FROM f GROUP BY r)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_notices, 0) AS n_notices, whole_text FROM d LEFT JOIN g USING (r)
"""

SQL["op7_mixing"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, '') AS s,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n FROM documents),
t AS (SELECT s, sum(n)::BIGINT AS tokens FROM d GROUP BY s HAVING sum(n) > 0),
tot AS (SELECT sum(tokens)::BIGINT AS total, count(*) AS k FROM t),
bisect(lo, hi) AS (SELECT 0, 1000001 UNION ALL
  SELECT CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT lo, hi, mid, (SELECT ln(sum(pow(tokens / total::DOUBLE, mid / 1e6)))
        - mid / 1e6 * sum(pow(tokens / total::DOUBLE, mid / 1e6) * ln(tokens / total::DOUBLE)) / sum(pow(tokens / total::DOUBLE, mid / 1e6))
        >= 0.97 * ln(any_value(k)) FROM t, tot) AS ok
    FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM bisect WHERE hi - lo > 1))),
ent AS (SELECT max(lo) AS a FROM bisect),
repeats(lo, hi) AS (SELECT -1, 1000001 UNION ALL
  SELECT CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END FROM (
    SELECT lo, hi, mid, (SELECT max(pow(tokens / total::DOUBLE, mid / 1e6) / (tokens / total::DOUBLE)) / sum(pow(tokens / total::DOUBLE, mid / 1e6)) > 4.0
      FROM t, tot) AS ok
    FROM (SELECT lo, hi, (lo + hi) // 2 AS mid FROM repeats WHERE hi - lo > 1))),
alpha AS (SELECT greatest((SELECT a FROM ent), least((SELECT max(lo) + 1 FROM repeats), 1000000)) / 1e6 AS a),
p AS (SELECT s, tokens, pow(tokens / total::DOUBLE, a) AS p FROM t, tot, alpha),
b AS (SELECT s, tokens, ((round(p / (SELECT sum(p) FROM p) * 1e12)::HUGEINT * total::HUGEINT + 500000000000) // 1000000000000)::BIGINT AS budget FROM p, tot),
e AS (SELECT s, tokens, budget // tokens AS epochs, budget % tokens AS rest FROM b),
x AS (SELECT doc_id, source, s, n, epochs, rest, unnest(generate_series(0, epochs)) AS epoch FROM d JOIN e USING (s)),
y AS (SELECT *, md5('mix-1|' || s || '|' || epoch || '|' || coalesce(doc_id::VARCHAR, '')) AS order_key FROM x),
z AS (SELECT *, sum(n) OVER (PARTITION BY s, epoch ORDER BY order_key RANGE UNBOUNDED PRECEDING) AS upto,
  FROM y)
SELECT doc_id, source, epoch, order_key FROM z WHERE epoch < epochs OR upto <= rest
"""

#: CRC-32 of a decimal number, bit by bit: a byte is mixed in, then eight shifts.
_CRC32 = r"""(xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda x: [x, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT, -1::BIGINT]))),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END),
    4294967295::BIGINT))"""

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op12_merkle_manifest"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, row_number() OVER () AS r, {_CRC32.format("doc_id")} % 5 = 0 AS chosen,
    sha256({_HEAD} || {_FIELD.format("text")}) AS leaf, sha256({_HEAD} || {_FIELD.format(_LOWER)}) AS changed FROM documents),
o AS (SELECT r, doc_id, leaf, CASE WHEN chosen THEN changed ELSE leaf END AS claim,
    CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS s FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS i FROM o),
t AS (SELECT s, 0 AS lvl, i, leaf AS h FROM p UNION ALL
  SELECT s, any_value(lvl) + 1, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) FROM
    (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM t) WHERE n > 1 GROUP BY s, i // 16),
sub AS (SELECT s, arg_max(h, lvl) AS subroot, max(lvl) AS top FROM t GROUP BY s),
g AS (SELECT s, row_number() OVER (ORDER BY encode(s)) - 1 AS j, subroot FROM sub),
u AS (SELECT 0 AS lvl, j AS i, subroot AS h FROM g UNION ALL
  SELECT any_value(lvl) + 1, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) FROM
    (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY i // 16),
rt AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS top FROM u),
a AS (SELECT r, lvl, i FROM (SELECT r, s, unnest(generate_series(0, top - 1)) AS lvl, p.i // pow(16, unnest(generate_series(0, top - 1)))::BIGINT AS i
    FROM p JOIN sub USING (s))),
low AS (SELECT a.r, a.lvl, a.i % 16 AS place, string_agg(t.h, '' ORDER BY t.i) FILTER (WHERE t.i <> a.i) AS others
  FROM a JOIN p USING (r) JOIN t ON t.s = p.s AND t.lvl = a.lvl AND t.i // 16 = a.i // 16 GROUP BY a.r, a.lvl, a.i),
ga AS (SELECT s, lvl, i FROM (SELECT s, unnest(generate_series(0, top - 1)) AS lvl, j // pow(16, unnest(generate_series(0, top - 1)))::BIGINT AS i FROM g, rt)),
high AS (SELECT ga.s, ga.lvl, ga.i % 16 AS place, string_agg(u.h, '' ORDER BY u.i) FILTER (WHERE u.i <> ga.i) AS others
  FROM ga JOIN u ON u.lvl = ga.lvl AND u.i // 16 = ga.i // 16 GROUP BY ga.s, ga.lvl, ga.i),
w AS (SELECT r, lvl AS k, place, coalesce(others, '') AS others FROM low UNION ALL
  SELECT r, 1000 + lvl, place, coalesce(others, '') FROM p JOIN high USING (s)),
ws AS (SELECT r, list(place ORDER BY k) AS place, list(others ORDER BY k) AS others FROM w GROUP BY r),
f AS (SELECT r, 0 AS k, claim AS h FROM p UNION ALL
  SELECT r, k + 1, sha256(left(others[k + 1], 64 * place[k + 1]) || h || substr(others[k + 1], 64 * place[k + 1] + 1)) FROM f JOIN ws USING (r) WHERE k < len(place)),
z AS (SELECT r, arg_max(h, k) AS folded FROM f GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(others, ''), '')) AS proof_sha256,
  folded AS folded_root, folded = root AS verified
FROM p JOIN sub USING (s) CROSS JOIN rt JOIN z USING (r) LEFT JOIN ws USING (r)
"""

SQL["op13_prefix_trie"] = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, c - c % 20 AS base, {_CRC32.format("c")} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT cs.c, 0 AS own, t.i, role, text FROM cs JOIN t ON t.c = cs.base AND t.i < h
  UNION ALL SELECT cs.c, 1, t.i, role, text FROM cs JOIN t ON t.c = cs.c AND t.i >= h),
p AS (SELECT c, row_number() OVER w AS d, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
    sha256(string_agg(sha256(role) || sha256(text), '') OVER w) AS k FROM r WINDOW w AS (PARTITION BY c ORDER BY own, i)),
a AS (SELECT c, d, k, words FROM p UNION ALL SELECT c, 0, '', 0 FROM cs),
n AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved FROM a GROUP BY d, k),
q AS (SELECT n.*, m.conv_id AS parent_conv_id, x.k AS parent FROM n LEFT JOIN a x ON x.c = n.conv_id AND x.d = n.d - 1
  LEFT JOIN n m ON m.d = x.d AND m.k = x.k),
ch AS (SELECT d - 1 AS d, parent AS k, count(*) AS n_children FROM q WHERE d > 0 GROUP BY ALL),
s AS (SELECT a.d, a.k, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM n LEFT JOIN ch USING (d, k) JOIN a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.d, a.k),
e AS (SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT c, max(d) AS d, arg_max(k, d) AS k FROM a GROUP BY c) GROUP BY d, k)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM q JOIN s USING (d, k) LEFT JOIN ch USING (d, k) LEFT JOIN e USING (d, k)
"""

SQL["op11_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (
  SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
h AS (SELECT r, i FROM g JOIN m USING (g) WHERE doc_id > first),
x AS (SELECT DISTINCT r, i + j AS i FROM (SELECT r, i, unnest(generate_series(0, 12)) AS j FROM h)),
k AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS kept, count(*) AS n FROM (
  SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d) a ANTI JOIN x USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
