"""DuckDB's SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .licenses import TELLING, TEMPLATES, THRESHOLD

_ESCAPE = r"regexp_replace({0}, '([<\[])(\\*)(/?(?:s>|INST\]|NEXT\]))', '\1\\\2\3', 'g')"

OP1 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPE.format("text")}) + CASE WHEN opens THEN 20 + length({_ESCAPE.format("role")}) ELSE 6 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN w[i:i + 4] ELSE w END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT * FROM (WITH RECURSIVE reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a) SELECT a, min(b) AS low FROM reach GROUP BY a))
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id
"""

OP4 = """
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, source, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM texts),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS c, n FROM (
    SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS i, array_to_string(w[i:i + 4], ' ') AS h FROM parts WHERE len(w) >= 5)),
repeats AS (
  SELECT doc_id, sum(least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) - i)) OVER (PARTITION BY doc_id) AS r
  FROM windows WHERE c >= 2),
measured AS (
  SELECT p.doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.r, 0) AS n_repeat_words
  FROM parts p LEFT JOIN (SELECT DISTINCT doc_id, r FROM repeats_sum) r USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM judged GROUP BY source),
moments AS (SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v, avg(1 / n) AS s FROM hosts),
prior AS (
  SELECT m, CASE WHEN m * (1 - m) > 0 THEN greatest(m * (1 - m) / greatest(coalesce(v, 0) - m * (1 - m) * s, m * (1 - m) * 1e-4) - 1, 1) ELSE 1 END AS k FROM moments),
verdict AS (SELECT source, (f + m * k) / (n + k) AS rate FROM hosts, prior)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND rate <= 0.6 AS kept
FROM judged j JOIN verdict v ON j.source IS NOT DISTINCT FROM v.source
""".replace("""repeats AS (
  SELECT doc_id, sum(least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) - i)) OVER (PARTITION BY doc_id) AS r
  FROM windows WHERE c >= 2),""", """repeats AS (
  SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), i + 5) - i) AS r FROM windows WHERE c >= 2),
repeats_sum AS (SELECT doc_id, sum(r) AS r FROM repeats GROUP BY doc_id),""")

_WORDS5 = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH docs AS (SELECT doc_id, {_WORDS5} AS w FROM documents),
items AS (SELECT item_id, {_WORDS5} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS m FROM items WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, m, w[i:i + m - 1] AS p FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT m FROM patterns),
spots AS (SELECT doc_id, m, i, w[i:i + m - 1] AS p FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, lengths WHERE len(w) >= m)),
found AS (SELECT doc_id, i, s.m, item_id FROM spots s JOIN patterns t ON s.m = t.m AND s.p = t.p),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT page_id, strlen(h) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND top <> page_id THEN top END AS refers_to
FROM m
"""

_T = ", ".join("('{}', '{}', {}, {})".format(n, x.replace("'", "''"), m.split(), next((v for k, v in TELLING.items() if k in n), [])) for n, x, m in TEMPLATES)
_W8 = r"list_filter(string_split(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
_B8 = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_S8 = rf"list_transform(string_split(regexp_replace(line, '([.!?;])[ \t]+', '\1' || chr(1), 'g'), chr(1)), lambda s: {_W8.format('s')})"

OP8 = f"""
WITH t AS (SELECT name, {_B8} AS b, list_concat(must, list_intersect(telling, w))::VARCHAR[] AS yes, list_filter(telling, lambda x: NOT list_contains(w, x))::VARCHAR[] AS no
  FROM (SELECT name, must, telling, {_W8.format("x")} AS w FROM (VALUES {_T}) v(name, x, must, telling))),
d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
e AS (SELECT doc_id, list_transform(regexp_split_to_array(x, '\n[ \t\r]*\n'), lambda p: list_transform(string_split(p, chr(10)), lambda line: {_S8})) AS n FROM d),
u AS (SELECT doc_id, unnest(list_distinct(list_concat(flatten(flatten(n)), list_transform(flatten(n), lambda x: flatten(x)), list_transform(n, lambda x: flatten(flatten(x))), [flatten(flatten(flatten(n)))]))) AS w FROM e),
n AS (SELECT row_number() OVER () AS u, doc_id, w, {_B8} AS b FROM u),
s AS (SELECT u, doc_id, name, 2.0::DOUBLE * len(list_intersect(n.b, t.b)) / (len(n.b) + len(t.b)) AS dice FROM n JOIN t
  ON len(n.b) BETWEEN 1 AND 1000 AND len(n.b) >= {THRESHOLD / (2 - THRESHOLD)!r} * len(t.b) AND len(n.b) <= {(2 - THRESHOLD) / THRESHOLD!r} * len(t.b) AND list_has_all(w, yes) AND NOT list_has_any(w, no)),
m AS (SELECT u, doc_id, max(dice) AS dice, arg_max(name, struct_pack(d := dice, n := name)) AS name FROM s WHERE dice >= {THRESHOLD} GROUP BY u, doc_id),
best AS (SELECT doc_id, count(*) AS c, max(dice) AS dice, arg_max(name, struct_pack(d := dice, n := name)) AS name FROM m GROUP BY doc_id)
SELECT d.doc_id, name AS license_id, dice, CAST(coalesce(c, 0) AS BIGINT) AS n_matches FROM d LEFT JOIN best USING (doc_id)
"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_BYTE = "list_reduce(list_prepend(xor(c, b), range(8)::BIGINT[]), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))"
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)), lambda c, b: {_BYTE}), 4294967295)"
_LOWERED = _LOWER.replace("coalesce(text, '')", "text")


def _levels(name: str, height: int) -> str:
    """Levels {name}0 (g, i, n, node) to {name}height; {name}p0 to {name}p(height): each node's siblings, by g, i."""
    out = []
    for k in range(height):
        out.append(f"""{name}p{k} AS (SELECT *, coalesce(string_agg(node, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(node, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WINDOW r AS (PARTITION BY g, i // 8 ORDER BY i)),
{name}{k + 1} AS (SELECT g, i // 8 AS i, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN node ELSE sha256(node || r) END AS node FROM {name}p{k} WHERE i % 8 = 0)""")
    return ",\n".join(out)


def _fold(name: str, start: str, height: int) -> str:
    """{name}f0 (id, g, i, acc, proof) from start up the levels, to {name}f(height)."""
    out = [f"{name}f0 AS ({start})"]
    for k in range(height):
        out.append(f"""{name}f{k + 1} AS (SELECT id, f.g, f.i // 8 AS i, CASE WHEN n = 1 THEN acc ELSE sha256(l || acc || r) END AS acc, CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof
  FROM {name}f{k} f JOIN {name}p{k} p ON f.g = p.g AND f.i = p.i)""")
    return ",\n".join(out)


_DEEP, _WIDE = 7, 3  # levels that are written out: parts of 8^7 rows, 8^3 parts
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS id, *, {_leaf('text')} AS leaf, {_leaf(_LOWERED)} AS lowered, {_CRC} % 3 = 0 AS hit, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
a0 AS (SELECT g, i, n, leaf AS node FROM o),
{_levels('a', _DEEP)},
b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n, node, g AS part FROM a{_DEEP}),
{_levels('b', _WIDE)},
{_fold('a', "SELECT id, g, i, CASE WHEN hit THEN lowered ELSE leaf END AS acc, '' AS proof FROM o", _DEEP)},
{_fold('b', f"SELECT id, 0 AS g, b0.i, acc, proof FROM af{_DEEP} f JOIN b0 ON f.g = b0.part", _WIDE)}
SELECT doc_id, leaf, s.node AS subroot, t.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.node AS verified
FROM o JOIN bf{_WIDE} f USING (id) JOIN a{_DEEP} s ON s.g = o.g JOIN b{_WIDE} t ON true
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
  regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
  coalesce(g.good, false) AS good, coalesce(g.toxic, false) AS toxic
  FROM w LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) g USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(range(1, 6)) AS k),
p AS (SELECT [a.k, b.k, c.k, e.k, h.k] AS o, chr(64 + a.k::INT) || chr(64 + b.k::INT) || chr(64 + c.k::INT) || chr(64 + e.k::INT) || chr(64 + h.k::INT) AS filter_order
  FROM l a, l b, l c, l e, l h WHERE len(list_distinct([a.k, b.k, c.k, e.k, h.k])) = 5),
s AS (SELECT m.*, filter_order, k AS step, o[k] AS x, list_position(list_transform(o, lambda y: fails[y]), true) AS gone FROM m, p, l),
r AS (SELECT part, filter_order, step, x,
  coalesce(sum(n) FILTER (gone IS NULL OR gone = 0 OR gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed, coalesce(sum(n) FILTER (fails[x] AND gone BETWEEN 1 AND step - 1), 0) AS redundant,
  coalesce(sum(n) FILTER (fails[x] AND len(list_filter(fails, lambda y: y)) = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r
"""

ORACLE_SQL = {"op1_chat_format": OP1, "op2_minhash_near_dedup": OP2, "op4_quality_rules": OP4, "op5_decontamination": OP5, "op7_warc": OP7, "op8_license_scan": OP8, "op12_merkle_manifest": OP12, "op13_filter_audit": OP13}
