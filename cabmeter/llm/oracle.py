"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=ASCII_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS s
      FROM w, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.a = doc_id
"""

OP2 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(e, lambda x: x <> 0))),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
      WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT page_id, html, h, list_transform(range(0, 160), lambda k:
        (instr('0123456789abcdef', h[k // 4 + 1]) - 1) >> (3 - k % 4) & 1) AS bits,
      max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda g: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * bits[5 * g + 1]
           + 8 * bits[5 * g + 2] + 4 * bits[5 * g + 3] + 2 * bits[5 * g + 4] + bits[5 * g + 5]]), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM b
"""

PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
           "list_bool_and(list_transform(string_split(v, '.'), lambda x: CAST(x AS HUGEINT) <= 255))"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", """len(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, len(d) + 1), lambda i:
        CASE WHEN i % 2 = 1 THEN CAST(d[len(d) - i + 1] AS INT) WHEN CAST(d[len(d) - i + 1] AS INT) > 4
        THEN CAST(d[len(d) - i + 1] AS INT) * 2 - 9 ELSE CAST(d[len(d) - i + 1] AS INT) * 2 END)) % 10 = 0"""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 9 AND 15"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", """len(replace(v, ' ', '')) BETWEEN 15 AND 34 AND
        list_reduce(list_concat([0], list_transform(string_split(substr(replace(v, ' ', ''), 5) || substr(v, 1, 4), ''),
        lambda c: ascii(c))), lambda r, c: CASE WHEN c < 58 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END) = 1"""),
    "ssn": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
            "regexp_matches(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)), '(?i)ssn|social security|sozialversicherung')"),
}
_FOUND = " UNION ALL ".join(f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, t, i, m[i] AS v, regexp_replace(m[i], '[^0-9]', '', 'g') AS d,
       CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
FROM (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{pattern}') AS m,
             regexp_split_to_array(coalesce(text, ''), '{pattern}') AS g FROM documents), unnest(range(1, len(m) + 1)) AS u(i)
""" for rank, (kind, (pattern, _)) in enumerate(PII.items()))
_PASSES = " ".join(f"WHEN kind = '{kind}' THEN {check}" for kind, (_, check) in PII.items())
OP4 = f"""
WITH f AS ({_FOUND}),
k AS (SELECT doc_id, rank, kind, s, kind || ':' || s || ':' || (s + length(v)) AS line FROM f WHERE CASE {_PASSES} END),
a AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
             count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
             string_agg(line, ',' ORDER BY s, rank) FILTER (rank < 4) AS base, string_agg(line, ',' ORDER BY s, rank) AS spans
      FROM k GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_email, 0) AS BIGINT) AS n_email, CAST(coalesce(n_ip, 0) AS BIGINT) AS n_ip,
       CAST(coalesce(n_card, 0) AS BIGINT) AS n_card, CAST(coalesce(n_phone, 0) AS BIGINT) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN a USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE o AS (SELECT doc_id, CAST(k AS BIGINT) AS k, ls[k] AS line, lower(regexp_replace(ls[k], '^\s+|\s+$', '', 'g')) AS b
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), unnest(range(1, len(ls) + 1)) AS t(k)),
b AS (SELECT row_number() OVER (ORDER BY doc_id, k) AS n, b FROM (SELECT b, min(doc_id) AS doc_id, arg_min(k, (doc_id, k)) AS k
      FROM o WHERE b <> '' GROUP BY b)),
s AS (SELECT DISTINCT n, substr(b, i, 8) AS s FROM b, unnest(range(1, greatest(length(b) - 7, 1) + 1)) AS t(i)),
c AS (SELECT n, count(*) AS c FROM s GROUP BY n),
p AS (SELECT x.n AS x, y.n AS y, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.n <> y.n GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN c a ON a.n = x JOIN c b ON b.n = y WHERE 100 * i >= 80 * (a.c + b.c - i)),
r(x, y) AS (SELECT n, n FROM b UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
g AS (SELECT x, min(y) AS g FROM r GROUP BY x),
f AS (SELECT o.doc_id, o.k, o.line, o.b = '' OR row_number() OVER (PARTITION BY o.b = '', g ORDER BY o.doc_id, o.k) = 1 AS stays
      FROM o LEFT JOIN b ON b.b = o.b LEFT JOIN g ON g.x = b.n)
SELECT doc_id, count(f.k) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (stays), '')) AS kept_sha256
FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id
"""

OP8 = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
      FROM w, unnest(range(1, len(ws) - 33)) AS t(i) WHERE len(ws) >= 35),
k AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM v) WHERE c > 1),
d AS (SELECT DISTINCT doc_id, j FROM k, unnest(range(i, i + 35)) AS t(j)),
g AS (SELECT doc_id, list(j) AS js FROM d GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN js IS NULL THEN ws ELSE
           [ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(js, j)] END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""

_BARE = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
OP9 = f"""
WITH d AS (SELECT doc_id, ws, len(ws) AS size FROM (SELECT doc_id, {_BARE} AS ws FROM documents) WHERE len(ws) > 0),
b AS (SELECT item_id, ws, len(ws) AS n FROM (SELECT item_id, {_BARE} AS ws FROM benchmark) WHERE len(ws) > 0),
ds AS (SELECT doc_id, size, p, array_to_string(ws[p + 1:p + 5], ' ') AS h FROM d, unnest(range(0, greatest(size - 4, 1))) AS t(p)),
bs AS (SELECT item_id, n, array_to_string(ws[p + 1:p + 5], ' ') AS h, count(*) AS c FROM b, unnest(range(0, greatest(n - 4, 1))) AS t(p)
       GROUP BY ALL),
w AS (SELECT DISTINCT doc_id, item_id, size, n, start FROM (SELECT doc_id, item_id, size, n, p FROM ds JOIN bs USING (h)),
      unnest(range(greatest(p - greatest(n - 4, 1) + 1, 0), least(p, greatest(size - n, 0)) + 1)) AS t(start)),
x AS (SELECT w.doc_id, w.item_id, w.start, w.size, w.n, ds.h, count(*) AS c FROM w JOIN ds ON ds.doc_id = w.doc_id
      AND ds.p BETWEEN w.start AND w.start + least(greatest(w.n - 4, 1), greatest(w.size - 4, 1)) - 1 GROUP BY ALL),
i AS (SELECT x.doc_id, x.item_id, x.start, any_value(x.size) AS size, any_value(x.n) AS n, sum(least(x.c, bs.c)) AS i
      FROM x JOIN bs ON bs.item_id = x.item_id AND bs.h = x.h GROUP BY ALL),
j AS (SELECT doc_id, item_id, max(i / (greatest(n - 4, 1) + least(greatest(n - 4, 1), greatest(size - 4, 1)) - i)) AS s FROM i GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n_items, arg_max(item_id, (s, -item_id)) AS best_item, max(s) AS s FROM j WHERE s >= 0.8 GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, best_item, round(CAST(s AS DOUBLE), 6) AS best_similarity,
       s IS NOT NULL AS contaminated
FROM documents LEFT JOIN g USING (doc_id)
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
lt AS (SELECT lang, count(*) AS v, sum(ln) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(gt.total, 0) + 5 * lt.v) AS p,
      1 + (1000000000::HUGEINT * (k.ln + 5)) // (lt.total + 5 * lt.v) AS q
      FROM g JOIN k USING (lang) JOIN lt USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source),
s AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM f x JOIN f y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
u AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q)
SELECT * FROM (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
      CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
WHERE part = 'pair' OR rank <= 50
"""

# CRC-32 by its table, made from the polynomial; words as one ASCII byte a code point, since levenshtein() counts bytes.
OP11 = r"""
WITH RECURSIVE tr(step, i, v) AS (SELECT 0, i, i::BIGINT FROM range(0, 256) AS t(i) UNION ALL
      SELECT step + 1, i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tr WHERE step < 8),
tb AS (SELECT list(v ORDER BY i) AS tb FROM tr WHERE step = 8),
ab AS (SELECT string_agg(chr(i::INTEGER), '' ORDER BY i) AS wide, string_agg(chr((i - 160)::INTEGER), '' ORDER BY i) AS slim FROM range(192, 256) AS t(i)),
r AS (SELECT id, run, count(*) AS times FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
      FROM documents) GROUP BY id, run),
h AS (SELECT run, times, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(id || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END))),
      lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM r, tb),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
x AS (SELECT word, n, translate(word, wide, slim) AS slim FROM v, ab),
k AS (SELECT word, n, slim, slim AS k FROM x UNION SELECT word, n, slim, substr(slim, 1, i - 1) || substr(slim, i + 1) FROM x, unnest(range(1, length(slim) + 1)) AS t(i)),
p AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM k a JOIN k b ON a.k = b.k AND a.word <> b.word WHERE levenshtein(a.slim, b.slim) = 1),
b AS (SELECT word, n, count(*) AS n_near, max(near_n) AS best FROM p GROUP BY word, n),
f AS (SELECT p.word, min(p.near) AS form, any_value(p.near_n) AS form_n FROM p JOIN b ON p.word = b.word AND p.near_n = b.best
      WHERE p.near_n >= 2 * p.n GROUP BY p.word),
c(word, last) AS (SELECT word, word FROM v UNION ALL SELECT c.word, f.form FROM c JOIN f ON c.last = f.word)
SELECT v.word, form, last AS root, v.n, coalesce(n_near, 0) AS n_near, form_n
FROM v LEFT JOIN f USING (word) LEFT JOIN b USING (word) JOIN c USING (word)
WHERE last NOT IN (SELECT word FROM f)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_superminhash": OP1, "op2_projection_forest": OP2, "op3_dictionary_warc": OP3, "op4_pii_checksums": OP4, "op5_fuzzy_lines": OP5, "op8_count_min": OP8,
            "op9_simhash_windows": OP9, "op11_reduced_alphabet": OP11, "op13_dominance_skyband": OP13}
