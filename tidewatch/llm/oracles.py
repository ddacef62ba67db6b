"""DuckDB statements for the queries that SQL can express, formulated independently of the operators."""

from __future__ import annotations

SPACES = r"chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _low(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{UPPER.lower()}')"


LINES = f"""
lines AS (
  SELECT doc_id, pos, lines[pos] AS line, {_low(f'trim(lines[pos], {SPACES})')} AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
       LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS pos)),
repeated AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT l.*, (r.key IS NOT NULL AND l.doc_id <> r.holder) AS lost FROM lines l LEFT JOIN repeated r USING (key))"""

NEAR_DUP = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
FROM docs d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id"""

NGRAM_JOIN = (NEAR_DUP.replace("75 * (x.n", "80 * (x.n").replace(", d.doc_id = min(r.other) AS kept", ""))

LINE_DEDUP = f"""
WITH {LINES}
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

DECONTAMINATION = rf"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all({_low('coalesce(text, chr(32))')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
starts AS (
  SELECT kind, id, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS i FROM words),
items AS (
  SELECT DISTINCT id AS item_id, least(13, n) AS size, array_to_string(w[i:i + least(13, n) - 1], ' ') AS win
  FROM starts WHERE kind = 'b' AND i <= n - least(13, n) + 1),
sizes AS (SELECT DISTINCT size FROM items),
found AS (
  SELECT d.id AS doc_id, d.i, m.size, m.item_id
  FROM (SELECT id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win FROM starts, sizes
        WHERE kind = 'd' AND i + size - 1 <= n) d JOIN items m USING (size, win)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
own AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit ON hit.doc_id = w.id LEFT JOIN own ON own.doc_id = w.id WHERE w.kind = 'd'"""

URL_FILTER = rf"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, {_low("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS nth
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM fits WHERE nth = 1"""

QUALITY_RULES = rf"""
WITH docs AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(text, '') AS text
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM docs WHERE len(w) > 3),
marked AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE times > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed THEN 1 ELSE 0 END) AS f FROM judged
  WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
prior AS (
  SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v - 1 < 1e6 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1e6 END AS s
  FROM moments),
bad AS (
  SELECT source FROM hosts, prior WHERE (f + m * s) / (n + s) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND b.source IS NULL AS kept
FROM judged j LEFT JOIN bad b ON j.source = b.source"""

SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY sha256(array_to_string(w[i:i + 34], ' '))) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
lost AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE times > 1),
words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN lost USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
talks AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY pos) AS own FROM turns GROUP BY conv_id),
heads AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, own, xor(list_reduce(list_prepend(4294967295::BIGINT,
      [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
      lambda crc, o: list_reduce([xor(crc, o), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))),
      4294967295::BIGINT) % 6 AS h FROM talks),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS said
  FROM heads c LEFT JOIN talks b ON b.conv_id = c.base),
paths AS (
  SELECT conv_id, len(said) AS total, d, md5(said[1:d]::VARCHAR || '/' || d) AS key,
         md5(said[1:d - 1]::VARCHAR || '/' || (d - 1)) AS parent, CASE WHEN d > 0 THEN length(said[d].text) ELSE 0 END AS n_chars
  FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT key, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
         any_value(n_chars) AS n_chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = total), '')) AS ends_sha256
  FROM paths GROUP BY key),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
own AS (
  SELECT n.conv_id, n.depth, (k.n IS NULL)::INT AS leaf, (n.n_convs - 1) * n.n_chars AS saved
  FROM nodes n LEFT JOIN kids k ON k.parent = n.key),
totals AS (
  SELECT p.key, sum(o.leaf) AS n_leaves, sum(o.saved) AS saved_tokens
  FROM own o JOIN paths p ON p.conv_id = o.conv_id AND p.d <= o.depth GROUP BY p.key)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.key = n.key LEFT JOIN kids k ON k.parent = n.key LEFT JOIN nodes p ON p.key = n.parent"""


def _vector_codes(rounds: int = 6) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT row, p, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) AS best
  FROM pieces JOIN books{r} USING (p) GROUP BY row, p, x)""")
        if r < rounds:
            steps.append(f"""
books{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM books{r} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS c FROM (
      SELECT p, best.e AS e, i, sum(x[i])::HUGEINT AS s, count(*) AS n
      FROM near{r}, range(1, 9) AS t(i) GROUP BY p, best.e, i) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)""")
    return f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS x,
         row_number() OVER (ORDER BY vec_id) AS row
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pieces AS MATERIALIZED (SELECT row, p, x[8 * p + 1:8 * p + 8] AS x FROM whole, range(0, 8) AS t(p)),
books0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM pieces WHERE row <= 16),{','.join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM books{rounds}),
coded AS (
  SELECT row, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY row)
SELECT w.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY w.label))::BIGINT AS label_error, b.digest AS codebooks_sha256
FROM whole w JOIN coded c USING (row), books b"""


ORACLES = {
    "op1_near_dup": NEAR_DUP,
    "op2_line_dedup": LINE_DEDUP,
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op4_quality_rules": QUALITY_RULES,
    "op7_decontamination": DECONTAMINATION,
    "op9_url_filter": URL_FILTER,
    "op11_ngram_join": NGRAM_JOIN,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_vector_codes": _vector_codes(),
}
