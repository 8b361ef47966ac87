"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
         WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s
  FROM w),
cls AS (SELECT min(doc_id) AS c, len(s) AS n, list_sort(s) AS s FROM sets GROUP BY list_sort(s), len(s)),
member AS (SELECT sets.doc_id, cls.c, cls.n FROM sets JOIN cls ON list_sort(sets.s) = cls.s),
g AS (SELECT c, n, md5_number(unnest(s)) AS g FROM cls WHERE n > 0),
pairs AS (
  SELECT a.c AS x, b.c AS y FROM g a JOIN g b ON a.g = b.g AND a.c < b.c
     AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(c, r) AS (SELECT c, c FROM cls UNION SELECT reach.c, e.y FROM reach JOIN edges e ON reach.r = e.x),
low AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles,
       CASE WHEN m.n = 0 THEN m.doc_id ELSE low.component_id END AS component_id
FROM member m JOIN low USING (c)
"""


# Lines: equal earlier ones, or (10 words or more) earlier ones within one word replaced, inserted or left out.
OP3 = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
each AS (SELECT doc_id, unnest(range(len(parts))) AS no, unnest(parts) AS part FROM raw),
line AS (SELECT doc_id, no, trim(regexp_replace(part, '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM each),
full_line AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, no) AS nth FROM line WHERE line <> ''),
one AS (SELECT line, doc_id, no, row_number() OVER (ORDER BY doc_id, no) AS place, string_split(line, ' ') AS w
        FROM full_line WHERE nth = 1),
long_line AS (SELECT place, w, len(w) AS n FROM one WHERE len(w) >= 10),
v AS (SELECT place, n, i, md5(array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ')) AS h
      FROM (SELECT place, w, n, unnest(range(1, n + 1)) AS i FROM long_line)),
replaced AS (SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY n, i, h) AS low FROM v) WHERE place > low),
whole AS (SELECT place, n, md5(array_to_string(w, ' ')) AS h FROM long_line),
inserted AS (SELECT greatest(v.place, whole.place) AS place FROM v JOIN whole ON v.h = whole.h AND v.n = whole.n + 1),
near AS (SELECT place FROM replaced UNION SELECT place FROM inserted),
verdict AS (SELECT f.doc_id, f.no, f.nth > 1 OR n.place IS NOT NULL AS gone, f.nth = 1 AND n.place IS NOT NULL AS near
            FROM full_line f JOIN one o USING (line) LEFT JOIN near n ON n.place = o.place),
kept AS (SELECT e.doc_id, count(*) AS n_lines, count(*) FILTER (v.gone) AS n_dropped, count(*) FILTER (v.near) AS n_near,
                coalesce(string_agg(e.part, chr(10) ORDER BY e.no) FILTER (v.gone IS NULL OR NOT v.gone), '') AS kept
         FROM each e LEFT JOIN verdict v ON v.doc_id = e.doc_id AND v.no = e.no GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, coalesce(n_near, 0) AS n_near,
       CASE WHEN d.text IS NOT NULL THEN length(kept) END AS kept_chars,
       CASE WHEN d.text IS NOT NULL THEN md5(kept) END AS kept_md5
FROM documents d LEFT JOIN kept USING (doc_id)
"""

_STOP = """
the be to of and that have with a in is it for on was as at by an this are from or
der die das und ist in zu den von mit sich des auf für nicht ein eine als im dem
le la les de des du et est en un une que qui dans pour pas sur au il elle avec
el la los las de del y en que un una es se no por con para su al lo
""".split()
_STOP_LIST = ", ".join(f"'{x}'" for w in _STOP for x in (w, w.capitalize(), w.upper()))

OP5 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: x IN (""" + _STOP_LIST + r"""))) AS stops,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS lettered,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\t]*[-*•●]'))) AS bullets,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\t\r]*$'))) AS dots
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.1
         AND stops / n_words >= 0.02 AND lettered / n_words >= 0.6 AND n_dup_lines / n_lines <= 0.3
         AND bullets / n_lines <= 0.9 AND dots / n_lines <= 0.3 AS kept
FROM b
"""

# For each capture and each name that may list its host: the last entry up to the fetch decides.
OP8 = r"""
WITH host AS (
  SELECT page_id, nullif(lower(regexp_replace(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.+$', '')), '') AS host FROM pages),
entry AS (
  SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'host' ELSE 'domain' END AS kind,
         CASE WHEN event_type IN ('error', 'signup') THEN host
              ELSE array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') END AS key,
         epoch_us(ts) AS dated, event_type IN ('error', 'purchase') AS listed
  FROM events JOIN host ON host.page_id = events.user_id WHERE event_type IN ('error', 'signup', 'purchase', 'click')),
one AS (SELECT kind, key, dated, max(listed) AS listed FROM entry WHERE key IS NOT NULL GROUP BY ALL),
turn AS (SELECT * FROM (SELECT *, coalesce(lag(listed) OVER (PARTITION BY kind, key ORDER BY dated), false) AS was FROM one)
         WHERE listed <> was),
cap AS (SELECT p.page_id, h.host, epoch_us(e.ts) AS fetched
        FROM pages p JOIN host h USING (page_id) LEFT JOIN events e ON e.event_id = p.page_id),
name AS (
  SELECT page_id, fetched, 'host' AS kind, host AS key FROM cap WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, fetched, 'domain', array_to_string(list_slice(l, i, len(l)), '.')
  FROM (SELECT page_id, fetched, l, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS i
        FROM (SELECT page_id, fetched, string_split(host, '.') AS l FROM cap WHERE host IS NOT NULL))),
hit AS (SELECT n.page_id, count(*) FILTER (t.listed) AS n_active, min(t.dated) FILTER (t.listed) AS since
        FROM name n ASOF JOIN turn t ON n.kind = t.kind AND n.key = t.key AND n.fetched >= t.dated GROUP BY n.page_id)
SELECT cap.page_id, cap.host, cap.fetched, coalesce(n_active, 0) > 0 AS blocked,
       coalesce(n_active, 0) AS n_active, since
FROM cap LEFT JOIN hit USING (page_id)
"""



def _spans_of(name: str, k: int, pattern: str, holds: str, source: str = "d") -> str:
    """Matches of a pattern with code point offsets: a match starts after the gaps and matches before it."""
    return f"""
SELECT doc_id, {k} AS k, '{name}' AS name, s, s + length(t) AS e, t,
       right(g[i], 80) || ' ' || left(g[i + 1], 80) AS around
FROM (SELECT doc_id, m, g, i, m[i] AS t,
             CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
      FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m,
                         string_split_regex(text, '{pattern}') AS g FROM {source})))
WHERE {holds}"""


_DIGITS = "regexp_replace(t, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j: CASE WHEN j % 2 = 1 "
         f"THEN CAST(reverse({_DIGITS})[j] AS INTEGER) ELSE (2 * CAST(reverse({_DIGITS})[j] AS INTEGER)) // 10 "
         f"+ (2 * CAST(reverse({_DIGITS})[j] AS INTEGER)) % 10 END)) % 10 = 0")
_BASE = " UNION ALL ".join((
    _spans_of("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    _spans_of("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              "list_bool_and(list_transform(string_split(t, '.'), lambda x: length(ltrim(x, '0')) <= 3 "
              "AND coalesce(TRY_CAST(ltrim(x, '0') AS INTEGER), 0) <= 255))"),
    _spans_of("card", 2, r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
    _spans_of("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15")))

OP10 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED (""" + _BASE + r"""),
mention AS (SELECT doc_id, entity, md5(lower(min({'s': s, 'k': k, 'a': around}).a)) AS context
            FROM (SELECT *, k || ':' || CASE k WHEN 0 THEN lower(t) WHEN 1 THEN t
                  ELSE regexp_replace(t, '[^0-9]', '', 'g') END AS entity FROM base) GROUP BY doc_id, entity),
word AS (SELECT DISTINCT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '\p{L}+'))) AS term
         FROM d WHERE doc_id IN (SELECT doc_id FROM mention)),
pair AS (SELECT entity, term, count(*) AS together FROM mention JOIN word USING (doc_id)
         GROUP BY ALL HAVING count(DISTINCT context) >= 3),
holder AS (SELECT entity, count(*) AS c_e FROM mention GROUP BY entity),
spread AS (SELECT term, count(*) AS c_t
           FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '\p{L}+'))) AS term FROM d) GROUP BY term),
total AS (SELECT count(*) AS n FROM d),
revealing AS (SELECT entity, term FROM pair JOIN holder USING (entity) JOIN spread USING (term), total
              WHERE ln(together * n / (c_t * c_e)) / nullif(ln(n / c_e), 0) >= 0.7),
flagged AS (SELECT DISTINCT doc_id, term FROM mention JOIN revealing USING (entity)),
touched AS (SELECT * FROM d WHERE doc_id IN (SELECT doc_id FROM flagged)),
run AS (""" + _spans_of("term", 4, r"\p{L}+", "true", "touched") + r"""),
every AS (SELECT doc_id, k, name, s, e FROM base
          UNION ALL SELECT run.doc_id, k, name, s, e FROM run JOIN flagged f ON f.doc_id = run.doc_id AND f.term = lower(t)),
said AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip,
                count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone, count(*) FILTER (k = 4) AS n_term,
                coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 4), '') AS base,
                string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
         FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_term, 0) AS n_term
FROM d LEFT JOIN said USING (doc_id)
"""

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _vector_codes() -> str:
    """Integer k-means of the parts, its rounds written out one after another."""
    steps = [f"""
kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS no, vec_id, label, embedding FROM embeddings
         WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {_PARTS} = 0
           AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
piece AS (SELECT no, p, list_transform(embedding[p * len(embedding) // {_PARTS} + 1:(p + 1) * len(embedding) // {_PARTS}],
                                       lambda c: CAST(floor(CAST(c AS DOUBLE) * 4096) AS BIGINT)) AS x
          FROM kept, range({_PARTS}) AS r(p)),
book0 AS (SELECT p, no - 1 AS e, x FROM piece WHERE no <= {_ENTRIES})"""]
    for k in range(_ROUNDS + 1):
        steps.append(f"""
near{k} AS (SELECT no, p, x, min({{'d': list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS m
            FROM (SELECT piece.no, piece.p, piece.x, book{k}.x AS y, book{k}.e FROM piece JOIN book{k} USING (p)) GROUP BY ALL)""")
        if k < _ROUNDS:
            steps.append(f"""
flat{k} AS (SELECT p, m.e AS e, unnest(x) AS c, unnest(range(len(x))) AS i FROM near{k}),
mean{k} AS (SELECT p, e, list(c ORDER BY i) AS x FROM (
            SELECT p, e, i, CAST((sum(c) - (((sum(c) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS c
            FROM flat{k} GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e)""")
    last = _ROUNDS
    return "WITH" + ",".join(steps) + f""",
coded AS (SELECT no, string_agg(lower(lpad(to_hex(m.e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
          FROM near{last} GROUP BY no),
label_sum AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (no) GROUP BY label),
sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{last})
SELECT k.vec_id, c.code, c.error, s.label_error, sha.h AS codebooks_sha256
FROM coded c JOIN kept k USING (no) JOIN label_sum s ON s.label IS NOT DISTINCT FROM k.label, sha
"""


# A program over each conversation's rows; crc32 by its table.
OP12 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) AS r(i)),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: ascii(ch))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM conversations, crc_table),
after_damage AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN h = 0 THEN [] WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM after_damage),
faulty AS (
  SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS previous FROM placed),
row_ AS (
  SELECT conv_id, pos, turn, role, text, initial, previous,
         CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM row_ GROUP BY conv_id),
ins(s, t, cost, edits, lines) AS (VALUES ('e', 'e', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
  ('e', 'u', 5, 'I', chr(10) || 'user:'), ('s', 'u', 5, 'I', chr(10) || 'user:'), ('a', 'u', 5, 'I', chr(10) || 'user:'),
  ('u', 'a', 5, 'I', chr(10) || 'assistant:'),
  ('e', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
op(s, edit, initial, t, cost) AS (VALUES
  ('e', 'D', NULL, 'e', 2), ('s', 'D', NULL, 's', 2), ('u', 'D', NULL, 'u', 2), ('a', 'D', NULL, 'a', 2),
  ('e', 'K', 's', 's', 0), ('e', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0),
  ('e', 'R', NULL, 'u', 1), ('s', 'R', NULL, 'u', 1), ('a', 'R', NULL, 'u', 1), ('u', 'R', NULL, 'a', 1)),
way(conv_id, pos, s, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 'e', {'cost': 0, 'audit': '', 'lines': ''} FROM counted
  UNION ALL
  SELECT w.conv_id, r.pos, op.t, min({
      'cost': w.best.cost + ins.cost + op.cost + CASE WHEN r.fault = 'truncated' AND op.edit <> 'D' THEN 5 ELSE 0 END,
      'audit': w.best.audit || ins.edits || op.edit,
      'lines': w.best.lines || ins.lines || CASE WHEN op.edit = 'D' THEN '' WHEN op.edit = 'K' THEN chr(10) || r.role || ':' || r.text
               ELSE chr(10) || CASE op.t WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text END})
  FROM way w JOIN row_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
  JOIN ins ON ins.s = w.s
  JOIN op ON op.s = ins.t AND (op.initial IS NULL OR op.initial = r.initial) AND (op.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, r.pos, op.t),
ended AS (
  SELECT c.conv_id, min({'cost': w.best.cost + ins.cost, 'audit': w.best.audit || ins.edits, 'lines': w.best.lines || ins.lines}) AS best
  FROM way w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos
  JOIN ins ON ins.s = w.s AND ins.t IN ('e', 'a') GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(e.best.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13 = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS no, vec_id, CAST(embedding AS DOUBLE[]) AS x,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
         AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS ok FROM embeddings),
link AS (SELECT a.no AS a, b.no AS b FROM v a JOIN v b ON a.no <> b.no AND a.ok AND b.ok AND len(a.x) = len(b.x)
         WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT no, no FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
component AS (SELECT r.a AS no, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.no = r.b GROUP BY r.a),
degree AS (SELECT a AS no, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept
FROM v JOIN component c USING (no) LEFT JOIN degree d USING (no)
"""

SQL = {"op1_ngram_jaccard_join": OP1, "op3_line_dedup": OP3, "op5_quality_rules": OP5, "op8_url_filter": OP8,
       "op10_pii": OP10, "op11_vector_codes": _vector_codes(), "op12_conversation_repair": OP12,
       "op13_embedding_near_dedup": OP13}
