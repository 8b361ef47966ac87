"""DuckDB SQL for each registered query (the correctness oracle).

Every statement starts from the same ``articles`` definition as
:func:`storyloom.sources.tables.articles`. ``as_of`` is the newest
publish time of the view; keywords and limits are the fixture values.
"""

from __future__ import annotations

ARTICLES = """
articles AS (
  SELECT d.doc_id AS item_id, d.source AS site,
         split_part(d.text, chr(10), 1) AS title,
         coalesce(p.url, 'https://' || d.source || '.example/' || CAST(d.doc_id AS VARCHAR)) AS link,
         d.text AS content, d.lang,
         CAST(e.ts AS TIMESTAMP) AS pub_time,
         CAST(floor(e.value) AS BIGINT) AS comments
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN pages p ON p.page_id = d.doc_id
),
params AS (SELECT max(pub_time) AS as_of FROM articles)"""

SUMMARY = ("CASE WHEN length(content) > 300 THEN substring(content, 1, 300) || '...' "
           "ELSE content END")

# X1 with keywords 'elle', 'wh'
SCORE = ("(CASE WHEN contains(lower(title), 'elle') THEN 100 ELSE 0 END"
         " + CASE WHEN contains(lower(summary), 'elle') THEN 50 ELSE 0 END"
         " + CASE WHEN contains(lower(title), 'wh') THEN 100 ELSE 0 END"
         " + CASE WHEN contains(lower(summary), 'wh') THEN 50 ELSE 0 END)")

EXCLUDED = "(contains(lower(title), 'nicht') OR contains(lower(summary), 'nicht'))"

CANDIDATES = f"""
summarised AS (
  SELECT a.*, {SUMMARY} AS summary FROM articles a, params
  WHERE a.pub_time >= params.as_of - INTERVAL 2 DAY
),
candidates AS (
  SELECT item_id, site, title, link, summary, pub_time, CAST(pub_time AS DATE) AS pub_date,
         comments, CAST({SCORE} AS INTEGER) AS kw_score, lang
  FROM summarised WHERE NOT {EXCLUDED}
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def filter_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["recent_articles"] = with_(ARTICLES) + """
SELECT item_id, site, title, link, pub_time
FROM articles, params WHERE pub_time >= params.as_of - INTERVAL 2 DAY"""
    q["short_summary"] = with_(ARTICLES) + f"""
SELECT item_id, {SUMMARY} AS summary, length({SUMMARY}) AS summary_len FROM articles"""
    q["exclude_keywords"] = with_(ARTICLES) + f"""
, s AS (SELECT *, {SUMMARY} AS summary FROM articles)
SELECT item_id, title FROM s WHERE NOT {EXCLUDED}"""
    q["keyword_score"] = with_(ARTICLES) + f"""
, s AS (SELECT *, {SUMMARY} AS summary FROM articles)
SELECT item_id, CAST({SCORE} AS INTEGER) AS kw_score FROM s"""
    q["candidates"] = with_(ARTICLES, CANDIDATES) + """
SELECT item_id, site, title, link, summary, pub_time, pub_date, comments, kw_score FROM candidates"""
    return q


# ---------------------------------------------------------------------------
# Shared SQL pieces. Fixed texts come from storyloom.params.
# ---------------------------------------------------------------------------
from storyloom.params import (DIGEST_BADGE_MARK, DIGEST_EMPTY, DIGEST_ITEM_RULE,  # noqa: E402
                              DIGEST_ITEM_SCORE, DIGEST_ITEM_SITE, DIGEST_ITEM_SUMMARY,
                              DIGEST_ITEM_TIME, DIGEST_OTHER_SOURCES, DIGEST_READ_MORE,
                              DIGEST_SCORE_LABEL, DIGEST_STATS_HEADING, DIGEST_STATS_ONBOARD,
                              DIGEST_STATS_SITES, DIGEST_STATS_TOTAL, DIGEST_TIME_LABEL,
                              DIGEST_TITLE, MODEL_DEFAULT_PROMPT, MODEL_FALLBACK_CONTENT,
                              MODEL_FALLBACK_TITLE, MODEL_SUMMARY_SUFFIX, NO_ABSTRACT_MARKER,
                              NO_ABSTRACT_PROBE, SEARCH_SITE_BARE, SEARCH_SITE_PREFIX,
                              SEARCH_SITE_SUFFIX)


# White space as Python's str.isspace() has it, and the entities that the
# native text form decodes; written out here so that the check does not lean on the engine.
WS_RUN = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
ENTITIES = ("nbsp \u0020", "lt <", "gt >", "quot \"", "#39 '", "apos '", "copy \u00a9", "middot \u00b7",
            "mdash \u2014", "ndash \u2013", "hellip \u2026", "amp &")
NETLOC_RE = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_RUN}|{WS_RUN}$', '', 'g')"


def lit(s: str) -> str:
    """SQL string literal; newlines become chr(10)."""
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


KEY = r"regexp_replace(lower(title), '[^\p{L}\p{N}]', '', 'g')"


def netloc(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '{NETLOC_RE}', 1)"


def host(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({netloc(x)}), '^.*@', ''), ':[0-9]*$', '')"


def native_text(x: str) -> str:
    h = f"coalesce({x}, '')"
    h = f"regexp_replace({h}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "template"):
        h = f"regexp_replace({h}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    h = f"regexp_replace({h}, '<[^>]*>', ' ', 'g')"
    for entity in ENTITIES:
        name, ch = entity.split(" ", 1)
        h = f"replace({h}, {lit('&' + name + ';')}, {lit(ch)})"
    h = f"regexp_replace({h}, '{WS_RUN}', ' ', 'g')"
    return f"regexp_replace({h}, '^ | $', '', 'g')"


def f8(x: str) -> str:
    return f"coalesce(CASE WHEN regexp_full_match({x}, '[0-9]+') THEN TRY_CAST({x} AS BIGINT) END, 0)"


READ_MORE = lit("[" + DIGEST_READ_MORE + "](")
OTHERS = lit(DIGEST_OTHER_SOURCES)


def groups_sql(dk: str | None, arrival: str = "site, pub_time DESC, item_id") -> str:
    """C7 over link + containment edges, A1-A4, T2/T5 top 15 per digest key."""
    dkcol = dk if dk else "''"
    return f"""
ordered AS (
  SELECT c.*, {dkcol} AS digest_key,
         row_number() OVER (ORDER BY {arrival}) AS ord, {KEY} AS key
  FROM candidates c
),
und AS (
  SELECT x.ord AS a, y.ord AS b FROM ordered x JOIN ordered y
    ON x.digest_key = y.digest_key AND x.ord <> y.ord
   AND (x.link = y.link OR (least(length(x.key), length(y.key)) >= 5
        AND (contains(x.key, y.key) OR contains(y.key, x.key))))
),
reach(node, label) AS (
  SELECT ord, ord FROM ordered
  UNION
  SELECT u.b, r.label FROM reach r JOIN und u ON u.a = r.node
),
comp AS (SELECT node AS ord, min(label) AS leader_ord FROM reach GROUP BY node),
members AS (
  SELECT o.*, c.leader_ord,
         row_number() OVER (PARTITION BY c.leader_ord
                            ORDER BY o.kw_score DESC, o.comments DESC, o.pub_date DESC, o.ord) AS mrank
  FROM ordered o JOIN comp c ON c.ord = o.ord
),
grp AS (SELECT leader_ord, count(DISTINCT site) AS source_count FROM members GROUP BY leader_ord),
reps AS (SELECT * FROM members WHERE mrank = 1),
site_first AS (
  SELECT *, row_number() OVER (PARTITION BY leader_ord, site ORDER BY mrank) AS srank FROM members
),
others AS (
  SELECT s.leader_ord,
         string_agg('[' || s.site || '](' || s.link || ')', ' | ' ORDER BY s.mrank) AS others
  FROM site_first s JOIN reps r ON r.leader_ord = s.leader_ord
  WHERE s.srank = 1 AND s.site <> r.site GROUP BY s.leader_ord
),
ranked AS (
  SELECT r.digest_key, l.item_id AS cluster_id, r.item_id, r.site, r.title, r.link, r.summary,
         r.pub_time, r.pub_date, r.kw_score, r.comments,
         CAST((g.source_count - 1) * 200 AS INTEGER) AS multi_source_bonus,
         CAST(g.source_count AS INTEGER) AS source_count,
         {READ_MORE} || r.link || ')' || coalesce({OTHERS} || o.others, '') AS links,
         r.leader_ord
  FROM reps r JOIN grp g ON g.leader_ord = r.leader_ord
  JOIN ordered l ON l.ord = r.leader_ord
  LEFT JOIN others o ON o.leader_ord = r.leader_ord
),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY digest_key
        ORDER BY multi_source_bonus + kw_score DESC, comments DESC, pub_date DESC, leader_ord) AS rank
    FROM ranked) WHERE rank <= 15
)"""


BADGE = (f"CASE WHEN source_count > 1 THEN ' ' || repeat({lit(DIGEST_BADGE_MARK)}, source_count - 1)"
         f" || ' (' || source_count || '源)' ELSE '' END")
ITEM_BLOCK = (
    "'## ' || rank || '. ' || title || ' ' || " + BADGE + " || ' ' || chr(10) || "
    + lit(DIGEST_ITEM_SITE) + " || site || chr(10) || "
    + lit(DIGEST_ITEM_TIME)
    + " || strftime(timezone('Asia/Shanghai', pub_time AT TIME ZONE 'UTC'), '%Y-%m-%d %H:%M')"
    + " || chr(10) || " + lit(DIGEST_ITEM_SCORE) + " || " + lit(DIGEST_SCORE_LABEL[0])
    + " || multi_source_bonus || " + lit(DIGEST_SCORE_LABEL[1]) + " || kw_score || "
    + lit(DIGEST_SCORE_LABEL[2]) + " || comments || " + lit(DIGEST_SCORE_LABEL[3])
    + " || chr(10) || " + lit(DIGEST_ITEM_SUMMARY) + " || summary || chr(10) || links"
    + " || chr(10) || " + lit(DIGEST_ITEM_RULE))


def digest_lines_sql(per_key: bool) -> str:
    """Lines (digest_key, line_no, value) over ``top`` and ``candidates``."""
    dk = "lang" if per_key else "''"
    gb = "GROUP BY lang" if per_key else ""
    return f"""
stats AS (SELECT {dk} AS digest_key, count(*) AS total FROM candidates {gb}),
dist AS (
  SELECT digest_key, string_agg(site || '(' || n || ')', ' | ' ORDER BY n DESC, first_rank) AS distribution,
         sum(n) AS onboard
  FROM (SELECT digest_key, site, count(*) AS n, min(rank) AS first_rank FROM top GROUP BY digest_key, site)
  GROUP BY digest_key
),
lines AS (
  SELECT digest_key, 0 AS line_no,
         {lit(DIGEST_TITLE)} || chr(10) || {lit(DIGEST_TIME_LABEL)}
         || strftime((SELECT as_of FROM params), '%Y-%m-%d %H:%M:%S') || chr(10) AS value
  FROM stats
  UNION ALL
  SELECT s.digest_key, 1,
         {lit(DIGEST_STATS_HEADING)} || chr(10) || {lit(DIGEST_STATS_TOTAL[0])} || s.total
         || {lit(DIGEST_STATS_TOTAL[1])} || chr(10) || {lit(DIGEST_STATS_ONBOARD[0])} || d.onboard
         || {lit(DIGEST_STATS_ONBOARD[1])} || chr(10) || {lit(DIGEST_STATS_SITES)} || d.distribution
         || chr(10) || chr(10) || '---' || chr(10)
  FROM stats s JOIN dist d ON d.digest_key = s.digest_key
  UNION ALL
  SELECT digest_key, 10 + rank, {ITEM_BLOCK} FROM top
)"""


HISTORY = """
history AS (
  SELECT a.link AS url, a.title, a.pub_time AS fetch_time FROM articles a
  WHERE a.item_id IN (SELECT doc_id FROM labels WHERE quality = 1)
)"""

NATIVE_BODY = f"""
bodies AS (
  SELECT c.*, coalesce(substring({native_text('p.html')}, 1, 4000), '') AS body
  FROM candidates c LEFT JOIN pages p ON p.url = c.link
),
inputs AS (
  SELECT *, CASE WHEN length(summary) < 100 OR contains(summary, {lit(NO_ABSTRACT_PROBE)})
                 THEN CASE WHEN length(body) > 50 THEN body
                           ELSE {lit(MODEL_FALLBACK_TITLE)} || title || {lit(MODEL_FALLBACK_CONTENT)} || summary END
                 ELSE summary END AS model_input
  FROM bodies
)"""


def more_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["title_key"] = with_(ARTICLES) + f"\nSELECT item_id, {KEY} AS key FROM articles"
    q["no_abstract_marker"] = with_(ARTICLES) + f"""
, s AS (SELECT a.*, coalesce(p.url, '') AS feed_url, {SUMMARY} AS summary
        FROM articles a LEFT JOIN pages p ON p.page_id = a.item_id)
SELECT item_id, CASE WHEN contains(feed_url, 'blog.') OR site = 'src3'
                     THEN {lit(NO_ABSTRACT_MARKER)} ELSE summary END AS summary FROM s"""
    q["comment_count"] = f"""
SELECT event_id, {f8('props')} AS from_props, {f8('CAST(value AS VARCHAR)')} AS from_value,
       {f8('CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)')} AS from_floor,
       {f8("json_extract_string(props, '$.k')")} AS from_k
FROM events"""
    q["published_time"] = with_(ARTICLES) + """
SELECT event_id, CASE event_type
    WHEN 'signup' THEN date_trunc('second', ts) - INTERVAL 8 HOUR
    WHEN 'view' THEN date_trunc('second', ts)
    WHEN 'purchase' THEN date_trunc('second', ts)
    WHEN 'error' THEN date_trunc('second', ts) + INTERVAL 1 HOUR
    ELSE (SELECT as_of FROM params) END AS pub_time
FROM events"""
    n = netloc("url")
    q["site_label"] = f"""
SELECT page_id, {n} AS netloc,
       CASE WHEN (contains({n}, '[') AND NOT contains({n}, ']'))
              OR (contains({n}, ']') AND NOT contains({n}, '['))
            THEN {lit(SEARCH_SITE_BARE)}
            ELSE {lit(SEARCH_SITE_PREFIX)} || {n} || {lit(SEARCH_SITE_SUFFIX)} END AS site
FROM pages"""
    h = host("url")
    q["domain_filter"] = f"""
SELECT page_id, url AS link FROM pages
WHERE {h} IN ('example.com', 'example.net')
   OR ends_with({h}, '.example.com') OR ends_with({h}, '.example.net')"""
    q["per_source_cap"] = with_(ARTICLES) + """
SELECT item_id, site, position FROM (
  SELECT item_id, site, row_number() OVER (PARTITION BY site ORDER BY pub_time DESC, item_id) AS position
  FROM articles) WHERE position <= 10"""
    q["html_text"] = f"SELECT page_id, {native_text('html')} AS text FROM pages"
    q["link_pairs"] = with_(ARTICLES) + f"""
, v AS (
  SELECT a.item_id, a.site, a.pub_time,
         CASE WHEN p.url IS NOT NULL THEN 'https://' || {netloc('p.url')}
              ELSE 'https://' || a.site || '.example/' END AS link
  FROM articles a LEFT JOIN pages p ON p.page_id = a.item_id, params
  WHERE a.pub_time >= params.as_of - INTERVAL 2 DAY
), o AS (
  SELECT *, lag(item_id) OVER (PARTITION BY link ORDER BY site, pub_time DESC, item_id) AS prev_item_id
  FROM v
)
SELECT link, item_id, prev_item_id FROM o WHERE prev_item_id IS NOT NULL"""
    q["containment_pairs"] = with_(ARTICLES) + f"""
, keys AS (SELECT DISTINCT {KEY} AS key FROM articles)
SELECT i.key AS inner_key, o.key AS outer_key FROM keys i JOIN keys o
  ON length(i.key) >= 5 AND length(o.key) > length(i.key) AND contains(o.key, i.key)"""
    g = "WITH RECURSIVE " + ",".join([ARTICLES, CANDIDATES, groups_sql(None)])
    q["story_components"] = g + """
SELECT o.item_id, l.item_id AS cluster_id
FROM comp c JOIN ordered o ON o.ord = c.ord JOIN ordered l ON l.ord = c.leader_ord"""
    q["representatives"] = g + "\nSELECT cluster_id, item_id, kw_score, comments, pub_date FROM ranked"
    q["source_bonus"] = g + "\nSELECT cluster_id, source_count, multi_source_bonus FROM ranked"
    q["alternative_links"] = g + "\nSELECT cluster_id, links FROM ranked"
    q["top_stories"] = g + """
SELECT rank, cluster_id, item_id, site, title, link, summary, pub_time, pub_date, kw_score,
       comments, multi_source_bonus, source_count, links FROM top"""
    q["onboard_by_site"] = g + """
SELECT site, count(*) AS onboard, min(rank) AS first_rank FROM top GROUP BY site"""
    q["candidate_stats"] = with_(ARTICLES, CANDIDATES) + """
SELECT count(*) AS total_candidates, count(DISTINCT site) AS sources,
       (SELECT string_agg(site, ', ' ORDER BY site) FROM (SELECT DISTINCT site FROM candidates))
         AS source_sites
FROM candidates"""
    q["source_counts"] = with_(ARTICLES, CANDIDATES) + """
SELECT 0 AS source_kind, 0 AS source_order, site AS source, count(*) AS kept
FROM candidates GROUP BY site"""
    q["unseen_articles"] = with_(ARTICLES, HISTORY) + """
SELECT a.item_id, a.link FROM articles a, params
WHERE a.pub_time >= params.as_of - INTERVAL 2 DAY
  AND NOT EXISTS (SELECT 1 FROM history h WHERE h.url = a.link)"""
    q["history_append"] = g + "," + HISTORY + """
SELECT url, title, fetch_time FROM history
UNION ALL
SELECT link AS url, arg_min(title, rank) AS title, (SELECT as_of FROM params) AS fetch_time
FROM top WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.url = top.link) GROUP BY link"""
    q["history_expire"] = with_(ARTICLES, HISTORY) + """
SELECT url, fetch_time FROM history, params WHERE fetch_time >= params.as_of - INTERVAL 1 DAY"""
    q["history_expired"] = with_(ARTICLES, HISTORY) + """
SELECT count(*) AS expired FROM history, params WHERE fetch_time < params.as_of - INTERVAL 1 DAY"""
    q["model_input"] = with_(ARTICLES, CANDIDATES, NATIVE_BODY) + "\nSELECT item_id, model_input FROM inputs"
    q["model_requests"] = with_(ARTICLES, CANDIDATES, NATIVE_BODY) + f"""
SELECT item_id, {lit(MODEL_DEFAULT_PROMPT)} AS system_prompt, model_input AS user_content,
       CAST(0.8 AS VARCHAR) AS temperature, CAST(10000 AS BIGINT) AS max_tokens FROM inputs"""
    q["summary_overlay"] = with_(ARTICLES, CANDIDATES) + f"""
, replies AS (SELECT conv_id AS item_id, arg_min(text, turn) AS text FROM conversations
              WHERE role = 'assistant' GROUP BY conv_id),
answers AS (SELECT item_id, {strip('text')} AS new_summary FROM replies)
SELECT c.item_id, CASE WHEN a.new_summary IS NOT NULL AND length(a.new_summary) > 0
                       THEN a.new_summary || {lit(MODEL_SUMMARY_SUFFIX)} ELSE c.summary END AS summary
FROM candidates c LEFT JOIN answers a ON a.item_id = c.item_id"""
    q["digest_lines"] = g + "," + digest_lines_sql(False) + \
        "\nSELECT CAST(line_no AS BIGINT) AS line_no, value FROM lines"
    gl = "WITH RECURSIVE " + ",".join([ARTICLES, CANDIDATES, groups_sql("lang")])
    q["digest_by_language"] = gl + "," + digest_lines_sql(True) + f"""
SELECT digest_key AS lang,
       CASE WHEN max(line_no) >= 10 THEN string_agg(value, chr(10) ORDER BY line_no)
            ELSE {lit(DIGEST_EMPTY)} END AS document
FROM lines GROUP BY digest_key"""
    q["digest_empty"] = with_(ARTICLES) + f"""
SELECT CASE WHEN count(*) = 0 THEN {lit(DIGEST_EMPTY)} END AS document
FROM articles, params WHERE pub_time >= params.as_of + INTERVAL 365 DAY - INTERVAL 2 DAY"""
    return q


def stream_sql() -> dict[str, str]:
    return {
        "stream_dedupe": "SELECT DISTINCT user_id FROM events",
        "site_trend": with_(ARTICLES) + """
SELECT date_trunc('day', pub_time) AS window_start, site, count(*) AS n
FROM articles GROUP BY ALL""",
    }


def push_sql() -> dict[str, str]:
    from storyloom.params import PUSH_TITLE_PREFIX
    g = "WITH RECURSIVE " + ",".join([ARTICLES, CANDIDATES, groups_sql(None)])
    return {"push_message": g + "," + digest_lines_sql(False) + f"""
SELECT '# ' || {lit(PUSH_TITLE_PREFIX)} || strftime((SELECT as_of FROM params), '%Y年%m月%d日')
       || chr(10) || chr(10) || string_agg(value, chr(10) ORDER BY line_no) AS message
FROM lines"""}


# Articles as they come back from a feed (text nodes collapsed, whole seconds) and from a search
# (label instead of a site, position in the response, no comments).
FEED_PART = f"""
fed AS (
  SELECT item_id, 0 AS kind, dense_rank() OVER (ORDER BY site) AS sorder, site AS source, site, title, link,
         {strip(f"regexp_replace(content, '{WS_RUN}', ' ', 'g')")} AS content,
         date_trunc('second', pub_time) AS pub_time, comments, lang
  FROM articles
)"""
SEARCH_PART = f"""
sought AS (
  SELECT item_id, 1 AS kind, item_id // 400 AS sorder, site || '/' || (item_id // 400) AS source,
         {lit(SEARCH_SITE_PREFIX)} || {netloc('link')} || {lit(SEARCH_SITE_SUFFIX)} AS site, title, link, content,
         date_trunc('second', pub_time) AS pub_time, 0::BIGINT AS comments, lang,
         row_number() OVER (PARTITION BY site, item_id // 400 ORDER BY item_id) AS position
  FROM articles
)"""


def items_from(name: str, more: str = "true") -> str:
    return f"""
items AS (
  SELECT item_id, kind, sorder, source, site, title, link, {SUMMARY} AS summary, pub_time,
         CAST(pub_time AS DATE) AS pub_date, comments, lang FROM {name}, params
  WHERE pub_time >= params.as_of - INTERVAL 2 DAY AND {more}
),
candidates AS (SELECT *, CAST({SCORE} AS INTEGER) AS kw_score FROM items WHERE NOT {EXCLUDED})"""


def source_sql() -> dict[str, str]:
    replies = with_(ARTICLES, CANDIDATES, NATIVE_BODY) + f"""
SELECT item_id, nullif({strip("split_part(model_input, '.', 1)")}, '') AS new_summary FROM inputs"""
    return {
        "feed_items": with_(ARTICLES, FEED_PART, items_from("fed")) + """
SELECT site, title, link, summary, pub_time, comments, kw_score FROM candidates""",
        "search_items": with_(ARTICLES, SEARCH_PART, items_from("sought", "position <= 10")) + """
SELECT site, title, link, summary, pub_time, pub_date, kw_score FROM candidates""",
        "model_replies": replies,
        "model_ledger": replies,
    }


def run_sql() -> dict[str, str]:
    """Even items come by feed, odd ones by search; history of one day; the model answers with the first
    sentence of what it is sent, and no page is landed."""
    union = """
kept_history AS (SELECT h.* FROM history h, params WHERE h.fetch_time >= params.as_of - INTERVAL 1 DAY),
arrived AS (SELECT * FROM fed WHERE item_id % 2 = 0
            UNION ALL SELECT * EXCLUDE (position) FROM (
              SELECT * EXCLUDE (position), row_number() OVER (PARTITION BY source ORDER BY item_id) AS position
              FROM sought WHERE item_id % 2 = 1) WHERE position <= 10)"""
    unseen = "NOT EXISTS (SELECT 1 FROM kept_history h WHERE h.url = arrived.link)"
    sent = (f"CASE WHEN length(summary) < 100 OR contains(summary, {lit(NO_ABSTRACT_PROBE)}) "
            f"THEN {lit(MODEL_FALLBACK_TITLE)} || title || {lit(MODEL_FALLBACK_CONTENT)} || summary ELSE summary END")
    said = strip(f"split_part({sent}, '.', 1)")
    groups = groups_sql(None, "kind, sorder, source, pub_time DESC, item_id")
    at = groups.rindex("top AS (")
    groups = groups[:at] + "ranked_top AS (" + groups[at + len("top AS ("):] + f""",
top AS (SELECT * REPLACE (CASE WHEN {said} <> '' THEN {said} || {lit(MODEL_SUMMARY_SUFFIX)} ELSE summary END AS summary)
        FROM ranked_top)"""
    return {"full_run_components": "WITH RECURSIVE " + ",".join([
        ARTICLES, HISTORY, FEED_PART, SEARCH_PART, union, items_from("arrived", unseen), groups,
        digest_lines_sql(False)]) + """
SELECT 'digest' AS kind, '' AS key, string_agg(value, chr(10) ORDER BY line_no) AS value FROM lines
UNION ALL
SELECT 'history', url, title || ' @ ' || strftime(fetch_time, '%Y-%m-%d %H:%M:%S.%f') FROM kept_history
UNION ALL
SELECT 'history', link, arg_min(title, rank) || ' @ ' || strftime((SELECT as_of FROM params), '%Y-%m-%d %H:%M:%S.%f')
FROM top WHERE NOT EXISTS (SELECT 1 FROM kept_history h WHERE h.url = top.link) GROUP BY link"""}


def sql() -> dict[str, str]:
    """All statements by query name."""
    return {**filter_sql(), **more_sql(), **stream_sql(), **push_sql(), **source_sql(), **run_sql()}
