"""DuckDB oracle SQL, one query per registered key.

Each query reads the driver's tables (pre-registered views) and computes the
expected rows independently of the Spark code: regexes over the raw HTML for
the ``pages`` table, and, for rendered fixtures, the values the renderer put
into the documents, derived straight from the source rows.
"""

from __future__ import annotations

NL = "chr(10)"
NL2 = "(chr(10) || chr(10))"
# Python's whitespace set, for RE2 (whose \s is [\t\n\f\r ]).
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _norm(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}', ' ', 'g'))"


def _text(e: str) -> str:
    """HTML fragment -> normalised text: <br> -> space, tags dropped,
    entities decoded (ampersand last)."""
    stripped = f"regexp_replace(regexp_replace({e}, '<br\\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g')"
    decoded = f"regexp_replace(replace(replace({stripped}, '&quot;', '\"'), '&#39;', ''''), '&amp;?', '&', 'g')"
    return _norm(decoded)


_URL = "'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)'"

PAGES_ART = f"""
art AS (SELECT page_id, url, html, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS a FROM pages_src),
heads AS (SELECT page_id, url,
    {_text("regexp_extract(a, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
    {_text("regexp_extract(a, '(?s)</h1>.*?<p>(.*)$', 1)")} AS intro_text
  FROM art)"""

R1 = f"""
r1_lines AS (
  SELECT l_orderkey, list(struct_pack(ln := l_linenumber, pk := l_partkey, sk := l_suppkey, q := l_quantity)
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS lines
  FROM lineitem GROUP BY l_orderkey),
r1 AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus AS st, o.o_orderpriority AS pr, o.o_custkey AS custkey, c.c_name AS cname,
         coalesce(r1_lines.lines, []) AS lines, len(coalesce(r1_lines.lines, [])) AS n
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN r1_lines ON r1_lines.l_orderkey = o.o_orderkey),
g AS (
  SELECT *,
    CASE WHEN k % 13 <> 0 OR k % 3 = 0 THEN 'Order ' || k ELSE 'Order ' || k || ' og' END AS title,
    CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS e,
    'Line count ' || n || '.'
      || CASE WHEN n > 0 THEN {NL2} || array_to_string(list_transform(lines, lambda x: '- Line ' || x.ln), {NL}) ELSE '' END
      || {NL2} || 'order ' || k || {NL} || '  lines ' || n || {NL2} || 'Quote ' || k AS details_text,
    CASE WHEN n > 0 THEN array_to_string(list_transform(range(1, n + 1), lambda i:
           (i + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) || '. Part ' || lines[i].pk || ' qty ' || CAST(lines[i].q AS BIGINT)), {NL}) || {NL2}
         ELSE '' END || '1. Extra ' || k || ' src' AS refs_text
  FROM r1 WHERE NOT (k % 97 = 96) AND NOT (k % 13 = 0 AND k % 3 = 2))"""


def _with(*ctes: str) -> str:
    sql = "WITH " + ",".join(ctes)
    if "pages_src" in sql and "pages_src AS" not in sql:
        sql = sql.replace("WITH ", "WITH pages_src AS (SELECT page_id, url, html FROM pages),", 1)
    return sql


def _js(e: str) -> str:
    """A value as JSON text: strings quoted, null as null."""
    return f"coalesce(CAST(to_json({e}) AS VARCHAR), 'null')"


def _media_js(index: int, url: str, caption: str, alt: str) -> str:
    return f"""'{{"index":{index},"image_url":' || {_js(url)} || ',"caption":' || {_js(caption)} || ',"alt_text":' || {_js(alt)} || '}}'"""


_IMG = "'https://img.example.org/o/' || k || "
_J_INFOBOX = """'[{"label":"Status","value":' || to_json(st) || '},{"label":"Priority","value":' || to_json(pr) || '},{"label":"Customer","value":"' || custkey || '"}]'"""
_J_LEAD = f"""'{{"image_url":"https://wiki.example.org/images/order_' || k || '.png?v=1","caption":' || {_js("CASE WHEN k % 4 <> 0 THEN 'Figure ' || k END")} || ',"alt_text":"Order ' || k || ' image"}}'"""
_J_SECTIONS = f"""'[{{"id":' || {_js("CASE WHEN k % 7 <> 0 THEN 'overview' END")} || ',"title":"Overview","level":2,"text":'
  || {_js("CASE WHEN k % 7 <> 0 THEN 'Status ' || st || ' and priority ' || pr || '.' ELSE '' END")} || ',"media":['
  || {_media_js(1, _IMG + "'/chart.png'", "'Chart ' || k", "'Chart ' || k")} || '],"subsections":[{{"id":"details","title":"Details","level":3,"text":'
  || {_js("details_text")} || ',"media":[' || {_media_js(1, _IMG + "'/a.png'", "CAST(NULL AS VARCHAR)", "'a'")} || ','
  || {_media_js(2, _IMG + "'/b.png'", "'B ' || k", "CAST(NULL AS VARCHAR)")} || ',' || {_media_js(3, _IMG + "'/c_(1).png'", "CAST(NULL AS VARCHAR)", "'paren'")}
  || '],"subsections":[]}}]}},{{"id":null,"title":"References","level":2,"text":' || {_js("refs_text")} || ',"media":[],"subsections":[]}}]'"""
_J_REFS = """'[' || array_to_string(list_concat(list_transform(range(1, n + 1), lambda i: '{"index":' || (i + e) || ',"text":"Part ' || lines[i].pk || ' qty '
  || CAST(lines[i].q AS BIGINT) || '","url":"/page/Supplier_' || lines[i].sk || '"}'),
  ['{"index":' || (n + 1) || ',"text":"Extra ' || k || ' src","url":"https://ext.example.com/o/' || k || '"}']), ',') || ']'"""
_J_LINKS = """'[' || array_to_string(list_transform(list_concat(['https://wiki.example.org/page/' || replace(cname, '#', '%23')],
  list_transform(list_filter(range(1, n + 1), lambda i: list_position(list_transform(lines, lambda x: x.sk), lines[i].sk) = i),
    lambda i: 'https://wiki.example.org/page/Supplier_' || lines[i].sk), ['https://ext.example.com/o/' || k]), lambda u: CAST(to_json(u) AS VARCHAR)), ',') || ']'"""
_CANONICAL = "'https://wiki.example.org/page/Order_' || k || CASE WHEN k % 2 = 0 THEN '' ELSE '?via=og' END"
_DESCRIPTION = "CASE WHEN k % 4 <> 3 THEN 'Order of ' || pr || ' priority' END"
_J_KEYWORDS = "CASE WHEN k % 11 <> 0 THEN '[' || to_json(st) || ',' || to_json(pr) || ']' END"
_INTRO = "'Order ' || k || ' placed by ' || cname || '.'"
_JSON = f"""'{{"url":"https://wiki.example.org/page/Order_' || k || '","slug":"Order_' || k || '","title":' || {_js("title")} || ',"intro_text":' || {_js(_INTRO)}
  || ',"infobox":' || {_J_INFOBOX} || ',"lead_figure":' || {_J_LEAD} || ',"sections":' || {_J_SECTIONS} || ',"references":' || {_J_REFS}
  || ',"links":' || {_J_LINKS} || ',"metadata":{{"status_code":200,"fetched_at_utc":"2026-01-01T00:00:00Z","canonical_url":' || {_js(_CANONICAL)}
  || ',"description":' || {_js(_DESCRIPTION)} || ',"keywords":' || coalesce({_J_KEYWORDS}, 'null') || '}}}}'"""

_MD = f"""'# ' || title
  || {NL2} || 'Order ' || k || ' placed by ' || cname || '.'
  || {NL2} || '## Infobox' || {NL} || '- **Status:** ' || st || {NL} || '- **Priority:** ' || pr || {NL} || '- **Customer:** ' || custkey
  || {NL2} || '![Order ' || k || ' image](https://wiki.example.org/images/order_' || k || '.png?v=1)'
     || CASE WHEN k % 4 <> 0 THEN {NL} || '*Figure ' || k || '*' ELSE '' END
  || {NL2} || '## Overview'
  || CASE WHEN k % 7 <> 0 THEN {NL2} || 'Status ' || st || ' and priority ' || pr || '.' ELSE '' END
  || {NL2} || '![Chart ' || k || '](https://img.example.org/o/' || k || '/chart.png)' || {NL} || '*Chart ' || k || '*'
  || {NL2} || '### Details'
  || {NL2} || details_text
  || {NL2} || '![a](https://img.example.org/o/' || k || '/a.png)'
  || {NL2} || '![](https://img.example.org/o/' || k || '/b.png)' || {NL} || '*B ' || k || '*'
  || {NL2} || '![paren](https://img.example.org/o/' || k || '/c_(1).png)'
  || {NL2} || '## References'
  || {NL2} || refs_text"""

_SLUG_SAFE = [("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*"),
              ("%2B", "+"), ("%2C", ","), ("%3B", ";"), ("%3D", "="), ("%3A", ":"), ("%40", "@")]


def _quote(e: str) -> str:
    out = f"url_encode({e})"
    for esc, ch in _SLUG_SAFE:
        out = f"replace({out}, '{esc}', '{ch}')"
    return out


ORACLE: dict[str, str] = {
    # ---------------------------------------------------------------- pages
    "page_heads": _with(PAGES_ART) + f"""
        SELECT page_id, url,
          regexp_replace(regexp_extract(url, {_URL}, 3), '^/+|/+$', '', 'g') AS slug, title, intro_text
        FROM heads""",
    "pages_scan": "SELECT page_id, url FROM pages",
    "shred": """
        WITH bare AS (SELECT page_id, html, regexp_replace(html, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g') AS h FROM pages)
        SELECT page_id, tag, count(*)::BIGINT AS n FROM (
          SELECT page_id, unnest(regexp_extract_all(h, '<([a-z][a-z0-9]*)[\\s/>]', 1)) AS tag FROM bare
          UNION ALL SELECT page_id, unnest(regexp_extract_all(html, '<(script|style)[\\s>]', 1)) FROM bare)
        GROUP BY page_id, tag""",
    "article_select": """
        SELECT page_id, len(regexp_extract_all(html, '<article[\\s>]'))::BIGINT AS n_articles,
          regexp_extract(html, '<article[^>]*class="([^"]*)"', 1) AS article_class FROM pages""",
    "head_title": f"""
        SELECT page_id, nullif({_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, '') AS head_title FROM pages""",
    "page_title": _with(PAGES_ART) + " SELECT page_id, title FROM heads",
    "page_intro": _with(PAGES_ART) + " SELECT page_id, intro_text FROM heads",
    "page_slug": f"SELECT page_id, regexp_replace(regexp_extract(url, {_URL}, 3), '^/+|/+$', '', 'g') AS slug FROM pages",
    "blocks": _with(PAGES_ART) + """
        SELECT page_id, 1::BIGINT AS seq, 'heading' AS kind, 1 AS level, title AS text FROM heads
        UNION ALL SELECT page_id, 2::BIGINT, 'paragraph', NULL, intro_text FROM heads""",
    "url_canonical": f"""
        SELECT page_id, lower(regexp_extract(url, {_URL}, 1)) || '://' || lower(regexp_extract(url, {_URL}, 2))
          || url_decode(regexp_extract(url, {_URL}, 3)) AS key FROM pages""",
    "url_dedupe": f"""
        SELECT key, arg_min(url, page_id) AS url, min(page_id) AS page_id, count(*) AS n FROM (
          SELECT page_id, url, lower(regexp_extract(url, {_URL}, 1)) || '://' || lower(regexp_extract(url, {_URL}, 2))
            || url_decode(regexp_extract(url, {_URL}, 3)) AS key FROM pages) GROUP BY key""",
    "url_origin": f"""
        SELECT page_id, lower(regexp_extract(url, {_URL}, 1)) || '://' || regexp_extract(url, {_URL}, 2) || '/robots.txt'
          AS robots_url FROM pages""",
    "robots_origins": f"""
        SELECT robots_url, count(*) AS n_pages FROM (
          SELECT lower(regexp_extract(url, {_URL}, 1)) || '://' || regexp_extract(url, {_URL}, 2) || '/robots.txt'
            AS robots_url FROM pages) GROUP BY robots_url""",
    "search_html_hits": f"""
        WITH h AS (
          SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
                 unnest(range(1, 1 + len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS ord FROM pages),
        n AS (SELECT page_id, lower(regexp_extract(url, {_URL}, 1)) || '://' || regexp_extract(url, {_URL}, 2)
                 || regexp_extract(href, '^([^?#]*)', 1) AS page_url, min(ord) AS first_ord
              FROM h GROUP BY ALL)
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first_ord)::BIGINT AS pos, page_url FROM n""",
    "ws_normalize": f"SELECT doc_id, {_norm('text')} AS text_norm FROM documents",
    "title_slug": f"SELECT p_partkey, nullif(replace({_norm('p_name')}, ' ', '_'), '') AS slug FROM part",
    "slug_url": f"""SELECT c_custkey, 'https://wiki.example.org/page/' || {_quote(f"replace({_norm('c_name')}, ' ', '_')")} AS url
        FROM customer""",
    "unquote": "SELECT c_custkey, c_name || ' +x' AS decoded FROM customer",
    "day_page": """
        SELECT CAST(o_orderdate AS DATE) AS day, strftime(CAST(o_orderdate AS DATE), '%B_%-d') AS title,
          'https://wiki.example.org/page/' || strftime(CAST(o_orderdate AS DATE), '%B_%-d') AS url, count(*) AS n_orders
        FROM orders GROUP BY ALL""",
    # ---------------------------------------------------------------- R1
    "parse_quarantine": """
        SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 97 = 96 THEN 'no_article' ELSE 'no_title' END AS reason
        FROM orders WHERE o_orderkey % 97 = 96 OR (o_orderkey % 13 = 0 AND o_orderkey % 3 = 2)""",
    "head_description": _with(R1) + """
        SELECT k AS page_id, CASE WHEN k % 4 <> 3 THEN 'Order of ' || pr || ' priority' END AS description FROM g""",
    "head_canonical": _with(R1) + """
        SELECT k AS page_id,
          'https://wiki.example.org/page/Order_' || k || CASE WHEN k % 2 = 0 THEN '' ELSE '?via=og' END AS canonical_url
        FROM g""",
    "head_title_r1": _with(R1) + """
        SELECT k AS page_id, CASE k % 3 WHEN 0 THEN 'Order ' || k WHEN 1 THEN 'Order ' || k || ' og' END AS head_title
        FROM g""",
    "head_keywords": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS pos, st AS keyword FROM g WHERE k % 11 <> 0
        UNION ALL SELECT k, 2::BIGINT, pr FROM g WHERE k % 11 <> 0""",
    "page_assemble": _with(R1) + f"""
        SELECT k AS page_id, 'https://wiki.example.org/page/Order_' || k AS url, 'Order_' || k AS slug, title, {_INTRO} AS intro_text,
          {_J_INFOBOX} AS infobox, {_J_LEAD} AS lead_figure, {_J_SECTIONS} AS sections, {_J_REFS} AS references, {_J_LINKS} AS links,
          200 AS status_code, {_CANONICAL} AS canonical_url, {_DESCRIPTION} AS description, {_J_KEYWORDS} AS keywords FROM g""",
    "link_edges": _with(R1, """
        s AS (SELECT k, sk, min(i) AS first_i FROM (SELECT k, unnest(lines).sk AS sk, unnest(range(1, n + 1)) AS i FROM g) GROUP BY k, sk),
        sr AS (SELECT k, sk, row_number() OVER (PARTITION BY k ORDER BY first_i) AS r, count(*) OVER (PARTITION BY k) AS m FROM s)""") + """
        SELECT k AS page_id, 1::BIGINT AS seq, 'https://wiki.example.org/page/' || replace(cname, '#', '%23') AS url FROM g
        UNION ALL SELECT k, (1 + r)::BIGINT, 'https://wiki.example.org/page/Supplier_' || sk FROM sr
        UNION ALL SELECT g.k, (2 + coalesce(max(sr.m), 0))::BIGINT, 'https://ext.example.com/o/' || g.k
          FROM g LEFT JOIN sr ON sr.k = g.k GROUP BY g.k""",
    "infobox": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS seq, 'Status' AS label, st AS value FROM g
        UNION ALL SELECT k, 2::BIGINT, 'Priority', pr FROM g
        UNION ALL SELECT k, 3::BIGINT, 'Customer', CAST(custkey AS VARCHAR) FROM g""",
    "lead_figure": _with(R1) + """
        SELECT k AS page_id, 'https://wiki.example.org/images/order_' || k || '.png?v=1' AS image_url,
          CASE WHEN k % 4 <> 0 THEN 'Figure ' || k END AS caption, 'Order ' || k || ' image' AS alt_text FROM g""",
    "sections": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS sec_no, 0::BIGINT AS sub_no, 2 AS level,
          CASE WHEN k % 7 <> 0 THEN 'overview' END AS id, 'Overview' AS title FROM g
        UNION ALL SELECT k, 1, 1, 3, 'details', 'Details' FROM g
        UNION ALL SELECT k, 2, 0, 2, NULL, 'References' FROM g""",
    "section_text": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS sec_no, 0::BIGINT AS sub_no,
          CASE WHEN k % 7 <> 0 THEN 'Status ' || st || ' and priority ' || pr || '.' ELSE '' END AS text FROM g
        UNION ALL SELECT k, 1, 1, details_text FROM g
        UNION ALL SELECT k, 2, 0, refs_text FROM g""",
    "references": _with(R1) + """
        SELECT k AS page_id, (i + e)::BIGINT AS index, 'Part ' || l.pk || ' qty ' || CAST(l.q AS BIGINT) AS text,
          '/page/Supplier_' || l.sk AS url
        FROM (SELECT k, e, unnest(lines) AS l, unnest(range(1, n + 1)) AS i FROM g)
        UNION ALL SELECT k, (n + 1)::BIGINT, 'Extra ' || k || ' src', 'https://ext.example.com/o/' || k FROM g""",
    "section_media": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS sec_no, 0::BIGINT AS sub_no, 1::BIGINT AS index,
          'https://img.example.org/o/' || k || '/chart.png' AS image_url, 'Chart ' || k AS caption, 'Chart ' || k AS alt_text FROM g
        UNION ALL SELECT k, 1, 1, 1, 'https://img.example.org/o/' || k || '/a.png', NULL, 'a' FROM g
        UNION ALL SELECT k, 1, 1, 2, 'https://img.example.org/o/' || k || '/b.png', 'B ' || k, NULL FROM g
        UNION ALL SELECT k, 1, 1, 3, 'https://img.example.org/o/' || k || '/c_(1).png', NULL, 'paren' FROM g""",
    "payload_media": _with(R1) + """
        SELECT k AS page_id, 1::BIGINT AS sec_no, 0::BIGINT AS sub_no,
          'https://img.example.org/o/' || k || '/chart.png' AS image_url, 'Chart ' || k AS caption, 'Chart ' || k AS alt_text FROM g
        UNION ALL SELECT k, 1, 1, 'https://img.example.org/o/' || k || '/a.png', NULL, 'again' FROM g
        UNION ALL SELECT k, 1, 1, 'https://img.example.org/o/' || k || '/c_(1).png', NULL, 'paren' FROM g""",
    "payload_markdown": _with(R1) + f"""
        SELECT k AS page_id, 1::BIGINT AS pno,
          '## Overview' || {NL} || '![Chart ' || k || '](https://img.example.org/o/' || k || '/chart.png)' || {NL2}
          || '*Chart ' || k || '*' || {NL} || '### Details' || {NL} || '![again](https://img.example.org/o/' || k || '/a.png)'
          || {NL} || '![paren](https://img.example.org/o/' || k || '/c_(1).png "t")' AS payload FROM g""",
    "page_stats": _with(R1) + """
        SELECT k AS page_id, 2::BIGINT AS n_sections, (n + 1)::BIGINT AS n_references, 4::BIGINT AS n_media,
          (CASE WHEN k % 11 <> 0 THEN 2 ELSE 0 END)::BIGINT AS n_keywords FROM g""",
    "markdown_render": _with(R1) + f" SELECT k AS page_id, {_MD} AS markdown FROM g",
    "page_json_read": _with(R1) + f" SELECT k AS page_id, {_MD} AS markdown FROM g",
    "page_json_write": _with(R1) + f" SELECT k AS page_id, {_JSON} AS json FROM g",
}


R5 = """
ev AS (SELECT *, 'User_' || user_id AS slug,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS pos FROM events),
tot AS (SELECT slug, count(*) AS total FROM ev GROUP BY slug)"""

_R5_FIELDS = """CAST(e.event_id AS VARCHAR) AS id, e.slug, CAST(e.user_id AS VARCHAR) AS user_id,
  'EDIT_REQUEST_STATUS_' || upper(e.event_type) AS status, e.event_type AS type, '' AS summary,
  CAST(NULL AS VARCHAR) AS original_content, e.props AS proposed_content,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE e.event_type END AS section_title,
  date_trunc('second', e.ts) AS created_at_utc, date_trunc('second', e.ts) + INTERVAL 60 SECOND AS updated_at_utc,
  CAST(floor(e.value) AS BIGINT) AS upvote_count, 0::BIGINT AS downvote_count, CAST(NULL AS VARCHAR) AS review_reason"""

ORACLE.update({
    "edit_batches": _with(R5) + """
        SELECT ev.slug, (((pos - 1) // 25) * 25)::BIGINT AS offset, count(*)::BIGINT AS n, any_value(total)::BIGINT AS total_count,
          ((pos - 1) // 25 + 1) * 25 < any_value(total) AS has_more, CAST(NULL AS VARCHAR) AS error
        FROM ev JOIN tot USING (slug) GROUP BY ev.slug, (pos - 1) // 25
        UNION ALL SELECT slug, total, 1, total, false, NULL FROM tot
        UNION ALL SELECT 'Bad_object', 0, 0, 1, false, 'entries_not_array'
        UNION ALL SELECT 'Bad_array', 0, 0, 0, false, 'not_object'""",
    "edit_entries": _with(R5) + f"""
        SELECT e.slug AS page_slug, (((e.pos - 1) // 25) * 25)::BIGINT AS offset, ((e.pos - 1) % 25 + 1)::BIGINT AS pos,
          {_R5_FIELDS} FROM ev e
        UNION ALL
        SELECT e.slug, t.total::BIGINT, 1::BIGINT, CAST(e.event_id + 1000000000 AS VARCHAR), e.slug, CAST(e.user_id AS VARCHAR),
          'EDIT_REQUEST_STATUS_' || upper(e.event_type), e.event_type, '', NULL, e.props,
          CASE WHEN e.event_type = 'error' THEN NULL ELSE e.event_type END,
          date_trunc('second', e.ts), date_trunc('second', e.ts) + INTERVAL 60 SECOND,
          CAST(floor(e.value) AS BIGINT), 0::BIGINT, NULL
        FROM ev e JOIN tot t USING (slug) WHERE e.pos = 1""",
    "edit_stitch": _with(R5) + """
        SELECT slug, ((total + 24) // 25)::BIGINT AS n_batches, total::BIGINT AS n_entries, total::BIGINT AS total_count,
          false AS has_more, true AS contiguous, true AS valid, true AS complete FROM tot
        UNION ALL SELECT 'Bad_object', 1, 0, 1, false, true, false, false
        UNION ALL SELECT 'Bad_array', 1, 0, 0, false, true, false, false""",
    "edit_page": _with(R5) + """
        SELECT slug AS page_slug, pos::BIGINT AS rank, CAST(event_id AS VARCHAR) AS id FROM ev WHERE pos BETWEEN 6 AND 15""",
    "edit_summary": _with(R5) + """
        SELECT slug AS page_slug, 'EDIT_REQUEST_STATUS_' || upper(event_type) AS status, count(*) AS n,
          sum(CAST(floor(value) AS BIGINT)) AS net_votes,
          max(date_trunc('second', ts) + INTERVAL 60 SECOND) AS last_updated
        FROM ev GROUP BY ALL""",
    "edit_payload_write": _with(R5, f"f AS (SELECT e.pos, t.total, {_R5_FIELDS} FROM ev e JOIN tot t USING (slug))") + f"""
        SELECT slug, ((pos - 1) // 25 * 25)::BIGINT AS "offset", '{{"edit_requests":[' || string_agg('{{"id":' || {_js('id')} || ',"slug":' || {_js('slug')}
            || ',"user_id":' || {_js('user_id')} || ',"status":' || {_js('status')} || ',"type":' || {_js('type')} || ',"summary":"","original_content":null,"proposed_content":'
            || {_js("nullif(proposed_content, '')")} || ',"section_title":' || {_js('section_title')}
            || ',"created_at_utc":"' || strftime(created_at_utc, '%Y-%m-%dT%H:%M:%SZ') || '","updated_at_utc":"' || strftime(updated_at_utc, '%Y-%m-%dT%H:%M:%SZ')
            || '","upvote_count":' || upvote_count || ',"downvote_count":0,"review_reason":null}}', ',' ORDER BY pos)
          || '],"total_count":' || any_value(total) || ',"has_more":' || CASE WHEN ((pos - 1) // 25 + 1) * 25 < any_value(total) THEN 'true' ELSE 'false' END || '}}' AS json
        FROM f GROUP BY slug, (pos - 1) // 25""",
    "edit_payload_read": _with(R5) + """
        SELECT DISTINCT slug, (((pos - 1) // 25) * 25)::BIGINT AS "offset", true AS accepted, CAST(NULL AS VARCHAR) AS error FROM ev
        UNION ALL SELECT slug, total, true, NULL FROM tot
        UNION ALL SELECT 'Bad_object', 0, false, 'entries_not_array' UNION ALL SELECT 'Bad_array', 0, false, 'not_object'""",
})


R3 = f"""
o AS (SELECT DISTINCT lower(regexp_extract(url, {_URL}, 1)) || '://' || regexp_extract(url, {_URL}, 2) || '/robots.txt' AS robots_url,
        regexp_extract(url, {_URL}, 2) AS host FROM pages),
r AS (SELECT robots_url, length(host) % 5 AS cls FROM o WHERE length(host) % 7 <> 0),
pg AS (SELECT page_id, url, regexp_extract(url, {_URL}, 2) AS host, regexp_extract(url, {_URL}, 3) AS path FROM pages),
gate AS (SELECT page_id, url, CASE WHEN length(host) % 7 = 0 THEN 'unavailable' ELSE CASE length(host) % 5
    WHEN 0 THEN CASE WHEN starts_with(path, '/fr/') OR starts_with(path, '/de/') THEN 'disallowed' ELSE 'allowed' END
    WHEN 1 THEN CASE WHEN starts_with(path, '/en/') THEN 'allowed' ELSE 'disallowed' END
    WHEN 2 THEN CASE WHEN starts_with(path, '/en/9') THEN 'disallowed' ELSE 'allowed' END
    WHEN 3 THEN 'allowed'
    ELSE CASE WHEN starts_with(path, '/en/1') OR starts_with(path, '/de/2') OR starts_with(path, '/es/') THEN 'disallowed' ELSE 'allowed' END
  END END AS verdict FROM pg)"""

ORACLE.update({
    "robots_rules": _with(R3) + """
        SELECT robots_url, x.entry_no::BIGINT AS entry_no, x.is_default, x.agents, x.seq::BIGINT AS seq, x.allow, x.prefix
        FROM r JOIN (VALUES
          (0, 1, true, '*', 1, false, '/fr/'), (0, 1, true, '*', 2, false, '/de/'),
          (1, 1, true, '*', 1, true, '/en/'), (1, 1, true, '*', 2, false, '/'),
          (2, 1, false, 'corpusbot', 1, false, '/en/9'), (2, 1, false, 'corpusbot', 2, true, '/'),
          (2, 1, false, 'corpusbot', 3, false, '/es/'), (2, 2, true, '*', 1, false, '/'),
          (3, 1, false, 'corpusbot', NULL, NULL, NULL), (3, 2, true, '*', 1, false, '/'),
          (4, 1, true, '*', 1, false, '/en/1'), (4, 1, true, '*', 2, false, '/de/2'), (4, 1, true, '*', 3, false, '/es/'))
          AS x(cls, entry_no, is_default, agents, seq, allow, prefix) ON x.cls = r.cls""",
    "robots_gate": _with(R3) + " SELECT page_id, verdict FROM gate",
    "robots_fail_closed": _with(R3) + " SELECT page_id, url FROM pg WHERE length(host) % 7 = 0",
    "robots_bypass": "SELECT page_id, 'allowed' AS verdict FROM pages",
})


R4 = f"""
p AS (SELECT p_partkey, p_brand AS query, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn,
        nullif(replace({_norm('p_name')}, ' ', '_'), '') AS t FROM part),
top AS (SELECT *, ((rn - 1) // 25 * 25)::BIGINT AS "offset", CASE WHEN p_partkey % 3 = 0 THEN t || ';v' || p_partkey ELSE t END AS slug FROM p),
api_valid AS (SELECT DISTINCT query, "offset" FROM top WHERE right(query, 1) NOT IN ('3', '4', '5')),
api_ok AS (SELECT * FROM top WHERE right(query, 1) NOT IN ('0', '3', '4', '5') AND p_partkey % 70 <> 0 AND p_partkey % 50 <> 0),
api_first AS (SELECT query, "offset", t, arg_min(slug, rn) AS slug, min(rn) AS rn FROM api_ok GROUP BY query, "offset", t),
api_hits AS (SELECT query, "offset", row_number() OVER (PARTITION BY query, "offset" ORDER BY rn)::BIGINT AS pos,
               'https://wiki.example.org/page/' || {_quote('slug')} AS page_url FROM api_first),
html_first AS (SELECT query, "offset", t, min(rn) AS rn FROM top WHERE p_partkey % 70 <> 0 AND p_partkey % 50 <> 0 GROUP BY query, "offset", t),
html_hits AS (SELECT query, "offset", row_number() OVER (PARTITION BY query, "offset" ORDER BY rn)::BIGINT AS pos,
               'https://wiki.example.org/page/' || t AS page_url FROM html_first),
fb AS (SELECT * FROM api_hits UNION ALL SELECT * FROM html_hits WHERE right(query, 1) IN ('3', '4', '5'))"""

_TOK = "list_filter(regexp_split_to_array(lower({e}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"

ORACLE.update({
    "search_api_hits": _with(R4) + ''' SELECT query, "offset", pos, page_url FROM api_hits''',
    "search_payload_read": _with(R4) + """
        SELECT query, "offset", (query, "offset") IN (SELECT (query, "offset") FROM api_valid) AS valid, coalesce(n, 0)::BIGINT AS n_hits
        FROM (SELECT DISTINCT query, "offset" FROM top) LEFT JOIN (SELECT query, "offset", count(*) AS n FROM api_hits GROUP BY ALL) USING (query, "offset")""",
    "search_html_read": _with(R4) + ''' SELECT query, "offset", pos, page_url FROM html_hits''',
    "search_fallback": _with(R4) + ''' SELECT query, "offset", pos, page_url FROM fb''',
    "search_limit": _with(R4) + ''' SELECT query, "offset", pos, page_url FROM fb WHERE pos <= 5''',
    "corpus_search": f"""
        WITH q AS (SELECT DISTINCT text AS query FROM benchmark WHERE text IS NOT NULL),
        qt AS (SELECT DISTINCT query, unnest({_TOK.format(e='query')}) AS term FROM q),
        dt AS (SELECT doc_id, unnest({_TOK.format(e='text')}) AS term FROM documents),
        dc AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
        s AS (SELECT query, doc_id, count(*) AS n_terms, sum(tf) AS tf FROM dc JOIN qt USING (term) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY n_terms DESC, tf DESC, doc_id) AS rank FROM s)
        SELECT query, doc_id, rank::BIGINT AS rank, n_terms::BIGINT AS n_terms, tf::BIGINT AS tf FROM r WHERE rank <= 25""",
})


R2 = """
v AS (
  SELECT c_nationkey AS nation, c_custkey, 0 AS variant, 'https://Wiki.example.org/page/' || replace(c_name, '#', '%23') AS loc FROM customer
  UNION ALL SELECT c_nationkey, c_custkey, 1, 'https://WIKI.EXAMPLE.ORG/page/' || replace(c_name, '#', '%23') FROM customer WHERE c_custkey % 30 = 0
  UNION ALL SELECT c_nationkey, c_custkey, 2, 'https://Wiki.example.org/page/' || replace(c_name, '#', '%23') FROM customer WHERE c_custkey % 45 = 0
  UNION ALL SELECT (c_nationkey + 1) % 25, c_custkey, 3, 'https://wiki.example.org/page/' || replace(c_name, '#', '%23') FROM customer WHERE c_custkey % 10 = 0),
d AS (SELECT nation, loc, min(c_custkey * 10 + variant) AS o FROM v GROUP BY nation, loc),
ch AS (SELECT nation, 'https://assets.example.org/sitemap-' || nation || '.xml' AS sitemap_url,
         dense_rank() OVER (ORDER BY nation)::BIGINT AS sitemap_pos FROM (SELECT DISTINCT nation FROM v)),
m AS (SELECT ch.sitemap_url, ch.sitemap_pos, row_number() OVER (PARTITION BY d.nation ORDER BY d.o)::BIGINT AS loc_pos, d.loc AS page_url
      FROM d JOIN ch USING (nation)),
k AS (SELECT 'https://wiki.example.org' || url_decode(regexp_extract(page_url, '^https://[^/]*(.*)$', 1)) AS key, sitemap_url, sitemap_pos,
        arg_max(page_url, loc_pos) AS page_url FROM m GROUP BY ALL)"""

ORACLE.update({
    "sitemap_locs": _with(R2) + """
        SELECT sitemap_url, loc_pos, page_url AS loc, CAST(NULL AS VARCHAR) AS error FROM m
        UNION ALL SELECT 'https://assets.example.org/sitemap-index.xml', sitemap_pos, sitemap_url, NULL FROM ch
        UNION ALL SELECT 'https://assets.example.org/sitemap-' || x.name || '.xml', x.pos, x.loc, x.error FROM (VALUES
          ('broken', NULL, NULL, 'unparsable XML'), ('mismatch', NULL, NULL, 'unparsable XML'),
          ('styled', 1, 'https://a.example/styled', NULL), ('comments', 1, 'https://a.example/c', NULL),
          ('bom', 1, 'https://a.example/bom', NULL), ('doctype', 1, 'https://a.example/&d', NULL)) AS x(name, pos, loc, error)""",
    "sitemap_manifest": _with(R2) + " SELECT sitemap_url, sitemap_pos, loc_pos, page_url, CAST(NULL AS VARCHAR) AS error FROM m",
    "sitemap_index": _with(R2) + " SELECT key, sitemap_url, page_url FROM k",
    "sitemap_lookup": _with(R2, """
        t AS (SELECT c_name AS title, 'https://wiki.example.org/page/' || c_name AS key FROM customer
              UNION ALL SELECT c_name || ' Missing', 'https://wiki.example.org/page/' || c_name || '_Missing' FROM customer
              WHERE c_custkey % 100 = 0),
        b AS (SELECT key, arg_min(page_url, sitemap_pos) AS page_url FROM k GROUP BY key)""") + """
        SELECT t.title, b.page_url FROM t LEFT JOIN b USING (key)""",
    "sitemap_sync": _with(R2) + """
        SELECT sitemap_url AS item, CASE WHEN nation = 24 THEN 'removed' ELSE 'kept' END AS change FROM ch
        UNION ALL SELECT 'https://assets.example.org/sitemap-new.xml', 'added'
        UNION ALL SELECT 'https://wiki.example.org/page/' || c_name, 'key_lost' FROM customer
          WHERE c_nationkey = 24 AND c_custkey % 10 <> 0""",
    "sitemap_refresh": _with(R2) + """
        SELECT sitemap_url, sitemap_pos, 0::BIGINT AS n_urls FROM ch WHERE nation <> 24
        UNION ALL SELECT 'https://assets.example.org/sitemap-new.xml', (SELECT count(*) FROM ch WHERE nation <> 24) + 1, 0""",
})


ORACLE.update({
    "stream_pages": ORACLE["page_heads"],
    "stream_url_dedupe": f"""
        SELECT DISTINCT lower(regexp_extract(url, {_URL}, 1)) || '://' || lower(regexp_extract(url, {_URL}, 2))
          || url_decode(regexp_extract(url, {_URL}, 3)) AS key FROM pages""",
    "stream_edits_latest": """
        SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, CAST(max(ts) AS TIMESTAMP) AS ts,
          arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id""",
})


R3_RESP = f"""
resp AS (SELECT page_id, url, CASE WHEN page_id % 10 = 3 THEN 404 WHEN page_id % 10 = 7 THEN 503 ELSE 200 END AS status,
           CASE WHEN page_id % 4 = 3 THEN regexp_replace(html, '[^\\x{{00}}-\\x{{7f}}]', chr(65533), 'g') ELSE html END AS text
         FROM pages),
ok AS (SELECT lower(regexp_extract(url, {_URL}, 1)) || '://' || lower(regexp_extract(url, {_URL}, 2))
          || url_decode(regexp_extract(url, {_URL}, 3)) AS key, page_id, url, text FROM resp WHERE status < 400),
newest AS (SELECT key, max(page_id) AS page_id FROM ok GROUP BY key),
ingested AS (SELECT ok.key, ok.page_id, ok.url, ok.text FROM ok JOIN newest USING (key, page_id))"""

ORACLE.update({
    "response_ingest": _with(R3_RESP) + " SELECT key, page_id, text FROM ingested",
    "response_status": """
        SELECT CASE WHEN page_id % 10 = 3 THEN 'not_found' WHEN page_id % 10 = 7 THEN 'http_error' ELSE 'ok' END AS status_class,
          count(*) AS n FROM pages GROUP BY ALL""",
    "crawl_pages": _with(R3_RESP, "pages_src AS (SELECT page_id, url, text AS html FROM ingested)", PAGES_ART, R3) + f"""
        SELECT h.page_id, h.url, regexp_replace(regexp_extract(h.url, {_URL}, 3), '^/+|/+$', '', 'g') AS slug,
          h.title, h.intro_text
        FROM heads h JOIN gate USING (page_id) WHERE gate.verdict = 'allowed'""",
})


ORACLE.update({
    "html_nodes": ORACLE["shred"],
    "link_hosts": _with(R1, """
        s AS (SELECT DISTINCT k, unnest(lines).sk AS sk FROM g)""") + """
        SELECT 'wiki.example.org' AS host, count(*) AS n_links, count(DISTINCT k) AS n_pages FROM (
          SELECT k FROM g UNION ALL SELECT k FROM s)
        UNION ALL SELECT 'ext.example.com', count(*), count(*) FROM g""",
    "infobox_labels": _with(R1) + """
        SELECT label, count(*) AS n FROM (SELECT 'Status' AS label FROM g UNION ALL SELECT 'Priority' FROM g
          UNION ALL SELECT 'Customer' FROM g) GROUP BY label""",
    "page_stats_rollup": _with(R1) + """
        SELECT scheme, host, count(*) AS pages, sum(n + 1) AS references, sum(4) AS media, max(2) AS max_sections
        FROM (SELECT 'https' AS scheme, 'wiki.example.org' AS host, n FROM g)
        GROUP BY ROLLUP (scheme, host)""",
})


R6 = """
dd AS (SELECT c_custkey AS k, c_name AS name, 3 + c_custkey % 48 AS depth, c_custkey % 10 = 0 AS bad FROM customer),
dn AS (
  SELECT k, depth, d AS seq, d, 's' || d AS id, name || ' ' || d AS title, CASE WHEN d % 2 = 0 THEN 'Text ' || d ELSE '' END AS text, d % 7 = 0 AS pic
  FROM (SELECT *, unnest(range(1, depth + 1)) AS d FROM dd WHERE NOT bad)
  UNION ALL
  SELECT k, depth, 2 * depth - d + 1, d, NULL, 'Leaf ' || d, '', false FROM (SELECT *, unnest(range(2, depth + 1)) AS d FROM dd WHERE NOT bad))"""

ORACLE.update({
    "page_outline": _with(R6) + """
        SELECT k AS page_id, seq::BIGINT AS seq, d::BIGINT AS depth, id, title, (d + 1)::BIGINT AS level, text,
          CASE WHEN pic THEN 1 ELSE 0 END::BIGINT AS n_media FROM dn""",
    "page_json_deep": _with(R6) + f""",
        md AS (SELECT k, string_agg(repeat('#', CAST(d AS INT) + 1) || ' ' || title || CASE WHEN text <> '' THEN {NL2} || text ELSE '' END
          || CASE WHEN pic THEN {NL2} || '![](https://img.example.org/d/' || k || '/' || d || '.png)' ELSE '' END, {NL2} ORDER BY seq) AS m FROM dn GROUP BY k)
        SELECT dd.k AS page_id, CASE WHEN bad THEN 'bad_sections' END AS error, CASE WHEN NOT bad THEN '# Deep ' || dd.k || {NL2} || m END AS markdown
        FROM dd LEFT JOIN md USING (k)""",
    "page_json_deep_write": _with(R6) + """,
        own AS (SELECT *, '{"id":' || coalesce('"' || id || '"', 'null') || ',"title":"' || title || '","level":' || (d + 1) || ',"text":"' || text || '","media":['
          || CASE WHEN pic THEN '{"index":2,"image_url":"https://img.example.org/d/' || k || '/' || d || '.png","caption":null,"alt_text":null}' ELSE '' END
          || '],"subsections":[' AS j FROM dn),
        doc AS (SELECT k, string_agg(CASE WHEN seq <= depth THEN '' WHEN seq = depth + 1 THEN ']},' ELSE ']}]},' END || j, '' ORDER BY seq) || ']}]}' AS s FROM own GROUP BY k)
        SELECT k AS page_id, '{"url":"https://wiki.example.org/page/Deep_' || k || '","slug":"Deep_' || k || '","title":"Deep ' || k
          || '","intro_text":null,"infobox":[],"lead_figure":null,"sections":[' || s || '],"references":[],"links":[],"metadata":{"status_code":200,'
          || '"fetched_at_utc":"2026-01-01T00:00:00Z","canonical_url":null,"description":null,"keywords":null}}' AS json FROM doc""",
})

_NEW_CHILD = """'https://assets.example.org/sitemap-new.xml', (SELECT count(*) FROM ch WHERE nation <> 24) + 1"""
ORACLE.update({
    "sitemap_table": _with(R2) + f"""
        SELECT sitemap_url, sitemap_pos, loc_pos, page_url, 'https://wiki.example.org' || url_decode(regexp_extract(page_url, '^https://[^/]*(.*)$', 1)) AS key
        FROM m WHERE sitemap_url NOT LIKE '%sitemap-24.xml' UNION ALL SELECT {_NEW_CHILD}, NULL, NULL, NULL""",
    "sitemap_table_index": _with(R2) + f"""
        SELECT sitemap_url, sitemap_pos, 1::BIGINT AS loaded FROM ch WHERE nation <> 24 UNION ALL SELECT {_NEW_CHILD}, 2""",
    "sitemap_table_changes": ORACLE["sitemap_sync"],
    "stream_robots_gate": ORACLE["robots_gate"],
})
