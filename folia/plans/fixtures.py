"""Rendered fixtures: documents built by Spark from the driver tables.

Each renderer writes documents with plain string expressions (it shares no
code with the extractors); the matching DuckDB oracle in ``folia.plans.oracle``
computes the expected rows straight from the source tables.

R1  wiki pages, one per order (its line items are the references)
R2  sitemap documents from ``customer``
R3  robots.txt documents for the hosts of ``pages``
R4  search payloads from ``part``
R5  edit-history payloads from ``events``
R6  page documents (JSON) with sections 3 to 50 levels deep, from ``customer``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.session import table

WIKI = "https://wiki.example.org"


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` into all of the session's shuffle partitions. Its
    rows are narrow and the documents made of them costly, so partitions sized
    by bytes would be too few to keep every core busy."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items grouped per order (TPC-H bounds an order's lines), sorted."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
               "l_extendedprice", "l_quantity")
    return _dealt(li, "l_orderkey").groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))
        ).alias("lines")
    )


R1_HTML = r"""concat(
 '<!DOCTYPE html><html><head><meta charset="utf-8">',
 CASE k % 3 WHEN 0 THEN concat('<title>Order ', k, '</title><meta property="og:title" content="Order ', k, ' og">')
            WHEN 1 THEN concat('<meta property="og:title" content="  Order ', k, '  og "><title>Order ', k, '</title>')
            ELSE '' END,
 CASE WHEN k % 2 = 0 THEN concat('<link rel="Canonical" href=" https://wiki.example.org/page/Order_', k, ' ">')
      ELSE concat('<meta property="og:url" content="https://wiki.example.org/page/Order_', k, '?via=og">') END,
 CASE WHEN k % 4 <> 3 THEN concat('<meta name="description" content="Order of  ', pr, '  priority">') ELSE '' END,
 CASE WHEN k % 11 <> 0 THEN concat('<meta name="Keywords" content="', st, ', , ', pr, '">') ELSE '' END,
 '</head><body><nav><a href="/page/Main_Page">Main</a></nav>',
 CASE WHEN k % 97 = 96 THEN '<div class="h-full w-full"><div class="text-[16px]">'
      ELSE '<article class="h-full w-full"><article class="text-[16px]">' END,
 CASE WHEN k % 13 <> 0 THEN concat('<h1>Order ', k, '<button>edit</button></h1>') ELSE '' END,
 '<p>Order  ', k, ' placed by <a href="/page/', replace(cname, '#', '%23'), '"> ', cname, ' </a>.</p>',
 '<dl><dt>Status</dt><dd>', st, '</dd><dd>ignored</dd><dt>Priority</dt><dd> ', pr, ' </dd>',
 '<dt>Clerk</dt><dt>Customer</dt><dd>', custkey, '</dd><dt></dt><dd>orphan</dd></dl>',
 '<figure><img src="/_next/image?url=%2Fimages%2Forder_', k, '.png%3Fv%3D1&amp;w=640" alt=" Order ', k, ' image ">',
 CASE WHEN k % 4 <> 0 THEN concat('<figcaption>Figure ', k, '</figcaption>') ELSE '' END, '</figure>',
 CASE WHEN k % 7 <> 0 THEN '<h2 id="overview">Overview</h2>' ELSE '' END,
 '<p>Status ', st, ' and priority ', pr, '.</p>',
 '<h3 id="details">Details</h3>',
 '<span data-tts-block="true">Line count ', size(lines), '.</span>',
 '<figure><img src="https://img.example.org/o/', k, '/a.png" alt="a"></figure>',
 '<figure><img src="https://img.example.org/o/', k, '/a.png" alt="dup"></figure>',
 '<figure><img srcset="https://img.example.org/o/', k, '/b.png 1x, https://img.example.org/o/', k, '/b2.png 2x">',
 '<figcaption>B ', k, '</figcaption></figure>',
 '<ul>', array_join(transform(lines, (l, i) -> concat('<li>Line ', l.l_linenumber, '</li>',
        CASE WHEN i = 0 THEN '<li> </li>' ELSE '' END)), ''), '</ul>',
 '<pre><code>\norder ', k, '\n  lines ', size(lines), '\n</code></pre>',
 '<blockquote>Quote ', k, '</blockquote>',
 '<h2>References</h2><ol>', CASE WHEN k % 5 = 0 THEN '<li></li>' ELSE '' END,
 array_join(transform(lines, l -> concat('<li><a href="/page/Supplier_', l.l_suppkey, '">Part ', l.l_partkey,
        '</a> qty ', CAST(l.l_quantity AS BIGINT), '</li>')), ''), '</ol>',
 '<ol><li>Extra ', k, ' <a href="https://ext.example.com/o/', k, '">src</a></li></ol>',
 CASE WHEN k % 97 = 96 THEN '</div></div>' ELSE '</article></article>' END,
 '<script>self.__next_f.push([1,"## Overview\\n![Chart ', k, '](https://img.example.org/o/', k,
 '/chart.png)\\n\\n*Chart ', k, '*\\n### Details\\n![again](https://img.example.org/o/', k,
 '/a.png)\\n![paren](https://img.example.org/o/', k, '/c_(1).png \\"t\\")"]);</script>',
 '</body></html>')"""


def r1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1: pages(page_id, url, html), one wiki page per order."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    named = orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
    src = (
        _dealt(named, "o_orderkey").join(_order_lines(spark, sf_dir), orders.o_orderkey == F.col("l_orderkey"), "left")
        .selectExpr(
            "o_orderkey AS k", "o_orderstatus AS st", "o_orderpriority AS pr", "c_name AS cname",
            "o_custkey AS custkey",
            "coalesce(lines, CAST(array() AS array<struct<l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,"
            "l_extendedprice:double,l_quantity:double>>)) AS lines",
        )
    )
    return src.selectExpr(
        "k AS page_id",
        f"concat('{WIKI}/page/Order_', k) AS url",
        f"{R1_HTML} AS html",
    )


# ---------------------------------------------------------------- R5

EDIT_BATCH = 25

_R5_ENTRY_CAMEL = """to_json(named_struct(
  'id', id, 'slug', slug, 'userId', user_id, 'status', status, 'type', event_type,
  'originalContent', '', 'proposedContent', props, 'sectionTitle', section_title,
  'createdAt', created, 'updatedAt', updated, 'upvoteCount', upvotes, 'reviewReason', CAST(NULL AS STRING)),
  map('ignoreNullFields', 'false'))"""

_R5_ENTRY_SNAKE = """to_json(named_struct(
  'id', id, 'slug', slug, 'user_id', user_id, 'status', status, 'type', event_type,
  'original_content', '', 'proposed_content', props, 'section_title', section_title,
  'created_at_utc', created, 'updated_at_utc', updated, 'upvote_count', upvotes))"""


def r5_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit entries derived from events, with their page position (newest first)."""
    from folia.operators.ranking import position_in_group

    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props").withColumn(
        "ts", F.col("ts").cast("timestamp")  # stored without zone; the session zone is UTC
    )
    ranked = position_in_group(
        ev, ["user_id"], F.to_date("ts"), -F.unix_date(F.to_date("ts")), [F.col("ts").desc(), F.col("event_id")]
    )
    # Even ids carry epoch seconds, odd ids an ISO string; created/updated a minute apart.
    return ranked.selectExpr(
        "concat('User_', user_id) AS slug", "user_id", "pos", "event_id AS id", "event_type", "props",
        "concat('EDIT_REQUEST_STATUS_', upper(event_type)) AS status",
        "CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS section_title",
        "CAST(floor(value) AS BIGINT) AS upvotes",
        "parse_json(CASE WHEN event_id % 2 = 0 THEN CAST(unix_seconds(ts) AS STRING) "
        "ELSE concat('\"', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"') END) AS created",
        "parse_json(CASE WHEN event_id % 2 = 0 THEN CAST(unix_seconds(ts) + 60 AS STRING) "
        "ELSE concat('\"', date_format(ts + INTERVAL 60 SECONDS, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"') END) AS updated",
    )


def r5_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5: edit-history payloads (slug, offset, payload): batches of 25 per
    user, camelCase keys in even batches and snake_case in odd ones, a stray
    batch after the last one, and two malformed payloads."""
    entries = r5_entries(spark, sf_dir).withColumn("batch", F.floor((F.col("pos") - 1) / EDIT_BATCH))
    totals = entries.groupBy("slug").agg(F.count(F.lit(1)).alias("total"))
    docs = entries.selectExpr(
        "slug", "batch", "pos",
        f"CASE WHEN batch % 2 = 0 THEN {_R5_ENTRY_CAMEL} ELSE {_R5_ENTRY_SNAKE} END AS doc",
    )
    batches = docs.groupBy("slug", "batch").agg(
        F.array_sort(F.collect_list(F.struct("pos", "doc"))).alias("items")
    ).join(totals, "slug")
    payloads = batches.selectExpr(
        "slug", f"CAST(batch * {EDIT_BATCH} AS BIGINT) AS offset",
        "CASE WHEN batch % 2 = 0 THEN concat('{\"editRequests\":[', array_join(transform(items, i -> i.doc), ','), "
        f"'],\"totalCount\":', total, ',\"hasMore\":', CASE WHEN (batch + 1) * {EDIT_BATCH} < total THEN 'true' ELSE 'false' END, '}}') "
        "ELSE concat('{\"edit_requests\":[', array_join(transform(items, i -> i.doc), ','), "
        f"'],\"total_count\":', total, ',\"has_more\":', CASE WHEN (batch + 1) * {EDIT_BATCH} < total THEN 'true' ELSE 'false' END, '}}') END AS payload",
    )
    newest = entries.where("pos = 1").selectExpr(
        "slug", "id + 1000000000 AS id", "user_id", "status", "event_type", "props", "section_title", "upvotes",
        "created", "updated",
    )
    stray = newest.join(totals, "slug").selectExpr(
        "slug", "CAST(total AS BIGINT) AS offset",
        f"concat('{{\"editRequests\":[', {_R5_ENTRY_CAMEL}, '],\"totalCount\":', total, ',\"hasMore\":false}}') AS payload",
    )
    bad = spark.createDataFrame(
        [("Bad_object", 0, '{"editRequests": {}, "totalCount": 1}'), ("Bad_array", 0, "[]")],
        "slug string, offset bigint, payload string",
    )
    return payloads.unionByName(stray).unionByName(bad)


# ---------------------------------------------------------------- R3

ROBOTS_AGENT = "corpusbot/1.0"

R3_TEXT = r"""CASE length(host) % 5
  WHEN 0 THEN 'User-agent: *\nDisallow: /fr/\nDisallow: /de/\n'
  WHEN 1 THEN '# site rules\nUser-agent: *\nAllow: /en/\nDisallow: /\n'
  WHEN 2 THEN 'User-agent: corpusbot\nDisallow: /en/9\nAllow: /\nDisallow: /es/\n\nUser-agent: *\nDisallow: /\n'
  WHEN 3 THEN 'User-agent: corpusbot\nCrawl-delay: 5\n\nUser-agent: *\nDisallow: /\n'
  ELSE 'User-agent: *\nDisallow: /en/1?\nDisallow: /de/2;\nDisallow: /es/#\n' END"""


def r3_robots_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3: one robots.txt response per origin of ``pages``:
    (robots_url, status, text); hosts whose length is a multiple of 7 answer 503."""
    from folia.functions import urls as U

    origins = (
        table(spark, sf_dir, "pages", "url")
        .selectExpr(f"{U.url_robots('url')} AS robots_url", f"{U.url_part('url', 'netloc')} AS host")
        .where("robots_url IS NOT NULL")
        .distinct()
    )
    return origins.selectExpr(
        "robots_url",
        "CASE WHEN length(host) % 7 = 0 THEN 503 ELSE 200 END AS status",
        f"{R3_TEXT} AS text",
    )


# ---------------------------------------------------------------- R4

SEARCH_PAGE = 25  # results per API request


def _r4_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts of each brand in key order, as successive result pages:
    (query, offset, rn within the page, p_partkey, slug). Positions are found
    without putting a brand into one task."""
    from folia.functions import urls as U
    from folia.operators.ranking import position_in_group

    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    slot = F.floor(F.col("p_partkey") / 100000)
    placed = position_in_group(parts, ["p_brand"], slot, slot, [F.col("p_partkey")])
    return placed.selectExpr(
        "p_brand AS query", f"CAST(floor((pos - 1) / {SEARCH_PAGE}) * {SEARCH_PAGE} AS BIGINT) AS offset",
        f"(pos - 1) % {SEARCH_PAGE} + 1 AS rn", "p_partkey",
        f"CASE WHEN p_partkey % 3 = 0 THEN concat({U.title_slug('p_name')}, ';v', p_partkey) "
        f"ELSE {U.title_slug('p_name')} END AS slug",
    )


def r4_search_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """R4: (api, html) search responses per request (brand query, offset).

    api(query, offset, status, refused, payload): JSON with ``results`` in
    key order, a blank slug for keys divisible by 50 and a bare number for
    keys divisible by 70; brands ending in 5 get an unparsable payload, in 0
    a valid empty one, in 3 status 500 with a valid body, in 4 a robots
    refusal. html(page_id, query, offset, url, html): result pages with
    '#section' duplicates, an off-site link, a non-/page/ link and, on the
    first hit, a repeated href with leading blanks.
    """
    res = _r4_results(spark, sf_dir)
    entries = res.selectExpr(
        "query", "offset", "rn",
        "CASE WHEN p_partkey % 70 = 0 THEN CAST(p_partkey AS STRING) "
        "WHEN p_partkey % 50 = 0 THEN '{\"slug\": \"   \"}' "
        "ELSE to_json(named_struct('slug', slug)) END AS item",
    )
    api = entries.groupBy("query", "offset").agg(F.array_sort(F.collect_list(F.struct("rn", "item"))).alias("items")).selectExpr(
        "query", "offset", "CASE WHEN endswith(query, '3') THEN 500 ELSE 200 END AS status", "endswith(query, '4') AS refused",
        "CASE WHEN endswith(query, '5') THEN '<html>temporarily unavailable</html>' "
        "WHEN endswith(query, '0') THEN '{\"results\": []}' "
        "ELSE concat('{\"results\": [', array_join(transform(items, i -> i.item), ', '), ']}') END AS payload",
    )
    links = res.where("p_partkey % 70 <> 0 AND p_partkey % 50 <> 0").selectExpr(
        "query", "offset", "rn",
        "concat('<li><a href=\"', CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE '' END, '/page/', slug, '\"', "
        "CASE WHEN p_partkey % 5 = 0 THEN ' href=\"/page/other\"' ELSE '' END, '>', slug, '</a> <a href=\"/page/', slug, '#section\">more</a></li>') AS li",
    )
    html = links.groupBy("query", "offset").agg(F.array_sort(F.collect_list(F.struct("rn", "li"))).alias("lis")).selectExpr(
        "CAST(regexp_extract(query, '([0-9]+)$', 1) AS BIGINT) * 1000000000 + offset AS page_id", "query", "offset",
        "concat('https://wiki.example.org/search?q=', url_encode(query), '&offset=', offset) AS url",
        "concat('<html><body><a href=\"https://other.example.org/page/X\">x</a><ul>', "
        "array_join(transform(lis, l -> l.li), ''), '</ul><a href=\"/about\">about</a></body></html>') AS html",
    )
    return api, html


# ---------------------------------------------------------------- R2

SITEMAP_BASE = "https://assets.example.org"
SITEMAP_INDEX = f"{SITEMAP_BASE}/sitemap-index.xml"
SITEMAP_MAX_URLS = 50_000  # the sitemap protocol's per-file limit


def _r2_locs(spark: SparkSession, sf_dir: str, drop_nation: int | None = None) -> DataFrame:
    """Child sitemap entries: (child, custkey, variant, loc).  Each customer is
    listed in its nation's child; keys divisible by 10 also in the next
    nation's child with a lower-case host; by 30 again in their own child
    with an upper-case host (last spelling wins); by 45 an exact repeat."""
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    path = "concat('/page/', replace(c_name, '#', '%23'))"
    own = cust.selectExpr("c_nationkey AS nation", "c_custkey", "0 AS variant", f"concat('https://Wiki.example.org', {path}) AS loc")
    upper = cust.where("c_custkey % 30 = 0").selectExpr(
        "c_nationkey AS nation", "c_custkey", "1 AS variant", f"concat('https://WIKI.EXAMPLE.ORG', {path}) AS loc"
    )
    repeat = cust.where("c_custkey % 45 = 0").selectExpr(
        "c_nationkey AS nation", "c_custkey", "2 AS variant", f"concat('https://Wiki.example.org', {path}) AS loc"
    )
    foreign = cust.where("c_custkey % 10 = 0").selectExpr(
        "(c_nationkey + 1) % 25 AS nation", "c_custkey", "3 AS variant", f"concat('https://wiki.example.org', {path}) AS loc"
    )
    locs = own.unionByName(upper).unionByName(repeat).unionByName(foreign)
    return locs if drop_nation is None else locs.where(F.col("nation") != drop_nation)


def r2_sitemap_docs(spark: SparkSession, sf_dir: str, snapshot: int = 1) -> DataFrame:
    """R2: sitemap documents (sitemap_url, xml): an index of one child per
    nation (split every 50,000 entries), namespaced child documents, and one
    malformed document.  Snapshot 2 drops nation 24 and adds an empty child."""
    from folia.operators.ranking import position_in_group

    locs = _r2_locs(spark, sf_dir, drop_nation=24 if snapshot == 2 else None)
    ranked = position_in_group(
        locs, ["nation"], F.floor(F.col("c_custkey") / 100000), F.floor(F.col("c_custkey") / 100000),
        [F.col("c_custkey"), F.col("variant")],
    ).withColumn("part", F.floor((F.col("pos") - 1) / SITEMAP_MAX_URLS))
    child_url = (
        f"CASE WHEN part = 0 THEN concat('{SITEMAP_BASE}/sitemap-', nation, '.xml') "
        f"ELSE concat('{SITEMAP_BASE}/sitemap-', nation, '-', part, '.xml') END"
    )
    children = ranked.groupBy("nation", "part").agg(
        F.array_sort(F.collect_list(F.struct("pos", "loc"))).alias("items")
    ).selectExpr(
        "nation", "part", f"{child_url} AS sitemap_url",
        "concat('<?xml version=\"1.0\" encoding=\"UTF-8\"?>"
        "<urlset xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\">', "
        "array_join(transform(items, i -> concat('<url><loc> ', i.loc, ' </loc></url>')), ''), '</urlset>') AS xml",
    )
    listed = children.select("nation", "part", "sitemap_url")
    if snapshot == 2:
        listed = listed.unionByName(
            spark.createDataFrame([(99, 0, f"{SITEMAP_BASE}/sitemap-new.xml")], "nation int, part long, sitemap_url string")
        )
    index = listed.agg(F.array_sort(F.collect_list(F.struct("nation", "part", "sitemap_url"))).alias("c")).selectExpr(
        f"'{SITEMAP_INDEX}' AS sitemap_url",
        "concat('<?xml version=\"1.0\"?><sitemapindex xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\">', "
        "array_join(transform(c, s -> concat('<sitemap><loc>', s.sitemap_url, '</loc></sitemap>')), ''), '</sitemapindex>') AS xml",
    )
    docs = index.unionByName(children.select("sitemap_url", "xml"))
    if snapshot == 2:
        docs = docs.unionByName(
            spark.createDataFrame([(f"{SITEMAP_BASE}/sitemap-new.xml", "<urlset></urlset>")], "sitemap_url string, xml string")
        )
    odd = spark.createDataFrame([(f"{SITEMAP_BASE}/sitemap-{name}.xml", xml) for name, xml in SITEMAP_ODD], "sitemap_url string, xml string")
    return docs.unionByName(odd)


# Documents the index does not list: what must parse, and what must not.
SITEMAP_ODD = [
    ("broken", "<urlset><url><loc>https://wiki.example.org/page/X"),
    ("mismatch", "<urlset><url><loc>a</loc></urlset>"),
    ("styled", '<?xml version="1.0"?><?xml-stylesheet type="text/xsl" href="s.xsl"?><urlset><url><loc>https://a.example/styled</loc></url></urlset>'),
    ("comments", "<!-- before --><urlset><!-- <loc>no</loc> --><url><loc> https://a.example/c </loc></url></urlset><!-- after -->"),
    ("bom", "\ufeff<urlset><url><loc>https://a.example/bom</loc></url></urlset>"),
    ("doctype", "<!DOCTYPE urlset><urlset><url><loc>https://a.example/&amp;d</loc></url></urlset>"),
    ("emptyroot", "<urlset/>"),
]


def r3_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3: a crawl-response log for ``pages``: (url, status, headers, body,
    fetched_at).  Keys ending in 3 answer 404, in 7 answer 503; the body is
    UTF-8 with a declared, missing or quoted-unknown charset, or Latin-1
    with a declared charset (by key modulo 4)."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return pages.selectExpr(
        "page_id", "url",
        "CASE WHEN page_id % 10 = 3 THEN 404 WHEN page_id % 10 = 7 THEN 503 ELSE 200 END AS status",
        "map('Content-Type', CASE page_id % 4 WHEN 0 THEN 'text/html; charset=utf-8' "
        "WHEN 1 THEN 'text/html; charset=ISO-8859-1' WHEN 2 THEN 'text/html' "
        "ELSE 'text/html; charset=\"x-unknown\"' END) AS headers",
        "CASE WHEN page_id % 4 IN (1, 3) THEN encode(html, 'ISO-8859-1') ELSE encode(html, 'UTF-8') END AS body",
        "TIMESTAMP'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, page_id) AS fetched_at",
    )


# ---------------------------------------------------------------- R6

#: A document whose sections nest ``3 + k % 48`` deep: on every level below the first, the section that
#: goes on is followed by a leaf. Every tenth document breaks a rule on its 40th (or last) level.
R6_JSON = """concat(
 '{"url":"https://wiki.example.org/page/Deep_', k, '","slug":"Deep_', k, '","title":"Deep ', k,
 '","intro_text":null,"infobox":[],"lead_figure":null,"sections":[',
 array_join(transform(sequence(1, depth), d -> concat('{"id":"s', d, '","title":"', name, ' ', d, '","level":', d + 1,
   CASE WHEN k % 10 = 0 AND d = least(40, depth) THEN ',"media":7'
        WHEN d % 7 = 0 THEN concat(',"media":[5,{"image_url":"https://img.example.org/d/', k, '/', d, '.png"}]') ELSE '' END,
   CASE WHEN d % 2 = 0 THEN concat(',"text":"Text ', d, '"') ELSE '' END, ',"subsections":[')), ''),
 array_join(transform(sequence(depth, 1, -1), d -> CASE WHEN d > 1
   THEN concat(']},{"title":"Leaf ', d, '","level":', d + 1, '}') ELSE ']}' END), ''),
 '],"references":[],"links":[],"metadata":{"status_code":200,"fetched_at_utc":"2026-01-01T00:00:00Z"}}')"""


def r6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6: documents (page_id, json)."""
    src = _dealt(table(spark, sf_dir, "customer", "c_custkey", "c_name"), "c_custkey").selectExpr("c_custkey AS k", "c_name AS name", "CAST(3 + c_custkey % 48 AS INT) AS depth")
    return src.selectExpr("k AS page_id", f"{R6_JSON} AS json")
