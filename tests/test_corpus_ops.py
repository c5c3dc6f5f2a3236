"""Corpus operators on hand-made rows: robots, sitemaps, search, edits,
responses, streams."""

import collections
import datetime as dt
import inspect
import itertools
import json
import random
import re
import time
import tracemalloc
import urllib.robotparser
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from folia.functions.text import split_lines
from folia.functions.udtf import register
from folia.functions.urls import parse_base
from folia.operators import edits as E
from folia.operators import payload as P
from folia.operators import robots as RB
from folia.operators import search as SR
from folia.operators import sitemaps as SM
from folia.operators.sitemap_table import SitemapTable
from folia.operators.shred import shred
from folia.sources import responses as RS
from folia.streaming import jobs as ST
from folia.streaming.store import LatestStore

ORIGIN = "https://h.example"


def test_robots_gate_agrees_with_the_standard_library(spark):
    texts = [
        "", "User-agent: heronbot\nCrawl-delay: 9\n\nUser-agent: *\nDisallow: /\n", "User-agent: *\nDisallow: /a?\nDisallow: /b;\nDisallow: /c#\n",
        "user-agent: x\nUser-Agent: HERON # both\nallow: /a/b\ndisallow: /a\n\nUser-agent: *\nUser-agent: y\nDisallow: /b\nUser-agent: *\nDisallow: /\n",
        "Disallow: /a\nUser-agent: *\n\nDisallow: /b\nUser-agent: *\nDisallow:\nDisallow: /c\n", "User-agent: *\nDisallow: /%61/\nDisallow: /é\nRequest-rate: 1/2\nAllow: *\n",
        "User-agent: other\nDisallow: /\nUser-agent: heronbot/2\nDisallow: /c\r\nUser-agent: *\nDisallow: /b?x=1\n", "garbage\n:\nUser-agent *\nUser-agent: *\nDisallow: //a\n",
    ]
    paths = ["", "/", "/a", "/a/b", "/a?", "/ab?x", "/b", "/b;p", "/b?x=1&y", "/c", "/c#f", "/%C3%A9", "/d e"]
    docs = spark.createDataFrame([(f"{ORIGIN}{k}/robots.txt", 200, t) for k, t in enumerate(texts)], "robots_url string, status int, text string")
    grid = list(itertools.product(range(len(texts)), paths))
    urls = spark.createDataFrame([(n, f"{ORIGIN}{k}{p}") for n, (k, p) in enumerate(grid)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in RB.robots_gate(urls, docs, "HeronBot/1.0 it's").collect()}
    for rules in (0, 1):  # entries longer than that are decided by the prefix join
        assert got == {r.page_id: r.verdict for r in RB.robots_gate(urls, docs, "HeronBot/1.0 it's", row_rules=rules).collect()}
    for n, (k, p) in enumerate(grid):
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(texts[k].splitlines())
        assert got[n] == ("allowed" if parser.can_fetch("HeronBot/1.0 it's", f"{ORIGIN}{k}{p}") else "disallowed"), (texts[k], p)


def test_long_robots_files(spark):
    """Entries agree with the standard library on random line soup; 100,000 rules meet 20,000 URLs by prefix, the first match wins."""
    rng = random.Random(3)
    lines = ["", "# c", "User-agent: *", "User-agent: a", "User-agent: bot", "Disallow: /x", "Allow: /x/y", "Disallow:", "Crawl-delay: 3", "Sitemap: s", "nonsense", " "]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 40))) for _ in range(150)]
    docs = spark.createDataFrame([(f"{ORIGIN}{k}/robots.txt", 200, t) for k, t in enumerate(texts)], "robots_url string, status int, text string")
    got = {r.robots_url: [(list(e.agents), [(x.allow, x.prefix) for x in e.rules]) for e in r.entries] for r in RB.robots_entries(docs).collect()}
    for k, t in enumerate(texts):
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(t.splitlines())
        want = [([a.lower() for a in e.useragents], [(r.allowance, r.path) for r in e.rulelines]) for e in [*parser.entries, *([parser.default_entry] if parser.default_entry else [])]]
        assert sorted(([a.lower() for a in agents], rules) for agents, rules in got[f"{ORIGIN}{k}/robots.txt"]) == sorted(want), t
    rules = [(rng.random() < 0.5, f"/{rng.randrange(3000)}/{'p' * rng.randrange(9)}") for _ in range(100_000)]
    text = "User-agent: *\n" + "\n".join(f"{'Allow' if a else 'Disallow'}: {p}" for a, p in rules)
    docs = spark.createDataFrame([(f"{ORIGIN}/robots.txt", 200, text)], "robots_url string, status int, text string")
    urls = spark.createDataFrame([(k, f"{ORIGIN}/{rng.randrange(4000)}/{'p' * rng.randrange(12)}q") for k in range(20_000)] + [(-1, ORIGIN)], "page_id long, url string")
    first = {}
    for a, p in rules:
        first.setdefault(p, (len(first), a))
    for r in RB.robots_gate(urls, docs, "bot").join(urls.withColumnRenamed("url", "u"), "page_id").collect():
        path = r.u.removeprefix(ORIGIN)
        hit = min((first[path[:n]] for n in range(len(path) + 1) if path[:n] in first), default=(0, True))
        assert r.verdict == ("allowed" if hit[1] else "disallowed")


def test_robots_fail_closed(spark):
    docs = spark.createDataFrame([(f"{ORIGIN}/robots.txt", 404, "User-agent: *")], "robots_url string, status int, text string")
    urls = spark.createDataFrame([(1, f"{ORIGIN}/a"), (2, "https://none.example/"), (3, "no url")], "page_id long, url string")
    assert {r.verdict for r in RB.robots_gate(urls, docs, "b").collect()} == {"unavailable"}


def test_sitemap_manifest_reports_bad_documents(spark):
    child = lambda n: f"<urlset><url><loc>{n}</loc></url><url><loc> {n} </loc></url></urlset>"
    docs = [("i", "<?pi x?><sitemapindex xmlns='n'><sitemap><loc>c1</loc></sitemap><sitemap><loc>c2</loc></sitemap><sitemap><loc>c3</loc></sitemap></sitemapindex>"),
            ("c1", child("p1")), ("c2", "<urlset><url></urlset>"), ("j", "<broken")]
    df = spark.createDataFrame(docs, "sitemap_url string, xml string")
    rows = sorted(map(tuple, SM.manifest(df, "i").collect()))
    assert rows == [("c1", 1, 1, "p1", None), ("c2", 2, None, None, "unparsable XML"), ("c3", 3, None, None, None)]
    assert [tuple(r) for r in SM.manifest(df, "j").collect()] == [("j", 0, None, None, "unparsable XML")]


# ---- search

def test_large_sitemaps_need_no_tree():
    many = "<urlset xmlns='n'>" + "".join(f"<url><loc> https://x.example/{k} </loc><lastmod>2024</lastmod><i><a/><b>t</b></i></url>" for k in range(60_000)) + "</urlset>"
    tracemalloc.start()
    locs, error = SM.read_locs(many)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert error is None and locs[:2] == ["https://x.example/0", "https://x.example/1"] and len(locs) == 60_000
    assert held < 2.5 * sum(map(len, locs)) + (16 << 20)
    assert SM.read_locs(many[:-3]) == (None, "unparsable XML") and SM.read_locs("") == (None, "unparsable XML")
    for xml in ("<loc>a<loc>b</loc></loc>", "<r><loc>a<loc>b</loc>c</loc><x><loc/> <loc>a</loc></x></r>", "<!-- <loc>n</loc> --><r><n:loc xmlns:n='u'>é</n:loc></r>", "<r>&u;</r>"):
        try:
            root = ElementTree.fromstring(xml)
        except ElementTree.ParseError:
            assert SM.read_locs(xml, piece=3) == (None, "unparsable XML")
        else:
            assert SM.read_locs(xml, piece=3)[0] == list(dict.fromkeys(x.text.strip() for x in root.iterfind(".//{*}loc") if x.text and x.text.strip()))


def test_payload_headings_find_the_next_title(spark):
    """Title places by binary search: the next such title after the cursor, else the first; thousands of headings."""
    rng = random.Random(6)
    titles = [rng.choice("abcdef") for _ in range(40)]
    wanted, cursor = [], -1
    asked = [(rng.choice("abcdefg")) for _ in range(200)]
    for t in asked:
        at = [k for k, x in enumerate(titles) if x == t]
        hit = next((k for k in at if k > cursor), at[0] if at else -1)
        cursor = hit if hit >= 0 else cursor
        wanted.append(hit)
    head = "named_struct('level', 2, 'opens', true, 'sec', i + 1, 'title', t)"
    frame = spark.createDataFrame([(titles, "\n".join(f"## {t}\n![x{k}](http://i/{k})" for k, t in enumerate(asked)))], "titles array<string>, text string")
    frame = frame.selectExpr(f"transform(titles, (t, i) -> {head}) AS heads", "array(text) AS payloads").selectExpr("payloads", f"{P.section_titles()} AS secs", f"{parse_base(repr('http://h/'))} AS _base")
    hits = frame.selectExpr(f"{P.payload_hits()} AS h").first().h
    assert [(h.image_url, h.sec_no) for h in hits] == [(f"http://i/{k}", w + 1) for k, w in enumerate(wanted) if w >= 0]
    n = 4000
    big = spark.range(1).selectExpr(f"transform(sequence(0, {n - 1}), i -> named_struct('level', 2, 'opens', true, 'sec', i + 1, 'title', concat('t', i))) AS heads",
                                    f"array(array_join(transform(sequence(0, {n - 1}), i -> concat('## T', {n - 1} - i, '\\n![a](http://i/', i, ')')), '\\n')) AS payloads")
    began = time.time()
    hits = big.selectExpr("payloads", f"{P.section_titles()} AS secs", f"{parse_base(repr('http://h/'))} AS _base").selectExpr(f"{P.payload_hits()} AS h").first().h
    assert [h.sec_no for h in hits] == list(range(n, 0, -1)) and time.time() - began < 60


def test_fallback_for_errors_refusals_and_bad_payloads(spark):
    ok = json.dumps({"results": [{"slug": "Tern"}, {"slug": " "}, 5, {"slug": "tern"}, {"slug": "Tern"}]})
    api = [("a", 0, 200, False, ok), ("b", 0, 500, False, ok), ("c", 0, 200, True, ok), ("d", 0, 200, False, "<p>"), ("e", 0, 200, False, '{"results": []}'), ("a", 25, 200, False, '{"results": 1}')]
    hits, valid = SR.api_hits(spark.createDataFrame(api, "query string, offset long, status int, refused boolean, payload string"))
    html = spark.createDataFrame([(q, o, 1, f"html-{q}{o}") for q in "abcde" for o in (0, 25)], "query string, offset long, pos long, page_url string")
    got = sorted((r.query, r.offset, r.page_url) for r in SR.fallback(hits, valid, html).collect() if (r.query, r.offset) in {x[:2] for x in api})
    page = "https://wiki.example.org/page/"
    assert got == [("a", 0, page + "Tern"), ("a", 0, page + "tern"), ("a", 25, "html-a25"), ("b", 0, "html-b0"), ("c", 0, "html-c0"), ("d", 0, "html-d0")]


def test_html_hits_take_the_first_href_and_strip_it(spark):
    html = "<a href='' href=' /page/A?x' href='/page/B'></a><a href='\n/page/A#y'></a><a href='/other'></a><a href='//wiki.example.org/page/C'></a>"
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = SR.html_hits(shred(pages), base_url=SR.SEARCH_BASE).orderBy("pos").collect()
    assert [r.page_url for r in got] == ["https://wiki.example.org/page/A", "https://wiki.example.org/page/C"]


def ranked(docs, queries, limit, offset=0):
    """Plain keyword search: every document against every query."""
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = []
    for q in set(queries):
        terms = set(words(q))
        scored = []
        for i, text in docs:
            counts = collections.Counter(w for w in words(text) if w in terms)
            if counts:
                scored.append((-len(counts), -sum(counts.values()), i is None, i or 0))
        out += [(q, None if null else i, k + 1, -n, -tf) for k, (n, tf, null, i) in enumerate(sorted(scored)) if offset <= k < offset + limit]
    return sorted(out, key=str)


@pytest.mark.parametrize("limit, offset", [(25, 0), (5, 0), (1, 0), (3, 4), (0, 0)])
def test_corpus_search_is_the_full_ranking(spark, limit, offset):
    """Left-out frequent terms and the bound of the seeds lose no result."""
    rng = random.Random(limit + offset)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(400)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for k in range(150)] + [(None, "W1 w2, w3"), (7, "w1 w1"), (8, None), (9, "")]
    queries = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 20))) for _ in range(25)] + ["W1!", "w1", "", "?!", "unheard words", "w1 unheard"]
    got = SR.corpus_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(q,) for q in queries + [queries[0], None]], "query string"), limit, offset)
    assert sorted(map(tuple, got.select("query", "doc_id", "rank", "n_terms", "tf").collect()), key=str) == ranked(docs, queries, limit, offset)


def test_an_index_serves_many_searches(spark):
    docs = spark.createDataFrame([(k, "red " * (k % 5) + "blue") for k in range(40)] + [(None, "red red red red red blue"), (99, None)], "doc_id long, text string")
    index = SR.build_index(docs)
    assert index.count() == 41 + 33
    whole = SR.search_index(index, spark.createDataFrame([("Red, blue!",), ("red",), ("!",)], "query string"), limit=12).collect()
    split = [r for o in (0, 5, 10) for r in SR.search_index(index, spark.createDataFrame([("Red, blue!",), ("red",)], "query string"), limit=5, offset=o).collect()]
    assert sorted((r for r in split if r["rank"] <= 12), key=str) == sorted(whole, key=str)
    assert [r.doc_id for r in sorted(whole, key=lambda r: r["rank"]) if r.query == "red"][:4] == [None, 4, 9, 14]


# ---- edits

def entry(i, **more):
    return {"id": f"e{i}", "createdAt": 1_700_000_000 + i, "updatedAt": "2024-05-06T07:08:09.250Z"} | more


def batch(first, n, more=True, total=9, **fields):
    return json.dumps({"editRequests": [entry(first + k) for k in range(n)], "hasMore": more, "totalCount": total} | fields)


def parsed(spark, rows, extra=""):
    return E.parse_batches(spark.createDataFrame(rows, f"slug string, offset long, payload string{extra}"))


@pytest.mark.parametrize("changes, reason", [
    ({"upvote_count": None}, "bad_votes"), ({"upvoteCount": "abc"}, "bad_votes"), ({"downvoteCount": None}, "bad_votes"), ({"upvoteCount": " 12 "}, None),
    ({"upvoteCount": 2.9}, None), ({"createdAt": "12:30"}, "bad_time"), ({"createdAt": "2024"}, "bad_time"), ({"createdAt": "20240102T030405"}, None),
    ({"createdAt": None}, "bad_time"), ({"createdAt": "2024-01-02"}, None), ({"updatedAt": 10**15}, "bad_time"), ({"updatedAt": "2024-01-02 03:04+0530"}, None),
])
def test_entry_rules(spark, changes, reason):
    row = parsed(spark, [("s", 0, json.dumps({"editRequests": [entry(1, **changes)]}))])
    assert row.first().error == reason
    if reason is None and "upvoteCount" in changes:
        assert E.entries(row).first().upvote_count == int(float(changes["upvoteCount"]))


def test_stitching_follows_the_offset_chain(spark):
    rows = [("s", 0, batch(0, 3), 1), ("s", 0, batch(50, 3), 0), ("s", 2, batch(80, 2), 1), ("s", 3, batch(3, 3), 1), ("s", 6, batch(6, 3, False), 1), ("s", 9, batch(9, 1, False), 1),
            ("gap", 0, batch(0, 2), 1), ("gap", 5, batch(5, 2, False), 1), ("bad", 0, batch(0, 2), 1), ("bad", 2, "{", 1), ("bad", 4, batch(4, 5, False), 1)]
    batches = parsed(spark, rows, ", fetched_at long")
    got = {r.slug: r for r in E.stitch(batches).collect()}
    assert (got["s"].n_batches, got["s"].n_entries, got["s"].contiguous, got["s"].complete) == (3, 9, True, True)
    assert (got["gap"].n_entries, got["gap"].contiguous, got["gap"].complete) == (2, False, False)
    assert (got["bad"].n_batches, got["bad"].valid, got["bad"].complete) == (2, False, False)
    ids = [(r["rank"], r.id) for r in E.stitched_entries(batches).where("page_slug = 's'").orderBy("rank").collect()]
    assert ids == [(k + 1, f"e{k}") for k in range(9)]


def test_a_long_history_takes_few_rounds(spark, monkeypatch):
    """20,000 batches of one page in a number of rounds that grows with their logarithm."""
    rows = spark.range(20000).selectExpr("'long' AS slug", "id * 25 AS offset", "25L AS n", "500000L AS total_count", "id < 19999 AS has_more", "CAST(NULL AS STRING) AS error", "'' AS digest")
    other = spark.range(1000).selectExpr("CASE WHEN id % 3 > 0 THEN concat('p', id DIV 3) END AS slug", "id * 10 AS offset", "10L AS n", "7L AS total_count", "true AS has_more", "CAST(NULL AS STRING) AS error", "'' AS digest")
    written = []
    monkeypatch.setattr(E, "materialize", lambda df, f=E.materialize: written.append(1) or f(df))
    got = {r.slug: r for r in E.stitch(rows.unionByName(other).unionByName(rows)).collect()}
    assert (got["long"].n_batches, got["long"].n_entries, got["long"].complete) == (20000, 500000, True)
    assert got["p1"].n_batches == 2 and got["p1"].contiguous is False  # 40 and 50; nothing starts at 60
    assert got[None].n_batches == 1 and len(written) < 40


def test_equal_batches_are_read_once(spark):
    rows = [("s", 0, batch(0, 2))] * 3 + [("s", 2, batch(2, 1, False, 3)), ("s", 2, batch(2, 1, False, 3)), ("s", 2, batch(5, 1, False, 3)), (None, 0, batch(0, 1, False, 1))]
    batches = parsed(spark, rows)
    ids = sorted((r["rank"], r.id) for r in E.stitched_entries(batches).where("page_slug = 's'").collect())
    assert [k for k, _ in ids] == [1, 2, 3] and ids[2][1] in ("e2", "e5")
    assert E.stitched_entries(batches).where("page_slug IS NULL").count() == 1
    assert sorted(map(tuple, E.stitched_entries(batches.orderBy(F.desc("digest"))).select("rank", "id").collect())) == sorted(map(tuple, E.stitched_entries(batches).select("rank", "id").collect()))


def test_written_times_keep_fractions(spark):
    batches = parsed(spark, [("s", 0, batch(0, 1, False, 1))])
    doc = json.loads(E.write_batches(E.read_batches(batches)).first().json)
    assert doc["edit_requests"][0]["updated_at_utc"] == "2024-05-06T07:08:09.250000Z"
    assert doc["edit_requests"][0]["created_at_utc"] == "2023-11-14T22:13:20Z" and doc["has_more"] is False


# ---- responses

def test_bodies_never_fail_the_job(spark):
    bodies = [("utf-8", "é"), ("idna", "xn--"), ("undefined", "a"), ("base64", "a"), ("utf-16-le", "\u00e9"), ("x\0y", "a"), (None, "a")]
    rows = [(k, f"{ORIGIN}/{k}", 200, {"content-TYPE": f"text/html; charset={c}"} if c else None, bytearray(t.encode("utf-16-le" if c == "utf-16-le" else "utf-8"))) for k, (c, t) in enumerate(bodies)]
    rows += [(90, f"{ORIGIN}/0", None, None, None), (91, f"{ORIGIN}/0", 404, None, None), (92, f"{ORIGIN}/0", 502, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, status int, headers map<string,string>, body binary").selectExpr("*", "timestamp_seconds(page_id) AS fetched_at")
    assert {r.page_id: r.status_class for r in RS.decode_bodies(df).collect() if r.page_id > 50} == {90: "fetch_error", 91: "not_found", 92: "http_error"}
    got = {r.page_id: r.text for r in RS.ingest(df.unionByName(df.where("page_id = 0").selectExpr("8 AS page_id", "url", "status", "headers", "body", "timestamp_seconds(-1) AS fetched_at"))).collect()}
    assert sorted(got) == list(range(7)) and got[0] == got[4] == "é"
    twice = df.unionByName(df).unionByName(df.where("page_id = 0").withColumn("body", F.lit(bytearray(b"other"))))
    assert sorted(r.page_id for r in RS.ingest(twice).collect()) == list(range(7))


# ---- table function and streams

def test_html_nodes_gives_every_element(spark):
    register(spark)
    spark.createDataFrame([(5, "<div><p>a<em>b</em></p></div>"), (6, None)], "page_id long, html string").createOrReplaceTempView("docs_n")
    got = spark.sql("SELECT page_id, tag, parent_pos, text FROM html_nodes(TABLE(SELECT page_id, html FROM docs_n)) ORDER BY pos").collect()
    assert [tuple(r) for r in got] == [(5, "div", -1, None), (5, "p", 0, "ab"), (5, "em", 1, None)]


def test_streams_resume_and_equal_the_batch(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    folder = str(tmp_path / "events.parquet")
    add = lambda rows: spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.mode("append").parquet(folder)
    add([(1, day(1), 7, "a"), (2, day(3), 8, "b")])
    add([(3, day(2), 7, "c"), (4, day(3), 8, "d")])
    got = lambda: sorted((r.user_id, r.event_id) for r in ST.stream_edits_latest(spark, str(tmp_path)).collect())
    assert got() == [(7, 3), (8, 4)]
    add([(5, day(9), 9, "e"), (6, day(1), 8, "f")])
    assert got() == [(7, 3), (8, 4), (9, 5)]  # a new run reads the new file only, and keeps what it had
    urls = str(tmp_path / "pages.parquet")
    more = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(urls)
    more([(1, "https://A.example/x", ""), (2, "https://a.example/x?q", ""), (3, "https://a.example/y", "")])
    keys = lambda: sorted(r.key for r in ST.stream_url_dedupe(spark, str(tmp_path)).collect())
    assert keys() == ["https://a.example/x", "https://a.example/y"]
    more([(4, "https://a.example/x#f", ""), (5, "https://a.example/z", "")])
    assert keys() == ["https://a.example/x", "https://a.example/y", "https://a.example/z"]


# ---- tables and streams on disk

def xml(*locs):
    return "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in locs) + "</urlset>"


def partitions(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def test_sitemap_table_rewrites_what_changed(spark, tmp_path):
    docs = lambda **d: spark.createDataFrame([(k.replace("_", "/"), v) for k, v in d.items()], "sitemap_url string, xml string")
    t = SitemapTable(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        t.load(docs(s_i="<broken"), "s/i")
    assert t.versions() == [] and t.manifest().count() == 0
    t.load(docs(s_i=xml("s/a", "s/b", "s/c", "s/gone"), s_a=xml("http://x.example/1", "http://X.example/1?q"), s_b=xml("http://x.example/2"), s_gone=xml("http://x.example/3")), "s/i")
    first = partitions(tmp_path / "m" / "children")
    assert [(r.sitemap_url, r.sitemap_pos, r.loc_pos, r.page_url) for r in t.manifest().orderBy("sitemap_pos", "loc_pos").collect()] == [
        ("s/a", 1, 1, "http://x.example/1"), ("s/a", 1, 2, "http://X.example/1?q"), ("s/b", 2, 1, "http://x.example/2"), ("s/c", 3, None, None), ("s/gone", 4, 1, "http://x.example/3")]
    second = docs(s_i=xml("s/b", "s/a", "s/c", "s/new"), s_a=xml("http://x.example/1", "http://X.example/1?q"), s_b=xml("http://x.example/22"), s_c="<broken", s_new=xml())
    t.load(second, "s/i")
    after = partitions(tmp_path / "m" / "children")
    assert first.items() <= after.items()  # nothing old is touched
    assert len({k.rpartition("/")[0] for k in after.keys() - first.keys()}) == 3  # b, c and new; not a
    assert {r.sitemap_url: r.loaded for r in t.index().collect()} == {"s/b": 2, "s/a": 1, "s/c": 2, "s/new": 2}
    assert [(r.sitemap_url, r.page_url, r.error) for r in t.manifest().orderBy("sitemap_pos", "loc_pos").collect()] == [
        ("s/b", "http://x.example/22", None), ("s/a", "http://x.example/1", None), ("s/a", "http://X.example/1?q", None), ("s/c", None, "unparsable XML"), ("s/new", None, None)]
    assert t.manifest(1).count() == 5  # an earlier version stays readable
    assert {tuple(r) for r in t.changes(1, 2).collect()} == {("s/a", "kept"), ("s/b", "changed"), ("s/c", "changed"), ("s/new", "added"), ("s/gone", "removed"),
                                                            ("http://x.example/2", "key_lost"), ("http://x.example/3", "key_lost")}
    assert [r.page_url for r in t.key_index().orderBy("key").collect()] == ["http://X.example/1?q", "http://x.example/22"]
    t.load(docs(s_i=xml("s/a", "s/b")), "s/i")  # the index alone: children keep what was read
    assert t.manifest().where("page_url IS NOT NULL").count() == 3 and t.index().where("loaded < 3").count() == 2
    t.vacuum(keep=1)
    assert t.versions() == [3] and t.manifest().where("page_url IS NOT NULL").count() == 3
    assert len({k.rpartition("/")[0] for k in partitions(tmp_path / "m" / "children")}) == 2
    t.refresh(second, "s/i")
    assert [(r.sitemap_url, r.loaded) for r in t.index().orderBy("sitemap_pos").collect()] == [("s/b", None), ("s/a", None), ("s/c", None), ("s/new", None)]
    assert t.manifest().where("page_url IS NOT NULL").count() == 0


def test_store_grows_with_keys(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(40), k, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(5000)), "x") for k in range(600)]
    store = LatestStore(spark, str(tmp_path / "s"), ST._LATEST_T, "user_id", ["ts", "event_id"], buckets=4)
    assert store.read().count() == 0
    frame = lambda part: spark.createDataFrame(part, ST._LATEST_T)
    newest, sizes = {}, []
    for epoch in range(12):
        part = rows[epoch * 50 : epoch * 50 + 50]
        store.merge(frame(part), epoch)
        if epoch % 4 == 1:  # an epoch that is repeated after a failure
            store.merge(frame(part), epoch)
        for r in part:
            newest[r[0]] = max(newest.get(r[0], r), r, key=lambda x: (x[2], x[1]))
        assert sorted((r.user_id, r.event_id) for r in store.read().collect()) == sorted((r[0], r[1]) for r in newest.values())
        sizes.append(len(partitions(tmp_path / "s" / "rows")))
    assert max(sizes) <= 8  # two epochs of four buckets, however many went by
    one = rows[599][0]
    store.merge(frame([(one, 10_000, dt.datetime(2030, 1, 1), "y")]), 12)
    assert len(list((tmp_path / "s" / "rows" / "epoch=12").glob("bucket=*"))) == 1
    store.merge(frame([]), 13)
    assert {r.user_id: r.event_id for r in store.read().collect()}[one] == 10_000


def test_latest_edits_take_late_rows_and_restart(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    folder = str(tmp_path / "events.parquet")
    add = lambda rows: spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.mode("append").parquet(folder)
    got = lambda: sorted((r.user_id, r.event_id) for r in ST.stream_edits_latest(spark, str(tmp_path)).collect())
    add([(1, day(20), 1, "a"), (2, day(20), 2, "a")])
    assert got() == [(1, 1), (2, 2)] == got()  # a run without new files changes nothing
    add([(3, day(1), 1, "late"), (4, day(21), 2, "a"), (5, day(1), 3, "late")])
    assert got() == [(1, 1), (2, 4), (3, 5)]


def test_gate_stream_serves_in_time(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    far = at(100_000)
    robots = "User-agent: *\nDisallow: /no\n"
    # answers: one early, one that a page waits for, one too late; and one behind the watermark of its stream
    answers = [[("https://a.example/robots.txt", 200, robots, at(0)), ("https://b.example/robots.txt", 200, robots, at(65)), ("https://e.example/robots.txt", 503, None, at(60))],
               [("https://c.example/robots.txt", 200, robots, at(200)), ("https://clock/robots.txt", 200, "", far)], [("https://d.example/robots.txt", 200, robots, at(60))]]
    urls = [[(1, "https://a.example/no/x", at(10)), (2, "https://a.example/x", at(59)), (3, "https://a.example/x", at(61)), (4, "https://b.example/no", at(60)), (5, "https://c.example/x", at(60))],
            [(6, "https://d.example/x", at(60)), (7, "https://e.example/x", at(60)), (8, "https://clock/", far)], []]
    for k in range(3):
        for name, rows, schema in (("urls", urls[k], "page_id long, url string, asked_at timestamp"), ("robots", answers[k], "robots_url string, status int, text string, fetched_at timestamp")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        read = lambda name: spark.readStream.schema(spark.read.parquet(str(tmp_path / name)).schema).parquet(str(tmp_path / name))
        out = ST._run_to_sink(ST.gate_stream(read("urls"), read("robots"), "bot/1"), str(tmp_path / "work"))
    got = sorted((r.page_id, r.verdict) for r in out.collect())
    assert got == [(1, "disallowed"), (2, "allowed"), (3, "unavailable"), (4, "disallowed"), (5, "unavailable"), (6, "unavailable"), (7, "unavailable"), (8, "allowed")]


def test_links_end_at_the_parenthesis_that_closes_them(spark):
    def expected(rest):
        depth, before = 1, ""
        for i, c in enumerate(rest):
            depth += 0 if before == "\\" else {"(": 1, ")": -1}.get(c, 0)
            before = c
            if depth == 0:
                return rest[:i]
        return None

    rng = random.Random(3)
    texts = ["".join(rng.choices("ab()()\\é😀\n ", k=rng.randint(0, 12))) for _ in range(500)] + [")", "", "(", "\\)", "a\\\\)b)", "c_(1).png \"t\")"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"{P.link_of('t')} AS link").collect()
    assert [(r.t, r.link) for r in found] == [(t, expected(t)) for t in texts]
    assert "split(" not in P.link_of("t")  # no step for every character
    assert split_lines("t").count("split(") == 1  # lines are split once


def test_payloads_are_parsed_once(spark):
    batches = E.parse_batches(spark.range(3).selectExpr("concat('s', id) AS slug", "id AS offset", "concat('{\"editRequests\": [], \"totalCount\": ', id, '}') AS payload"))
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = E.entries(batches)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    assert len(re.findall(r"(?i)parse_?json\W", plan)) == 1
    time_of = E._entry("x")["created_at_utc"]
    assert time_of.count("'$.createdAt'") <= 2  # the value is looked up once, then bound


def test_index_tokens_are_sorted_natively(spark):
    docs = spark.createDataFrame([(1, "b a b ü"), (2, None), (3, " "), (None, "A")], "doc_id long, text string")
    rows = {(r.term, r.doc_id, r.tf) for r in SR.build_index(docs).collect()}
    assert rows == {("b", 1, 2), ("a", 1, 1), ("ü", 1, 1), ("a", None, 1)}
    assert "array_sort(tokens)" not in inspect.getsource(SR.build_index)  # its comparator runs as an interpreted lambda
