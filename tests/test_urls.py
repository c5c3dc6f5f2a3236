"""URL expressions against Python's urllib on a table of cases."""

from urllib.parse import quote, unquote, urljoin, urlparse

from pyspark.sql import functions as F

from folia.functions import urls as U

BASES = ["http://a/b/c/d;p?q", "https://Site.example/page/Foo?x=1#f", "http://a", ""]
REFS = ["g", "./g", "../g", "../../../g", "/g", "//h/g", "?y", "#s", "g?y#s", ";x", "", ".", "..",
        "HTTPS://Q/r", "mailto:a@b", "g/./h/../i", "/page/A%20B;v1", "x y+z%zz"]


def test_url_resolve_matches_urljoin(spark):
    rows = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(rows, "b string, r string")
    got = df.select("b", "r", F.expr(U.url_resolve("b", "r")).alias("j")).collect()
    for row in got:
        expected = urljoin(row.b, row.r) if row.b else row.r
        assert row.j == expected, (row.b, row.r)


def test_canonical_slug_quote_unquote(spark):
    urls = ["HTTP://Wiki.Example.org/page/Caf%C3%A9;p?q#f", "https://x/page/%27Salt,_Sea!%27_%C3%A0_la_carte", "https://x/a/b/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select(
        "u",
        F.expr(U.url_canonical("u")).alias("canon"),
        F.expr(U.page_slug("u")).alias("slug"),
        F.expr(U.quote_slug("u")).alias("q"),
        F.expr(U.unquote("u")).alias("uq"),
    ).collect()
    for row in got:
        p = urlparse(row.u)
        assert row.canon == f"{p.scheme.lower()}://{p.netloc.lower()}{unquote(p.path)}"
        path = p.path
        assert row.slug == (unquote(path[6:]) if path.startswith("/page/") else unquote(path.strip("/")))
        assert row.q == quote(row.u, safe="!$&'()*+,;=:@._~-")
        assert row.uq == unquote(row.u)


def test_title_slug_and_slug_url(spark):
    df = spark.createDataFrame([("  Salt,\tSea! ",), ('a "b" [c]',), ("   ",)], "t string")
    got = df.select(
        F.expr(U.title_slug("t")).alias("s"),
        F.expr(U.slug_url(U.title_slug("t"), "https://site.example/")).alias("url"),
    ).collect()
    assert got[0].s == "Salt,_Sea!"
    assert got[1].url == "https://site.example/page/a_%22b%22_%5Bc%5D"
    assert got[2].s is None and got[2].url is None
