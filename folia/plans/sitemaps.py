"""Sitemap jobs over fixture R2 (sitemaps rendered from ``customer``)."""

from __future__ import annotations

from folia.operators import sitemaps as SM
from folia.operators.sitemap_table import SitemapTable
from folia.plans.fixtures import SITEMAP_INDEX, r2_sitemap_docs
from folia.session import scratch_folder, table

BASE = "https://wiki.example.org"


def sitemap_locs(spark, sf_dir):
    parsed = SM.sitemap_locs(r2_sitemap_docs(spark, sf_dir))
    good = parsed.where("error IS NULL").selectExpr(
        "sitemap_url", "posexplode(locs) AS (p, loc)"
    ).selectExpr("sitemap_url", "CAST(p + 1 AS BIGINT) AS loc_pos", "loc", "CAST(NULL AS STRING) AS error")
    bad = parsed.where("error IS NOT NULL").selectExpr(
        "sitemap_url", "CAST(NULL AS BIGINT) AS loc_pos", "CAST(NULL AS STRING) AS loc", "error"
    )
    return good.unionByName(bad)


def sitemap_manifest(spark, sf_dir):
    return SM.manifest(r2_sitemap_docs(spark, sf_dir), SITEMAP_INDEX)


def sitemap_index(spark, sf_dir):
    return SM.key_index(SM.manifest(r2_sitemap_docs(spark, sf_dir), SITEMAP_INDEX)).select("key", "sitemap_url", "page_url")


def sitemap_lookup(spark, sf_dir):
    """Every customer name as a title, plus one title per hundred that no
    sitemap lists."""
    names = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    titles = names.selectExpr("c_name AS title").unionByName(
        names.where("c_custkey % 100 = 0").selectExpr("concat(c_name, ' Missing') AS title")
    )
    index = SM.key_index(SM.manifest(r2_sitemap_docs(spark, sf_dir), SITEMAP_INDEX))
    return SM.lookup(titles, index, BASE)


def sitemap_sync(spark, sf_dir):
    return SM.sync(r2_sitemap_docs(spark, sf_dir), r2_sitemap_docs(spark, sf_dir, snapshot=2), SITEMAP_INDEX)


def sitemap_refresh(spark, sf_dir):
    return SM.refresh(r2_sitemap_docs(spark, sf_dir, snapshot=2), SITEMAP_INDEX)


def _loaded(spark, sf_dir):
    """A manifest table with both snapshots loaded, in a folder of this run."""
    made = SitemapTable(spark, scratch_folder(spark, "sitemaps"))
    for snapshot in (1, 2):
        made.load(r2_sitemap_docs(spark, sf_dir, snapshot=snapshot), SITEMAP_INDEX)
    return made


def sitemap_table(spark, sf_dir):
    """The manifest of the table's second version."""
    return _loaded(spark, sf_dir).manifest().select("sitemap_url", "sitemap_pos", "loc_pos", "page_url", "key")


def sitemap_table_index(spark, sf_dir):
    """In which version each listed child was read: unchanged ones not again."""
    return _loaded(spark, sf_dir).index().select("sitemap_url", "sitemap_pos", "loaded")


def sitemap_table_changes(spark, sf_dir):
    """From the first version to the second, computed on the table."""
    return _loaded(spark, sf_dir).changes(1, 2)
