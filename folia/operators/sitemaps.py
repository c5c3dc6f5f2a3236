"""Sitemaps: loc extraction, manifest, canonical-key index, title lookup,
snapshot sync and refresh.

The reference loads child sitemaps lazily and keeps hash indexes in memory;
here the manifest is a table (sitemap_url, sitemap_pos, loc_pos, page_url)
and every lookup is a join on the canonical URL key.
"""

from __future__ import annotations

import sys
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import urls as U
from folia.session import materialize, ship_by_value

_SCHEMA = "sitemap_url string, locs array<string>, error string"


def read_locs(xml: str | None, piece: int = 1 << 16) -> tuple[list[str] | None, str | None]:
    """(locs, None) of a well-formed document, else (None, reason).

    The parser is fed in pieces, and an element is dropped where it ends: of
    a large document only the locs found are held, no tree.
    """
    if xml is None:
        return None, "no document"
    parser = ElementTree.XMLPullParser(events=("start", "end"))
    found: list[str | None] = []
    path: list = []  # open elements, a loc with its place in found
    try:
        for at in range(0, max(1, len(xml)), piece):
            parser.feed(xml[at : at + piece])
            _take(parser, path, found)
        parser.close()
        _take(parser, path, found)
    except (ElementTree.ParseError, ValueError):  # ValueError: characters XML cannot hold
        return None, "unparsable XML"
    return [loc for loc in dict.fromkeys(x.strip() for x in found if x) if loc], None


def _take(parser, path: list, found: list[str | None]) -> None:
    for event, node in parser.read_events():
        if event == "start":
            is_loc = bool(path) and isinstance(node.tag, str) and node.tag.rpartition("}")[2] == "loc"  # the root is none
            path.append((node, len(found) if is_loc else None))
            if is_loc:
                found.append(None)  # in document order, nested ones after their outer one
        else:
            node, place = path.pop()
            if place is not None:
                found[place] = node.text
            if path:
                path[-1][0].remove(node)


def _parse(batches):
    for batch in batches:
        parsed = [read_locs(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([locs for locs, _ in parsed], pa.list_(pa.string())), pa.array([e for _, e in parsed], pa.string())],
            names=["sitemap_url", "locs", "error"])


def sitemap_locs(docs: DataFrame) -> DataFrame:
    """(sitemap_url, xml) -> (sitemap_url, locs, error): every loc in any
    namespace, stripped, non-empty, unique in first-seen order.

    A real XML parser decides per document, in one Arrow stage: comments,
    processing instructions, a byte order mark, a document type or an empty
    root are fine; what is not well-formed is reported, and the job goes on.
    """
    return docs.selectExpr("CAST(sitemap_url AS STRING) AS sitemap_url", "regexp_replace(xml, '^\\uFEFF', '') AS xml").mapInArrow(_parse, _SCHEMA)


def manifest(docs: DataFrame, index_url: str) -> DataFrame:
    """Children of the index in order, each with its page URLs in order:
    (sitemap_url, sitemap_pos, loc_pos, page_url, error).

    A listed child with no document yet, or one that lists nothing, has a row
    with null loc_pos and page_url; a child or an index that cannot be parsed
    has such a row with its ``error`` (the index at position 0). Documents
    are parsed once, into a table that both sides of the join read."""
    parsed = materialize(sitemap_locs(docs))
    index = parsed.where(F.col("sitemap_url") == index_url)
    listed = index.selectExpr("posexplode(locs) AS (sitemap_pos, sitemap_url)")
    children = parsed.where(F.col("sitemap_url") != index_url).selectExpr("sitemap_url", "error", "posexplode_outer(locs) AS (loc_pos, page_url)")
    rows = listed.join(children, "sitemap_url", "left").selectExpr(
        "sitemap_url", "CAST(sitemap_pos + 1 AS BIGINT) AS sitemap_pos",
        "CAST(loc_pos + 1 AS BIGINT) AS loc_pos", "page_url", "error",
    )
    broken = index.where("error IS NOT NULL").selectExpr(
        "sitemap_url", "0L AS sitemap_pos", "CAST(NULL AS BIGINT) AS loc_pos", "CAST(NULL AS STRING) AS page_url", "error")
    return rows.unionByName(broken)


def key_index(man: DataFrame) -> DataFrame:
    """Canonical key -> spelling per owning sitemap (the last spelling inside
    one sitemap wins): (key, sitemap_url, sitemap_pos, page_url)."""
    keyed = man.where("page_url IS NOT NULL").selectExpr(
        "sitemap_url", "sitemap_pos", "loc_pos", "page_url", f"{U.url_canonical('page_url')} AS key"
    )
    return keyed.groupBy("key", "sitemap_url", "sitemap_pos").agg(F.max_by("page_url", "loc_pos").alias("page_url"))


def lookup(titles: DataFrame, index: DataFrame, base_url: str) -> DataFrame:
    """title -> slug -> page URL -> key -> the manifest's spelling from the
    first sitemap (index order) that lists the key; null when none does."""
    wanted = titles.selectExpr(
        "title", f"{U.slug_url(U.title_slug('title'), base_url)} AS url"
    ).selectExpr("title", f"{U.url_canonical('url')} AS key")
    best = index.groupBy("key").agg(F.min_by("page_url", "sitemap_pos").alias("page_url"))
    return wanted.join(best, "key", "left").select("title", "page_url")


def sync(old_docs: DataFrame, new_docs: DataFrame, index_url: str) -> DataFrame:
    """Apply a new index: (item, change) rows -- each child sitemap 'kept',
    'added' (listed, not loaded yet) or 'removed', and each canonical key
    lost because every sitemap that owned it was removed."""
    old_man = manifest(old_docs, index_url)
    new_list = sitemap_locs(new_docs).where(F.col("sitemap_url") == index_url).selectExpr("explode(locs) AS sitemap_url")
    old_list = old_man.select("sitemap_url").distinct()
    changes = old_list.withColumn("o", F.lit(True)).join(
        new_list.distinct().withColumn("n", F.lit(True)), "sitemap_url", "full_outer"
    ).selectExpr(
        "sitemap_url AS item",
        "CASE WHEN o AND n THEN 'kept' WHEN n THEN 'added' ELSE 'removed' END AS change",
    )
    owners = key_index(old_man).select("key", "sitemap_url")
    removed = changes.where("change = 'removed'").selectExpr("item AS sitemap_url")
    surviving = owners.join(removed, "sitemap_url", "left_anti").select("key")
    lost = owners.join(removed, "sitemap_url", "left_semi").select("key").distinct().join(surviving, "key", "left_anti")
    return changes.unionByName(lost.selectExpr("key AS item", "'key_lost' AS change"))


def refresh(new_docs: DataFrame, index_url: str) -> DataFrame:
    """Reset and reload the index only: every listed child maps to []."""
    listed = sitemap_locs(new_docs).where(F.col("sitemap_url") == index_url).selectExpr(
        "posexplode(locs) AS (sitemap_pos, sitemap_url)"
    )
    return listed.selectExpr("sitemap_url", "CAST(sitemap_pos + 1 AS BIGINT) AS sitemap_pos", "0L AS n_urls")


ship_by_value(sys.modules[__name__])
