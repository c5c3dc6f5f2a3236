"""Jobs over page corpora: the driver's ``pages`` table and fixture R1.

Every function takes (spark, sf_dir) and returns a DataFrame whose columns
match the oracle SQL in ``folia.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import nodes as N
from folia.functions import urls as U
from folia.functions.text import ws_normalize
from folia.operators import assemble as A
from folia.operators import payload as P
from folia.operators import render as R
from folia.operators import sections as S
from folia.operators.extract import page_frame
from folia.operators.shred import shred
from folia.plans.fixtures import r1_pages, r6_documents
from folia.session import materialize, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "url", "html")


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_frame(shred(_pages(spark, sf_dir)))


def _r1(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return A.corpus_frame(r1_pages(spark, sf_dir), *columns)


def _r1_records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return A.page_records(_r1(spark, sf_dir, *(columns or A.RECORD_COLUMNS)))


# ---------------------------------------------------------------- pages (P)

def page_heads(spark, sf_dir):
    """Flagship: one row per page with url, slug, title and intro."""
    return _frame(spark, sf_dir).where("quarantine IS NULL").select("page_id", "url", "slug", "title", "intro_text")


def pages_scan(spark, sf_dir):
    return _frame(spark, sf_dir).select("page_id", "url")


def shred_tags(spark, sf_dir):
    """Element counts per page and tag, every element of the page."""
    counted = shred(_pages(spark, sf_dir), keep_all=True).selectExpr(
        "page_id",
        "transform(array_distinct(transform(nodes, n -> n.tag)), "
        "t -> named_struct('tag', t, 'n', size(filter(nodes, n -> n.tag = t)))) AS counts",
    )
    return counted.selectExpr("page_id", "inline(counts)").selectExpr("page_id", "tag", "CAST(n AS BIGINT) AS n")


def article_select(spark, sf_dir):
    return shred(_pages(spark, sf_dir)).selectExpr("page_id", "nodes").selectExpr(
        "page_id",
        "CAST(size(filter(nodes, n -> n.tag = 'article')) AS BIGINT) AS n_articles",
        f"coalesce(try_element_at({N.select_article()}.attrs, 'class'), '') AS article_class",
    )


def head_title_pages(spark, sf_dir):
    return _frame(spark, sf_dir).select("page_id", "head_title")


def page_title(spark, sf_dir):
    return _frame(spark, sf_dir).select("page_id", "title")


def page_intro(spark, sf_dir):
    return _frame(spark, sf_dir).select("page_id", "intro_text")


def page_slug(spark, sf_dir):
    return _frame(spark, sf_dir).select("page_id", "slug")


def blocks(spark, sf_dir):
    """Article blocks of every page: kind, level and text (figures: image)."""
    return S.block_rows(_frame(spark, sf_dir)).selectExpr(
        "page_id", "CAST(bno + 1 AS BIGINT) AS seq", "kind", "level", "text"
    )


def url_canonical(spark, sf_dir):
    return _pages(spark, sf_dir).selectExpr("page_id", f"{U.url_canonical('url')} AS key")


def url_dedupe(spark, sf_dir):
    """One row per canonical key: the first page (lowest page_id) and the count."""
    keyed = _pages(spark, sf_dir).selectExpr("page_id", "url", f"{U.url_canonical('url')} AS key")
    return keyed.groupBy("key").agg(
        F.min_by("url", "page_id").alias("url"), F.min("page_id").alias("page_id"), F.count("*").alias("n")
    )


def url_origin(spark, sf_dir):
    return _pages(spark, sf_dir).selectExpr("page_id", f"{U.url_robots('url')} AS robots_url")


def robots_origins(spark, sf_dir):
    """The robots.txt work list: one fetch per origin."""
    return (
        _pages(spark, sf_dir)
        .selectExpr(f"{U.url_robots('url')} AS robots_url")
        .groupBy("robots_url")
        .agg(F.count("*").alias("n_pages"))
    )


def nav_links(spark, sf_dir):
    """search_html_hits over the corpus: every a[href] of the whole document,
    resolved against the page URL, same host, query and fragment dropped,
    unique per page in first-seen order."""
    from folia.operators.search import html_hits

    sh = shred(_pages(spark, sf_dir))
    return html_hits(sh, base_col="url", path_prefix="/")


def ws_normalize_docs(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").selectExpr(
        "doc_id", f"{ws_normalize('text')} AS text_norm"
    )


def title_slug(spark, sf_dir):
    return table(spark, sf_dir, "part", "p_partkey", "p_name").selectExpr(
        "p_partkey", f"{U.title_slug('p_name')} AS slug"
    )


def slug_url(spark, sf_dir):
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").selectExpr(
        "c_custkey", f"{U.slug_url(U.title_slug('c_name'), 'https://wiki.example.org')} AS url"
    )


def unquote_names(spark, sf_dir):
    """Percent-decoding round trip of customer page URLs, '+' kept."""
    quoted = U.quote_slug("concat(c_name, ' +x')")
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").selectExpr(
        "c_custkey", f"{U.unquote(quoted)} AS decoded"
    )


def day_page(spark, sf_dir):
    """Date -> 'Month_D' title -> page URL, per order date."""
    days = table(spark, sf_dir, "orders", "o_orderdate").groupBy(
        F.to_date("o_orderdate").alias("day")
    ).agg(F.count("*").alias("n_orders"))
    url = U.slug_url("date_format(day, 'MMMM_d')", "https://wiki.example.org")
    return days.selectExpr("day", "date_format(day, 'MMMM_d') AS title", f"{url} AS url", "n_orders")


# ---------------------------------------------------------------- R1 pages

def r1_quarantine(spark, sf_dir):
    return _r1(spark, sf_dir, "title").where("quarantine IS NOT NULL").selectExpr("page_id", "quarantine AS reason")


def r1_head_title(spark, sf_dir):
    return _r1(spark, sf_dir, "head_title").where("quarantine IS NULL").select("page_id", "head_title")


def r1_head_description(spark, sf_dir):
    return _r1(spark, sf_dir, "description").where("quarantine IS NULL").select("page_id", "description")


def r1_head_canonical(spark, sf_dir):
    return _r1(spark, sf_dir, "canonical_url").where("quarantine IS NULL").select("page_id", "canonical_url")


def r1_keywords(spark, sf_dir):
    return _r1(spark, sf_dir, "keywords").where("quarantine IS NULL").selectExpr(
        "page_id", "posexplode(keywords) AS (pos, keyword)"
    ).selectExpr("page_id", "CAST(pos + 1 AS BIGINT) AS pos", "keyword")


def r1_assemble(spark, sf_dir):
    """The whole record: its nested fields as JSON, so that all of it is compared."""
    nested = ["infobox", "lead_figure", "sections", "references", "links"]
    return _r1_records(spark, sf_dir).selectExpr(
        "page_id", "url", "slug", "title", "intro_text",
        *[f"to_json({c}, map('ignoreNullFields', 'false')) AS {c}" for c in nested],
        "metadata.status_code AS status_code", "metadata.canonical_url AS canonical_url", "metadata.description AS description",
        "to_json(metadata.keywords) AS keywords",
    )


def r1_links(spark, sf_dir):
    return _r1(spark, sf_dir, "links").where("quarantine IS NULL").selectExpr(
        "page_id", "posexplode(links) AS (pos, url)"
    ).selectExpr("page_id", "CAST(pos + 1 AS BIGINT) AS seq", "url")


def r1_infobox(spark, sf_dir):
    return _r1(spark, sf_dir, "infobox").where("quarantine IS NULL").selectExpr(
        "page_id", "posexplode(infobox) AS (pos, f)"
    ).selectExpr("page_id", "CAST(pos + 1 AS BIGINT) AS seq", "f.label AS label", "f.value AS value")


def r1_lead_figure(spark, sf_dir):
    return _r1(spark, sf_dir, "lead_figure").where("quarantine IS NULL").selectExpr(
        "page_id", "lead_figure.image_url AS image_url", "lead_figure.caption AS caption",
        "lead_figure.alt_text AS alt_text",
    )


def r1_sections(spark, sf_dir):
    return S.target_rows(_r1_records(spark, sf_dir, "sections")).select("page_id", "sec_no", "sub_no", "level", "id", "title")


def r1_section_text(spark, sf_dir):
    return S.target_rows(_r1_records(spark, sf_dir, "sections")).select("page_id", "sec_no", "sub_no", "text")


def r1_references(spark, sf_dir):
    # the outer form: Spark would otherwise test the size in a filter and build the references twice
    return _r1_records(spark, sf_dir, "references").selectExpr("page_id", "inline_outer(references)").where("index IS NOT NULL").selectExpr(
        "page_id", "CAST(index AS BIGINT) AS index", "text", "url"
    )


def r1_section_media(spark, sf_dir):
    return S.target_rows(_r1_records(spark, sf_dir, "sections")).selectExpr("page_id", "sec_no", "sub_no", "inline(media)").selectExpr(
        "page_id", "sec_no", "sub_no", "CAST(index AS BIGINT) AS index", "image_url", "caption", "alt_text"
    )


def r1_payload_markdown(spark, sf_dir):
    return P.payloads(_r1(spark, sf_dir, "payloads")).selectExpr("page_id", "CAST(pno + 1 AS BIGINT) AS pno", "payload")


def r1_payload_media(spark, sf_dir):
    return P.payload_media(_r1(spark, sf_dir, "hits")).selectExpr(
        "page_id", "CAST(sec_no AS BIGINT) AS sec_no", "CAST(sub_no AS BIGINT) AS sub_no",
        "image_url", "caption", "alt_text",
    )


def r1_page_stats(spark, sf_dir):
    return A.page_stats(_r1_records(spark, sf_dir, "sections", "references", "keywords")).selectExpr(
        "page_id", "CAST(n_sections AS BIGINT) AS n_sections", "CAST(n_references AS BIGINT) AS n_references",
        "CAST(n_media AS BIGINT) AS n_media", "CAST(n_keywords AS BIGINT) AS n_keywords",
    )


def r1_markdown(spark, sf_dir):
    return R.with_markdown(_r1_records(spark, sf_dir)).select("page_id", "markdown")


def r1_json_roundtrip(spark, sf_dir):
    """page_json_write -> page_json_read -> markdown must equal the original."""
    from folia.sources import pagejson as J

    written = materialize(J.page_json_write(_r1_records(spark, sf_dir)))  # documents in a store, as a reader finds them
    back = J.page_json_read(written.selectExpr("page_id", "json"))
    return R.with_markdown(back.where("error IS NULL")).select("page_id", "markdown")


def r1_json_write(spark, sf_dir):
    """The whole JSON document of every page."""
    from folia.sources import pagejson as J

    return J.page_json_write(_r1_records(spark, sf_dir))


# ---------------------------------------------------------------- R6 documents

def r6_markdown(spark, sf_dir):
    """Documents with sections of any depth: their Markdown, or why they are rejected."""
    from folia.sources import pagejson as J

    return R.with_markdown(J.page_json_read(r6_documents(spark, sf_dir))).select("page_id", "error", "markdown")


def r6_outline(spark, sf_dir):
    """All their sections in document order."""
    from folia.operators.outline import outline_rows
    from folia.sources import pagejson as J

    records = J.page_json_read(r6_documents(spark, sf_dir)).where("error IS NULL")
    return outline_rows(records).selectExpr("page_id", "seq", "depth", "id", "title", "CAST(level AS BIGINT) AS level", "text", "CAST(size(media) AS BIGINT) AS n_media")


def r6_json_write(spark, sf_dir):
    """The accepted documents, written again with every field."""
    from folia.sources import pagejson as J

    return J.page_json_write(J.page_json_read(r6_documents(spark, sf_dir)).where("error IS NULL"))


# ---------------------------------------------------------------- rollups

def r1_link_hosts(spark, sf_dir):
    from folia.operators.rollups import link_hosts

    return link_hosts(_r1(spark, sf_dir, "links"))


def r1_infobox_labels(spark, sf_dir):
    from folia.operators.rollups import infobox_labels

    return infobox_labels(_r1(spark, sf_dir, "infobox"))


def r1_stats_by_host(spark, sf_dir):
    from folia.operators.rollups import stats_by_host

    counted = materialize(A.page_stats(_r1_records(spark, sf_dir, "url", "sections", "references", "keywords"), "url"))  # pages are parsed once for both sides
    return stats_by_host(counted, counted.drop("url"))


def html_nodes_sql(spark, sf_dir):
    """Tag counts through the SQL table function."""
    from folia.functions.udtf import register

    register(spark)
    _pages(spark, sf_dir).createOrReplaceTempView("folia_pages")
    return spark.sql(
        "SELECT page_id, tag, count(*) AS n FROM html_nodes(TABLE(SELECT page_id, html FROM folia_pages)) GROUP BY page_id, tag"
    )
