"""Search jobs over fixture R4 (responses rendered from ``part``) and the
corpus keyword search over ``documents``."""

from __future__ import annotations

from folia.operators import search as SR
from folia.operators.shred import shred
from folia.plans.fixtures import r4_search_payloads
from folia.session import materialize, table

LIMIT = 5


def _html_hits(spark, sf_dir, answered=None):
    """Hits of the result pages; with ``answered``, of the other requests' pages alone: only these are tokenised."""
    _, html = r4_search_payloads(spark, sf_dir)
    html = html if answered is None else materialize(html.join(answered, SR.REQUEST, "left_anti"))
    hits = SR.html_hits(shred(html.select("page_id", "url", "html")), base_url=SR.SEARCH_BASE, path_prefix="/page/")
    return hits.join(html.select("page_id", *SR.REQUEST), "page_id").select(*SR.REQUEST, "pos", "page_url")


def search_api_hits(spark, sf_dir):
    api, _ = r4_search_payloads(spark, sf_dir)
    return SR.api_hits(api)[0]


def search_html_results(spark, sf_dir):
    return _html_hits(spark, sf_dir)


def _fallback(spark, sf_dir):
    api, _ = r4_search_payloads(spark, sf_dir)
    hits, valid = SR.api_hits(api)
    return SR.fallback(hits, valid, _html_hits(spark, sf_dir, valid))


def search_fallback(spark, sf_dir):
    return _fallback(spark, sf_dir)


def search_limit(spark, sf_dir):
    return SR.limit_results(_fallback(spark, sf_dir), LIMIT)


def search_payload_read(spark, sf_dir):
    """How each API answer was read: valid or not, and its number of hits."""
    api, _ = r4_search_payloads(spark, sf_dir)
    hits, valid = SR.api_hits(api)
    n = hits.groupBy(*SR.REQUEST).count()
    answers = api.select(*SR.REQUEST).join(valid.selectExpr(*SR.REQUEST, "true AS ok"), SR.REQUEST, "left").join(n, SR.REQUEST, "left")
    return answers.selectExpr(*SR.REQUEST, "coalesce(ok, false) AS valid", "coalesce(count, 0) AS n_hits")


def corpus_search(spark, sf_dir):
    """Keyword search of documents; the queries are the benchmark passages."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    queries = table(spark, sf_dir, "benchmark", "text").selectExpr("text AS query").where("query IS NOT NULL")
    return SR.corpus_search(docs, queries).selectExpr(
        "query", "doc_id", "CAST(rank AS BIGINT) AS rank", "n_terms", "tf"
    )
