"""The registered queries: key -> (spark, sf_dir) -> DataFrame.

oracle in ``folia.plans.oracle`` unless noted there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folia.plans import crawl as CR
from folia.plans import edits as ED
from folia.plans import pages as PG
from folia.plans import robots as RB
from folia.plans import search as SE
from folia.plans import sitemaps as SMP
from folia.streaming import jobs as ST

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # pages table (oracle: regexes over the raw HTML)
        "page_heads": PG.page_heads,
        "pages_scan": PG.pages_scan,
        "shred": PG.shred_tags,
        "article_select": PG.article_select,
        "head_title": PG.head_title_pages,
        "page_title": PG.page_title,
        "page_intro": PG.page_intro,
        "page_slug": PG.page_slug,
        "blocks": PG.blocks,
        "url_canonical": PG.url_canonical,
        "url_dedupe": PG.url_dedupe,
        "url_origin": PG.url_origin,
        "robots_origins": PG.robots_origins,
        "search_html_hits": PG.nav_links,
        # plain table expressions
        "ws_normalize": PG.ws_normalize_docs,
        "title_slug": PG.title_slug,
        "slug_url": PG.slug_url,
        "unquote": PG.unquote_names,
        "day_page": PG.day_page,
        # fixture R1: wiki pages rendered from orders / lineitem / customer
        "parse_quarantine": PG.r1_quarantine,
        "head_title_r1": PG.r1_head_title,
        "head_description": PG.r1_head_description,
        "head_canonical": PG.r1_head_canonical,
        "head_keywords": PG.r1_keywords,
        "page_assemble": PG.r1_assemble,
        "link_edges": PG.r1_links,
        "infobox": PG.r1_infobox,
        "lead_figure": PG.r1_lead_figure,
        "sections": PG.r1_sections,
        "section_text": PG.r1_section_text,
        "references": PG.r1_references,
        "section_media": PG.r1_section_media,
        "payload_markdown": PG.r1_payload_markdown,
        "payload_media": PG.r1_payload_media,
        "page_stats": PG.r1_page_stats,
        "markdown_render": PG.r1_markdown,
        "page_json_write": PG.r1_json_write,
        "page_json_read": PG.r1_json_roundtrip,
        "page_json_deep": PG.r6_markdown,
        "page_json_deep_write": PG.r6_json_write,
        "page_outline": PG.r6_outline,
        "link_hosts": PG.r1_link_hosts,
        "infobox_labels": PG.r1_infobox_labels,
        "page_stats_rollup": PG.r1_stats_by_host,
        "html_nodes": PG.html_nodes_sql,
        # fixture R5: edit-history payloads rendered from events
        "edit_payload_read": ED.edit_payload_read,
        "edit_batches": ED.edit_batches,
        "edit_entries": ED.edit_entries,
        "edit_stitch": ED.edit_stitch,
        "edit_page": ED.edit_page,
        "edit_summary": ED.edit_summary,
        "edit_payload_write": ED.edit_payload_write,
        # fixture R3: crawl responses and robots.txt documents for the hosts of pages
        "response_ingest": CR.response_ingest,
        "response_status": CR.response_status,
        "crawl_pages": CR.crawl_pages,
        "robots_rules": RB.robots_rules,
        "robots_gate": RB.robots_gate,
        "robots_fail_closed": RB.robots_fail_closed,
        "robots_bypass": RB.robots_bypass,
        # fixture R4: search responses rendered from part
        "search_payload_read": SE.search_payload_read,
        "search_api_hits": SE.search_api_hits,
        "search_html_read": SE.search_html_results,
        "search_fallback": SE.search_fallback,
        "search_limit": SE.search_limit,
        # keyword search over documents
        "corpus_search": SE.corpus_search,
        # fixture R2: sitemaps rendered from customer
        "sitemap_locs": SMP.sitemap_locs,
        "sitemap_manifest": SMP.sitemap_manifest,
        "sitemap_index": SMP.sitemap_index,
        "sitemap_lookup": SMP.sitemap_lookup,
        "sitemap_sync": SMP.sitemap_sync,
        "sitemap_refresh": SMP.sitemap_refresh,
        "sitemap_table": SMP.sitemap_table,
        "sitemap_table_index": SMP.sitemap_table_index,
        "sitemap_table_changes": SMP.sitemap_table_changes,
        # Structured Streaming forms (run with availableNow, read back)
        "stream_pages": ST.stream_pages,
        "stream_url_dedupe": ST.stream_url_dedupe,
        "stream_edits_latest": ST.stream_edits_latest,
        "stream_robots_gate": ST.stream_robots_gate,
    }
    return q
