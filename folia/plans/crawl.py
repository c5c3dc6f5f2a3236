"""Crawl jobs: response-log ingest and the gated page run (fixture R3)."""

from __future__ import annotations

from folia.operators import robots as RB
from folia.operators.extract import page_frame
from folia.operators.shred import shred
from folia.plans.fixtures import ROBOTS_AGENT, r3_responses, r3_robots_docs
from folia.session import materialize
from folia.sources import responses as RS


def response_ingest(spark, sf_dir):
    return RS.ingest(r3_responses(spark, sf_dir)).select("key", "page_id", "text")


def response_status(spark, sf_dir):
    return RS.status_counts(r3_responses(spark, sf_dir))


def crawl_pages(spark, sf_dir):
    """Responses -> newest ok page per URL key -> robots gate -> shred ->
    page heads.  The gate and the dedupe run before the Python stage:
    Catalyst cannot push filters through mapInArrow, so only pages that
    will be kept are ever parsed."""
    # The clean pages table is read by the gate and by the parse: written once.
    pages = materialize(RS.ingest(r3_responses(spark, sf_dir)).selectExpr("page_id", "url", "text AS html"))
    verdicts = RB.robots_gate(pages.select("page_id", "url"), r3_robots_docs(spark, sf_dir), ROBOTS_AGENT)
    allowed = pages.join(verdicts.where("verdict = 'allowed'").select("page_id"), "page_id", "left_semi")
    return page_frame(shred(allowed)).where("quarantine IS NULL").select("page_id", "url", "slug", "title", "intro_text")
