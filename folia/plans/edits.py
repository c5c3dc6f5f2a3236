"""Edit-history jobs over fixture R5 (payloads rendered from ``events``)."""

from __future__ import annotations

from folia.operators import edits as E
from folia.plans.fixtures import r5_payloads


def _batches(spark, sf_dir):
    return E.parse_batches(r5_payloads(spark, sf_dir))


def edit_payload_read(spark, sf_dir):
    """How each payload was read: accepted, or quarantined with its reason."""
    read = E.parse_batches(r5_payloads(spark, sf_dir))
    return read.selectExpr("slug", "offset", "error IS NULL AS accepted", "error")


def edit_batches(spark, sf_dir):
    return E.parse_batches(r5_payloads(spark, sf_dir)).select("slug", "offset", "n", "total_count", "has_more", "error")


def edit_entries(spark, sf_dir):
    return E.entries(E.parse_batches(r5_payloads(spark, sf_dir)))


def edit_stitch(spark, sf_dir):
    return E.stitch(E.parse_batches(r5_payloads(spark, sf_dir)))


def edit_page(spark, sf_dir):
    """edit_history(limit=10, offset=5) for every page."""
    return E.page_slice(E.stitched_entries(_batches(spark, sf_dir)), limit=10, offset=5).select(
        "page_slug", "rank", "id"
    )


def edit_summary(spark, sf_dir):
    return E.summary(E.stitched_entries(_batches(spark, sf_dir)))


def edit_payload_write(spark, sf_dir):
    """The whole JSON document of every batch that is read."""
    return E.write_batches(E.read_batches(_batches(spark, sf_dir)))
