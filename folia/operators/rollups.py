"""Corpus rollups over extracted page tables (keyed aggregations with
map-side partial aggregation; ``rollup`` for the host hierarchy)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import urls as U


def link_hosts(frame: DataFrame) -> DataFrame:
    """Out-links per target host: (host, n_links, n_pages)."""
    edges = frame.where("quarantine IS NULL").selectExpr("page_id", "explode(links) AS url")
    return edges.selectExpr("page_id", f"lower({U.url_part('url', 'netloc')}) AS host").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_links"), F.countDistinct("page_id").alias("n_pages")
    )


def infobox_labels(frame: DataFrame) -> DataFrame:
    """Infobox label frequencies: (label, n)."""
    return (
        frame.where("quarantine IS NULL")
        .selectExpr("explode(infobox) AS f")
        .groupBy(F.col("f.label").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stats_by_host(records: DataFrame, stats: DataFrame) -> DataFrame:
    """Page stats summed per (scheme, host) with rollup subtotals and a grand
    total (null keys mark the subtotal rows)."""
    hosts = records.selectExpr("page_id", f"{U.url_part('url', 'scheme')} AS scheme",
                               f"lower({U.url_part('url', 'netloc')}) AS host")
    return hosts.join(stats, "page_id").rollup("scheme", "host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n_references").alias("references"),
        F.sum("n_media").alias("media"),
        F.max("n_sections").alias("max_sections"),
    )
