"""Robots jobs over fixture R3 (robots.txt documents for the hosts of pages)."""

from __future__ import annotations

from folia.operators import robots as RB
from folia.plans.fixtures import ROBOTS_AGENT, r3_robots_docs
from folia.session import table


def _urls(spark, sf_dir):
    return table(spark, sf_dir, "pages", "page_id", "url")


def robots_rules(spark, sf_dir):
    return RB.robots_rules(r3_robots_docs(spark, sf_dir)).selectExpr(
        "robots_url", "CAST(entry_no AS BIGINT) AS entry_no", "is_default", "array_join(agents, ',') AS agents",
        "CAST(seq AS BIGINT) AS seq", "allow", "prefix",
    )


def robots_gate(spark, sf_dir):
    return RB.robots_gate(_urls(spark, sf_dir), r3_robots_docs(spark, sf_dir), ROBOTS_AGENT).select("page_id", "verdict")


def robots_fail_closed(spark, sf_dir):
    """Pages whose robots.txt is missing or failed: never fetched."""
    return (
        RB.robots_gate(_urls(spark, sf_dir), r3_robots_docs(spark, sf_dir), ROBOTS_AGENT)
        .where("verdict = 'unavailable'")
        .select("page_id", "url")
    )


def robots_bypass(spark, sf_dir):
    """respect_robots with allow_robots_override: no check is made."""
    return RB.robots_gate(
        _urls(spark, sf_dir), r3_robots_docs(spark, sf_dir), ROBOTS_AGENT, respect_robots=True, allow_override=True
    ).select("page_id", "verdict")
