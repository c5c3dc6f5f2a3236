"""Driver-style comparison of registered jobs with their DuckDB oracles on
sf0.001 (all keys when FOLIA_FULL_ORACLE=1, else one per job family)."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import _rows, connect

SF = "/root/testdata/sf0.001"
QUICK = ["page_heads", "shred", "search_html_hits", "day_page", "sections", "references", "payload_media",
         "edit_stitch", "robots_gate", "search_fallback", "sitemap_lookup", "response_ingest", "stream_edits_latest"]
KEYS = sorted(E.queries()) if os.environ.get("FOLIA_FULL_ORACLE") else QUICK


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return connect(SF)


@pytest.mark.parametrize("name", KEYS)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())
