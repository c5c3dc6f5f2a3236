import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from folia.session import checkpoint_dir, get_session

    session = get_session("local[4]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session


@pytest.fixture(scope="session")
def records_of(spark):
    """(page_id, url, html) tuples -> {page_id: Page dict} through the full pipeline."""
    from folia.operators.assemble import corpus_frame, page_records
    from folia.operators.render import with_markdown

    def run(rows):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        recs = with_markdown(page_records(corpus_frame(pages)))
        return {r["page_id"]: r.asDict(recursive=True) for r in recs.collect()}

    return run
