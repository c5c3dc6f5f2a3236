"""``html_nodes``: the shred fold as a SQL table function, for SQL users.

    SELECT page_id, tag, text FROM html_nodes(TABLE(SELECT page_id, html FROM pages))

An Arrow table function over a table of (page_id, html): a call takes a batch
of pages and gives back the rows of every element of each.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark.sql.functions import arrow_udtf

from folia.operators.shred import shred_html
from folia.session import ship_by_value

RETURN_TYPE = "page_id long, pos int, end_pos int, parent_pos int, depth int, tag string, text string"
_TYPES = {"pos": pa.int32(), "end_pos": pa.int32(), "parent_pos": pa.int32(), "depth": pa.int32(), "tag": pa.string(), "text": pa.string()}


@arrow_udtf(returnType=RETURN_TYPE)
class HtmlNodes:
    def eval(self, pages: pa.RecordBatch):
        for page_id, html in zip(pages.column(0), pages.column(1)):
            nodes, _error = shred_html(html.as_py(), keep_all=True)
            columns = {name: pa.array([n[name] for n in nodes], kind) for name, kind in _TYPES.items()}
            yield pa.table({"page_id": pa.array([page_id.as_py()] * len(nodes), pa.int64()), **columns})


def register(spark) -> None:
    spark.udtf.register("html_nodes", HtmlNodes)


ship_by_value(sys.modules[__name__])
