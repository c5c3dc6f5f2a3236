"""folia: a PySpark engine for encyclopedia-style web page corpora.

Tables of raw HTML pages, sitemap and robots documents, search payloads and
edit-history payloads go in; structured Spark tables come out.  HTML is
tokenised once per page in a single Arrow stage (``operators.shred``); all
later work is DataFrame / SQL expressions planned by Catalyst.
"""

from folia.session import checkpoint_dir, get_session, table

__all__ = ["checkpoint_dir", "get_session", "table"]
