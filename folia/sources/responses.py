"""Crawl-response logs -> clean page tables.

A response row is (url, status, headers, body BINARY, fetched_at).  Bodies are
decoded by the Content-Type charset (default UTF-8) as the reference does:
strictly, else with replacement characters; an unknown charset falls back to
UTF-8 with replacement.  UTF-8, Latin-1 and ASCII stay in the JVM; other
charsets use Python's codecs in an Arrow UDF on their own rows.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from folia.functions import urls as U
from folia.functions.sql import lit, lits
from folia.session import ship_by_value

HIGH_BYTES = r"[\x{80}-\x{ff}]"
CHARSET_PARAM = r'(?i)charset\s*=\s*"?([^";\s]+)'
REPLACEMENT = "\ufffd"

# Charset labels decoded in the JVM.
UTF8_LABELS = ["", "utf-8", "utf8"]
LATIN1_LABELS = ["iso-8859-1", "latin-1", "latin1", "iso8859-1", "l1"]
ASCII_LABELS = ["us-ascii", "ascii"]


def _decode(data: bytes, name: str) -> str:
    """Strictly, else with replacement characters; as UTF-8 with replacement
    where the codec is unknown, is none for text, or cannot replace."""
    for errors in ("strict", "replace"):
        try:
            return data.decode(name or "utf-8", errors)
        except UnicodeError:
            continue
        except (LookupError, ValueError):  # ValueError: no codec can have such a name
            break
    return data.decode("utf-8", "replace")


@pandas_udf(StringType())
def decode_like_python(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes -> text with Python's codecs (see ``_decode``)."""
    out = []
    for raw, name in zip(body, charset):
        if raw is None:
            out.append(None)
            continue
        out.append(_decode(bytes(raw), name))
    return pd.Series(out, dtype=object)


def classify(responses: DataFrame, page_requests: bool = True) -> DataFrame:
    """Adds status_class: fetch_error (no status came back), not_found (404 of
    a page request), http_error (other statuses from 400), ok."""
    missing = "WHEN status = 404 THEN 'not_found' " if page_requests else ""
    return responses.selectExpr("*", f"CASE WHEN status IS NULL THEN 'fetch_error' {missing}WHEN status >= 400 THEN 'http_error' ELSE 'ok' END AS status_class")


def decode_bodies(responses: DataFrame) -> DataFrame:
    """Adds charset, text and status_class.

    UTF-8 (invalid bytes -> U+FFFD), Latin-1 and ASCII are decoded with JVM
    expressions; every other declared charset goes through
    ``decode_like_python`` on its own branch, so the Arrow UDF only sees
    those rows.
    """
    # Header names are case-insensitive; a missing header means no charset.
    content_type = (
        "coalesce(try_element_at(map_values(map_filter(coalesce(headers, map()), "
        "(k, v) -> lower(k) = 'content-type')), 1), '')"
    )
    charset = f"lower(regexp_extract({content_type}, {lit(CHARSET_PARAM)}, 1))"
    tagged = classify(responses).selectExpr("*", f"{charset} AS charset")
    jvm = f"charset IN ({lits(UTF8_LABELS + LATIN1_LABELS + ASCII_LABELS)})"
    fast = tagged.where(jvm).selectExpr(
        "*",
        f"CASE WHEN charset IN ({lits(LATIN1_LABELS)}) THEN decode(body, 'ISO-8859-1') "
        f"WHEN charset IN ({lits(ASCII_LABELS)}) THEN regexp_replace(decode(body, 'ISO-8859-1'), "
        f"{lit(HIGH_BYTES)}, {lit(REPLACEMENT)}) "
        "ELSE make_valid_utf8(CAST(body AS STRING)) END AS text",
    )
    slow = tagged.where(f"NOT ({jvm})").withColumn("text", decode_like_python("body", "charset"))
    return fast.unionByName(slow)


def ingest(responses: DataFrame) -> DataFrame:
    """The newest ok response per canonical URL: (key, page_id, url, text,
    fetched_at).

    The winners are found on (key, fetched_at, page_id) alone, with map-side
    combine; bodies meet them in one semi-join (no shuffle of bodies where
    Spark can broadcast the winners) and only the winners' are decoded.
    Responses equal in all three columns are one: the body with the largest
    digest stays."""
    ok = classify(responses).where("status_class = 'ok'").drop("status_class").selectExpr("*", f"{U.url_canonical('url')} AS key")
    ok = ok.withColumn("digest", F.expr("coalesce(md5(body), '')"))
    each = ok.groupBy("key", "fetched_at", "page_id", "digest").agg(F.count("*").alias("n"))
    newest = each.groupBy("key").agg(F.max(F.struct("fetched_at", "page_id", "digest", "n")).alias("w")).selectExpr(
        "key AS k", "w.fetched_at AS at", "w.page_id AS id", "w.digest AS d", "w.n AS n")
    wins = F.col("key").eqNullSafe(F.col("k")) & F.col("fetched_at").eqNullSafe(F.col("at")) & F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d"))
    alone = ok.join(newest.where("n = 1"), wins, "left_semi")
    # rows repeated in the log: the only bodies that have to meet each other
    repeated = ok.join(newest.where("n > 1"), wins, "left_semi").dropDuplicates(["key"])
    kept = alone.unionByName(repeated).drop("digest")
    return decode_bodies(kept).select("key", "page_id", "url", "text", "fetched_at")


def status_counts(responses: DataFrame) -> DataFrame:
    return classify(responses.select("status")).groupBy("status_class").agg(F.count(F.lit(1)).alias("n"))


ship_by_value(sys.modules[__name__])
