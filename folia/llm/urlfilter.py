"""URL filter: rules first, then a list of canonical URLs.

The list is a table of any size. A blocked Bloom filter of its keys passes
possible hits on to an exact hash join, which removes the false positives, so
only a sliver of the URLs is ever shuffled. The filter is built with SQL
aggregates: a key picks one 256-bit block by its hash and sets eight bits in
it, and ``bit_or`` merges the keys of a block. Its size is bounded: at most
MAX_BLOCKS rows of 40 bytes (about 10 MB), which is what makes the broadcast
safe; a longer list only lets more possible hits through to the exact join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged

MAX_BLOCKS = 1 << 18
KEYS_PER_BLOCK = 16
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"://([^/?#]*)([^?#]*)(\?[^#]*)?"

#: Rules of the registered query: (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: The registered query lists the URLs of pages with at most this many characters of HTML.
THIN = 1200


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _AZ, _az)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a default port, path without closing slashes, and the query without
    ``utm_`` parameters; no scheme, no fragment. Empty if there is no ``://``."""
    query = F.array_join(F.filter(F.split(F.substring(F.coalesce(F.regexp_extract(url, _URL, 3), F.lit("")), 2, 1 << 30), "&"),
                                  lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.concat(F.regexp_replace(host(url), ":(80|443)$", ""), F.regexp_replace(path(url), "/+$", ""),
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def rule_of(h: Column, p: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A tie in length goes to the first given."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first, as the outermost
        rh, _, rp = text.partition("/")
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith("/" + rp)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit(1))
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int"))
    return [one(2 * w).bitwiseOR(one(2 * w + 1)) for w in range(4)]


def bloom(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(key) -> (block, w0..w3), at most ``n_blocks`` rows."""
    k = keys.select(F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("block"), *[m.alias(f"m{w}") for w, m in enumerate(_masks(F.col("key")))])
    return k.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(4)])


def possibly_in(rows: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """``rows`` plus ``maybe``: false only where ``key`` is not among the
    distinct ``keys`` (key). The filter is broadcast; it has at most
    MAX_BLOCKS rows of 40 bytes whatever the number of keys."""
    wanted, n_blocks = keys.count() // KEYS_PER_BLOCK + 1, 1
    while n_blocks < min(wanted, MAX_BLOCKS):
        n_blocks *= 2
    columns = rows.columns
    u = rows.withColumn("__block", F.pmod(F.xxhash64(key), F.lit(n_blocks)))
    u = u.join(F.broadcast(bloom(keys, n_blocks).withColumnRenamed("block", "__block")), "__block", "left")
    maybe = F.lit(True)
    for w, m in enumerate(_masks(key)):
        maybe = maybe & (F.col(f"w{w}").bitwiseAND(m) == m)
    return u.select(*columns, F.coalesce(maybe, F.lit(False)).alias("maybe"))


def judge(urls: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES, *,
          id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """Verdict of every URL: (page_id, host, path, rule, verdict, key, is_listed).

    The longest fitting rule decides; where none fits, a URL whose canonical
    form is listed is blocked and any other allowed. A null URL, or one
    without ``://``, has empty host, path and key, fits no rule and is
    allowed: the empty key is never listed. Every input row gives one row,
    repeated rows included; an empty list blocks nothing. Other columns are
    not read. A URL that holds a third of all rows is split by AQE's skew
    join: the list's keys are distinct.
    """
    keys = staged(listed.select(canonical(F.col(listed_col)).alias("key")).where("key != ''").distinct())
    u = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("__u"))
    u = u.select("page_id", host(F.col("__u")).alias("host"), path(F.col("__u")).alias("path"), canonical(F.col("__u")).alias("key"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    u = possibly_in(u.select("*", rule.alias("rule"), verdict.alias("said")), keys, F.col("key")).withColumn("maybe", F.col("maybe") & (F.col("key") != ""))
    hits = keys.withColumn("is_listed", F.lit(True))
    checked = u.where("maybe").join(hits, "key", "left").select("page_id", "host", "path", "key", "rule", "said", F.coalesce("is_listed", F.lit(False)).alias("is_listed"))
    passed = u.where("NOT maybe").select("page_id", "host", "path", "key", "rule", "said", F.lit(False).alias("is_listed"))
    out = passed.unionByName(checked)
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("said", F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"), "key", "is_listed")


def op2_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the fixed rules and the list of thin pages:
    the canonical URLs under which at most THIN characters of HTML came back."""
    pages = documents(spark, sf_dir, "pages")
    thin = pages.where(F.length("html") <= THIN).select("url")
    return judge(pages.select("page_id", "url"), thin)


_PARTS = rf"""
  translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{_AZ}', '{_az}') AS host,
  coalesce(regexp_extract(url, '{_URL}', 2), '') AS path,
  array_to_string(list_filter(string_split(substr(coalesce(regexp_extract(url, '{_URL}', 3), ''), 2), '&'),
    lambda x: x <> '' AND NOT starts_with(x, 'utm_')), '&') AS q
"""
ORACLE = rf"""
WITH parts AS (SELECT page_id, length(html) AS n, {_PARTS} FROM pages),
keyed AS (SELECT *, regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS key FROM parts),
listed AS (SELECT DISTINCT key FROM keyed WHERE n <= {THIN} AND key <> ''),
ruled AS (SELECT *, CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
  key IN (SELECT key FROM listed) AS is_listed FROM keyed)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN is_listed THEN 'block' ELSE 'allow' END AS verdict, key, is_listed FROM ruled
"""
