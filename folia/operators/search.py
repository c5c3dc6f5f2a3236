"""Search results: API payloads, HTML result pages, fallback, limit, and a
corpus keyword search.

The remote site ranks results; for a corpus the ranking is ours: distinct
query terms matched, then total term frequency, then page_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folia.functions import nodes as N
from folia.functions import urls as U
from folia.functions.text import py_strip
from folia.functions.sql import aggregate, filter_, let, transform
from folia.session import materialize

SEARCH_BASE = "https://wiki.example.org"
SEARCH_RESULTS = 25


def first_href(n: str) -> str:
    """An anchor's first non-empty href, where the attribute is repeated."""
    return f"coalesce(nullif({n}.first_href, ''), nullif({N.attr(n, 'href')}, ''))"


def html_hits(shredded: DataFrame, base_col: str | None = None, base_url: str | None = None,
              path_prefix: str = "/page/", key_cols: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Result links of HTML documents: every a[href] of the whole document,
    resolved, same host as the base, path under ``path_prefix``, query and
    fragment dropped, unique in first-seen order.

    With ``base_url`` the site base is fixed (search pages: joined as
    base + '/'); with ``base_col`` each document's own URL is the base.
    """
    base = f"concat({N.lit(base_url.strip().rstrip('/'))}, '/')" if base_url else base_col
    hrefs = transform(
        filter_("nodes", lambda n: f"({n}.tag = 'a' AND {first_href(n)} IS NOT NULL)"),
        lambda n: U.url_resolve(base, first_href(n)),
    )

    def keep(resolved: str) -> str:
        def parts(u: str) -> str:
            return (
                f"named_struct('host', lower({U.url_part(u, 'netloc')}), 'path', {U.url_path(u)}, "
                f"'norm', concat({U.url_part(u, 'scheme')}, '://', {U.url_part(u, 'netloc')}, {U.url_path(u)}))"
            )

        expected = f"lower({U.url_part(base, 'netloc')})"
        ok = filter_(
            transform(resolved, parts),
            lambda p: f"({p}.host = {expected} AND startswith({p}.path, {N.lit(path_prefix)}))",
        )
        return f"array_distinct({transform(ok, lambda p: f'{p}.norm')})"

    return shredded.selectExpr(*key_cols, f"{let(hrefs, keep)} AS hits").selectExpr(
        *key_cols, "posexplode(hits) AS (pos, page_url)"
    ).selectExpr(*key_cols, "CAST(pos + 1 AS BIGINT) AS pos", "page_url")


REQUEST = ["query", "offset"]


def api_hits(api: DataFrame, base_url: str = SEARCH_BASE) -> tuple[DataFrame, DataFrame]:
    """(query, offset, status, refused, payload), a row for each request ->
    hits (query, offset, pos, page_url) and the requests with a valid answer
    (even an empty one).

    An answer is valid when robots rules did not refuse the request, its
    status is below 400 and its payload parses to an object with a
    ``results`` array. Non-object entries and blank or non-string slugs are
    skipped; hits are unique by canonical URL key, the first spelling kept,
    in result order.
    """
    # payloads are parsed once: what is valid and what it lists are read from the written result
    parsed = api.selectExpr(*REQUEST, "CASE WHEN status < 400 AND NOT refused THEN try_parse_json(payload) END AS v").selectExpr(
        *REQUEST,
        "CASE WHEN v IS NOT NULL AND schema_of_variant(v) LIKE 'OBJECT%' "
        "THEN try_variant_get(v, '$.results', 'array<variant>') END AS results",
    ).where("results IS NOT NULL")
    slugs = transform("results", lambda x: (
        f"CASE WHEN schema_of_variant({x}) LIKE 'OBJECT%' AND schema_of_variant(variant_get({x}, '$.slug')) = 'STRING' "
        f"THEN try_variant_get({x}, '$.slug', 'string') END"))
    urls = transform(filter_(slugs, lambda x: f"({x} IS NOT NULL AND {py_strip(x)} <> '')"), lambda x: U.slug_url(x, base_url))
    listed = materialize(parsed.selectExpr(*REQUEST, f"{urls} AS urls"))
    keyed = listed.selectExpr("*", f"{transform('urls', U.url_canonical)} AS keys")
    unique = filter_("urls", lambda u, i: f"array_position(keys, get(keys, {i})) = {i} + 1", arity=2)
    hits = keyed.selectExpr(*REQUEST, f"posexplode({unique}) AS (i, page_url)").selectExpr(*REQUEST, "CAST(i + 1 AS BIGINT) AS pos", "page_url")
    return hits, listed.select(*REQUEST)


def fallback(api_result: DataFrame, valid: DataFrame, html_result: DataFrame) -> DataFrame:
    """API hits for every request with a valid answer (even an empty one); the
    HTML hits for the others: HTTP errors, robots refusals, bad payloads."""
    columns = [*REQUEST, "pos", "page_url"]
    return api_result.select(*columns).unionByName(html_result.join(valid, REQUEST, "left_anti").select(*columns))


def limit_results(hits: DataFrame, n: int) -> DataFrame:
    """The first n hits of each query (0 allowed)."""
    if n < 0:
        raise ValueError("limit must be >= 0")
    return hits.where(F.col("pos") <= n)


def _tokens(e: str) -> str:
    return f"array_remove(split(lower({e}), '[^\\\\p{{L}}\\\\p{{N}}]+'), '')"


def build_index(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> the inverted index, written: (term, uid, doc_id, tf).

    A row's tokens are sorted in the row; runs of equal ones are its postings,
    so counting needs no exchange. Postings are dealt out by term and a part
    of the rows, so a word of every document spreads over tasks, and lie
    sorted by term, so a search skips files by their statistics. ``uid``
    numbers the rows: ids may be null or repeat. A scan keeps its splits; the
    session setting ``folia.shred.partitions`` deals a table of few files out.
    """
    wanted = int(docs.sparkSession.conf.get("folia.shred.partitions", "0"))
    docs = docs.select("doc_id", "text")
    docs = docs.repartition(wanted) if wanted else docs
    runs = let("sort_array(tokens)", lambda s: let(
        f"filter(sequence(0, size({s}) - 1), i -> i = 0 OR {s}[i] <> {s}[i - 1])", lambda at: (
            f"transform({at}, (p, j) -> named_struct('term', {s}[p], 'tf', CAST(coalesce(get({at}, j + 1), size({s})) - p AS BIGINT)))")))
    rows = docs.selectExpr("monotonically_increasing_id() AS uid", "CAST(doc_id AS BIGINT) AS doc_id", f"{_tokens('text')} AS tokens").where("size(tokens) > 0")
    postings = rows.selectExpr("uid", "doc_id", f"inline({runs})")
    return materialize(postings.repartition("term", F.expr("uid % 8")).sortWithinPartitions("term"))


def _top(scored: DataFrame, keep: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.desc("n_terms"), F.desc("tf"), F.asc_nulls_last("doc_id"), "uid")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def _matches(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """(qid, terms wanted of it) -> (qid, uid, doc_id, n_terms, tf) over these terms."""
    return wanted.selectExpr("qid", "explode(wanted) AS term").join(index, "term").groupBy("qid", "uid").agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("tf"), F.any_value("doc_id").alias("doc_id"))


def search_index(index: DataFrame, queries: DataFrame, limit: int = SEARCH_RESULTS, offset: int = 0) -> DataFrame:
    """Ranks offset + 1 to offset + limit of every distinct query over an
    index: (query, doc_id, rank, n_terms, tf).

    Rank: distinct query terms matched, then total term frequency, then
    doc_id. A query's terms are ordered by their number of documents, rarest
    first. The rarest ones, with 40 times as many postings as results, choose
    twice that many documents; theta, the terms that the best of these match
    at least, is a lower bound for every result. All but two of the theta
    most frequent terms are then left out: whatever belongs in the results
    matches two of the others, and only for documents that do are the
    frequent terms looked up. The work grows with the postings read, not
    with documents times queries.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    keep = limit + offset
    asked = queries.select("query").distinct().selectExpr("query", f"array_distinct({_tokens('query')}) AS terms").where("size(terms) > 0")
    asked = materialize(asked.selectExpr("monotonically_increasing_id() AS qid", "query", "terms"))
    wanted = asked.selectExpr("qid", "explode(terms) AS term")
    index = materialize(index.join(wanted.select("term").distinct(), "term"))  # the matching postings: all that follows reads them
    spread = index.groupBy("term").agg(F.count("*").alias("df"))
    ordered = wanted.join(spread, "term").groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("df", "term"))).alias("t"))  # a query's own terms
    few = aggregate("t", "named_struct('n', 0, 'sum', 0L)", lambda a, x: f"CASE WHEN {a}.sum >= {40 * keep} THEN {a} ELSE named_struct('n', {a}.n + 1, 'sum', {a}.sum + {x}.df) END")
    ordered = materialize(ordered.selectExpr("qid", "t.term AS terms", f"({few}).n AS few"))

    seeds = _top(_matches(ordered.selectExpr("qid", "slice(terms, 1, few) AS wanted"), index), 2 * keep)
    seeds = materialize(seeds.select("qid", "uid", "n_terms"))
    rest = seeds.select("qid", "uid").join(ordered.selectExpr("qid", "explode(slice(terms, few + 1, size(terms))) AS term"), "qid").join(index, ["term", "uid"])
    seeds = seeds.unionByName(rest.selectExpr("qid", "uid", "1L AS n_terms")).groupBy("qid", "uid").agg(F.sum("n_terms").alias("n_terms"))
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("n_terms")))
    bound = seeds.withColumn("place", place).where(F.col("place") == keep).selectExpr("qid", "n_terms AS theta")
    plan = ordered.join(bound, "qid", "left").selectExpr("qid", "terms", "coalesce(theta, 0) AS theta")
    plan = materialize(plan.selectExpr("*", "CAST(greatest(theta - 2, 0) AS INT) AS off"))

    first = _matches(plan.selectExpr("qid", "slice(terms, 1, size(terms) - off) AS wanted"), index)
    first = first.join(plan.selectExpr("qid", "theta - off AS least"), "qid").where("n_terms >= least").drop("least")
    first = materialize(first.select("qid", "uid", "doc_id", "n_terms", "tf"))
    frequent = plan.where("off > 0").selectExpr("qid", "explode(slice(terms, size(terms) - off + 1, off)) AS term")
    looked = first.select("qid", "uid").join(frequent, "qid").join(index, ["term", "uid"]).selectExpr("qid", "uid", "doc_id", "1L AS n_terms", "tf")
    scored = first.unionByName(looked).groupBy("qid", "uid").agg(F.sum("n_terms").alias("n_terms"), F.sum("tf").alias("tf"), F.any_value("doc_id").alias("doc_id"))
    return _top(scored, keep).where(F.col("rank") > offset).join(asked.select("qid", "query"), "qid").select("query", "doc_id", "rank", "n_terms", "tf")


def corpus_search(docs: DataFrame, queries: DataFrame, limit: int = SEARCH_RESULTS, offset: int = 0) -> DataFrame:
    """Keyword search of a document table (doc_id, text): ``search_index``
    over its index. Documents and queries are tokenised alike (lower-case,
    runs of letters or digits); null texts match nothing."""
    return search_index(build_index(docs), queries, limit, offset)
