"""Edit history: payload parsing, pagination stitching, slices and rollups.

A payload is one API batch: an object with ``editRequests`` (or
``edit_requests``), ``totalCount`` and ``hasMore``.  Parsing goes through a
VARIANT so key presence can be told from a JSON null: the camelCase key wins
whenever it is present, even when null; otherwise the snake_case key is used.
A batch that breaks the shape rules is quarantined with the reason, never
dropped silently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions.sql import let
from folia.functions.text import py_strip
from folia.functions.times import ISO_TEXT, iso_time
from folia.session import materialize

_INT_TYPES = "('BIGINT', 'INT', 'SMALLINT', 'TINYINT', 'BOOLEAN')"


def _pick(x: str, camel: str, snake: str) -> str:
    """_mapping_value: the camelCase value if the key is present, else snake_case."""
    return f"coalesce(variant_get({x}, '$.{camel}'), variant_get({x}, '$.{snake}'))"


def _s(v: str) -> str:
    return f"try_variant_get({v}, '$', 'string')"


def _time(v: str) -> str:
    """Epoch seconds (integer, years 1-9999) or an ISO-8601 string ('Z' or
    offset; naive = UTC); null otherwise, which quarantines the batch."""
    return let(f"named_struct('v', {v}, 'type', schema_of_variant({v}))", lambda p: (
        f"CASE WHEN {p}.type IN {_INT_TYPES} THEN {let(f"try_variant_get({p}.v, '$', 'bigint')", lambda n: (
            f"CASE WHEN {n} BETWEEN -62135596800 AND 253402300799 THEN timestamp_seconds({n}) END"))} "
        f"WHEN {p}.type = 'STRING' THEN {iso_time(_s(f'{p}.v'))} END"
    ))


def _count(v: str) -> str:
    """A vote count: 0 where the key is missing; a number cut to an integer,
    or a string of digits; null for anything else, null values included."""
    return let(v, lambda x: (
        f"CASE WHEN {x} IS NULL THEN 0 WHEN schema_of_variant({x}) = 'STRING' THEN "
        f"{let(_s(x), lambda t: f"(CASE WHEN {t} RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$' THEN try_cast(trim({t}) AS bigint) END)")} "
        f"ELSE try_variant_get({x}, '$', 'bigint') END"
    ))


def parse_batches(payloads: DataFrame) -> DataFrame:
    """(slug, offset, payload) -> edit_batches: slug, offset, digest (of the
    payload), n, total_count, has_more, error, items (entry VARIANTs)."""
    kept = [c for c in payloads.columns if c == "fetched_at"]
    kept.append("digest")
    v = payloads.selectExpr("slug", "offset", *kept[:-1], "coalesce(md5(payload), '') AS digest", "try_parse_json(payload) AS v")
    reqs = _pick("v", "editRequests", "edit_requests")
    total = _pick("v", "totalCount", "total_count")
    more = _pick("v", "hasMore", "has_more")
    shaped = v.selectExpr(
        "slug", "offset", *kept, "v",
        f"{reqs} AS reqs", f"{total} AS total_v", f"{more} AS more_v",
    ).selectExpr(
        "*",
        "CASE WHEN reqs IS NULL OR is_variant_null(reqs) THEN CAST(array() AS array<variant>) "
        "ELSE try_variant_get(reqs, '$', 'array<variant>') END AS items",
    )
    votes = " OR ".join(f"({_count(_pick('x', camel, snake))}) IS NULL" for camel, snake in (("upvoteCount", "upvote_count"), ("downvoteCount", "downvote_count")))
    # No partition has a negative number. A nondeterministic expression keeps Spark from pushing filters on
    # the error or the items below, where every payload would be parsed again for each use.
    error = (
        "CASE WHEN spark_partition_id() < 0 THEN NULL WHEN v IS NULL THEN 'not_json' "
        "WHEN schema_of_variant(v) NOT LIKE 'OBJECT%' THEN 'not_object' "
        f"WHEN total_v IS NOT NULL AND schema_of_variant(total_v) NOT IN {_INT_TYPES} THEN 'bad_total' "
        "WHEN more_v IS NOT NULL AND schema_of_variant(more_v) <> 'BOOLEAN' THEN 'bad_has_more' "
        "WHEN items IS NULL THEN 'entries_not_array' "
        "WHEN exists(items, x -> schema_of_variant(x) NOT LIKE 'OBJECT%') THEN 'entry_not_object' "
        f"WHEN exists(items, x -> {_time(_pick('x', 'createdAt', 'created_at_utc'))} IS NULL "
        f"OR {_time(_pick('x', 'updatedAt', 'updated_at_utc'))} IS NULL) THEN 'bad_time' "
        f"WHEN exists(items, x -> {votes}) THEN 'bad_votes' END"
    )
    return shaped.selectExpr(
        "slug", "offset", *kept,
        "CAST(CASE WHEN items IS NULL THEN 0 ELSE size(items) END AS BIGINT) AS n",
        "coalesce(try_variant_get(total_v, '$', 'bigint'), 0) AS total_count",
        "coalesce(try_variant_get(more_v, '$', 'boolean'), false) AS has_more",
        f"{error} AS error",
        "items",
    )


def _entry(x: str) -> dict[str, str]:
    """The fields of an entry VARIANT."""
    def opt(camel: str, snake: str, strip: bool) -> str:
        raw = _s(_pick(x, camel, snake))
        return f"nullif({py_strip(raw)}, '')" if strip else f"nullif({raw}, '')"

    plain = lambda key: f"coalesce(try_variant_get({x}, '$.{key}', 'string'), '')"
    return {
        "id": plain("id"), "slug": plain("slug"), "user_id": f"coalesce({_s(_pick(x, 'userId', 'user_id'))}, '')",
        "status": plain("status"), "type": plain("type"), "summary": plain("summary"),
        "original_content": opt("originalContent", "original_content", False), "proposed_content": opt("proposedContent", "proposed_content", False),
        "section_title": opt("sectionTitle", "section_title", True),
        "created_at_utc": _time(_pick(x, "createdAt", "created_at_utc")), "updated_at_utc": _time(_pick(x, "updatedAt", "updated_at_utc")),
        "upvote_count": _count(_pick(x, "upvoteCount", "upvote_count")), "downvote_count": _count(_pick(x, "downvoteCount", "downvote_count")),
        "review_reason": opt("reviewReason", "review_reason", True),
    }


def entries(batches: DataFrame) -> DataFrame:
    """edit_entries: one row per entry of every valid batch, with the 14
    EditHistoryEntry fields plus slug (page), offset and pos (1-based)."""
    rows = batches.where("error IS NULL").selectExpr("slug AS page_slug", "offset", "posexplode(items) AS (p, x)")
    return rows.selectExpr("page_slug", "offset", "CAST(p + 1 AS BIGINT) AS pos", *[f"{e} AS {name}" for name, e in _entry("x").items()])


def newest(batches: DataFrame) -> DataFrame:
    """One batch for each (slug, offset), narrow: the one fetched last where
    there is a ``fetched_at`` column, else a valid one before the others and
    the longest; the payload's digest decides between equals. Columns: slug,
    offset, n, total_count, has_more, valid, next (the offset the loop asks
    for after it, null where it stops) and, if the batches have it, uid."""
    names = ["fetched_at"] if "fetched_at" in batches.columns else ["valid", "n"]
    kept = ["n", "total_count", "has_more", "valid"] + ["uid"] * ("uid" in batches.columns)
    narrow = batches.withColumn("valid", F.expr("error IS NULL")).select("slug", "offset", "digest", *{*names, *kept})
    picked = narrow.groupBy("slug", "offset").agg(F.max(F.struct(*names, "digest", *[c for c in kept if c not in names])).alias("b"))
    rows = picked.select("slug", "offset", *[f"b.{c}" for c in kept])
    return rows.withColumn("next", F.expr("CASE WHEN has_more AND n > 0 AND valid THEN offset + n END"))


def _follow(reached: DataFrame, jumps: DataFrame) -> DataFrame:
    """Where the jumps lead from what is reached."""
    j = jumps.withColumnRenamed("slug", "s")
    return reached.join(j, F.col("slug").eqNullSafe(F.col("s")) & (F.col("at") == F.col("offset"))).select("slug", F.col("to").alias("offset"))


def chain(rows: DataFrame) -> DataFrame:
    """The pagination loop as a table: of ``newest`` rows (written), those it reads.

    The loop starts at a page's first offset and goes on at ``next`` while a
    batch starts there. Pointers are doubled: after round k the first 2^k
    batches of every page are reached, and a jump covers 2^k batches, so a
    page of a million batches takes twenty rounds. Each round is two joins of
    narrow rows on (page, offset); nothing is gathered per page.
    """
    there = rows.select(F.col("slug").alias("s"), F.col("offset").alias("o"))
    jumps = rows.where("next IS NOT NULL").select("slug", F.col("offset").alias("at"), F.col("next").alias("to")).join(
        there, F.col("slug").eqNullSafe(F.col("s")) & (F.col("to") == F.col("o")), "left_semi")
    start = rows.groupBy("slug").agg(F.min("offset").alias("offset"))
    found = [materialize(start)]
    while True:
        jumps = materialize(jumps)
        new = materialize(_follow(reduce(DataFrame.unionByName, found), jumps))
        if new.isEmpty():
            break
        found.append(new)
        onward = jumps.select(F.col("slug").alias("s"), F.col("at").alias("mid"), F.col("to").alias("far"))
        jumps = jumps.join(onward, F.col("slug").eqNullSafe(F.col("s")) & (F.col("to") == F.col("mid"))).select("slug", "at", F.col("far").alias("to"))
    read = reduce(DataFrame.unionByName, found).select(F.col("slug").alias("s"), F.col("offset").alias("o"))
    return rows.join(read, F.col("slug").eqNullSafe(F.col("s")) & (F.col("offset") == F.col("o")), "left_semi")


def stitch(batches: DataFrame) -> DataFrame:
    """Per page: batches and entries read, total and has_more of the last
    batch read, whether the loop found every batch it asked for
    (``contiguous``), whether all could be parsed (``valid``) and whether the
    history is complete (entries read = total)."""
    read = chain(materialize(newest(batches)))
    rows = read.groupBy("slug").agg(
        F.count("*").alias("n_batches"), F.sum("n").alias("n_entries"), F.max_by(F.struct("total_count", "has_more", "next"), "offset").alias("last"),
        F.min("valid").alias("valid"))
    rows = rows.selectExpr("slug", "n_batches", "n_entries", "last.total_count", "last.has_more", "last.next IS NULL AS contiguous", "valid")
    return rows.withColumn("complete", F.expr("valid AND contiguous AND n_entries = total_count"))


def read_batches(batches: DataFrame) -> DataFrame:
    """The batches that the loop reads, with their items. The bodies are
    written once under a row number; all that is decided about them is decided
    on narrow rows, and the numbers found choose the bodies."""
    numbered = materialize(batches.withColumn("uid", F.monotonically_increasing_id()))
    read = chain(materialize(newest(numbered.drop("items"))))
    return numbered.join(read.select("uid"), "uid", "left_semi")


def stitched_entries(batches: DataFrame) -> DataFrame:
    """Entries of the batches that the loop reads, with their rank in the
    combined history (offset + position)."""
    return entries(read_batches(batches)).withColumn("rank", F.col("offset") + F.col("pos"))


def page_slice(stitched: DataFrame, limit: int = 25, offset: int = 0) -> DataFrame:
    """edit_history(limit, offset): the slice (offset, offset + limit] of each
    page's combined history."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    return stitched.where((F.col("rank") > offset) & (F.col("rank") <= offset + limit))


def summary(stitched: DataFrame) -> DataFrame:
    """Per page and status: entries, net votes, latest update."""
    return stitched.groupBy("page_slug", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("upvote_count") - F.col("downvote_count")).alias("net_votes"),
        F.max("updated_at_utc").alias("last_updated"),
    )


def write_batches(read: DataFrame) -> DataFrame:
    """Batches (of ``read_batches``) re-serialised with snake_case keys, each
    in its row: (slug, offset, json). Batches without entries are left out."""
    fields = _entry("x")
    fields |= {name: let(fields[name], lambda t: ISO_TEXT.format(t=t)) for name in ("created_at_utc", "updated_at_utc")}
    made = "named_struct(" + ", ".join(f"'{name}', {e}" for name, e in fields.items()) + ")"
    return read.where("error IS NULL AND size(items) > 0").selectExpr(
        "slug", "offset",
        f"to_json(named_struct('edit_requests', transform(items, x -> {made}), 'total_count', total_count, "
        "'has_more', has_more), map('ignoreNullFields', 'false')) AS json",
    )
