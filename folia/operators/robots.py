"""robots.txt: one row of entries per origin, and the per-URL crawl gate.

A document is parsed in its row. An entry opens at a user-agent line that does
not follow another one and ends before the next entry or a blank line; without
a rule in it, it is none. Allow, disallow, crawl-delay and request-rate lines
are rules, but only the first two leave a path; rules outside of an entry
count for nothing, and lines of other kinds are not there at all. The first
entry naming '*' is the default entry, later ones are dropped.

The gate takes the first entry that names the crawler, else the default one,
and in it the first path that prefixes the URL. No rule, no entry or no match means allowed. A missing
or failed (>= 400) robots.txt makes the URL ``unavailable`` (fail closed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.functions import urls as U
from folia.functions.sql import exists, filter_, first, let, lit, transform
from folia.functions.text import py_strip, split_lines
from folia.session import materialize

_RULES_T = "array<struct<allow:boolean,prefix:string>>"
_ENTRY_T = f"struct<agents:array<string>,rules:{_RULES_T}>"


def _py_quote(e: str) -> str:
    """quote(s, safe='/'): only letters, digits, '_.-~' and '/' stay raw."""
    out = f"replace(url_encode({e}), '+', '%20')"
    for esc, ch in (("%7E", "~"), ("%2F", "/")):
        out = f"replace({out}, '{esc}', '{ch}')"
    return f"replace({out}, '*', '%2A')"


def _event(line: str) -> str:
    """A line as (blank, key, value); key is null for a line without a colon."""
    body = py_strip(f"substring_index({line}, '#', 1)")
    return let(body, lambda b: (
        f"named_struct('blank', {line} = '', 'key', CASE WHEN contains({b}, ':') THEN lower({py_strip(f"substring_index({b}, ':', 1)")}) END, "
        f"'value', CASE WHEN contains({b}, ':') THEN {U.unquote(py_strip(f"substring({b}, instr({b}, ':') + 1)"))} END)"))


def parse_entries(text: str) -> str:
    """The document's entries in order: array of (agents, rules). Every line
    is looked at a fixed number of times, however long the document is."""
    kinds = "('user-agent', 'allow', 'disallow', 'crawl-delay', 'request-rate')"
    told = filter_(transform(split_lines(text), _event), lambda x: f"({x}.blank OR {x}.key IN {kinds})")
    agent = lambda x: f"(NOT {x}.blank AND {x}.key = 'user-agent')"

    def entry(x: str, first_line: str, past: str) -> str:
        """Lines of an entry: from its first user-agent line to the next entry or a blank line."""
        whole = f"slice({x}, {first_line} + 1, {past} - {first_line})"
        lines = let(whole, lambda w: let(f"CAST(array_position({transform(w, lambda e: f'{e}.blank')}, true) AS INT)",
                                         lambda b: f"CASE WHEN {b} > 0 THEN slice({w}, 1, {b} - 1) ELSE {w} END"))
        rule = lambda r: f"named_struct('allow', {r}.key = 'allow' OR {r}.value = '', 'prefix', {_py_quote(U.reassemble(f'{r}.value'))})"
        return let(lines, lambda ls: (
            f"CASE WHEN {exists(ls, lambda e: f'NOT {agent(e)}')} THEN named_struct("
            f"'agents', {transform(filter_(ls, agent), lambda e: f'{e}.value')}, "
            f"'rules', {transform(filter_(ls, lambda e: f"{e}.key IN ('allow', 'disallow')"), rule)}) END"))

    def entries(x: str) -> str:
        opens = f"filter(sequence(0, size({x}) - 1), i -> {agent(f'{x}[i]')} AND (i = 0 OR NOT {agent(f'{x}[i - 1]')}))"
        made = let(opens, lambda at: transform(at, lambda i, k: entry(x, i, f"coalesce(get({at}, {k} + 1), size({x}))"), arity=2))
        return f"CASE WHEN size({x}) = 0 THEN CAST(array() AS array<{_ENTRY_T}>) ELSE {filter_(made, lambda e: f'{e} IS NOT NULL')} END"

    return let(told, entries)


def robots_entries(docs: DataFrame, *keep_columns: str) -> DataFrame:
    """(robots_url, status, text) -> one row for each successful document:
    robots_url, ``keep_columns``, entries (agents, rules, is_default), in order."""
    def keep(es: str) -> str:
        star = filter_(transform(es, lambda e, i: f"CASE WHEN array_contains({e}.agents, '*') THEN {i} END", arity=2), lambda i: f"{i} IS NOT NULL")
        return let(f"coalesce({first(star)}, -1)", lambda d: filter_(
            transform(es, lambda e, i: f"named_struct('agents', {e}.agents, 'rules', {e}.rules, 'is_default', {i} = {d})", arity=2),
            lambda e: f"({e}.is_default OR NOT array_contains({e}.agents, '*'))"))

    good = docs.where("status < 400 AND text IS NOT NULL")
    return good.selectExpr("robots_url", *keep_columns, f"{let(parse_entries('text'), keep)} AS entries")


def robots_rules(docs: DataFrame) -> DataFrame:
    """(robots_url, entry_no, is_default, agents, seq, allow, prefix): a row for
    each path rule; an entry without any has one row with nulls."""
    entries = robots_entries(docs).selectExpr("robots_url", "posexplode(entries) AS (p, e)")
    rows = entries.selectExpr("robots_url", "p + 1 AS entry_no", "e.is_default AS is_default", "e.agents AS agents", "posexplode_outer(e.rules) AS (s, r)")
    return rows.selectExpr("robots_url", "entry_no", "is_default", "agents", "s + 1 AS seq", "r.allow AS allow", "r.prefix AS prefix")


#: An entry of at most so many rules is decided in the URL's row; a longer one by a hash join on the URL's prefixes.
ROW_RULES = 64


def robots_gate(urls: DataFrame, docs: DataFrame, user_agent: str, respect_robots: bool = True, allow_override: bool = False,
                row_rules: int = ROW_RULES) -> DataFrame:
    """(page_id, url) -> (page_id, url, verdict in allowed/disallowed/unavailable).

    The crawler's entry is chosen once per origin; one equi-join on the
    robots URL gives it to the URLs (Spark picks broadcast or shuffle from
    measured sizes and splits an origin that holds many URLs). A long entry's
    rules stay out of the rows: a URL takes along the lengths that its rules
    have, and its prefixes of these lengths meet the rules in a hash join.
    The rule with the smallest sequence number decides, as everywhere."""
    if not respect_robots or allow_override:
        return urls.selectExpr("page_id", "url", "'allowed' AS verdict")
    chosen = robots_entries(docs).selectExpr("robots_url", f"{_entry_of(user_agent)} AS entry").selectExpr(
        "robots_url", "coalesce(entry.rules, CAST(array() AS " + _RULES_T + ")) AS rules")
    chosen = materialize(chosen)  # one row per origin, read by both joins
    origins = chosen.selectExpr(
        "robots_url", f"CASE WHEN size(rules) <= {row_rules} THEN rules END AS rules",
        f"CASE WHEN size(rules) > {row_rules} THEN array_distinct({transform('rules', lambda r: f'length({r}.prefix)')}) END AS lengths")
    joined = gate_targets(urls, "page_id", "url").join(origins, "robots_url", "left")
    decides = first(filter_("rules", lambda r: f"startswith(path_q, {r}.prefix)"))
    short = joined.where("lengths IS NULL").selectExpr(
        "page_id", "url", f"CASE WHEN rules IS NULL THEN 'unavailable' WHEN coalesce({decides}.allow, true) THEN 'allowed' ELSE 'disallowed' END AS verdict")
    long = chosen.where(f"size(rules) > {row_rules}").selectExpr("robots_url", "posexplode(rules) AS (seq, r)").groupBy("robots_url", F.col("r.prefix").alias("prefix")).agg(
        F.min(F.struct("seq", "r.allow")).alias("rule"))
    asked = joined.where("lengths IS NOT NULL").selectExpr("monotonically_increasing_id() AS uid", "*").selectExpr(  # a number for each URL, not for each prefix
        "uid", "page_id", "url", "robots_url",
        f"explode({transform(filter_('lengths', lambda n: f'{n} <= length(path_q)'), lambda n: f'left(path_q, {n})')}) AS prefix")
    # a URL whose path no rule's length fits has no row here, and is allowed
    none = joined.where("lengths IS NOT NULL AND NOT exists(lengths, n -> n <= length(path_q))").selectExpr("page_id", "url", "'allowed' AS verdict")
    met = asked.join(long, ["robots_url", "prefix"], "left").groupBy("uid").agg(
        F.any_value("page_id").alias("page_id"), F.any_value("url").alias("url"), F.min("rule").alias("rule"))
    return short.unionByName(none).unionByName(met.selectExpr("page_id", "url", "CASE WHEN coalesce(rule.allow, true) THEN 'allowed' ELSE 'disallowed' END AS verdict"))


def _entry_of(user_agent: str) -> str:
    """Of ``entries``: the first that names the crawler, else the default one."""
    token = lit(user_agent.split("/")[0].lower())
    named = first(filter_("entries", lambda e: f"(NOT {e}.is_default AND {exists(f'{e}.agents', lambda a: f'contains({token}, lower({a}))')})"))
    return f"coalesce({named}, {first(filter_('entries', lambda e: f'{e}.is_default'))})"


def gate_targets(urls: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the URLs with the origin's robots URL and the target its rules are held against."""
    return urls.selectExpr(*columns, f"{U.url_robots('url')} AS robots_url", f"{_robot_path('url')} AS path_q")


def gate_verdicts(joined: DataFrame, user_agent: str) -> DataFrame:
    """Targets with their origin's ``entries`` (null: none known) -> (page_id, url, verdict)."""
    decides = first(filter_("entry.rules", lambda r: f"startswith(path_q, {r}.prefix)"))
    return joined.selectExpr("*", f"{_entry_of(user_agent)} AS entry").selectExpr("page_id", "url", "entries IS NOT NULL AS known", f"coalesce({decides}.allow, true) AS allow").selectExpr(
        "page_id", "url", "CASE WHEN NOT known THEN 'unavailable' WHEN allow THEN 'allowed' ELSE 'disallowed' END AS verdict")


def _robot_path(e: str) -> str:
    """The gate's target: path, params, query and fragment of the unquoted
    URL, re-assembled and quoted; '/' when empty."""
    return let(U.unquote(e), lambda u: f"coalesce(nullif({_py_quote(U.reassemble(u, relative=True))}, ''), '/')")
