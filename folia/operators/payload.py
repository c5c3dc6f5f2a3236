"""Markdown media carried in ``self.__next_f.push([n, "..."])`` script payloads.

Everything happens in the page's row: payload texts come from the script
nodes (regex, JSON unescape), their lines are classified with array
expressions (heading, image, caption from the next four lines), and the
heading and image events of each payload go through an ``aggregate`` fold
that moves the heading cursor (next title match after the cursor, else the
first). The images it attaches are merged after the figures by
``sections.nested``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from folia.functions.sql import aggregate, filter_, first, let, lit, transform
from folia.functions.text import py_strip, split_lines, ws_normalize
from folia.functions.urls import normalize_image_url

# The string argument is matched possessively: the alternation form
# ``(?:\\.|[^"\\])*`` recurses per character in Java's regex engine and
# overflows its stack on payloads of a few thousand characters.
PUSH_RE = r'(?sU)self\.__next_f\.push\(\[\s*\d+\s*,\s*"((?:[^"\\]++|\\.)*+)"\s*\]\s*\);'

# Fixed value: where an image may begin; its link ends at the parenthesis that
# closes the one opened here, found by ``link_of``.
MD_IMAGE_START = r"(?s)!\[([^\]]*)\]\((.*)$"


def link_of(rest: str) -> str:
    """The text up to the parenthesis that closes a link, at any depth;
    escaped parentheses do not count. Null if none closes it. The fold goes
    from one parenthesis to the next, not over the characters."""
    init = "named_struct('d', 1, 'i', 0, 'end', -1)"

    def step(a: str, piece: str) -> str:
        depth = f"({a}.d + CASE WHEN endswith({piece}, '\\\\(') OR endswith({piece}, '\\\\)') THEN 0 WHEN endswith({piece}, '(') THEN 1 ELSE -1 END)"
        return (f"CASE WHEN {a}.end >= 0 THEN {a} ELSE {let(depth, lambda d: let(f'{a}.i + char_length({piece})', lambda i: (
            f"named_struct('d', {d}, 'i', {i}, 'end', CASE WHEN {d} = 0 THEN {i} - 1 ELSE -1 END)")))} END")

    pieces = f"regexp_extract_all({rest}, {lit('[^()]*+[()]')}, 0)"
    nested = let(f"{aggregate(pieces, init, step)}.end", lambda e: f"CASE WHEN {e} >= 0 THEN substring({rest}, 1, {e}) END")
    # mostly the first closing parenthesis ends the link: nothing before it opens or escapes one
    plain = f"substring_index({rest}, ')', 1)"
    return let(plain, lambda x: f"CASE WHEN contains({rest}, ')') AND NOT contains({x}, '(') AND NOT endswith({x}, '\\\\') THEN {x} ELSE {nested} END")


def _json_unescape(e: str) -> str:
    """json.loads('"' + e + '"'), null when that fails (raw control
    characters are rejected, as Python's strict decoder does)."""
    return (
        f"CASE WHEN {e} RLIKE '[\\\\x00-\\\\x1f]' THEN NULL "
        f"ELSE get_json_object(concat('{{\"v\":\"', {e}, '\"}}'), '$.v') END"
    )


def decode_payload(raw: str) -> str:
    """Unescape once (raw kept on failure); if escapes remain, again, falling
    back to replacing only \\" and \\n."""

    def second(d: str) -> str:
        fallback = f"replace(replace({d}, '\\\\\"', '\"'), '\\\\n', '\\n')"
        return (
            f"CASE WHEN contains({d}, '\\\\n') OR contains({d}, '\\\\\"') "
            f"THEN coalesce({_json_unescape(d)}, {fallback}) ELSE {d} END"
        )

    return let(f"coalesce({_json_unescape(raw)}, {raw})", second)


def payload_texts(scripts: str = "scripts") -> str:
    """Markdown payloads of the page in document order (those with '## ' and '![')
    from the texts of its scripts."""
    raws = f"flatten({transform(scripts, lambda s: f'regexp_extract_all({s}, {lit(PUSH_RE)}, 1)')})"
    decoded = transform(raws, decode_payload)
    return filter_(decoded, lambda d: f"(contains({d}, '## ') AND contains({d}, '!['))")


def _places(items: str) -> str:
    """Index of a list of titled items: (title, place), sorted."""
    return f"array_sort({transform(items, lambda x, i: f'named_struct({lit("title")}, {x}.title, {lit("at")}, {i})', arity=2)})"


def section_titles(heads: str = "heads") -> str:
    """Sections of a page's h2/h3 headings (``fields``), in order: array of (sec_no, title, subs
    array of (sub_no, title), places of the subs by title); titles normalised
    and lower-cased. A section's headings follow one another."""
    def section(at: str, i: str, j: str) -> str:
        own = f"slice({heads}, {i} + 1, coalesce(get({at}, {j} + 1), size({heads})) - {i})"
        subs = transform(
            filter_(own, lambda h: f"({h}.level = 3 AND {h}.sec = {j} + 1)"),
            lambda h, k: f"named_struct('sub_no', {k} + 1, 'title', lower({ws_normalize(f'{h}.title')}))",
            arity=2,
        )
        title = f"CASE WHEN {heads}[{i}].level = 2 THEN lower({ws_normalize(f'{heads}[{i}].title')}) ELSE 'overview' END"
        return let(subs, lambda s: f"named_struct('sec_no', {j} + 1, 'title', {title}, 'subs', {s}, 'places', {_places(s)})")

    opens = filter_(f"{transform(heads, lambda h, i: f'CASE WHEN {h}.opens THEN {i} END', arity=2)}", lambda i: f"{i} IS NOT NULL")
    return let(opens, lambda at: transform(at, lambda i, j: section(at, i, j), arity=2))


def _match(places: str, title: str, start: str) -> str:
    """Place of the first item titled ``title`` at or after ``start``, else of
    the first such item anywhere, else -1: binary searches in the index."""
    def seek(after: str) -> str:
        key = f"named_struct('title', {title}, 'at', {after})"
        rounds = f"sequence(1, CAST(ceil(log2(size({places}) + 1)) AS INT) + 1)"

        def step(a: str, _: str) -> str:
            return let(f"({a}.lo + {a}.hi) DIV 2", lambda m: (
                f"CASE WHEN {a}.lo >= {a}.hi THEN {a} WHEN {places}[CAST({m} AS INT)] < {key} THEN named_struct('lo', CAST({m} + 1 AS INT), 'hi', {a}.hi) "
                f"ELSE named_struct('lo', {a}.lo, 'hi', CAST({m} AS INT)) END"))

        return let(f"get({places}, {aggregate(rounds, f'named_struct({lit("lo")}, 0, {lit("hi")}, size({places}))', step)}.lo)",
                   lambda e: f"CASE WHEN {e}.title = {title} THEN {e}.at END")

    return f"coalesce({seek(start)}, {seek('0')}, -1)"


_HIT = "struct<no:int,sec_no:int,sub_no:int,alt:string,raw_url:string,caption:string>"


def cursor_fold(events: str, secs: str, places: str) -> str:
    """The reference's line scan as a fold over classified line events
    (no, kind, title, alt, raw_url, caption): '## ' moves the section cursor,
    '### ' the subsection cursor inside it, an image attaches to the current
    target.  Returns the attached images with their (sec_no, sub_no)."""
    init = f"named_struct('sc', -1, 'cur', -1, 'ssc', -1, 'csub', -1, 'out', CAST(array() AS array<{_HIT}>))"

    def step(acc: str, ln: str) -> str:
        def on_h2(m: str) -> str:
            return (
                f"named_struct('sc', CASE WHEN {m} >= 0 THEN {m} ELSE {acc}.sc END, 'cur', {m}, "
                f"'ssc', -1, 'csub', -1, 'out', {acc}.out)"
            )

        def on_h3(m: str) -> str:
            return (
                f"named_struct('sc', {acc}.sc, 'cur', {acc}.cur, "
                f"'ssc', CASE WHEN {m} >= 0 THEN {m} ELSE {acc}.ssc END, 'csub', {m}, 'out', {acc}.out)"
            )

        cur_sec = f"element_at({secs}, {acc}.cur + 1)"
        hit = (
            f"named_struct('no', {ln}.no, 'sec_no', {cur_sec}.sec_no, "
            f"'sub_no', CASE WHEN {acc}.csub >= 0 THEN element_at({cur_sec}.subs, {acc}.csub + 1).sub_no ELSE 0 END, "
            f"'alt', {ln}.alt, 'raw_url', {ln}.raw_url, 'caption', {ln}.caption)"
        )
        return (
            f"CASE WHEN {ln}.kind = 'h2' THEN {let(_match(places, f'{ln}.title', f'{acc}.sc + 1'), on_h2)} "
            f"WHEN {ln}.kind = 'h3' AND {acc}.cur >= 0 "
            f"THEN {let(let(f'{cur_sec}.places', lambda p: _match(p, f'{ln}.title', f'{acc}.ssc + 1')), on_h3)} "
            f"WHEN {ln}.kind = 'img' AND {acc}.cur >= 0 AND {ln}.raw_url IS NOT NULL "
            f"THEN named_struct('sc', {acc}.sc, 'cur', {acc}.cur, 'ssc', {acc}.ssc, 'csub', {acc}.csub, "
            f"'out', concat({acc}.out, array({hit}))) "
            f"ELSE {acc} END"
        )

    return f"{aggregate(events, init, step)}.out"


def payloads(frame: DataFrame) -> DataFrame:
    """payload_markdown: page_id, pno, payload (decoded markdown)."""
    return frame.where("quarantine IS NULL").selectExpr("page_id", "posexplode(payloads) AS (pno, payload)")


def _classify(lines: str, s: str, i: str) -> str:
    """Line i as an event: kind, heading title, image alt, raw URL, caption."""
    ahead = f"coalesce({', '.join(f"nullif(get({lines}, {i} + {k}), '')" for k in range(1, 5))})"
    caption = let(ahead, lambda n: (
        f"CASE WHEN {n} IS NULL OR startswith({n}, '##') OR startswith({n}, '![') THEN NULL "
        f"WHEN startswith({n}, '*') AND endswith({n}, '*') AND char_length({n}) > 2 "
        f"THEN nullif({ws_normalize(f'substring({n}, 2, char_length({n}) - 2)')}, '') END"))
    none = "CAST(NULL AS STRING)"

    def image(x: str) -> str:
        raw = let(ws_normalize(f"{x}.link"), lambda v: (
            f"CASE WHEN {v} = '' THEN NULL WHEN startswith({v}, '<') AND contains({v}, '>') "
            f"THEN substring_index(substring({v}, 2), '>', 1) ELSE nullif(substring_index({v}, ' ', 1), '') END"))
        return (f"named_struct('no', {i}, 'kind', CASE WHEN {x}.link IS NULL THEN 'other' ELSE 'img' END, 'title', {none}, "
                f"'alt', nullif({ws_normalize(f'{x}.alt')}, ''), 'raw_url', {raw}, 'caption', {caption})")

    def plain(kind: str, title: str) -> str:
        return f"named_struct('no', {i}, 'kind', {kind}, 'title', {title}, 'alt', {none}, 'raw_url', {none}, 'caption', {none})"

    found = let(
        f"regexp_extract({s}, {lit(MD_IMAGE_START)}, 2)",
        lambda rest: f"named_struct('alt', regexp_extract({s}, {lit(MD_IMAGE_START)}, 1), 'link', CASE WHEN {rest} <> '' THEN {link_of(rest)} END)",
    )
    return (
        f"CASE WHEN startswith({s}, '## ') THEN {plain("'h2'", f"lower({ws_normalize(f'substring({s}, 4)')})")} "
        f"WHEN startswith({s}, '### ') THEN {plain("'h3'", f"lower({ws_normalize(f'substring({s}, 5)')})")} "
        f"WHEN contains({s}, '![') THEN {let(found, image)} ELSE {plain("'other'", none)} END"
    )


def events(payload: str) -> str:
    """The heading and image lines of a payload as events, in order."""
    stripped = transform(split_lines(payload), py_strip)
    return let(stripped, lambda ls: filter_(transform(ls, lambda s, i: _classify(ls, s, i), arity=2), lambda e: f"{e}.kind <> 'other'"))


def payload_hits(payloads: str = "payloads", secs: str = "secs", base: str = "_base") -> str:
    """The payloads' images in order, placed under the page's headings:
    array of (sec_no, sub_no, image_url, caption, alt_text)."""
    hits = let(_places(secs), lambda x: f"flatten({transform(payloads, lambda p: let(events(p), lambda e: cursor_fold(e, secs, x)))})")
    # bound outside the lambda: Spark may put the base's own expression where it is used once, here for every image
    return let(base, lambda b: transform(hits, lambda h: (
        f"named_struct('sec_no', {h}.sec_no, 'sub_no', {h}.sub_no, "
        f"'image_url', {normalize_image_url(f'{h}.raw_url', b, parsed_base=True)}, 'caption', {h}.caption, 'alt_text', {h}.alt)")))


def payload_media(frame: DataFrame) -> DataFrame:
    """The payload images of good pages, a row each: page_id, sec_no, sub_no,
    image_url, caption, alt_text."""
    # the outer form: Spark would otherwise test size(hits) in a filter and build the hits twice
    return frame.where("quarantine IS NULL").selectExpr("page_id", "inline_outer(hits)").where("sec_no IS NOT NULL")
