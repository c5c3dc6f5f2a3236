"""Expressions over the shredded ``nodes`` array (SQL text).

A node's subtree is the contiguous slice ``slice(nodes, n.idx, n.span)``
(pre-order interval encoding), so descendant lookups cost the subtree, not
the page.  Nothing here shuffles: every value is a projection of one row.
"""

from __future__ import annotations

from folia.functions.sql import exists, filter_, first, let, lit, transform  # noqa: F401 (lit re-exported)
from folia.functions.text import py_strip, ws_normalize

NODES = "nodes"
NL_SQL = "'\\n'"  # SQL literal for a newline


def attr(n: str, name: str) -> str:
    """``node.attrs.get(name, "")``."""
    return f"coalesce(try_element_at({n}.attrs, {lit(name)}), '')"


def subtree(n: str, nodes: str = NODES) -> str:
    return f"slice({nodes}, {n}.idx, {n}.span)"


def descendants(n: str, nodes: str = NODES) -> str:
    return f"slice({nodes}, {n}.idx + 1, greatest({n}.span - 1, 0))"


def first_tag(arr: str, tag: str) -> str:
    return first(filter_(arr, lambda n: f"{n}.tag = {lit(tag)}"))


def reads_as(e: str, word: str) -> str:
    """``e`` in lower case is ``word``, an ASCII word. Other lengths in bytes
    are not lower-cased; of other characters only the Kelvin sign becomes an
    ASCII letter (k)."""
    sizes = ", ".join(str(len(word) + 2 * k) for k in range(word.count("k") + 1))
    return f"(octet_length({e}) IN ({sizes}) AND lower({e}) = {lit(word)})"


def is_references_heading(n: str) -> str:
    return f"({n}.tag IN ('h2', 'h3') AND {reads_as(f'{n}.text', 'references')})"


def select_article(nodes: str = NODES) -> str:
    """First article whose class contains text-[16px]; else the first with an
    h1 and a "references" h2/h3 inside; else the first; else null."""

    def pick(arts: str) -> str:
        by_class = first(filter_(arts, lambda a: f"contains({attr(a, 'class')}, 'text-[16px]')"))
        by_headings = first(
            filter_(
                arts,
                lambda a: f"{exists(descendants(a, nodes), lambda n: f"{n}.tag = 'h1'")} "
                f"AND {exists(descendants(a, nodes), is_references_heading)}",
            )
        )
        return f"coalesce({by_class}, {by_headings}, {first(arts)})"

    return let(filter_(nodes, lambda n: f"{n}.tag = 'article'"), pick)


def head_nodes(nodes: str = NODES) -> str:
    """The first <head>'s subtree, or the whole document."""
    return let(first_tag(nodes, "head"), lambda h: f"CASE WHEN {h} IS NULL THEN {nodes} ELSE {subtree(h, nodes)} END")


def head_title(head: str) -> str:
    """First non-empty og:title / twitter:title content or <title> text, in
    document order."""
    picked = filter_(
        head,
        lambda n: f"(({n}.tag = 'meta' AND ({attr(n, 'property')} = 'og:title' OR {attr(n, 'name')} = 'twitter:title')) "
        f"OR {n}.tag = 'title')",
    )
    values = transform(
        picked,
        lambda n: f"CASE WHEN {n}.tag = 'meta' THEN {ws_normalize(attr(n, 'content'))} "
        f"ELSE {ws_normalize(f"coalesce({n}.raw, '')")} END",
    )
    return first(filter_(values, lambda v: f"{v} <> ''"))


def head_description(head: str) -> str:
    picked = filter_(
        head,
        lambda n: f"({n}.tag = 'meta' AND ({attr(n, 'name')} = 'description' OR {attr(n, 'property')} = 'og:description'))",
    )
    return first(filter_(transform(picked, lambda n: ws_normalize(attr(n, "content"))), lambda v: f"{v} <> ''"))


def head_canonical(head: str) -> str:
    """link[rel=canonical] href, else og:url / twitter:url content."""
    links = transform(
        filter_(head, lambda n: f"({n}.tag = 'link' AND {reads_as(attr(n, 'rel'), 'canonical')})"),
        lambda n: py_strip(attr(n, "href")),
    )
    metas = transform(
        filter_(head, lambda n: f"({n}.tag = 'meta' AND {attr(n, 'property')} IN ('og:url', 'twitter:url'))"),
        lambda n: py_strip(attr(n, "content")),
    )
    return (
        f"coalesce({first(filter_(links, lambda v: f"{v} <> ''"))}, "
        f"{first(filter_(metas, lambda v: f"{v} <> ''"))})"
    )


def keyword_list(content: str) -> str:
    return filter_(transform(f"split({content}, ',', -1)", ws_normalize), lambda k: f"{k} <> ''")


def head_keywords(head: str) -> str:
    """First keywords meta (name or itemprop, any case) with a non-empty list."""
    lists = transform(
        filter_(
            head,
            lambda n: f"({n}.tag = 'meta' AND ({reads_as(attr(n, 'name'), 'keywords')} "
            f"OR {reads_as(attr(n, 'itemprop'), 'keywords')}))",
        ),
        lambda n: keyword_list(attr(n, "content")),
    )
    return first(filter_(lists, lambda k: f"size({k}) > 0"))


def is_block(n: str, article: str) -> str:
    """A block of the article walk: a block tag with no block or skipped tag
    between it and the article."""
    return (
        f"(({n}.tag IN ('h1', 'h2', 'h3', 'p', 'figure', 'ul', 'ol', 'pre', 'blockquote') "
        f"OR ({n}.tag = 'span' AND {attr(n, 'data-tts-block')} = 'true')) "
        f"AND {n}.stop_anc < {article}.pos)"
    )


def first_href(li: str, nodes: str = NODES) -> str:
    hrefs = transform(filter_(subtree(li, nodes), lambda n: f"{n}.tag = 'a'"), lambda a: py_strip(attr(a, "href")))
    return first(filter_(hrefs, lambda h: f"{h} <> ''"))


def list_items(lst: str, nodes: str = NODES) -> str:
    """Items of a ul/ol (direct li children, else every li inside) with their
    1-based number, text and first link."""

    def items(below: str) -> str:
        direct = filter_(below, lambda n: f"({n}.tag = 'li' AND {n}.parent_pos = {lst}.pos)")
        any_li = filter_(below, lambda n: f"{n}.tag = 'li'")
        return let(direct, lambda d: f"CASE WHEN size({d}) > 0 THEN {d} ELSE {any_li} END")

    return transform(
        let(descendants(lst, nodes), items),
        lambda li, i: f"named_struct('num', {i} + 1, 'text', coalesce({li}.text, ''), 'href', {first_href(li, nodes)})",
        arity=2,
    )


def list_text(items: str, ordered: str) -> str:
    """'- x' / 'n. x' lines of the non-empty items (numbering keeps gaps)."""
    lines = transform(
        filter_(items, lambda it: f"{it}.text <> ''"),
        lambda it: f"concat(CASE WHEN {ordered} THEN concat(CAST({it}.num AS STRING), '.') ELSE '-' END, ' ', {it}.text)",
    )
    return f"array_join({lines}, {NL_SQL})"


def code_text(pre: str, nodes: str = NODES) -> str:
    """pre: first direct code child's raw text, else the pre's; edge newlines cut."""
    code = first(filter_(descendants(pre, nodes), lambda n: f"({n}.tag = 'code' AND {n}.parent_pos = {pre}.pos)"))
    return f"regexp_replace(coalesce({code}.raw, {pre}.raw, ''), {lit('^\\n+|\\n+$')}, '')"
