"""Page-level extraction: narrow projections over ``shredded`` rows.

Article choice, head metadata, title, intro, slug, links, infobox, lead figure
and the ordered block list are higher-order-function projections of the
page's own ``nodes`` array, so this stage never shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from folia.functions import nodes as N
from folia.functions.sql import exists, filter_, first, let, transform
from folia.functions.text import py_strip, ws_normalize
from folia.functions.urls import normalize_image_url, page_slug, parse_base, resolve_with


def figure_data(fig: str, nodes: str = N.NODES) -> str:
    """First img (src, else first srcset candidate), first figcaption, alt:
    named_struct(raw_src, caption, alt_text), null when there is no usable
    image.  The src is resolved later (``normalize_image_url``), once per
    kept figure, outside the array lambdas."""

    def with_img(img: str) -> str:
        src = py_strip(N.attr(img, "src"))
        srcset = py_strip(N.attr(img, "srcset"))
        raw_src = (
            f"CASE WHEN {src} <> '' THEN {src} "
            f"ELSE substring_index(substring_index({srcset}, ',', 1), ' ', 1) END"
        )
        caption_node = N.first_tag(N.descendants(fig, nodes), "figcaption")
        caption = f"nullif({caption_node}.text, '')"  # a node's text is normalised
        alt = f"nullif({ws_normalize(N.attr(img, 'alt'))}, '')"
        return let(
            raw_src,
            lambda s: f"CASE WHEN {img} IS NOT NULL AND {s} <> '' THEN named_struct("
            f"'raw_src', {s}, 'caption', {caption}, 'alt_text', {alt}) END",
        )

    return let(N.first_tag(N.descendants(fig, nodes), "img"), with_img)


def _block(n: str, base: str, nodes: str = N.NODES) -> str:
    is_list = f"{n}.tag IN ('ul', 'ol')"
    is_heading = f"{n}.tag IN ('h1', 'h2', 'h3')"
    parts = (
        f"named_struct('fig', CASE WHEN {n}.tag = 'figure' THEN {figure_data(n, nodes)} END, "
        f"'items', CASE WHEN {is_list} THEN {N.list_items(n, nodes)} END)"
    )

    def build(v: str) -> str:
        ordered = f"({n}.tag = 'ol')"
        kind = (
            f"CASE WHEN {is_heading} THEN 'heading' WHEN {n}.tag IN ('p', 'span') THEN 'paragraph' "
            f"WHEN {n}.tag = 'figure' THEN 'figure' WHEN {is_list} THEN 'list' "
            f"WHEN {n}.tag = 'pre' THEN 'code' ELSE 'blockquote' END"
        )
        text = (
            f"CASE WHEN {is_list} THEN {N.list_text(f'{v}.items', ordered)} "
            f"WHEN {n}.tag = 'pre' THEN {N.code_text(n, nodes)} "
            f"WHEN {n}.tag = 'figure' THEN '' ELSE coalesce({n}.text, '') END"
        )
        return (
            f"named_struct('bpos', {n}.pos, 'kind', {kind}, "
            f"'level', CASE WHEN {is_heading} THEN CAST(substring({n}.tag, 2, 1) AS INT) END, "
            f"'heading_id', CASE WHEN {is_heading} THEN nullif({N.attr(n, 'id')}, '') END, "
            f"'text', {text}, 'raw_src', {v}.fig.raw_src, 'caption', {v}.fig.caption, "
            f"'alt_text', {v}.fig.alt_text, 'ordered', {ordered}, 'items', {v}.items)"
        )

    return let(parts, build)


def article_blocks(article: str, base: str, nodes: str = N.NODES) -> str:
    """The article walk: ordered, non-empty blocks."""
    candidates = filter_(N.descendants(article, nodes), lambda n: N.is_block(n, article))
    built = transform(candidates, lambda n: _block(n, base, nodes))
    return filter_(
        built,
        lambda b: f"CASE WHEN {b}.kind = 'figure' THEN {b}.raw_src IS NOT NULL ELSE {b}.text <> '' END",
    )


def infobox(article: str, nodes: str = N.NODES) -> str:
    """dt/dd children of containers inside the article (article included),
    ordered by container then child; a dd counts when the dt/dd sibling just
    before it is a dt with a non-empty label and its own value is non-empty."""
    picked = transform(
        filter_(
            N.descendants(article, nodes),
            lambda n: f"({n}.tag IN ('dt', 'dd') AND {n}.parent_pos BETWEEN {article}.pos AND {article}.end_pos)",
        ),
        lambda n: f"named_struct('parent_pos', {n}.parent_pos, 'pos', {n}.pos, 'tag', {n}.tag, 'text', coalesce({n}.text, ''))",
    )

    def pairs(sorted_items: str) -> str:
        with_prev = transform(
            sorted_items,
            lambda p, i: f"named_struct('cur', {p}, 'prev', CASE WHEN {i} > 0 THEN element_at({sorted_items}, {i}) END)",
            arity=2,
        )
        kept = filter_(
            with_prev,
            lambda x: f"({x}.cur.tag = 'dd' AND {x}.cur.text <> '' AND {x}.prev IS NOT NULL AND {x}.prev.tag = 'dt' "
            f"AND {x}.prev.parent_pos = {x}.cur.parent_pos AND {x}.prev.text <> '')",
        )
        return transform(kept, lambda x: f"named_struct('label', {x}.prev.text, 'value', {x}.cur.text)")

    return let(f"sort_array({picked})", pairs)  # array_sort would compare by an interpreted lambda


def links(article: str, base: str, nodes: str = N.NODES) -> str:
    """Every a[href] in the article, stripped, resolved, unique in first-seen order."""
    hrefs = filter_(
        transform(filter_(N.descendants(article, nodes), lambda n: f"{n}.tag = 'a'"), lambda a: py_strip(N.attr(a, "href"))),
        lambda h: f"{h} <> ''",
    )
    return f"array_distinct({transform(hrefs, lambda h: resolve_with(base, h))})"


def lead_figure_raw(article: str, blocks: str, nodes: str = N.NODES) -> str:
    """The first figure of the article with a usable image (src unresolved).

    Usually that is the first usable figure block, already built; only when
    a figure that is not a block (inside a paragraph, list or skipped tag)
    comes before it are all figures of the article examined."""
    figures = filter_(N.descendants(article, nodes), lambda n: f"{n}.tag = 'figure'")
    everything = first(filter_(transform(figures, lambda f: figure_data(f, nodes)), lambda f: f"{f} IS NOT NULL"))

    def pick(cand: str) -> str:
        hidden_before = exists(
            figures,
            lambda f: f"(({cand} IS NULL OR {f}.pos < {cand}.bpos) AND NOT {N.is_block(f, article)})",
        )
        return (
            f"CASE WHEN {hidden_before} THEN {everything} WHEN {cand} IS NOT NULL THEN "
            f"named_struct('raw_src', {cand}.raw_src, 'caption', {cand}.caption, 'alt_text', {cand}.alt_text) END"
        )

    return let(first(filter_(blocks, lambda b: f"{b}.kind = 'figure'")), pick)


def page_frame(shredded: DataFrame) -> DataFrame:
    """shredded -> one row per page with every page-level field.

    Columns: page_id, url (page URL), source_url, slug, title, intro_text,
    canonical_url, description, keywords, head_title, lead_figure, infobox,
    links, blocks, quarantine (null for good pages), parse_error, nodes.
    """
    df = shredded.selectExpr(
        "page_id", "url AS source_url", "nodes", "parse_error",
        f"{N.select_article()} AS article",
        f"{N.head_nodes()} AS _head",
    )
    df = df.selectExpr(
        "*",
        f"{N.head_title('_head')} AS head_title",
        f"{N.head_description('_head')} AS description",
        f"{N.head_canonical('_head')} AS canonical_url",
        f"{N.head_keywords('_head')} AS keywords",
    ).drop("_head")
    df = df.selectExpr("*", "coalesce(nullif(source_url, ''), canonical_url, '') AS url")
    df = df.selectExpr("*", f"{parse_base('url')} AS _base")
    df = df.selectExpr(
        "*",
        f"{article_blocks('article', '_base')} AS blocks",
        f"{infobox('article')} AS infobox",
        f"{links('article', '_base')} AS links",
        f"{page_slug('url')} AS slug",
    )
    df = df.selectExpr("*", f"{lead_figure_raw('article', 'blocks')} AS _lead")
    first_h2 = first(transform(filter_("blocks", lambda b: f"({b}.kind = 'heading' AND {b}.level = 2)"), lambda b: f"{b}.bpos"))
    df = df.selectExpr("*", f"{first_h2} AS _first_h2")
    # read from the nodes: a job that needs no blocks builds none for its titles
    h1 = first(filter_(
        N.descendants("article"), lambda n: f"({n}.tag = 'h1' AND coalesce({n}.text, '') <> '' AND {N.is_block(n, 'article')})"))
    intro = first(filter_("blocks", lambda b: f"({b}.kind = 'paragraph' AND (_first_h2 IS NULL OR {b}.bpos < _first_h2))"))
    df = df.selectExpr(
        "*", f"coalesce({h1}.text, head_title) AS title", f"{intro}.text AS intro_text",
        f"CASE WHEN _lead IS NOT NULL THEN named_struct('image_url', "
        f"{normalize_image_url('_lead.raw_src', '_base', parsed_base=True)}, "
        f"'caption', _lead.caption, 'alt_text', _lead.alt_text) END AS lead_figure",
    )
    return df.selectExpr(
        "page_id", "url", "source_url", "slug", "title", "intro_text", "canonical_url", "description",
        "keywords", "head_title", "lead_figure", "infobox", "links", "blocks",
        f"{_quarantine('article IS NULL')} AS quarantine", "parse_error", "nodes",
    )


def _quarantine(no_article: str) -> str:
    # No partition has a negative number. A nondeterministic expression keeps Spark from pushing filters on
    # the quarantine below, where the title, and with it all blocks, would be built a second time.
    return (
        f"CASE WHEN spark_partition_id() < 0 THEN NULL WHEN parse_error IS NOT NULL THEN 'unparsable' WHEN {no_article} THEN 'no_article' "
        "WHEN title IS NULL OR title = '' THEN 'no_title' END"
    )


def frame_of_fields(fields: DataFrame) -> DataFrame:
    """``page_frame`` from the fields that ``operators.fields`` reads beside the
    tokenizer (has_article, title and canonical_url at least): the same columns as far as
    their fields are given, the other fields, and the parsed page URL ``_base``."""
    df = fields.withColumnRenamed("url", "source_url")
    df = df.selectExpr("*", "coalesce(nullif(source_url, ''), canonical_url, '') AS url")
    df = df.selectExpr("*", f"{parse_base('url')} AS _base", f"{page_slug('url')} AS slug")
    made = []
    if "hrefs" in df.columns:
        made.append(f"array_distinct({transform('hrefs', lambda h: resolve_with('_base', h))}) AS links")
    if "lead" in df.columns:
        made.append(f"CASE WHEN lead IS NOT NULL THEN named_struct('image_url', {normalize_image_url('lead.raw_src', '_base', parsed_base=True)}, "
                    "'caption', lead.caption, 'alt_text', lead.alt_text) END AS lead_figure")
    return df.selectExpr("*", *made, f"{_quarantine('NOT has_article')} AS quarantine").drop("hrefs", "lead", "has_article")
