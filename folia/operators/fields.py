"""Page fields read from a page's nodes while the shred stage has them at hand.

``page_fields`` is the shred stage with another output: instead of the nodes it
writes the fields that page records are made of, and only those asked for.
The rules are those of ``extract.page_frame``, which reads the same
fields from shredded rows with expressions; tests hold the two together. URLs
are left as they stand in the page: resolving them, and all that follows, is
done by expressions on these columns.
"""

from __future__ import annotations

import re
import sys
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from folia.operators.shred import BATCH_CHARS, _Nodes, _shred_into, dealt
from folia.session import ship_by_value

_FIGURE = pa.struct([("raw_src", pa.string()), ("caption", pa.string()), ("alt_text", pa.string())])
_ITEM = pa.struct([("num", pa.int32()), ("text", pa.string()), ("href", pa.string())])
_BLOCK = pa.struct([
    ("bpos", pa.int32()), ("kind", pa.string()), ("level", pa.int32()), ("heading_id", pa.string()), ("text", pa.string()),
    ("raw_src", pa.string()), ("caption", pa.string()), ("alt_text", pa.string()), ("ordered", pa.bool_()), ("items", pa.list_(_ITEM)),
])
_SUB = pa.struct([("id", pa.string()), ("title", pa.string()), ("text", pa.string()), ("figures", pa.list_(_FIGURE))])

#: The fields a page can be read into.
FIELD_TYPES = {
    "has_article": pa.bool_(),
    "head_title": pa.string(),
    "description": pa.string(),
    "canonical_url": pa.string(),
    "keywords": pa.list_(pa.string()),
    "title": pa.string(),
    "intro_text": pa.string(),
    "lead": _FIGURE,
    "infobox": pa.list_(pa.struct([("label", pa.string()), ("value", pa.string())])),
    "hrefs": pa.list_(pa.string()),
    "blocks": pa.list_(_BLOCK),
    "tree": pa.list_(pa.struct([*_SUB, ("subs", pa.list_(_SUB))])),
    "heads": pa.list_(pa.struct([("level", pa.int32()), ("title", pa.string()), ("opens", pa.bool_()), ("sec", pa.int32())])),
    "refs": pa.list_(pa.struct([("index", pa.int32()), ("text", pa.string()), ("url", pa.string())])),
    "scripts": pa.list_(pa.string()),
}

#: The node tags that the article, the title and the head fields are made of, and the further ones of the other fields.
BASE_TAGS = frozenset(["head", "title", "meta", "link", "article", "h1", "h2", "h3"])
_LISTS = frozenset(["ul", "ol", "li"])
_FIGURES = frozenset(["figure", "img", "figcaption"])
FIELD_TAGS = {
    "infobox": frozenset(["dt", "dd"]),
    "hrefs": frozenset(["a"]),
    "lead": _FIGURES,
    "scripts": frozenset(["script"]),
    "intro_text": frozenset(["p", "span"]),
    "refs": _LISTS | {"a"},
    "tree": frozenset(["p", "span", "blockquote", "pre", "code"]) | _LISTS | _FIGURES,
    "blocks": frozenset(["p", "span", "blockquote", "pre", "code", "a"]) | _LISTS | _FIGURES,
}

# Places in a node (see ``shred.NODE_TYPE``).
_IDX, _SPAN, _POS, _END_POS, _PARENT_POS, _DEPTH, _TAG, _ATTRS, _TEXT, _RAW, _STOP_ANC, _FIRST_HREF = range(12)
_KINDS = {"h1": "heading", "h2": "heading", "h3": "heading", "p": "paragraph", "span": "paragraph", "figure": "figure",
          "ul": "list", "ol": "list", "pre": "code", "blockquote": "blockquote"}
# Line breaks at the ends of code: Java's ``^\n+|\n+$``, whose ``$`` also stands before a last line terminator.
_EDGE_LINES = re.compile("^\n+|\n+(?=(?:\r\n|[\r\x85  ])?\\Z)")


def _normal(text: str) -> str:
    return " ".join(text.split())


def _article(rows: list[list]) -> list | None:
    """First article whose class contains text-[16px]; else the first with an
    h1 and a "references" h2/h3 inside; else the first."""
    articles = [n for n in rows if n[_TAG] == "article"]
    for n in articles:
        if "text-[16px]" in n[_ATTRS].get("class", ""):
            return n
    for n in articles:
        below = rows[n[_IDX]:n[_IDX] + n[_SPAN] - 1]
        if any(m[_TAG] == "h1" for m in below) and any(
                m[_TAG] in ("h2", "h3") and (m[_TEXT] or "").lower() == "references" for m in below):
            return n
    return articles[0] if articles else None


def _head(rows: list[list]) -> dict:
    """Title, description, canonical URL and keywords of the first <head>, or
    of a document without one."""
    title = description = link_url = meta_url = words = None
    head = next((n for n in rows if n[_TAG] == "head"), None)
    for n in rows if head is None else rows[head[_IDX]:head[_IDX] + head[_SPAN] - 1]:
        tag = n[_TAG]
        if tag == "meta":
            attrs = n[_ATTRS]
            prop, name, content = attrs.get("property", ""), attrs.get("name", ""), attrs.get("content", "")
            if title is None and (prop == "og:title" or name == "twitter:title"):
                title = _normal(content) or None
            if description is None and (name == "description" or prop == "og:description"):
                description = _normal(content) or None
            if meta_url is None and prop in ("og:url", "twitter:url"):
                meta_url = content.strip() or None
            if words is None and (name.lower() == "keywords" or attrs.get("itemprop", "").lower() == "keywords"):
                words = [w for w in map(_normal, content.split(",")) if w] or None
        elif tag == "title":
            if title is None:
                title = _normal(n[_RAW] or "") or None
        elif tag == "link" and link_url is None and n[_ATTRS].get("rel", "").lower() == "canonical":
            link_url = n[_ATTRS].get("href", "").strip() or None
    return {"head_title": title, "description": description, "canonical_url": meta_url if link_url is None else link_url, "keywords": words}


def _figure(rows: list[list], fig: list) -> tuple | None:
    """(raw_src, caption, alt_text) of the first img (src, else first srcset
    candidate) and the first figcaption; None without a usable image."""
    img = caption = None
    for n in rows[fig[_IDX]:fig[_IDX] + fig[_SPAN] - 1]:
        if img is None and n[_TAG] == "img":
            img = n[_ATTRS]
        elif caption is None and n[_TAG] == "figcaption":
            caption = n
    if img is None:
        return None
    src = img.get("src", "").strip() or img.get("srcset", "").strip().split(",", 1)[0].split(" ", 1)[0]
    return (src, caption and caption[_TEXT] or None, _normal(img.get("alt", "")) or None) if src else None


def _items(rows: list[list], lst: list) -> list[tuple]:
    """(num, text, href) of the direct items of a list, else of every item inside."""
    below = rows[lst[_IDX]:lst[_IDX] + lst[_SPAN] - 1]
    every = [n for n in below if n[_TAG] == "li"]
    found = []
    for num, li in enumerate([n for n in every if n[_PARENT_POS] == lst[_POS]] or every, 1):
        href = None
        if li[_SPAN] > 1:
            for n in rows[li[_IDX]:li[_IDX] + li[_SPAN] - 1]:
                if n[_TAG] == "a":
                    href = n[_ATTRS].get("href", "").strip() or None
                    if href:
                        break
        found.append((num, li[_TEXT] or "", href))
    return found


def _code(rows: list[list], pre: list) -> str:
    code = next((n for n in rows[pre[_IDX]:pre[_IDX] + pre[_SPAN] - 1] if n[_TAG] == "code" and n[_PARENT_POS] == pre[_POS]), None)
    text = pre[_RAW] if code is None or code[_RAW] is None else code[_RAW]
    return _EDGE_LINES.sub("", text or "")


def _blocks(rows: list[list], article: list) -> list[tuple]:
    """The article walk: ordered, non-empty blocks."""
    found, start = [], article[_POS]
    for n in rows[article[_IDX]:article[_IDX] + article[_SPAN] - 1]:
        if n[_STOP_ANC] >= start:
            continue
        tag = n[_TAG]
        kind = _KINDS.get(tag)
        if kind is None or (tag == "span" and n[_ATTRS].get("data-tts-block", "") != "true"):
            continue
        if kind == "figure":
            fig = _figure(rows, n)
            if fig is not None:
                found.append((n[_POS], kind, None, None, "", *fig, False, None))
        elif kind == "list":
            items = _items(rows, n)
            if tag == "ol":
                text = "\n".join([f"{num}. {text}" for num, text, _ in items if text])
            else:
                text = "\n".join([f"- {text}" for _, text, _ in items if text])
            if text:
                found.append((n[_POS], kind, None, None, text, None, None, None, tag == "ol", items))
        elif kind == "heading":
            if n[_TEXT]:
                found.append((n[_POS], kind, int(tag[1]), n[_ATTRS].get("id") or None, n[_TEXT], None, None, None, False, None))
        else:
            text = _code(rows, n) if kind == "code" else n[_TEXT]
            if text:
                found.append((n[_POS], kind, None, None, text, None, None, None, False, None))
    return found


def _sections(blocks: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """The tree of h2 sections with their h3 sections - an h3 before any other
    heading opens a synthetic "Overview" -, each with the text and the figures
    up to the next heading; and the references: items of the lists under
    "References" headings, whose index is items kept from earlier lists + the
    item's place in its own list, empty items counted."""
    tree, refs, kept = [], [], 0
    parts = figures = None  # of the heading last met
    referring = False
    for b in blocks:
        kind = b[1]
        if kind == "heading":
            level, title = b[2], b[4]
            if level == 1:
                continue
            parts, figures, referring = [], [], title.lower() == "references"
            if level == 2:
                tree.append((b[3], title, parts, figures, []))
            else:
                if not tree:
                    tree.append((None, "Overview", [], [], []))
                tree[-1][4].append((b[3], title, parts, figures))
        elif parts is None:
            continue
        elif kind == "figure":
            figures.append(b[5:8])
        else:
            parts.append(b[4])
            if referring and kind == "list":
                filled = [(kept + num, text, href) for num, text, href in b[9] if text]
                refs += filled
                kept += len(filled)
    return [(key, title, "\n\n".join(own), figs, [(k, t, "\n\n".join(p), f) for k, t, p, f in subs]) for key, title, own, figs, subs in tree], refs


def _heads(blocks: list[tuple]) -> list[tuple]:
    """The h2/h3 headings in order: level, title, whether it opens a section
    and the section's number."""
    found: list[tuple] = []
    for b in blocks:
        if b[2] == 2 or b[2] == 3:
            opens = b[2] == 2 or not found
            found.append((b[2], b[4], opens, (found[-1][3] if found else 0) + opens))
    return found


def _infobox(below: list[list]) -> list[tuple]:
    """(label, value): a dd counts when the dt/dd sibling just before it is a
    dt with a label and its own value is not empty; ordered by container, then child."""
    found, before = [], None
    for n in sorted([(n[_PARENT_POS], n[_POS], n[_TAG], n[_TEXT]) for n in below if n[_TAG] == "dt" or n[_TAG] == "dd"]):
        if n[2] == "dd" and n[3] and before and before[2] == "dt" and before[0] == n[0] and before[3]:
            found.append((before[3], n[3]))
        before = n
    return found


def read_fields(rows: list[list], wanted: frozenset[str]) -> dict:
    """The fields ``wanted`` of a page's nodes, by name; None where there is none."""
    found: dict = _head(rows)
    article = _article(rows)
    found["has_article"] = article is not None
    if "scripts" in wanted:
        found["scripts"] = [n[_RAW] for n in rows if n[_TAG] == "script" and n[_RAW]]
    found["title"] = found["head_title"]
    if article is None:
        return found
    below, start = rows[article[_IDX]:article[_IDX] + article[_SPAN] - 1], article[_POS]
    if "title" in wanted:
        found["title"] = next((n[_TEXT] for n in below if n[_TAG] == "h1" and n[_TEXT] and n[_STOP_ANC] < start), found["head_title"])
    if "infobox" in wanted:
        found["infobox"] = _infobox(below)
    if "hrefs" in wanted:
        found["hrefs"] = list(dict.fromkeys([h for h in [n[_ATTRS].get("href", "").strip() for n in below if n[_TAG] == "a"] if h]))
    if "lead" in wanted:
        found["lead"] = next((f for f in (_figure(rows, n) for n in below if n[_TAG] == "figure") if f), None)
    if not wanted.isdisjoint(("blocks", "tree", "heads", "refs", "intro_text")):
        found["blocks"] = blocks = _blocks(rows, article)
        found["tree"], found["refs"] = _sections(blocks)
        if "heads" in wanted:
            found["heads"] = _heads(blocks)
        for b in blocks:
            if b[1] == "paragraph":
                found["intro_text"] = b[4]
            if b[1] == "paragraph" or b[2] == 2:
                break
    return found


def _array(values: list, kind: pa.DataType) -> pa.Array:
    """Python values as an Arrow array; of a struct, tuples in field order."""
    if pa.types.is_list(kind):
        starts, flat = [], []
        for v in values:
            if v is None:
                starts.append(None)
            else:
                starts.append(len(flat))
                flat += v
        starts.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), _array(flat, kind.value_type), type=kind)
    if pa.types.is_struct(kind):
        missing = [v is None for v in values]
        mask = None
        if any(missing):
            none = (None,) * kind.num_fields
            values, mask = [none if v is None else v for v in values], pa.array(missing, pa.bool_())
        columns = list(zip(*values)) or [()] * kind.num_fields
        return pa.StructArray.from_arrays([_array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind), mask=mask)
    return pa.array(values, kind)


def _batches(names: list[str], tags: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), *((name, FIELD_TYPES[name]) for name in names), ("parse_error", pa.string())])
    wanted = frozenset(names)

    def made(pages: pa.RecordBatch, found: list[dict], errors: list[str | None]) -> pa.RecordBatch:
        columns = [_array([f.get(name) for f in found], FIELD_TYPES[name]) for name in names]
        arrays = [pages.column("page_id").cast(pa.int64()), pages.column("url").cast(pa.string()), *columns, pa.array(errors, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, errors, size, done = [], [], 0, 0
            for n, html in enumerate(batch.column("html"), 1):
                text, out = html.as_py(), _Nodes()
                errors.append(_shred_into(out, text, False, tags))
                found.append(read_fields(out.rows, wanted))
                size += len(text or "")
                if size > BATCH_CHARS:
                    yield made(batch.slice(done, n - done), found, errors)
                    found, errors, size, done = [], [], 0, n
            yield made(batch.slice(done), found, errors)

    return run


def _spark_type(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_spark_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{','.join(f'{f.name}:{_spark_type(f.type)}' for f in kind)}>"
    return {pa.string(): "string", pa.int32(): "int", pa.bool_(): "boolean"}[kind]


def page_fields(pages: DataFrame, *names: str, partitions: int | None = None) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, the fields ``names`` (all, if
    none is given) in their order, parse_error. What ``shred`` says of the scan's partitions
    holds here as well."""
    chosen = list(names or FIELD_TYPES)
    tags = BASE_TAGS.union(*(FIELD_TAGS.get(name, ()) for name in chosen))
    schema = ", ".join(["page_id long", "url string", *(f"{name} {_spark_type(FIELD_TYPES[name])}" for name in chosen), "parse_error string"])
    return dealt(pages, partitions).mapInArrow(_batches(chosen, tags), schema)


# Python workers need not have the package installed: the stage's code goes with the task.
ship_by_value(sys.modules[__name__])
