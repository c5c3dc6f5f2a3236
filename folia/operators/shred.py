"""``shred``: the one Python stage of the engine.

Each HTML page is tokenised with the standard-library ``HTMLParser`` inside a
``mapInArrow`` task and folded into a flat, pre-order ``nodes`` array (interval
encoding).  Everything downstream reads that array with Catalyst expressions.

Tree rules (they decide every extracted value):

* tags and attribute names are lower-cased; a valueless attribute is ``""``
  and, for a duplicated attribute, the last value wins;
* void tags are never opened and any self-closed tag (``<div/>``) is a leaf;
* an end tag closes the nearest open element with that tag and everything
  opened after it; an end tag with no open match is ignored; nothing is ever
  closed implicitly, so ``<p>a<p>b`` nests;
* character references are decoded, script and style are raw text;
* the tokenizer is fed but never closed, so an unterminated trailing tag is
  lost, as is an unterminated script.

The fold is iterative and linear: all text of a page lies in two shared lists
of pieces, an open element only remembers where its part began, and text is
joined only for the nodes that a later stage can read. Unclosed ``<p>`` or
``<li>`` runs, which nest, therefore cost no more than closed ones.
"""

from __future__ import annotations

import re
import sys
from html import unescape
from html.parser import HTMLParser
from operator import itemgetter
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folia.session import ship_by_value

# HTML void elements, inline-skipped tags, subtree-skipped tags
# and the block tags at which the block walk stops descending.
VOID_TAGS = frozenset(
    ["area", "base", "br", "col", "embed", "hr", "img", "input", "link",
     "meta", "param", "source", "track", "wbr"]
)
SKIP_INLINE_TAGS = frozenset(["button", "script", "style", "svg", "path", "noscript"])
SKIP_SUBTREE_TAGS = frozenset(["script", "style", "noscript"])
BLOCK_TAGS = frozenset(["h1", "h2", "h3", "p", "figure", "ul", "ol", "pre", "blockquote"])

# Tags written to ``nodes``; other elements only shape pos/end_pos/parent_pos.
EMIT_TAGS = frozenset(
    ["head", "title", "meta", "link", "article", "h1", "h2", "h3", "p", "span",
     "figure", "img", "figcaption", "ul", "ol", "li", "pre", "code",
     "blockquote", "dt", "dd", "a", "script"]
)
_STOP_TAGS = BLOCK_TAGS | SKIP_SUBTREE_TAGS
#: A script is only read where its text holds this call.
PUSH_MARK = "self.__next_f.push("
#: Output batches are closed at about this many characters of HTML.
BATCH_CHARS = 4 << 20

NODE_TYPE = pa.struct(
    [
        ("idx", pa.int32()),        # 1-based index in the nodes array
        ("span", pa.int32()),       # emitted nodes in the subtree, self included
        ("pos", pa.int32()),        # pre-order number over all elements
        ("end_pos", pa.int32()),    # largest pos inside the subtree
        ("parent_pos", pa.int32()),  # pos of the parent element (-1 = document)
        ("depth", pa.int32()),
        ("tag", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
        ("raw", pa.string()),
        ("stop_anc", pa.int32()),   # pos of the nearest block/skip ancestor
        ("first_href", pa.string()),  # of an anchor with several, the first that is not empty
    ]
)
OUT_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()),
     ("nodes", pa.list_(NODE_TYPE)), ("parse_error", pa.string())]
)
SPARK_SCHEMA = (
    "page_id long, url string, nodes array<struct<idx:int,span:int,pos:int,end_pos:int,"
    "parent_pos:int,depth:int,tag:string,attrs:map<string,string>,text:string,raw:string,"
    "stop_anc:int,first_href:string>>, parse_error string"
)


def _norm(text: str) -> str:
    return " ".join(text.split())


# An open element is a list: its tag and pos, the pos of the nearest block or
# skipped tag and of the article around what it holds, the lengths of the piece
# lists when it was opened, its row of the nodes if it is written, whether its
# text is read, an anchor's href, and of its children: the last dt or dd,
# whether one is a li, and (of a figure) whether its caption was found.
(_O_TAG, _O_POS, _O_STOP, _O_ARTICLE, _O_INL, _O_RAW, _O_NODE, _O_WANTED, _O_HREF, _O_DEFINITION, _O_ITEMS,
 _O_CAPTIONED) = range(12)
_LISTS = ("ul", "ol")
#: Open elements of these tags are looked up by ``_reads``.
_LOOKED_UP = frozenset([*_LISTS, "figure"])
#: Leaves that change the text around them when they end.
_LEAF_TEXT = frozenset(["a", "code"])
#: Written elements of which no text is read.
_TEXTLESS = frozenset(["head", "meta", "link", "article", "figure", "img", "ul", "ol", "a"])
_position = itemgetter(_O_POS)


def _loud(tags: frozenset[str]) -> frozenset[str]:
    """The tags whose elements do more than shape the tree when only ``tags``
    are written."""
    if tags not in _louds:
        _louds[tags] = tags.union(_LOOKED_UP, ("span", "br", "article", "a"), ("dt", "dd") if "dd" in tags else (), ("li",) if "li" in tags else ())
    return _louds[tags]


_louds: dict[frozenset[str], frozenset[str]] = {}


_FIELDS = [field.name for field in NODE_TYPE]
_SPAN, _END_POS, _TAG, _ATTRS, _TEXT, _RAW, _STOP_ANC = map(_FIELDS.index, ("span", "end_pos", "tag", "attrs", "text", "raw", "stop_anc"))


class _Nodes:
    """The nodes of a batch of pages: ``rows`` has a list of the fields of
    NODE_TYPE for each, with ``attrs`` a dict."""

    def __init__(self) -> None:
        self.rows: list[list] = []

    def cut(self, n: int) -> None:
        """Forget all nodes after the first ``n``."""
        del self.rows[n:]

    def dicts(self) -> list[dict]:
        return [dict(zip(_FIELDS, row), attrs=list(row[_ATTRS].items())) for row in self.rows]

    def array(self) -> pa.StructArray:
        columns = list(zip(*self.rows)) or [()] * len(_FIELDS)
        ends, keys, values = [0], [], []
        for attrs in columns[_ATTRS]:
            if attrs:
                keys.extend(attrs)
                values.extend(attrs.values())
            ends.append(len(keys))
        attrs = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
        arrays = [attrs if f.name == "attrs" else pa.array(c, f.type) for c, f in zip(columns, NODE_TYPE)]
        return pa.StructArray.from_arrays(arrays, fields=list(NODE_TYPE))


# Text up to a plain token, and that token: a tag whose attributes have quoted
# values or none, an end tag, a comment without ">", a doctype. On these the
# tokenizer's rules leave no choice, so they need not go through its states.
_OPENED = r"""[a-zA-Z][a-zA-Z0-9-]*+)((?:[ \t\n\r\f]++[a-zA-Z_:@][-\w:.@]*+(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+'))?+)*+)[ \t\n\r\f]*+"""
_OTHERS = r"""/([a-zA-Z][a-zA-Z0-9]*+)>|!--[^>]*?-->|![dD][oO][cC][tT][yY][pP][eE][^>]*+>"""
_PLAIN = re.compile(rf"([^<]*+)<(?:({_OPENED}(/?)>|{_OTHERS})")
_ATTRIBUTE = re.compile(r"""([^\s=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'))?""")

#: How deep elements may nest in what ``_after_quiet`` passes over.
_QUIET_DEPTH = 3


#: The group of ``_after_quiet`` that has the text of a whole element.
_CONTENT = _QUIET_DEPTH + 5

_quiet: dict[frozenset[str], re.Pattern] = {}  # a cache by functools would not be shipped by value


def _after_quiet(tags: frozenset[str]) -> re.Pattern:
    """A plain token, or the whole of an element that holds nothing but text,
    behind any number of whole elements, opened and closed by
    plain tags, of which neither they nor what they hold is written when only
    ``tags`` are. Where no text is read, such an element leaves nothing but
    its numbers: it opens and closes, and only a node, or a list or figure
    still open, can tell it was there. No step back is ever taken into what
    was passed, and an element tried in vain has been read to a fixed depth:
    the work stays linear."""
    if tags in _quiet:
        return _quiet[tags]
    noisy = tags.union(HTMLParser.CDATA_CONTENT_ELEMENTS, ("dt", "dd") if "dd" in tags else ())
    attributes = r"""(?:[ \t\n\r\f]++[a-zA-Z_:@][-\w:.@]*+(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"[^"<]*+"|'[^'<]*+'))?+)*+[ \t\n\r\f]*+"""
    opened = rf"<(?!(?:{'|'.join(sorted(noisy | VOID_TAGS))})[ \t\n\r\f/>])(?P<%s>[a-z][a-z0-9]*+){attributes}>[^<]*+"
    leaves = sorted(VOID_TAGS - noisy)
    leaf = element = rf"<(?:{'|'.join(leaves)})(?![-a-zA-Z0-9]){attributes}/?>" if leaves else r"(?!)"
    for depth in range(_QUIET_DEPTH):
        element = f"(?:{opened % f'q{depth}'}(?:{element}[^<]*+)*+</(?P=q{depth})>|{leaf})"
    whole = rf"(?P<whole>{_OPENED}(?:(/)>|>(?:([^<]*+)</(?P=whole)>)?+)"
    _quiet[tags] = re.compile(rf"((?:[^<]*+{element})*+)[^<]*+<(?:{whole}|{_OTHERS})")
    return _quiet[tags]


class _Folder(HTMLParser):
    """Writes the flat nodes of a page to ``out`` while tokens stream in."""

    def __init__(self, out: _Nodes, keep_all: bool = False, tags: frozenset[str] = EMIT_TAGS) -> None:
        super().__init__(convert_charrefs=True)
        self.keep_all, self.tags = keep_all, tags
        self.out = out
        self.first = len(out.rows)
        self.count = 0
        self.reading = 0  # open elements whose text is read; without any, pieces are not kept
        self.inl: list[str] = []
        self.raw: list[str] = []
        self.path: list[list] = [["", -1, -1, -1, 0, 0, None, False, None, "", False, False]]
        self.open_count: dict[str, int] = {}
        self.open_at: dict[str, list[list]] = {tag: [] for tag in _LOOKED_UP}

    def feed(self, data):
        """The plain tokens that ``data`` begins with, read here; the rest,
        from the first other one on, goes through the tokenizer."""
        at, plain = 0, _PLAIN.match
        path, count, inl, raw = self.path, self.open_count, self.inl, self.raw
        loud, silent_links = None if self.keep_all else _loud(self.tags), "a" not in self.tags
        whole = self.keep_all
        after_quiet = None if whole else _after_quiet(self.tags).match
        while True:
            if whole or self.reading:
                found = plain(data, at)
                if found is None:
                    break
                text, tag, attrs, leaf, closed = found.groups()
                content = None
            else:
                found = after_quiet(data, at)
                if found is None:
                    break
                passed, _, _, _, tag, attrs, leaf, content, closed = found.groups()
                text = None
                if passed:
                    self.count += passed.count("<") - passed.count("</")
                    at += len(passed)
            body, end = None, found.end()
            if tag:
                tag = tag.lower()
                if tag in self.CDATA_CONTENT_ELEMENTS and not leaf:
                    if content is not None:  # read again below, by its own rules
                        end, content = found.start(_CONTENT), None
                    self.set_cdata_mode(tag)
                    body = self.interesting.search(data, end)
                    self.clear_cdata_mode()
                    if body is None or body[0][-1] != ">":
                        break
            at = end
            if text and self.reading:
                if "&" in text:
                    text = unescape(text)
                inl.append(text)
                raw.append(text)
            if tag and body is None and loud is not None and (tag not in loud or (tag == "a" and silent_links and not self.reading)):
                pos = self.count
                self.count = pos + 1
                if content is None and not leaf and tag not in VOID_TAGS:
                    here = path[-1]
                    count[tag] = count.get(tag, 0) + 1
                    path.append([tag, pos, pos if tag in _STOP_TAGS else here[_O_STOP], here[_O_ARTICLE], len(inl), len(raw),
                                 None, False, "", "", False, False])
            elif tag:
                attr_map, several = {}, None
                if attrs:
                    pairs = _ATTRIBUTE.findall(attrs)
                    for name, double, single in pairs:
                        value = double or single
                        attr_map[name.lower()] = unescape(value) if "&" in value else value
                    if len(pairs) > len(attr_map):
                        several = [(name.lower(), unescape(double or single)) for name, double, single in pairs]
                self._begin(tag, attr_map, several, leaf or tag in VOID_TAGS, content)
                if body is not None:
                    if body.start() > at:
                        self.handle_data(data[at:body.start()])
                    self.handle_endtag(tag)
                    at = body.end()
            elif closed:
                closed = closed.lower()
                here = path[-1]
                if here[_O_TAG] == closed:
                    if here[_O_NODE] is None and not self.reading and closed not in _LOOKED_UP:
                        path.pop()
                        count[closed] -= 1
                    else:
                        self._end_last(True)
                else:
                    self.handle_endtag(closed)
        if at < len(data):
            super().feed(data[at:])

    def handle_data(self, data):
        if self.reading:
            self.inl.append(data)
            self.raw.append(data)

    def handle_startendtag(self, tag, attrs):
        self._from_tokenizer(tag, attrs, True)

    def handle_starttag(self, tag, attrs):
        self._from_tokenizer(tag, attrs, tag in VOID_TAGS)

    def handle_endtag(self, tag):
        if self.open_count.get(tag):
            path = self.path
            while path[-1][_O_TAG] != tag:
                self._end_last(False)
            self._end_last(True)

    def _from_tokenizer(self, tag, attrs, leaf):
        attr_map = {name: value or "" for name, value in attrs}
        self._begin(tag, attr_map, attrs if len(attrs) > len(attr_map) else None, leaf)

    def _begin(self, tag, attr_map, several, leaf, content=None):
        """``several`` has all attributes where a name is given twice; a
        ``leaf`` ends at once. ``content`` is the text of an element whose end
        tag was read with it, while no text around it is read."""
        parent, pos = self.path[-1], self.count
        self.count = pos + 1
        spoken = tag == "span" and attr_map.get("data-tts-block") == "true"
        stop = parent[_O_STOP]
        node, wanted = None, False
        if self.keep_all or (tag in self.tags and (spoken or tag != "span")):
            out = self.out
            href = next((v for name, v in several if name == "href" and v), None) if several and tag == "a" else None
            node = [len(out.rows) - self.first + 1, 1, pos, pos, parent[_O_POS], len(self.path), tag, attr_map, None, None, stop, href]
            out.rows.append(node)
            wanted = tag not in _TEXTLESS and self._reads(tag, spoken, parent)
        if tag == "br" and self.reading:
            self.inl.append("\n")
        if tag == "dt" or tag == "dd":
            parent[_O_DEFINITION] = tag
        elif tag == "li":
            parent[_O_ITEMS] = True
        if content is not None:
            if wanted:
                self._write_whole(node, parent[_O_ARTICLE], unescape(content) if "&" in content else content)
            return
        if leaf and not wanted and (tag not in _LEAF_TEXT or not self.reading):
            return
        here = [
            tag, pos, pos if spoken or tag in _STOP_TAGS else stop, pos if tag == "article" else parent[_O_ARTICLE],
            len(self.inl), len(self.raw), node, wanted, attr_map.get("href", "") if tag == "a" else None, "", False, False,
        ]
        self.reading += wanted
        self.open_count[tag] = self.open_count.get(tag, 0) + 1
        if tag in _LOOKED_UP:
            self.open_at[tag].append(here)
        self.path.append(here)
        if leaf:
            self._end_last(False)

    def _reads(self, tag, spoken, parent) -> bool:
        """Whether some later stage can read this node's text or raw text."""
        if spoken or tag in ("h1", "h2", "h3", "p", "blockquote", "pre"):
            # a block of an article (or of a page without one): no block in between
            return parent[_O_STOP] <= parent[_O_ARTICLE] or tag in ("h2", "h3")
        if tag == "li":  # a list's own items; where it has none, every item inside
            lists = [self.open_at[kind][-1] for kind in _LISTS if self.open_at[kind]]
            return parent[_O_TAG] in _LISTS or not lists or not max(lists, key=_position)[_O_ITEMS]
        if tag == "dd":
            return parent[_O_DEFINITION] == "dt"
        if tag == "figcaption":  # the first one of some open figure
            bare = [figure for figure in self.open_at["figure"] if not figure[_O_CAPTIONED]]
            for figure in bare:
                figure[_O_CAPTIONED] = True
            return bool(bare)
        return tag in ("dt", "title", "script") or (tag == "code" and parent[_O_TAG] == "pre")

    def _end_last(self, by_own_tag):
        here = self.path.pop()
        tag, node = here[_O_TAG], here[_O_NODE]
        self.open_count[tag] -= 1
        if tag in _LOOKED_UP:
            self.open_at[tag].pop()
        if node is not None:
            node[_END_POS] = self.count - 1
            node[_SPAN] = len(self.out.rows) - self.first - node[0] + 1
            if here[_O_WANTED]:
                self._write(here, by_own_tag)
                self.reading -= 1
                if not self.reading:
                    self.inl.clear()
                    self.raw.clear()
        if self.reading:
            if tag == "a":
                inl = self.inl
                inl[here[_O_INL]:] = [_norm("".join(inl[here[_O_INL]:])) or here[_O_HREF].strip()]
            elif tag == "code":
                inl = self.inl
                inl[here[_O_INL]:] = [_norm("".join(inl[here[_O_INL]:]))]
            elif tag in SKIP_INLINE_TAGS:
                del self.inl[here[_O_INL]:], self.raw[here[_O_RAW]:]

    def _write(self, here, by_own_tag):
        tag, node = here[_O_TAG], here[_O_NODE]
        if tag in ("title", "pre", "code"):
            node[_RAW] = "".join(self.raw[here[_O_RAW]:])
        elif tag == "script":
            text = "".join(self.raw[here[_O_RAW]:])
            node[_RAW] = text if PUSH_MARK in text else ""
        elif tag == "dt" and not by_own_tag:
            node[_TEXT] = ""  # its parent ends too: no dd can follow
        elif tag in ("h2", "h3") and node[_STOP_ANC] > here[_O_ARTICLE]:
            # inside another block only "references" is ever looked for
            node[_TEXT] = self._short_text(here[_O_INL], len("references"))
        else:
            node[_TEXT] = _norm("".join(self.inl[here[_O_INL]:]))

    def _write_whole(self, node, article, content):
        """``_write`` of an element that holds ``content`` and no element."""
        tag = node[_TAG]
        if tag in ("title", "pre", "code"):
            node[_RAW] = content
        else:
            text = _norm(content)
            hidden = tag in ("h2", "h3") and node[_STOP_ANC] > article and len(text) - text.count(" ") > len("references")
            node[_TEXT] = "" if hidden else text

    def _short_text(self, start, most) -> str:
        """The text from ``start`` if it has at most ``most`` characters besides white space, else ""."""
        seen, n = [], 0
        for k in range(start, len(self.inl)):
            piece = self.inl[k]
            n += sum(map(len, piece.split()))
            if n > most:
                return ""
            seen.append(piece)
        return _norm("".join(seen))

    def finish(self) -> None:
        # The tokenizer is deliberately not closed; still-open elements end
        # with the document.
        while len(self.path) > 1:
            self._end_last(False)


def _shred_into(out: _Nodes, html: str | None, keep_all: bool, tags: frozenset[str]) -> str | None:
    """Appends a page's nodes to ``out``; returns its parse error."""
    if html is None:
        return "unparsable: no html"
    before = len(out.rows)
    folder = _Folder(out, keep_all, tags)
    try:
        folder.feed(html)
    except Exception as exc:  # one bad page is quarantined, never the task
        out.cut(before)
        return f"unparsable: {exc}"
    folder.finish()
    return None


def shred_html(html: str | None, keep_all: bool = False, tags: frozenset[str] = EMIT_TAGS) -> tuple[list[dict], str | None]:
    """HTML text -> (nodes, parse_error). ``keep_all`` writes every element,
    not only those in ``tags``."""
    out = _Nodes()
    error = _shred_into(out, html, keep_all, tags)
    return out.dicts(), error


def _shred_batches(keep_all: bool, tags: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, offsets, errors, size, done = _Nodes(), [0], [], 0, 0
            for n, html in enumerate(batch.column("html"), 1):
                text = html.as_py()
                errors.append(_shred_into(out, text, keep_all, tags))
                offsets.append(len(out.rows))
                size += len(text or "")
                if size > BATCH_CHARS:
                    yield _batch(batch.slice(done, n - done), out, offsets, errors)
                    out, offsets, errors, size, done = _Nodes(), [0], [], 0, n
            yield _batch(batch.slice(done), out, offsets, errors)

    return run


def _batch(pages: pa.RecordBatch, out: _Nodes, offsets: list[int], errors: list[str | None]) -> pa.RecordBatch:
    nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), out.array(), type=OUT_SCHEMA.field("nodes").type)
    columns = [pages.column("page_id"), pages.column("url"), nodes, pa.array(errors, pa.string())]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, OUT_SCHEMA)], schema=OUT_SCHEMA)


def dealt(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """The three columns a page stage reads, in the scan's own partitions, so no
    HTML is shuffled; ``partitions`` (or the session setting
    ``folia.shred.partitions``) deals a table of few files out anew."""
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    wanted = partitions or int(pages.sparkSession.conf.get("folia.shred.partitions", "0"))
    return slim.repartition(wanted) if wanted and not pages.isStreaming else slim


def shred(pages: DataFrame, partitions: int | None = None, keep_all: bool = False, tags: frozenset[str] = EMIT_TAGS) -> DataFrame:
    """pages(page_id, url, html) -> shredded(page_id, url, nodes, parse_error).

    Only the three columns the stage needs cross into Python, and of the nodes
    only those whose tag is in ``tags`` come back. ``dealt`` says how pages
    are spread over the partitions.
    """
    return dealt(pages, partitions).mapInArrow(_shred_batches(keep_all, tags & EMIT_TAGS), SPARK_SCHEMA)


# Python workers need not have the package installed: the stage's code goes
# with the task.
ship_by_value(sys.modules[__name__])
