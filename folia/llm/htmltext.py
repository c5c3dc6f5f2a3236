"""Main text of HTML pages by inferred wrappers.

A wrapper is a union-free regular expression over the block tags of a host's
pages: tags, text slots, optional parts ``( )?`` and repeated groups ``( )+``.
A page's token stream, read as a tree, already folds its own repeats; the
streams of a host are then aligned one after another, and what does not
match becomes optional, what recurs a repeat, what differs in text is a slot.
Equal streams are merged by Spark before any alignment, the rest of a host is
aligned in salted parts and the parts' wrappers with each other, so a host
with a third of all pages is neither collected nor aligned in one task.

The wrapper tells slots apart. Menus, headers, footers, forms, notices and the
like are known by tag, class, id or role. The slots' statistics over the host
decide on the rest, inside a page's article or main part as well as on pages
without one: a text that is in its slot on nearly all of many pages is
template, a slot made of links is a menu, and all the other text is the
article. A page with a main part gives what is left inside it.
"""

from __future__ import annotations

import json
import re
from difflib import SequenceMatcher
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, written
from .urlfilter import host as host_of

SALTS = 16
MAX_DEPTH = 64
MAX_GROUP = 8
#: A slot with one text on this many different pages is part of the template.
TEMPLATE_PAGES = 5
OPTIONAL, REPEATED = 1, 2
#: State of an open element: inside clutter, inside what may be clutter, inside a main part by tag or role, or by class or id,
#: inside a heading, inside an article, inside an article's own header.
HIDE, DOUBT, MARKED, NAMED, HEADING, ARTICLE, HEADER = 1, 2, 4, 8, 16, 32, 64

# Names with a meaning in HTML and in common class names.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main "
                   "menu nav noscript object ol optgroup option p pre script search section select style summary svg table tbody td template textarea tfoot th thead title tr ul button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title nav header footer aside form button search select textarea iframe object svg canvas audio video menu dialog".split())
MAIN = frozenset(("article", "main"))
CLUTTER = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments contentinfo cookie cookies copyright disclaimer dialog discussion disqus footer "
                    "header masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination popup promo promotion recommended related replies responses search "
                    "share sharing sidebar skip social sponsor sponsored subscribe tags toolbar widget widgets".split())
# Words that say no more than that something is a part of the page: a name of a clutter word and these is clutter.
PARTS = frozenset("a actions area bar block bottom box button buttons card cards col column container content controls entry fixed foot form global group head holder icon icons inline inner item items layout left "
                  "line link links list main mobile module outer page panel part pane primary region right row secondary section site sign signup slot small sticky text thread title top unit up wrap wrapper zone".split())
# Words that may as well name a section of the text.
TOPICS = frozenset("advertising advertisement copyright cookies discussion disclaimer header navigation notice notices notifications promotion related responses search social tags".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNNAMED = frozenset("html body p pre code blockquote address caption figcaption dt dd".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body main td th".split())
by_value(__name__)


def _clutter(words: list[str]) -> bool:
    """Does a name say clutter: by its last word ("main-nav"), or by its first
    with words after it that only say that it is a part ("sidebar-left")?
    "related-work" is a work, and stays."""
    return words[-1] in CLUTTER or words[0] in CLUTTER and PARTS.issuperset(words[1:])


def verdict(tag: str, tokens: list[tuple[str, str]], outer: int = 0) -> int:
    """State that a tag with (attribute, name) pairs gives to what it holds,
    ``outer`` being the state around it.

    Names are whole class, id and role values, on parts that hold blocks:
    headings, paragraphs and code are never judged by name. Clutter wins over
    main, and over <article>: a reader's comment may be one. The id of a
    <section> that is compound or may as well name a part of the text
    ("discussion") raises a doubt only. A header inside an article keeps its headings.
    """
    if tag in HEADINGS:
        return HEADING
    inside = outer & (MARKED | NAMED | ARTICLE)
    if tag == "header" and inside:
        return HEADER
    if tag in HIDDEN:
        return HIDE
    state = doubt = 0
    for key, token in tokens if tag not in UNNAMED else ():
        words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())
        if not words:
            continue
        if _clutter(words):
            if words == ["header"] and inside:
                state |= HEADER
            elif key == "id" and tag == "section" and (len(words) > 1 or words[0] in TOPICS):
                doubt = DOUBT
            else:
                return HIDE
        elif "main" in words and {"main", "content"}.issuperset(words):
            state |= MARKED if key == "role" else NAMED if tag in ("div", "section", "td") else 0
    if tag in MAIN:
        state |= ARTICLE | MARKED if tag == "article" else MARKED
    return state | doubt


def hidden(state: int) -> bool:
    return bool(state & HIDE or state & HEADER and not state & HEADING)


class Page(HTMLParser):
    """Block tree of a page: nodes [label, children], texts ["#", text, characters in links, state].

    The state of a text is carried by the open elements, so it does not depend
    on how deep the tree may grow."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.children: list = []
        self.stack: list = [("", self.children, 0)]
        self.pieces: list[str] = []
        self.linked, self.in_link = 0, 0
        self.feed(html or "")
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.pieces).split())
        state = self.stack[-1][2]
        if text and not (hidden(state) and len(self.stack) > MAX_DEPTH):
            self.stack[-1][1].append(["#", text, min(self.linked, len(text)), state])
        self.pieces, self.linked = [], 0

    def handle_data(self, data):
        self.pieces.append(data)
        if self.in_link:
            self.linked += len(data)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.pieces.append(" ")
        names, tokens = [], []
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += re.findall(r"[a-z]+", value.lower())
                tokens += [(key, t) for t in value.split()]
        if tag == "a":
            self.in_link = 1
        if tag in VOID or tag not in BLOCKS:  # an unknown tag ends no block
            if tag == "hr":
                self.flush()
            return
        self.flush()
        if tag in CLOSES_P:
            self.pop({"p"})
        if tag in CLOSED_BY:
            self.pop(CLOSED_BY[tag])
        label = ".".join([tag, *sorted(set(names))])
        state = self.stack[-1][2] | verdict(tag, tokens, self.stack[-1][2])
        if len(self.stack) < MAX_DEPTH:
            node = [label, []]
            self.stack[-1][1].append(node)
            self.stack.append((tag, node[1], state))
        else:  # as deep as wrappers go: its texts are still blocks of their own, hidden or marked by their state
            self.stack.append((tag, self.stack[-1][1], state))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def pop(self, tags):
        """Closes the innermost of ``tags``, unless a list, table or part stands between."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                del self.stack[k:]
                return
            if self.stack[k][0] in SCOPE:
                return

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = 0
        if any(tag == t for t, *_ in self.stack[1:]):
            self.flush()
            while self.stack.pop()[0] != tag:
                pass
        elif tag in BLOCKS and tag not in VOID:
            self.flush()


# ------------------------------------------------------------------- wrappers
# A wrapper part is (label, flags, parts); "#" is a text slot, "()" a group.

def skeleton(children) -> tuple:
    """The parts of a page's nodes, repeats folded."""
    return fold(tuple(("#", 0, ()) if c[0] == "#" else (c[0], 0, skeleton(c[1])) for c in children))


def fold(parts: tuple) -> tuple:
    """Adjacent equal parts, then equal runs of up to MAX_GROUP parts, become repeats."""
    for g in range(1, MAX_GROUP + 1):
        out, i = [], 0
        while i < len(parts):
            unit, n = parts[i : i + g], 1
            while len(unit) == g and parts[i + n * g : i + (n + 1) * g] == unit:
                n += 1
            if n == 1:
                out.append(parts[i])
                i += 1
            else:
                out.append((unit[0][0], unit[0][1] | REPEATED, unit[0][2]) if g == 1 else ("()", REPEATED, unit))
                i += n * g
        parts = tuple(out)
    return parts


def _key(part) -> str:
    return part[0] if part[0] != "()" else "(" + " ".join(map(_key, part[2])) + ")"


def align(a: tuple, b: tuple) -> tuple:
    """One expression for both: matched parts are aligned inside, the rest is optional."""
    if a == b:
        return a
    out: list = []
    for op, i, k, j, m in SequenceMatcher(None, list(map(_key, a)), list(map(_key, b)), autojunk=False).get_opcodes():
        if op == "equal":
            out += [(x[0], x[1] | y[1], align(x[2], y[2])) for x, y in zip(a[i:k], b[j:m])]
        else:
            out += [(x[0], x[1] | OPTIONAL, x[2]) for x in a[i:k] + b[j:m]]
    return fold(tuple(out))


def _load(x):
    return tuple((label, flags, _load(parts)) for label, flags, parts in x)


def slots(children, parts, path=()):
    """Yields (text, link characters, slot, state) of a page's texts
    outside clutter. A slot is the path of numbers to its place in the wrapper, or
    "?" for what the wrapper does not know."""
    places: dict[str, list[int]] = {}
    flat = _flat(parts)
    for k, p in enumerate(flat):
        places.setdefault(p[0], []).append(k)
    at = -1
    for c in children:
        known = places.get(c[0])
        if known:  # on in the sequence, here again if this repeats, or back to the start of a repeated group
            at = next((k for k in known if k > at or k == at and flat[k][1] & REPEATED), known[0])
        here = (*path, at if known else "?")
        if c[0] != "#":
            yield from slots(c[1], flat[at][2] if known else (), here)
        elif not hidden(c[3]):
            yield c[1], c[2], here, c[3]


def blocks(html: str | None, parts) -> list[tuple]:
    """(text, link characters, slot, in main) of a page's texts outside clutter.

    The slot is given as text, "=" before those in a main part, "=h" before
    headings there. The article is the main part where there is one, else what
    is marked by tag or role; a main part known by its name only counts if it holds
    text that is no menu. A block in doubt goes if it is made of links."""
    found = [x for x in slots(Page(html).children, parts) if not (x[3] & DOUBT and x[1] * 2 >= len(x[0]))]
    main = next((kind for kind in (ARTICLE, MARKED, NAMED) if any(x[3] & kind and x[1] * 2 < len(x[0]) for x in found)), MARKED)
    marks = [("=h" if state & HEADING else "=") if state & main else "" for *_, state in found]
    return [(text, links, mark + "/".join(map(str, slot)), mark != "") for (text, links, slot, _), mark in zip(found, marks)]


def _flat(parts):
    out = []
    for p in parts:
        out += _flat(p[2]) if p[0] == "()" else [p]
    return out


# ------------------------------------------------------------------- the jobs

def _skeletons(batches):
    for b in batches:
        out = [json.dumps(skeleton(Page(h.as_py()).children), separators=(",", ":")) for h in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["host", "skeleton"])


def _infer(table: pa.Table) -> pa.Table:
    """Wrapper of one group's expressions, aligned in the order of their text."""
    wrapper = None
    for x in sorted(table.column("skeleton").to_pylist()):
        parts = _load(json.loads(x))
        wrapper = parts if wrapper is None else align(wrapper, parts)
    return pa.table({"host": pa.array([table.column("host")[0].as_py()], pa.string()), "skeleton": [json.dumps(wrapper, separators=(",", ":"))]})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, html) -> (host, skeleton): a wrapper for each host."""
    streams = pages.mapInArrow(_skeletons, "host string, skeleton string").distinct()
    salted = streams.withColumn("salt", F.pmod(F.xxhash64("skeleton"), F.lit(SALTS)))
    parts = salted.groupBy("host", "salt").applyInArrow(lambda t: _infer(t), "host string, skeleton string")
    return parts.groupBy("host").applyInArrow(lambda t: _infer(t), "host string, skeleton string")


class _Wrappers(dict):
    """Parsed wrappers of the hosts met lately."""

    def __missing__(self, text: str | None) -> tuple:
        if len(self) > 1000:
            self.clear()
        w = self[text] = _load(json.loads(text)) if text else ()
        return w


_BLOCKS = "array<struct<text:string,links:int,slot:string,main:boolean>>"
_BLOCKS_ARROW = pa.list_(pa.struct([("text", pa.string()), ("links", pa.int32()), ("slot", pa.string()), ("main", pa.bool_())]))


def _block_rows(batches):
    """(row, host, html, skeleton) -> (row, host, blocks)."""
    seen = _Wrappers()
    for b in batches:
        found = [[{"text": t, "links": n, "slot": slot, "main": m} for t, n, slot, m in blocks(html, seen[w])] for html, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, _BLOCKS_ARROW)], names=["row", "host", "blocks"])


def _slot_rows(batches):
    """A row for each slot of a page, without a text, and one for each of its texts."""
    for b in batches:
        out: list = [[], [], [], [], [], []]
        for h, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            page = xxhash.xxh64_intdigest("\n".join(x["text"] for x in found)) >> 1
            sums: dict[tuple, list[int]] = {}
            for x in found:
                for key in ((x["slot"], None), (x["slot"], _digest(x["text"]))):
                    of = sums.setdefault(key, [0, 0])
                    of[0] += len(x["text"])
                    of[1] += x["links"]
            for (slot, text), (n, links) in sums.items():
                for c, v in zip(out, (h, slot, text, n, links, page)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), *[pa.int64()] * 4))], names=["host", "slot", "text", "n", "links", "page"])


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def template(pages: DataFrame) -> DataFrame:
    """(host, blocks) -> (host, off): what is no article text on the
    host's pages, lines of "slot" for menus and "slot text" for template.

    Pages with equal texts count once. Outside main parts, slots made of links
    go, and the texts of slots with one text on TEMPLATE_PAGES pages, wherever
    the wrapper placed them ("* text"). In a main part more is
    needed: a text goes that is on nine of ten pages with its slot (a heading
    only if its slot has no other), and a slot made of links that is no
    heading, both on TEMPLATE_PAGES at least. Where texts alike are half of the
    main parts, the pages are copies of one another, and they stay.
    """
    rows = pages.mapInArrow(_slot_rows, "host string, slot string, text long, n long, links long, page long")
    once = rows.groupBy("host", "slot", "text", "page").agg(F.max("n").alias("n"), F.max("links").alias("links"))
    sums = once.groupBy("host", "slot", "text").agg(F.count("*").alias("pages"), F.sum("n").alias("n"), F.sum("links").alias("links"))
    sums = written(sums.where(f"text IS NULL OR pages >= {TEMPLATE_PAGES}"))
    menu = f"links * 2 >= n AND (NOT startswith(slot, '=') OR NOT startswith(slot, '=h') AND pages >= {TEMPLATE_PAGES})"
    slot = sums.where("text IS NULL").select("host", "slot", F.col("pages").alias("of"), F.col("n").alias("size"), F.expr(menu).alias("menu"), F.expr("startswith(slot, '=')").alias("main"))
    alike = sums.where("text IS NOT NULL").join(slot.where("NOT menu"), ["host", "slot"]).where("pages * 10 >= of * 9")
    outside = alike.where("NOT main AND n = size").select("host", F.lit("*").alias("slot"), "text")
    share = slot.where("main AND NOT menu").groupBy("host").agg(F.sum("size").alias("all")).join(alike.where("main").groupBy("host").agg(F.sum("n").alias("same")), "host").where("same * 2 < all")
    inside = alike.where("main AND (n = size OR NOT startswith(slot, '=h'))").join(share, "host").select("host", "slot", "text")
    off = slot.where("menu").select("host", F.col("slot").alias("x")).unionByName(outside.unionByName(inside).select("host", F.concat_ws(" ", "slot", F.col("text").cast("string")).alias("x")))
    return off.groupBy("host").agg(F.concat_ws("\n", F.sort_array(F.collect_list("x"))).alias("off"))


class _Off(dict):
    """Parsed results of ``template`` of the hosts met lately."""

    def __missing__(self, text: str | None) -> frozenset:
        if len(self) > 1000:
            self.clear()
        off = self[text] = frozenset(text.split("\n") if text else ())
        return off


def _texts(batches):
    offs = _Off()
    for b in batches:
        out = []
        for found, off in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            off = offs[off]
            marked = [x for x in found if x["main"]]
            main = []
            for x in marked or found:
                if not off or x["slot"] not in off and f"{x['slot'] if marked else '*'} {_digest(x['text'])}" not in off:
                    main.append(x["text"])
            if not main:  # a page of template only: all that is marked, or else is no menu
                main = [x["text"] for x in marked] or [x["text"] for x in found if x["links"] * 2 < len(x["text"])]
            out.append("\n\n".join(main))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row.

    Null or empty HTML, and pages without an article text, give the empty
    string; a page without a URL or host belongs to the host "". Plain text
    without tags is one block. Repeated rows and null ids give a row each; an
    empty table gives none; other columns are not read. Texts are whole,
    however long and however deep in the page.
    """
    rows = pages.select(F.struct(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).alias("row"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    known = written(wrappers(rows.select("host", "html")))
    # one row a host; the files' size tells Spark whether to broadcast it, and AQE splits a hot host's pages otherwise
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.join(known, "host", "left").select("row", "host", "html", "skeleton").mapInArrow(_block_rows, f"row {kind}, host string, blocks {_BLOCKS}")
    found = written(found, "zstd")  # pages are parsed for the wrappers and for their blocks, not again for the text
    off = written(template(found.select("host", "blocks")))
    out = found.join(off, "host", "left").select("row", "blocks", "off").mapInArrow(_texts, f"row {kind}, text string")
    return out.select("row.page_id", "row.url", "text")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(documents(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# What the given pages hold: one <article> of <h1> and <p> blocks, with <b> and <br> inside.
ORACLE = r"""
WITH b AS (SELECT page_id, url, regexp_split_to_array(regexp_replace(coalesce(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), ''), '<br>', ' ', 'g'), '</?(?:p|h1)>') AS parts FROM pages),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(
        replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'),
        '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t
"""
