"""URL and title expressions (SQL text; see ``folia.functions.sql``).

All are JVM built-ins, so they stay in the plan and work inside
higher-order-function lambdas.  Parsing follows the RFC 3986 reference regex
plus the Python ``urllib`` details the extracted values depend on: lower-cased
scheme, ``;params`` cut from the last path segment, ``urljoin``'s merge and
dot-segment rules.  ``parse_url`` is not used: under ANSI mode it raises on
spaces and quotes.
"""

from __future__ import annotations

from folia.functions.sql import aggregate, filter_, let, lit, lits
from folia.functions.text import py_strip, ws_normalize

# Python urllib's scheme classes.
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
                 "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
                 "svn+ssh", "ws", "wss"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
               "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
               "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
               "itms-services"]
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
               "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]

# Fixed value: the characters page_url_from_slug leaves unescaped besides
# letters, digits and "_.-~", with the escape the JVM URL encoder gives them.
SLUG_SAFE_ESCAPES = [("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "'"), ("%28", "("),
                     ("%29", ")"), ("%2B", "+"), ("%2C", ","), ("%3B", ";"), ("%3D", "="),
                     ("%3A", ":"), ("%40", "@"), ("%7E", "~")]

URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_PART = {"scheme": 1, "netloc": 2, "path": 3, "query": 4, "fragment": 5}


def clean(e: str) -> str:
    """What URL parsing drops first: leading blanks and control characters
    (and trailing ones), and line breaks and tabs anywhere."""
    return f"regexp_replace({e}, {lit(r'^[\x00-\x20]+|[\x00-\x20]+$|[\t\r\n]')}, '')"


def url_part(e: str, name: str) -> str:
    """One urlsplit component ("" when absent); the scheme is lower-cased."""
    cleaned = clean(e)
    extracted = f"regexp_extract({cleaned}, {lit(URL_RE)}, {_PART[name]})"
    return f"lower({extracted})" if name == "scheme" else extracted


def url_parts(e: str) -> dict[str, str]:
    return {name: url_part(e, name) for name in _PART}


def cut_params(path: str, scheme: str) -> str:
    """urlparse's ``;params`` split: drop from the first ';' of the last segment."""
    cut = f"regexp_replace({path}, {lit('(?s)^((?:.*/)?[^/;]*);[^/]*$')}, '$1')"
    return f"CASE WHEN {scheme} IN ({lits(USES_PARAMS)}) THEN {cut} ELSE {path} END"


def unquote(e: str) -> str:
    """urllib.parse.unquote: %XX as UTF-8 (bad bytes -> U+FFFD); '+' and
    malformed escapes kept."""
    fixed = f"regexp_replace(replace({e}, '+', '%2B'), {lit('%(?![0-9A-Fa-f]{2})')}, '%25')"
    return f"CASE WHEN contains({e}, '%') THEN url_decode({fixed}) ELSE {e} END"


def unquote_plus(e: str) -> str:
    """Form decoding (parse_qs values): '+' is a space, then %XX."""
    return f"url_decode(regexp_replace({e}, {lit('%(?![0-9A-Fa-f]{2})')}, '%25'))"


def url_canonical(e: str) -> str:
    """Dedupe key: lower(scheme)://lower(netloc) + decoded path; query,
    fragment and ;params dropped."""
    return let(
        e,
        lambda u: let(
            f"named_struct('s', {url_part(u, 'scheme')}, 'n', {url_part(u, 'netloc')}, 'p', {url_part(u, 'path')})",
            lambda p: f"concat({p}.s, '://', lower({p}.n), {unquote(cut_params(p + '.p', p + '.s'))})",
        ),
    )


def url_robots(e: str) -> str:
    """scheme://netloc/robots.txt; null when scheme or netloc is missing."""
    s, n = url_part(e, "scheme"), url_part(e, "netloc")
    return f"CASE WHEN {s} <> '' AND {n} <> '' THEN concat({s}, '://', {n}, '/robots.txt') END"


def url_path(e: str) -> str:
    """urlparse(url).path (params cut)."""
    return cut_params(url_part(e, "path"), url_part(e, "scheme"))


def page_slug(e: str) -> str:
    """The decoded path after /page/, else the decoded path without edge
    slashes; "" for an empty URL."""

    def body(p: str) -> str:
        trimmed = f"regexp_replace({p}, '^/+|/+$', '')"
        return (
            f"CASE WHEN coalesce({e}, '') = '' THEN '' "
            f"WHEN startswith({p}, '/page/') THEN {unquote(f'substring({p}, 7)')} "
            f"ELSE {unquote(trimmed)} END"
        )

    return let(url_path(e), body)


def title_slug(e: str) -> str:
    """slug_from_title: whitespace runs -> '_'; null for a blank title."""
    return f"nullif(replace({ws_normalize(e)}, ' ', '_'), '')"


def quote_slug(e: str) -> str:
    """Percent-encode like Python quote(slug, safe="!$&'()*+,;=:@._~-")."""
    encoded = f"replace(url_encode({e}), '+', '%20')"
    for escape, char in SLUG_SAFE_ESCAPES:
        encoded = f"replace({encoded}, {lit(escape)}, {lit(char)})"
    return encoded


def slug_url(e: str, base_url: str) -> str:
    """page_url_from_slug: base + '/page/' + encoded stripped slug; null if blank."""
    base = base_url.strip().rstrip("/")
    return let(
        py_strip(e),
        lambda s: f"CASE WHEN {s} <> '' THEN concat({lit(base + '/page/')}, {quote_slug(s)}) END",
    )


def _unparse(scheme: str, netloc: str, path: str, query: str, fragment: str) -> str:
    """urlunsplit: empty query and fragment left out."""
    needs_authority = (
        f"({netloc} <> '' OR ({scheme} <> '' AND {scheme} IN ({lits(USES_NETLOC)}) "
        f"AND NOT startswith({path}, '//')))"
    )
    rooted = f"CASE WHEN {path} <> '' AND NOT startswith({path}, '/') THEN concat('/', {path}) ELSE {path} END"
    return (
        f"concat(CASE WHEN {scheme} <> '' THEN concat({scheme}, ':') ELSE '' END, "
        f"CASE WHEN {needs_authority} THEN concat('//', {netloc}, {rooted}) ELSE {path} END, "
        f"CASE WHEN {query} <> '' THEN concat('?', {query}) ELSE '' END, "
        f"CASE WHEN {fragment} <> '' THEN concat('#', {fragment}) ELSE '' END)"
    )


def reassemble(e: str, relative: bool = False) -> str:
    """urlunparse(urlparse(e)): empty params, query and fragment go.
    ``relative`` leaves out the scheme and the authority."""
    def body(p: str) -> str:
        path = f"CASE WHEN {p}.s IN ({lits(USES_PARAMS)}) THEN regexp_replace({p}.p, {lit('(?s)^((?:.*/)?[^/;]*);$')}, '$1') ELSE {p}.p END"
        return let(path, lambda x: _unparse("''" if relative else f"{p}.s", "''" if relative else f"{p}.n", x, f"{p}.q", f"{p}.f"))

    parts = {"s": "scheme", "n": "netloc", "p": "path", "q": "query", "f": "fragment"}
    return let(e, lambda u: let(f"named_struct({', '.join(f"'{k}', {url_part(u, v)}" for k, v in parts.items())})", body))


def _merge_paths(base_path: str, ref_path: str) -> str:
    """urljoin's path merge with dot-segment removal."""
    base_parts = f"split({base_path}, '/', -1)"
    base_dir = (
        f"CASE WHEN element_at({base_parts}, -1) <> '' "
        f"THEN slice({base_parts}, 1, size({base_parts}) - 1) ELSE {base_parts} END"
    )
    relative = let(
        f"concat({base_dir}, split({ref_path}, '/', -1))",
        lambda j: filter_(j, lambda x, i: f"({i} = 0 OR {i} = size({j}) - 1 OR {x} <> '')", arity=2),
    )
    segments = f"CASE WHEN startswith({ref_path}, '/') THEN split({ref_path}, '/', -1) ELSE {relative} END"

    def resolve(segs: str) -> str:
        stack = aggregate(
            segs,
            "CAST(array() AS array<string>)",
            lambda acc, s: (
                f"CASE WHEN {s} = '..' THEN (CASE WHEN size({acc}) > 0 "
                f"THEN slice({acc}, 1, size({acc}) - 1) ELSE {acc} END) "
                f"WHEN {s} = '.' THEN {acc} ELSE concat({acc}, array({s})) END"
            ),
        )
        tail = f"CASE WHEN element_at({segs}, -1) IN ('.', '..') THEN array('') ELSE CAST(array() AS array<string>) END"
        return let(f"array_join(concat({stack}, {tail}), '/')", lambda p: f"CASE WHEN {p} = '' THEN '/' ELSE {p} END")

    return let(segments, resolve)


def _resolve(base: str, ref: str) -> str:
    fields = []
    for side, e in (("b", base), ("r", ref)):
        for name in _PART:
            fields.append(f"'{side}{name}', {url_part(e, name)}")
    has_scheme = f"regexp_replace({ref}, '[\\\\t\\\\r\\\\n]', '') RLIKE {lit('^[A-Za-z][A-Za-z0-9+.\\-]*:')}"

    def body(p: str) -> str:
        b = {name: f"{p}.b{name}" for name in _PART}
        r = {name: f"{p}.r{name}" for name in _PART}
        scheme = f"(CASE WHEN {has_scheme} THEN {r['scheme']} ELSE {b['scheme']} END)"
        netloc = f"(CASE WHEN {scheme} IN ({lits(USES_NETLOC)}) THEN {b['netloc']} ELSE {r['netloc']} END)"
        no_path = _unparse(
            scheme, netloc, b["path"],
            f"(CASE WHEN {r['query']} <> '' THEN {r['query']} ELSE {b['query']} END)", r["fragment"],
        )
        merged = let(_merge_paths(b["path"], r["path"]), lambda m: _unparse(scheme, netloc, m, r["query"], r["fragment"]))
        return (
            f"CASE WHEN coalesce({base}, '') = '' THEN {ref} "
            f"WHEN coalesce({ref}, '') = '' THEN {base} "
            f"WHEN {scheme} <> {b['scheme']} OR {scheme} NOT IN ({lits(USES_RELATIVE)}) THEN {ref} "
            f"WHEN {scheme} IN ({lits(USES_NETLOC)}) AND {r['netloc']} <> '' "
            f"THEN {_unparse(scheme, r['netloc'], r['path'], r['query'], r['fragment'])} "
            f"WHEN {r['path']} = '' THEN {no_path} "
            f"ELSE {merged} END"
        )

    return let(f"named_struct({', '.join(fields)})", body)


def parse_base(e: str) -> str:
    """A base URL parsed once: named_struct(url, scheme, netloc, path, query),
    to resolve many references against (see ``resolve_with``)."""
    return let(f"named_struct('url', {e}, 'c', {clean(e)})", lambda u: (
        f"named_struct('url', {u}.url, {_cleaned_parts(f'{u}.c', 'scheme', 'netloc', 'path', 'query')})"))


def _cleaned_parts(cleaned: str, *names: str) -> str:
    """Fields of a struct: the components ``names`` of a URL that is cleaned already."""
    part = lambda name: f"regexp_extract({cleaned}, {lit(URL_RE)}, {_PART[name]})"
    return ", ".join(f"'{name}', " + (f"lower({part(name)})" if name == "scheme" else part(name)) for name in names)


# References that need no merge: absolute with an authority, or rooted paths
# without dot segments; neither may end in an empty '?' or '#', which
# urlunsplit would drop.
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]"
_ROOTED_PLAIN = r"^/[^/]"
_DOT_SEGMENT = r"(^|/)\.\.?($|[/?#])"
_UNSAFE = r"[\t\r\n]|\?#|[?#]$|\?$"


def resolve_with(base: str, ref: str) -> str:
    """urljoin(base.url, ref) for a base from ``parse_base``.

    Common shapes are answered directly (an absolute reference keeps its
    text, with the scheme lower-cased when urljoin re-assembles it; a rooted
    path without dot segments is appended to the base's scheme and
    authority); everything else goes through the full merge of ``_resolve``.
    """
    absolute = let(f"lower(substring_index({ref}, ':', 1))", lambda scheme: (
        f"CASE WHEN {scheme} = {base}.scheme AND {scheme} IN ({lits(USES_RELATIVE)}) AND {scheme} IN ({lits(USES_NETLOC)}) "
        f"THEN concat({scheme}, substring({ref}, instr({ref}, ':'))) ELSE {ref} END"
    ))
    # what each pattern needs is looked for first: a search for a character costs far less than a pattern
    suspect = " OR ".join(f"contains({ref}, {c})" for c in ("'?'", "'#'", "'\\t'", "'\\r'", "'\\n'"))
    return (
        f"CASE WHEN coalesce({base}.url, '') = '' THEN {ref} "
        f"WHEN ({suspect}) AND {ref} RLIKE {lit(_UNSAFE)} THEN {_resolve(f'{base}.url', ref)} "
        f"WHEN NOT startswith({ref}, '/') AND {ref} RLIKE {lit(_ABSOLUTE)} THEN {absolute} "
        f"WHEN {ref} RLIKE {lit(_ROOTED_PLAIN)} AND NOT (contains({ref}, '/.') AND {ref} RLIKE {lit(_DOT_SEGMENT)}) "
        f"AND {base}.scheme IN ({lits(USES_NETLOC)}) AND {base}.scheme <> '' "
        f"THEN concat({base}.scheme, '://', {base}.netloc, {ref}) "
        f"ELSE {_resolve(f'{base}.url', ref)} END"
    )


def url_resolve(base: str, ref: str) -> str:
    """urllib.parse.urljoin(base, ref)."""
    return let(f"named_struct('b', {parse_base(base)}, 'r', {ref})", lambda v: resolve_with(f"{v}.b", f"{v}.r"))


def normalize_image_url(raw_src: str, base: str, parsed_base: bool = False) -> str:
    """Resolve an image src; a /_next/image wrapper yields its ``url`` query
    value, form-decoded then percent-decoded, and resolved again.  ``base``
    is a URL, or a ``parse_base`` struct when ``parsed_base``."""
    b = base if parsed_base else parse_base(base)

    def unwrap(v: str) -> str:
        resolved = f"{v}.resolved"

        def inner(p: str) -> str:
            once = lambda raw: let(unquote_plus(raw), lambda x: let(unquote(x), lambda i: resolve_with(f"{v}.base", i)))
            return let(f"regexp_extract({p}.query, {lit('(?:^|&)url=([^&]+)')}, 1)", lambda raw: (
                f"CASE WHEN {cut_params(f'{p}.path', f'{p}.scheme')} = '/_next/image' AND {raw} <> '' THEN {once(raw)} ELSE {resolved} END"))

        parts = let(clean(resolved), lambda c: f"named_struct({_cleaned_parts(c, 'scheme', 'path', 'query')})")
        return f"CASE WHEN contains({resolved}, '/_next/image') THEN {let(parts, inner)} ELSE {resolved} END"

    return let(f"named_struct('base', {b}, 'r', {raw_src})", lambda p: let(
        f"named_struct('resolved', {resolve_with(f'{p}.base', f'{p}.r')}, 'base', {p}.base)", unwrap))
