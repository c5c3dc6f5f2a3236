"""Text expressions (SQL text; see ``folia.functions.sql``)."""

from __future__ import annotations

from folia.functions.sql import let, lit

# Fixed value: every character Python's str.split() treats as whitespace.
# Java's \s is ASCII-only, so the rest are listed.
WS_CLASS = "[\\s\\u001c-\\u001f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
WS_CHARS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# What a normalised text has none of. Printable ASCII is told apart by one comparison.
_WS = f"[[^!-~]&&{WS_CLASS}]"
_UNNORMAL = f"{_WS}{{2,}}|[[^ -~]&&{WS_CLASS}]"

# Fixed value: line boundaries of Python's str.splitlines().
LINE_BREAK = "\\r\\n|[\\n\\r\\u000b\\u000c\\u001c\\u001d\\u001e\\u0085\\u2028\\u2029]"


def ws_normalize(e: str) -> str:
    """``" ".join(s.split())``: collapse whitespace runs, trim the ends."""
    return f"trim(regexp_replace({e}, {lit(_UNNORMAL)}, ' '))"


def py_strip(e: str) -> str:
    """``s.strip()`` with Python's whitespace set (plain ``trim`` drops only spaces)."""
    return f"trim(BOTH {lit(WS_CHARS)} FROM {e})"


def split_lines(e: str) -> str:
    """``s.splitlines()``: split on line breaks, minus one trailing empty piece."""
    return let(f"split({e}, {lit(LINE_BREAK)}, -1)", lambda parts: (
        f"CASE WHEN size({parts}) > 0 AND element_at({parts}, -1) = '' "
        f"THEN slice({parts}, 1, size({parts}) - 1) ELSE {parts} END"
    ))
