"""Page records: the nested page, assembled in the row.

``pages -> page_fields -> corpus_frame -> page_records`` is narrow
from the scan on: no exchange, no join, no staging. A row never needs another
row, so repeated page ids are harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from folia.operators import payload as P
from folia.operators import sections as S
from folia.operators.extract import frame_of_fields
from folia.operators.fields import page_fields

# Default metadata of pages read from a table; a batch job takes the fetch
# time as a parameter, so results are reproducible.
DEFAULT_STATUS = 200
DEFAULT_FETCHED_AT = "2026-01-01 00:00:00"


#: The fields that every frame is made of, and the further ones of its columns.
BASE_FIELDS = ("has_article", "title", "canonical_url")
COLUMN_FIELDS = {
    "url": (), "source_url": (), "slug": (), "title": (), "canonical_url": (), "quarantine": (), "parse_error": (), "_base": (),
    "links": ("hrefs",), "lead_figure": ("lead",), "references": ("refs",), "payloads": ("scripts",), "hits": ("scripts", "heads"),
    "sections": ("tree", "scripts", "heads"),
    **{name: (name,) for name in ("head_title", "description", "keywords", "intro_text", "infobox", "blocks", "tree")},
}
FRAME_COLUMNS = [
    "page_id", "url", "source_url", "slug", "title", "intro_text", "canonical_url", "description", "keywords", "head_title",
    "lead_figure", "infobox", "links", "blocks", "quarantine", "parse_error", "payloads", "tree", "references", "_base", "hits",
]
#: The columns of a frame that a whole record is made of.
RECORD_COLUMNS = ("url", "slug", "title", "intro_text", "infobox", "lead_figure", "sections", "references", "links", "canonical_url", "description", "keywords")


def corpus_frame(pages: DataFrame, *columns: str) -> DataFrame:
    """pages -> page frame without nodes, with the payload texts, the section
    tree, the references and the payload images placed under the headings
    (``hits``). Given ``columns``, a frame of page_id, these and the quarantine, for which only
    the fields they are made of leave the tokenizer's stage; ``sections`` stands
    for all that a record's sections are made of."""
    fields = dict.fromkeys([*BASE_FIELDS, *(f for c in columns or FRAME_COLUMNS[1:] for f in COLUMN_FIELDS[c])])
    df = frame_of_fields(page_fields(pages, *fields)).withColumnsRenamed({"refs": "references"})
    if "scripts" in fields:
        df = df.selectExpr("*", f"{P.payload_texts()} AS payloads")
    if "scripts" in fields and "heads" in fields:
        df = df.selectExpr("*", f"{P.section_titles()} AS secs").selectExpr("*", f"{P.payload_hits()} AS hits")
    chosen = [c for name in columns for c in (("tree", "hits", "_base") if name == "sections" else (name,))]
    return df.select(*(["page_id", *dict.fromkeys(chosen), "quarantine"] if columns else FRAME_COLUMNS))


def page_records(frame: DataFrame, status_code: int = DEFAULT_STATUS, fetched_at: str = DEFAULT_FETCHED_AT) -> DataFrame:
    """Good pages -> page_id + every page field (nested, in record order). Of a
    frame of some columns, the fields that these make."""
    metadata = {
        "status_code": str(int(status_code)), "fetched_at_utc": f"TIMESTAMP'{fetched_at}'",
        **{name: name for name in ("canonical_url", "description", "keywords") if name in frame.columns},
    }
    plain = [c for c in ("url", "slug", "title", "intro_text", "infobox", "lead_figure") if c in frame.columns]
    return frame.where("quarantine IS NULL").selectExpr(
        "page_id", *plain,
        *([f"{S.nested()} AS sections"] if "tree" in frame.columns else []),
        *[c for c in ("references", "links") if c in frame.columns],
        f"named_struct({', '.join(f"'{name}', {e}" for name, e in metadata.items())}) AS metadata",
    )


def page_stats(records: DataFrame, *keep: str) -> DataFrame:
    """Per-page counts: sections, references, media (sections +
    subsections), keywords; the record's columns ``keep`` stay."""
    return records.selectExpr(
        "page_id", *keep,
        "size(sections) AS n_sections",
        "size(references) AS n_references",
        "aggregate(sections, 0, (acc, s) -> acc + size(s.media) + "
        "aggregate(s.subsections, 0, (a2, t) -> a2 + size(t.media))) AS n_media",
        "coalesce(size(metadata.keywords), 0) AS n_keywords",
    )
