"""The fields read beside the tokenizer are those that expressions read from shredded nodes."""

import random

import pytest

from folia.operators import assemble as A
from folia.operators.extract import frame_of_fields, page_frame
from folia.operators.fields import page_fields
from folia.operators.shred import shred
from folia.plans import pages as PG

SCHEMA = "page_id long, url string, html string"
OPEN = [
    "div", "p", "p", "span", "span data-tts-block='true'", "h1", "h2", "h2 id='k'", "h3", "h3 id=''", "ul", "ol", "li", "li", "a href=' /y '", "a href=''", "a href='?q'", "code", "pre",
    "figure", "img src='/i.png' alt=' a  b '", "img src=' ' srcset=' /s.png 1x, /t.png'", "img alt='x'", "figcaption", "blockquote", "dl", "dt", "dd", "dt", "button", "script",
    "article", "article class='b text-[16px]'", "br", "head", "title", "meta name='KEYWORDS' content=' a, ,b  c'", "meta property='og:title' content=' o  g '", "meta name='description' content='d'",
    "meta property='og:url' content=' /o '", "link rel='Canonical' href=' /c '",
]
WORDS = ["x", " y  z ", "\n", "\r\n", "&amp;", "\x85", " ", "References", " REFERENCES ", "İK", "Overview"]
PUSH = '<script>self.__next_f.push([1,"## Overview\\n![a](/w.png)"]);</script>'


def soup(rng, n):
    out, opened = [], []
    for _ in range(n):
        r = rng.random()
        if r < 0.45:
            opened.append(rng.choice(OPEN))
            out.append(f"<{opened[-1]}>")
        elif r < 0.75 and opened:
            out.append(f"</{opened.pop().split()[0]}>")
        else:
            out.append(rng.choice(WORDS))
    return "".join(out)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    htmls = [f"{rng.choice(['<article>', '<article><h1>T</h1>', ''])}{soup(rng, rng.randrange(70))}{rng.choice(['</article>', ''])}{rng.choice([PUSH, ''])}" for _ in range(500)]
    htmls += [
        None, "", "<article><pre>\n\na\n\r\n</pre><pre><code>\nb\n </code></pre><pre>c\n\n</pre></article>",
        "<article><p><figure><img src='/hidden.png'></figure></p><figure><img src='/second.png'></figure></article>",
    ]
    urls = ["https://a.example/page/T", "", None, "x/y;p?q#f"]
    return spark.createDataFrame([(k if k % 9 else None, urls[k % 4], h) for k, h in enumerate(htmls)], SCHEMA)


def test_fields_are_those_of_the_nodes(pages):
    columns = ["page_id", "url", "source_url", "slug", "title", "intro_text", "canonical_url", "description", "keywords", "head_title",
               "lead_figure", "infobox", "links", "blocks", "quarantine", "parse_error"]
    want, got = (sorted(map(repr, f.select(columns).collect())) for f in (page_frame(shred(pages)), frame_of_fields(page_fields(pages))))
    assert len(got) == 504 and got == want


def test_each_column_alone_is_that_of_the_whole_frame(pages):
    whole = A.corpus_frame(pages).cache()
    records = A.page_records(whole).cache()
    for column in ("intro_text", "blocks", "references", "infobox", "hits", "lead_figure"):
        assert sorted(map(repr, A.corpus_frame(pages, column).collect())) == sorted(map(repr, whole.select("page_id", column, "quarantine").collect()))
    alone = A.page_records(A.corpus_frame(pages, "sections"))
    assert sorted(map(repr, alone.select("page_id", "sections").collect())) == sorted(map(repr, records.select("page_id", "sections").collect()))
    of_record = A.page_records(A.corpus_frame(pages, *A.RECORD_COLUMNS))
    assert of_record.columns == records.columns and sorted(map(repr, of_record.collect())) == sorted(map(repr, records.collect()))
    whole.unpersist(), records.unpersist()


@pytest.mark.parametrize("job", ["r1_assemble", "r1_markdown", "r1_json_write", "r1_page_stats", "r1_sections", "r1_section_text", "r1_section_media", "r1_references", "r1_lead_figure"])
def test_no_nodes_leave_the_stage(spark, monkeypatch, pages, job):
    monkeypatch.setattr(PG, "r1_pages", lambda *_: pages)
    plan = getattr(PG, job)(spark, "")._jdf.queryExecution().analyzed().toString()
    stage = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert "nodes#" not in plan and "blocks#" not in stage
    if job == "r1_references":
        assert "scripts#" not in stage and "tree#" not in stage


def test_a_page_url_is_parsed_once_for_all_images():
    from folia.functions import urls as U
    from folia.operators import payload as P

    # of a base used once Spark would put the expression into the lambda over the images
    assert P.payload_hits(base="the_base").startswith("transform(array(the_base)") and P.payload_hits(base="the_base").count("the_base") == 1
    wrapped = U.normalize_image_url("raw", "b", parsed_base=True)
    assert wrapped.count("(?:^|&)url=") == 1
