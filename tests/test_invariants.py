"""
tag soup, and streaming = batch."""

from hypothesis import given, settings
from hypothesis import strategies as st

from folia.operators.shred import shred_html

TAGS = ["p", "div", "a", "li", "ul", "h2", "span", "br", "img", "figure", "article", "script", "b"]
piece = st.one_of(
    st.sampled_from(TAGS).map(lambda t: f"<{t}>"),
    st.sampled_from(TAGS).map(lambda t: f"</{t}>"),
    st.sampled_from(TAGS).map(lambda t: f"<{t}/>"),
    st.text(alphabet="ab &;<>\n", max_size=6),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(piece, max_size=40))
def test_shred_intervals_nest(pieces):
    nodes, err = shred_html("".join(pieces))
    assert err is None
    by_pos = {n["pos"]: n for n in nodes}
    for i, n in enumerate(nodes, start=1):
        assert n["idx"] == i
        assert n["pos"] <= n["end_pos"]
        # the subtree slice holds exactly the emitted nodes inside the interval
        inside = [m for m in nodes if n["pos"] <= m["pos"] <= n["end_pos"]]
        assert inside == nodes[i - 1:i - 1 + n["span"]]
        parent = by_pos.get(n["parent_pos"])
        if parent is not None:
            assert parent["pos"] < n["pos"] <= parent["end_pos"]


def test_stream_equals_batch(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    batch = sorted(map(tuple, E.queries()["page_heads"](spark, sf).collect()))
    stream = E.queries()["stream_pages"](spark, sf)
    streamed = sorted(map(tuple, stream.select("page_id", "url", "slug", "title", "intro_text").collect()))
    assert streamed == batch
