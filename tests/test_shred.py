"""Tree rules of the shred stage (pure Python, no Spark)."""

from folia.operators.shred import shred_html


def by_tag(nodes, tag):
    return [n for n in nodes if n["tag"] == tag]


def test_paragraphs_nest_without_implied_closing():
    nodes, err = shred_html("<article><p>one<p>two</p>three</p></article>")
    assert err is None
    outer, inner = by_tag(nodes, "p")
    assert inner["parent_pos"] == outer["pos"]
    assert outer["text"] == "onetwothree"
    assert inner["text"] is None  # no block of its own: nobody reads it
    assert outer["pos"] < inner["pos"] <= outer["end_pos"]


def test_void_and_self_closed_tags_are_leaves():
    nodes, _ = shred_html("<p>a<br>b<img src='x'>c<div/>d</p>")
    p = by_tag(nodes, "p")[0]
    img = by_tag(nodes, "img")[0]
    assert img["end_pos"] == img["pos"]
    assert img["parent_pos"] == p["pos"]
    assert p["text"] == "a bcd"  # br is a line break, img adds no text


def test_unmatched_end_tag_is_ignored_and_match_pops_to_it():
    nodes, _ = shred_html("<ul><li>a</span>b<li>c</ul><p>after</p>")
    ul = by_tag(nodes, "ul")[0]
    lis = by_tag(nodes, "li")
    assert lis[1]["parent_pos"] == lis[0]["pos"]  # no implied </li>
    p = by_tag(nodes, "p")[0]
    assert p["parent_pos"] == -1 and p["pos"] > ul["end_pos"]


def test_links_render_own_text_or_href_and_skip_buttons():
    nodes, _ = shred_html("<h1>Title<button>edit</button></h1><p>see <a href=' /x '>  the   link </a>.<a href='/y'></a></p>")
    assert by_tag(nodes, "h1")[0]["text"] == "Title"
    assert by_tag(nodes, "p")[0]["text"] == "see the link./y"


def test_script_is_raw_text_and_charrefs_decode():
    nodes, _ = shred_html("<script>var a = '<p>not a tag</p>';</script><p>&amp; &quot;q&quot;</p>")
    assert by_tag(nodes, "script")[0]["raw"] == "" and len(by_tag(nodes, "p")) == 1
    nodes, _ = shred_html("<script>self.__next_f.push(['<p>'])</script><p>&amp; &quot;q&quot;</p>")
    assert by_tag(nodes, "script")[0]["raw"] == "self.__next_f.push(['<p>'])"
    assert by_tag(nodes, "p")[0]["text"] == '& "q"'


def test_subtree_slices_and_stop_ancestors():
    nodes, _ = shred_html("<article><p>x<span data-tts-block='true'>y</span></p><noscript><p>z</p></noscript></article>")
    art = by_tag(nodes, "article")[0]
    assert art["span"] == len(nodes)
    span = by_tag(nodes, "span")[0]
    assert span["stop_anc"] == by_tag(nodes, "p")[0]["pos"]
    hidden = by_tag(nodes, "p")[1]
    assert hidden["stop_anc"] > art["pos"]


def test_deep_documents_do_not_recurse():
    html = "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000
    nodes, err = shred_html(html)
    assert err is None and by_tag(nodes, "p")[0]["text"] == "deep"


def test_unclosed_runs_stay_linear():
    import time

    for unit in ("<p>some words", "<li>some words", "<dt>some words", "<h2>some words"):
        html = "<article><ul>" + unit * 25_000 + "</ul></article>"
        began = time.process_time()
        nodes, _ = shred_html(html)
        assert time.process_time() - began < 5
        assert sum(len(n["text"] or "") for n in nodes) < 2 * len(html)


def test_every_element_on_request():
    nodes, _ = shred_html("<div><i>x</i></div>", keep_all=True)
    assert [n["tag"] for n in nodes] == ["div", "i"]


def test_unterminated_script_is_lost():
    nodes, _ = shred_html("<p>kept</p><script>never closed")
    assert by_tag(nodes, "script")[0]["raw"] == ""


def test_plain_tokens_read_as_the_tokenizer_reads_them(monkeypatch):
    import re

    from folia.operators import shred as module

    pages = [
        "<!DOCTYPE html><head><title>a &amp; b</title><META Name='x' content=\"1 &gt; 0\" hidden></head><p>t</P >end",
        "<!-- c --><!----><!--->still</p>--><a href='1' HREF=\"2\" >l</a><img src='i'/><br /><x-y z>",
        "<script>if (a < b) f('</b>')</SCRIPT ><p>x</p><script>never closed <p>",
        "<p a=b>bare<p a=\"1\"b=\"2\">joined<p a=\"open><ul><li>", "1 < 2 <<p>q</p>&lt;tail", "<style>p > a {}</style><h1>T<button>e</button></h1>",
    ]
    fast = [shred_html(page, keep_all) for page in pages for keep_all in (False, True)]
    monkeypatch.setattr(module, "_PLAIN", re.compile("(?!)"))
    assert fast == [shred_html(page, keep_all) for page in pages for keep_all in (False, True)]


def test_only_the_tags_asked_for_leave_the_fold():
    nodes, _ = shred_html("<article><h1>T <a href='x'>l</a></h1><p>p</p></article>", tags=frozenset(["article", "h1"]))
    assert [(n["tag"], n["idx"], n["span"], n["pos"], n["text"]) for n in nodes] == [("article", 1, 2, 0, None), ("h1", 2, 1, 1, "T l")]


def test_text_that_nobody_reads_is_not_kept():
    from folia.operators import shred as module

    folder = module._Folder(module._Nodes(), tags=frozenset(["article", "h1"]))
    folder.feed("<article><p>skipped <a href='x'>l</a></p><h1>T <a href='/y'></a>&amp;<b>")
    assert folder.inl == ["T ", "/y", "&"]
    folder.feed("</h1>tail<ul><li>i<li>")
    assert folder.inl == [] and folder.out.dicts()[1]["text"] == "T /y&"


def test_elements_that_leave_no_node_are_passed_over_whole():
    import random
    import time

    from folia.operators import shred as module

    head = frozenset(["head", "title", "article", "h1", "h2"])
    page = "<p>a <a href='x>y'>l</a><br></p><ul><li><b>1</b><li-x>2</li-x></li></ul>t<h1>T</h1>"
    found = module._after_quiet(head).match(page)
    assert found[1].endswith("</p>") and page.count("<", 0, found.end(1)) == 5  # a name with a dash is read as its own token
    assert module._after_quiet(head).match(page.replace("li-x", "i"))[1].endswith("</ul>")
    rng = random.Random(7)
    pieces = ["<p>", "</p>", "<div class='a'>", "</div>", "<li>x</li>", "<ul>", "</ul>", "<dt>k</dt>", "<dd>v</dd>", "<dt>", "<dd>", "<br>", "<img src='i'>", "<h1>",
              "</h1>", "<article>", "</article>", "<a href='/x'>l</a>", "<figure><img src=a><figcaption>c</figcaption></figure>", "<b/>", "<P>q</P>", " t & u ",
              "<figcaption>d</figcaption>", "<figure>", "</figure>", "<span data-tts-block='true'>s</span>", "<i title='</i>'>w</i>", "<h2>R</h2>", "<script>1<2</script>", "1 < 2"]
    sets = [head, head | {"dt", "dd"}, head | {"a"}, head | {"figure", "img", "figcaption"}, head | {"li"}, head | {"p", "span"}]
    for _ in range(600):
        html = "".join(rng.choices(pieces[:-1] if rng.random() < 0.9 else pieces, k=rng.randint(1, 30)))
        every, _ = shred_html(html)
        for tags in sets:
            nodes, _ = shred_html(html, tags=tags)
            plain = lambda ns: [{k: v for k, v in n.items() if k not in ("idx", "span")} for n in ns]
            assert plain(nodes) == plain(n for n in every if n["tag"] in tags), (html, tags)
    for unit in ("<p>w", "<ul><li>x</li>", "<div><p>a</p><p>b</p>", "<p><b>x</b><i>y</p>", "<p a='1' b='2' c", "<li>x</li>", "<p><p>a</p>"):
        began = time.process_time()
        shred_html("<article>" + unit * 25_000, tags=head)
        assert time.process_time() - began < 5


def test_an_element_of_text_alone_is_read_in_one_go():
    import random

    from folia.operators import shred as module

    tags = frozenset(["head", "title", "article", "meta", "h1", "h2", "h3", "dt", "dd"])
    for element in ("<h1>T</h1>", "<dt class='k'></dt>", "<title>a &amp; b</title>", "<li-x>2</li-x>"):
        assert module._after_quiet(tags).match("<p>passed</p>" + element + "t</h1>")[0] == "<p>passed</p>" + element
    for rest in ("<h1/>T</h1>", "<h1>T<b>", "<h1>T</H1>", "<h1>T</h1 >"):
        assert module._after_quiet(tags).match(rest)[0] == rest[:rest.index(">") + 1]
    pieces = ["<title>a &amp; b</title>", "<h1>T</h1>", "<h2> References </h2>", "<h3>another heading here</h3>", "<blockquote>", "</blockquote>", "<h1/>y</h1>",
              "<meta name='a'>m</meta>", "<br>x</br>", "<script>z</script>", "<script>&amp;</SCRIPT>", "<style>s</style>", "<pre>\n q </pre>", "<pre>", "</pre>", "<code>c d</code>",
              "<a href='/x' href='/y'>l</a>", "<a href=''></a>", "<dt>K</DT>", "</dt>", "<dt> k  k </dt>", "<dd>&lt;v</dd>", "<dd></dd>", "<DT>q</DT>", "<span data-tts-block='true'>s</span>",
              "<figure>", "<figcaption>c</figcaption>", "</figure>", "<ul>", "<li>i</li>", "</ul>", "<article>", "</article>", "<article>t</article>", "<p>", "</p>", "<x-y>w</x-y>", "tail"]
    sets = [tags, tags | {"pre", "code"}, tags | {"a", "script"}, tags | {"figure", "figcaption"}, tags | {"li", "ul"}, tags | {"span", "p", "blockquote"}]
    rng = random.Random(11)
    for _ in range(800):
        html = "".join(rng.choices(pieces, k=rng.randint(1, 25)))
        every, _ = shred_html(html)
        for some in sets:
            plain = lambda ns: [{k: v for k, v in n.items() if k not in ("idx", "span")} for n in ns]
            assert plain(shred_html(html, tags=some)[0]) == plain(n for n in every if n["tag"] in some), (html, some)
