"""Wrapper inference and main text of hand-made pages."""

import pytest

from tickline.llm import html_wrappers as hw
from tickline.llm.html_tree import parse

PROSE = "The long text number {0} of this page says {0} things that no other page says, and goes on for a while about {0}."


def text_of(page, *others):
    """Text of ``page`` by the wrapper of it and ``others``."""
    whole = None
    for p in (page, *others):
        own = hw.fold(parse(p, hw._marked))
        whole = own if whole is None else hw.merge(whole, own, across=True)
    return hw.main_text(parse(page, hw._marked), hw.decide(whole))


def shape(w):
    inner = " ".join(shape(k) for k in w.kids)
    return f"{w.label}{'{' + inner + '}' if inner else ''}{'+' if w.rep else ''}{'?' if w.opt else ''}"


def test_alignment_finds_optional_and_repeated_groups():
    def wrap(*pages):
        whole = None
        for p in pages:
            own = hw.fold(parse(p, hw._marked))
            whole = own if whole is None else hw.merge(whole, own, across=True)
        return whole

    one = wrap("<div class=c><h1>a</h1><p>x<p>y</div>", "<div class=c><h1>b</h1><p>z</p><ul><li>1</ul></div>")
    assert shape(one) == "#root{div.c{h1 p+ ul{li}?}}"
    assert one.kids[0].kids[0].literal == "*" and one.pages == 2
    pairs = wrap("<dl><dt>a<dd>1<dt>b<dd>2</dl>", "<dl><dt>c<dd>3</dl>", "<dl><dt>c<dd>3<dt>d<dd>4<dt>e<dd>5</dl>")
    assert shape(pairs) == "#root{dl{(dt dd){dt dd}+}}"
    apart = wrap("<div><ul><li>a</ul></div><div><h1>t</h1><p>x</div>", "<div><h1>u</h1><p>y</div>")
    assert shape(apart) == "#root{div{ul{li}}? div{h1 p}}"
    same = wrap("<p>k</p>", "<p>k</p>")
    assert same.kids[0].literal not in ("", "*")


def test_wrapper_size_is_bounded_by_layout():
    mixed = "".join(f"<{t}>x{i}</{t}>" for i in range(3000) for t in [("p", "h2", "pre", "blockquote", "h3")[(i * i + i // 7) % 5]])
    w = hw.fold(parse(f"<article>{mixed}</article>", hw._marked))
    assert len(w.kids[0].kids) <= hw.MOST_KIDS
    deep = "<div>" * 3000 + "bottom" + "</div>" * 3000
    assert text_of(f"<article>{deep}</article>") == "bottom"


BOILER = [
    "<nav><ul><li><a href=/>Home</a></ul></nav>",
    "<header><h1>Site</h1></header>",
    "<div class='site-header'>Site</div>",
    "<aside>side</aside>",
    "<div id=sidebar><p>side</p></div>",
    "<div class='cookie-notice'>We use cookies</div>",
    "<div class=ad>buy</div>",
    "<div class='adBanner'>buy</div>",
    "<ins class=adsbygoogle>buy</ins>",
    "<form action=x><label>Mail</label><input><button>Go</button></form>",
    "<script>var a = '<p>no</p>';</script>",
    "<style>p {}</style>",
    "<!-- <p>no</p> -->",
    "<section id=comments><h3>2 comments</h3><article class=comment><p>first!</p></article></section>",
    "<section><h2>Comments (3)</h2><p>first!</p></section>",
    "<div role=complementary>side</div>",
    "<noscript>enable</noscript>",
    "<footer><p>&copy; site</p></footer>",
    "<div class='share-buttons'><a href=x>Share</a></div>",
]


@pytest.mark.parametrize("extra", BOILER)
def test_boilerplate_inside_and_outside_the_article_goes(extra):
    body = f"<h1>Title</h1><p>{PROSE.format(1)}</p><p>a&nbsp;&lt;b&gt; &amp; c</p>"
    want = f"Title\n\n{PROSE.format(1)}\n\na <b> & c"
    assert text_of(f"<html><body>{extra}<article>{body}</article>{extra}</body></html>") == want
    if "<header" not in extra:  # the article's own header: its headings stay
        assert text_of(f"<html><body><article>{body}{extra}</article></body></html>") == want
    assert text_of(f"<html><body>{extra}<main>{body}</main></body></html>") == want


def test_undeclared_article_is_found_by_the_wrapper():
    def page(i, more=""):
        return (
            "<html><body><div><a href=/>Start here</a> <a href=/b>All of the topics</a> <a href=/c>About this site</a></div>"
            "<div>Our summer offer ends on Sunday, tell all of your friends about the summer offer today.</div>"
            f"<div><h1>Head {i}</h1><p>{PROSE.format(i)}</p><p>{PROSE.format(i + 50)}</p>{more}</div>"
            "<div>All rights reserved by the owners of this site and by nobody else at all.</div></body></html>"
        )

    pages = [page(i, "<p>more</p>" * (i % 3)) for i in range(1, 6)]
    assert text_of(*pages) == "\n\n".join(["Head 1", PROSE.format(1), PROSE.format(51), "more"])


def test_broken_markup():
    assert text_of("<article><p><b>one<br><p>two</p><h1>three<h2>four</article>tail") == "one\n\ntwo\n\nthree\n\nfour"
    assert text_of("<article><p title='a > b'>x<p data-x=\"it's\">y</article>") == "x\n\ny"
    assert text_of("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul></article>") == "a\n\nb\n\nc\n\nd"
    assert text_of("<article><table><tr><td>a<td>b<tr><td>c</table>z</article>") == "a\n\nb\n\nc\n\nz"
    assert text_of("<article>in <i>line</i>d <span class=ad>no <span>no</span> no</span>text<p>5 < 6 &am &amp</article>") == "in lined text\n\n5 < 6 &am &"
    assert text_of("<article><p>open script <script>x") == "open script"
    assert text_of("<article><header><h1>T</h1><p>by me</p></header><p>x</p></article>") == "T\n\nx"
    assert text_of("<div class='content-with-sidebar'><h1>T</h1><p>" + PROSE + "</p></div>").startswith("T\n\nThe long")
    assert text_of("") == "" and text_of("<nav>x</nav>") == ""


def test_extract_on_spark(spark):
    def page(i):
        return f"<body><div class=menu>m</div><article><h1>T{i}</h1><p>{PROSE.format(i)}</p></article><div class=ad>a</div></body>"

    rows = [(i, f"http://{'hot' if i % 3 else f'h{i % 7}'}.example/{i}", page(i), "clash", 1) for i in range(120)]
    rows += [(200, None, page(200), "c", 1), (201, "no host", page(201), "c", 1), (202, "http://x.example", None, "c", 1), (203, "http://hot.example/", "", None, None)]
    rows += [(5, "http://hot.example/5", page(5), "clash", 1), (None, "http://hot.example/6", page(6), "clash", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, salt int").repartition(5)
    got = hw.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]

    def want(html):
        i = html.split("<h1>T")[1].split("<")[0] if html else ""
        return f"T{i}\n\n{PROSE.format(i)}" if html else ""

    expect = sorted(((i, u, want(h), len(want(h))) for i, u, h, _, _ in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expect
    assert hw.extract(pages.where("1 = 0")).count() == 0
