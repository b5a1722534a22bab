"""Operator 2: pages whose article is known."""

import time
import tracemalloc

import pytest

from pos360.llm.html_extract import extract, main_text, path_ratios, read_page

PARAS = ["First paragraph, with some text. And a second sentence, too.", "Short one.", "Third & last: it has \"quotes\" and an en – dash."]
ARTICLE = "<h1>Head line</h1><p>First paragraph, with some <b>text</b>. And a\n   second sentence, too.</p><p>Short one.<p>Third &amp; last: it has &quot;quotes&quot; and an en &#8211; dash.</p>"
WANT = "\n".join(["Head line", *PARAS])
MENU = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(30))


@pytest.mark.parametrize("page", [
    f"<html><body><nav><ul>{MENU}</ul></nav><article>{ARTICLE}</article><footer>&copy; us, 2020. All rights reserved, really.</footer></body></html>",
    f"<body><div id=menu>{MENU}</div><div class='post'>{ARTICLE}</div><div class=\"sidebar right\"><p>Long side text, it goes on and on. And on.</p></div>",
    f"<body class='has-sidebar'><header><h2>Site</h2></header><main><div>{ARTICLE}</div><section id='comments'><h3>Comments</h3><p>Great post, I like it. Thanks, really!</p></section></main>",
    f"<div class='cookie-notice'>We use cookies, as all do. Agree, please.</div><article>{ARTICLE}<form><label>Mail</label><input name=a></form><div class='ad-slot'>Buy, buy, buy! Now.</div></article>",
    f"<article><script>if (a < b) document.write('<p>no, no. no</p>')</script><style>p {{ margin: 0 }}</style><!-- <p>gone, gone.</p> -->{ARTICLE}</article>",
    f"<ARTICLE CLASS=story>{ARTICLE}<ASIDE><P>Aside, aside. Aside!</P></ASIDE><p hidden>Not, shown. At all.</p><div style='display: none'>Nor, this.</div></ARTICLE><div role=contentinfo>Imprint, address. And more.</div>",
])
def test_known_articles(page):
    assert main_text(page) == WANT


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text", "plain text"), ("<p>a", "a"), ("<div>x<!-- never closed", "x"), ("<nav>only a menu</nav>", ""), ("<p>a &am", "a &am"), ("<p>a &amp", "a &"),
    ("<p>one<br>two</p>", "one two"), ("<script>never closed", ""), ("<div a='>x</div>", "x"), ("<p>5 < 6 and 7 > 6</p>", "5 < 6 and 7 > 6"), ("</p></div><p>z</p></b>", "z"), ("<p>&nbsp; a   b</p>", "a b"),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


LONG = "A sentence of some length, with marks. And another of them, as long as this. " * 6


@pytest.mark.parametrize("page, text", [
    # title and introduction above the element with the body
    ("<body><article><h1>Title</h1><p>intro</p><div class='entry-content'>{b}</div></article></body>", "Title\nintro\n{t}"),
    ("<main><h1>Title</h1><section><p>intro</p></section><div><div>{b}</div></div><p>end</p></main>", "Title\nintro\n{t}\nend"),
    # one part holds nearly all
    ("<article><h1>Title</h1><p>intro</p><table><tr><td>{b}</td></tr></table><p>end</p></article>", "Title\nintro\n{t}\nend"),
    ("<article><h1>Title</h1><p>intro</p><section>{b}</section><p>end</p></article>", "Title\nintro\n{t}\nend"),
    ("<body><div><h1>Title</h1><p>intro</p><blockquote>{b}</blockquote><p>end</p></div></body>", "Title\nintro\n{t}\nend"),
    ("<body><div><h1>Title</h1><p>intro</p><ul><li>{b}</li></ul><p>end</p></div></body>", "Title\nintro\n{t}\nend"),
    # no wrapper: by the ratio of the path, headings with what they stand above
    ("<body><div>x</div><div><a>y</a></div><h1>Title</h1><p>Intro, a line of it, and more. Yes.</p><div>{b}</div></body>", "Title\nIntro, a line of it, and more. Yes.\n{t}"),
    ("<body><h1>Title</h1><center><table><tr><td>{b}</td></tr></table></center></body>", "Title\n{t}"),
    ("<article><h1>One</h1>{b}<ul><li>a</ul></article><article><h1>Two</h1>{b}</article>", "One\n{t}\na\nTwo\n{t}"),
])
def test_what_stands_outside_the_densest_element(page, text):
    body = f"<p>{LONG}</p>" * 12
    assert main_text(page.format(b=body)) == text.format(t="\n".join([LONG.strip()] * 12))


@pytest.mark.parametrize("page", [
    "<article class='post comments-open'>{a}</article>", "<div id='page' class='header-fixed'>{a}</div>", "<div class='content-with-sidebar'>{a}</div>",
    "<body><form id='form1' action='/'><div class='aspNetHidden'><input></div><div><ul>{m}</ul></div><div>{a}</div></form></body>",
    "<div class='widget' id=sidebar><div class='widget'>Ad, ad.</div><div>{a}</div></div>", "<article id='comment' role='form'>{a}</article><div class='comments-area'><h3>Said</h3><p>Great post, I like it. Thanks, really!</p></div>",
    "<div class='promo-holder'><ul>{m}</ul></div><div class=x>{a}</div><div class='siteNavInner'><p>Long side text, it goes on and on. And on.</p></div><div id='related-posts'><p>Read, this. And that.</p></div>",
])
def test_names_that_only_hold_a_listed_word(page):
    assert main_text(page.format(a=ARTICLE, m=MENU)) == WANT


@pytest.mark.parametrize("page, text", [
    ("<article><h2 id='related-work'>Related work</h2><p>{t}</p></article>", "Related work\n{t}"),
    ("<article><p>{t}</p><section id='social-policy'><h2>Social policy</h2><p>{t}</p></section></article>", "{t}\nSocial policy\n{t}"),
    ("<article><p>Take <span class='notice'>no notice</span> of it.</p><p>{t}</p></article>", "Take no notice of it.\n{t}"),
    ("<article><p>See <a title='a hidden gem'>this</a>, <a data-x='display:none'>that</a>.</p><p>{t}</p></article>", "See this, that.\n{t}"),
    ("<article><p>See <a hidden>this</a><b style='color:red; DISPLAY: none'>that</b>.</p><p class=a hidden=''>x</p><p>{t}</p></article>", "See .\n{t}"),
])
def test_headings_sections_and_words_in_a_sentence(page, text):
    assert main_text(page.format(t=LONG)) == text.format(t=LONG.strip())


def test_nested_cells_and_lists_are_blocks():
    assert main_text("<article><p>Text, text. Text, text.</p><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>") == "Text, text. Text, text.\none\ntwo\na\nb\nc"


def test_ratios_are_those_of_paths():
    nodes = [n for n in read_page("<div><p>aaaa, bbbb.</p><p>cc</p></div>").nodes if n.text.strip()]
    assert nodes[0].path == nodes[1].path != read_page("<div><p>x</p></div>text").nodes[1].path
    fused = (11 + 2) / 2 * (1 + 2 / 2)  # text a node, times one and the marks a node
    assert path_ratios(nodes).tolist() == pytest.approx([fused] * 2)


@pytest.mark.parametrize("page", [
    "<body><div><p>{t}</p><p>{t}</p></div><div><a href=x>Link one</a> <a href=y>Link two</a></div></body>",
    "<main><p>{t}</p><p>{t}</p><ul><li><a href=x>Top stories</a></li><li><a>Other</a></li></ul></main>",
    "<article><p>{t}</p><p>{t}</p></article><section><p>Great post, thanks a lot for it.</p><p>I do not agree, really.</p></section>",
])
def test_links_and_comments_without_telling_names_go(page):
    assert main_text(page.format(t=LONG)) == f"{LONG.strip()}\n{LONG.strip()}"


def test_a_page_of_links_is_its_links():
    assert main_text("<ul><li><a href=x>one</a></li><li><a>two</a></li></ul>") == "one\ntwo"


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "text", "<div>" * 8000 + "</x>" * 100_000 + "text", "<x>" * 100_000 + "text",
    "<p><b>" + "<i>" * 50_000 + "</u>" * 50_000 + "<div>text", "<li>" * 100_000 + "text",
])
def test_time_and_memory_follow_the_page_not_its_nesting(page):
    tracemalloc.start()
    began = time.monotonic()
    assert main_text(page) == "text"
    took, peak = time.monotonic() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 60 and peak < 600 * len(page)


def test_very_long_and_deep_pages():
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    long = "word, " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()
    assert main_text("<" * 20_000 + "a='") is not None


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    pages = spark.createDataFrame([(1, "u", "<p>é x</p>", "clash", 1), (1, "u", "<p>é x</p>", "clash", 1), (None, None, None, None, None)], schema)
    assert sorted(map(tuple, extract(pages).collect()), key=str) == [(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0)]
    assert extract(pages.where("false")).count() == 0
