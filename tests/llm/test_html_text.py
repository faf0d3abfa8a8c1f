"""Main text of pages: hand-written pages, the test tables against a plain reading of their markup."""

import html as references
import os
import re

import pytest

from zerotally.llm import html_text
from zerotally.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def texts(spark, pages, **kw):
    got = html_text.extract(spark.createDataFrame(pages, SCHEMA), **kw)
    return sorted(((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()), key=repr)


def one(page):
    return html_text.main_text(page, frozenset())


def test_blocks_references_and_white_space():
    assert one("<article><h1>A &amp; B</h1>\n<p>x \n\t y<br>z &lt;3 &#233;&nbsp;!<p>second <b>bo</b>ld<ul><li>i<li>j</ul>tail</article>") == \
        "A & B\nx y z <3 é !\nsecond bold\ni\nj\ntail"
    assert one("<p>a &am b &amp") == "a &am b &"
    assert one("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert one("") == "" and one("no markup  at all") == "no markup at all" and one("<!-- c --><p>a<p>") == "a"


def test_furniture_goes():
    page = ("<head><title>t</title></head><body><header>site</header><nav>menu</nav><div class='ad'>buy</div><aside>side</aside>"
            "<script>var a='<p>no</p>'</script><style>p{}</style><form>f<input></form><article><header><p>by me</p><h1>Head</h1></header>"
            "<p>Text</p><div id='cookie-notice'>we use</div><section class='comments'><article><p>first!</article></section>"
            "<footer>f</footer></article><article class=comment>me too</article><footer>foot</footer>")
    assert one(page) == "Head\nText"


def test_article_inside_marked_wrapper_is_found():
    assert one("<div class='sidebar-left menu'><article><p>a</article></div>") == "a"
    assert one("<body class='form'><main><p>m</p></main><p>no</p></body>") == "m"
    assert one("<div>a<div>b</div>c</div>") == "a\nb\nc"


def test_unclosed_elements():
    assert one("<article><h1>t</h1><p><b>one.<br><p>two</article><footer>x</footer>") == "t\none.\ntwo"
    assert one("<article><p>a</div></span><p>b</article><nav>m") == "a\nb"


def test_deep_and_long_pages():
    assert one("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert one("<article>" + "<p>word</p>" * 50_000 + "</article>").count("\n") == 49_999


def test_templates_of_a_host_go_and_shared_passages_stay(spark):
    passage = "said before " * 40
    pages = [(i, f"https://A.example.com/{i}", f"<body><div><span>Sign up today</span></div><div><p>own words {i}</p><p>{passage}</p></div>"
              f"<div>You read page of A</div><script>{i}</script></body>") for i in range(8)]
    pages += [(100 + i, f"http://b.example.com/{i}", f"<div>Sign up today</div><p>other {i}") for i in range(4)]
    got = dict((i, t) for i, t, _ in texts(spark, pages))
    assert all(got[i] == f"own words {i}\n{passage.strip()}" for i in range(8))
    assert all(got[100 + i] == f"Sign up today\nother {i}" for i in range(4))  # too few pages to tell


def test_copies_of_a_page_are_no_template(spark):
    pages = [(i, f"http://c.example.com/{i}", "<p>Same news</p><p>everywhere</p>") for i in range(50)]
    assert {t for _, t, _ in texts(spark, pages)} == {"Same news\neverywhere"}


def test_link_lists_in_articles_go_only_if_they_recur(spark):
    links = "<div><a href=1>One story</a> <a href=2>Another story</a></div>"
    pages = [(i, f"http://d.example.com/{i}", f"<article><p>own {i}</p><p>Shared line.</p>{links}<ul><li><a>only {i}</a></ul></article>")
             for i in range(6)]
    assert [t for _, t, _ in texts(spark, pages)] == [f"own {i}\nShared line.\nonly {i}" for i in range(6)]


def test_rare_repeats_on_a_large_host_stay(spark):
    pages = [(i, f"http://e.example.com/{i}", f"<p>own {i}</p>" + ("<p>a motto</p>" if i < 6 else "")) for i in range(100)]
    assert [t for _, t, _ in texts(spark, pages, many_share=0.1)][:3] == ["own 0\na motto", "own 1\na motto", "own 10"]


def test_nulls_repeats_empty_table_and_other_columns(spark):
    pages = [(1, None, None), (1, None, None), (None, "", "<p>x"), (2, "no host", "")]
    assert texts(spark, pages) == [(1, "", 0), (1, "", 0), (2, "", 0), (None, "x", 1)]
    assert texts(spark, []) == []
    frame = spark.createDataFrame([(1, "http://h/", "<p>x", "a", 2)], SCHEMA + ", host string, text int")
    assert [tuple(r) for r in html_text.extract(frame).collect()] == [(1, "http://h/", "x", 1)]


def test_list_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", 0)
    pages = [(i, f"http://f.example.com/{i}", f"<p>own {i}</p><div>Terms of use</div>") for i in range(9)]
    assert [t for _, t, _ in texts(spark, pages)] == [f"own {i}" for i in range(9)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_registered_query_against_plain_reading(spark, folder):
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(references.unescape(re.sub(r"<[^>]+>", " " if "br" in b else "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in QUERIES["op11_html_text"](spark, folder).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_broken_markup():
    assert one("a < b and c <3 <p>d <1 e</p>") == "a < b and c <3\nd <1 e"
    assert one("<p title='x > y' class=\"lead\">kept</p><p don't>too</p>") == "kept\ntoo"
    assert one("<p>end <div class=\"cut") == "end"
    assert one("<p>a<!-- never closed <p>b") == "a" and one("<p>a<!-->b<!doctype x><?php x ?></>c") == "abc"
    assert one("<head><title>T</title><meta x><body><p>body") == "body" and one("<title>T</title>text") == "text"
    assert one("<head>text in a head") == "text in a head"
    assert one("<script>if (a</b) '<p>no'</SCRIPT ><p>yes<style>p{}") == "yes"
    assert one("<P CLASS=Ad>no</P><DIV ID='Main'>yes</DIV>") == "yes"
    assert one('<p a="' + "x" * 200_000) == "" and one("<p>" + "<a =\"" * 20_000) == ""
