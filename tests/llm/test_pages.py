from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripflow.llm import urls
from tripflow.llm.extraction import host_of, main_texts, path_of
from tripflow.llm.html import blocks, parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><a href=/>Home</a></nav><div class="promo box">Buy {n}!</div>
<div id=x><p>Template line</p></div>
<article><h1>Title &amp; {n}</h1><p>First <b>bold</b>
text<br>more<p>Second &lt;tag&gt; &#233;<div class=banner>ad</div><div><em>Sign up</em> here</div>
<ul><li>one<li>two</ul><script>var t="</p>";</script><p>Shared quote.</p></article>
<footer>&copy; me</footer></body></html>"""


def test_blocks_of_a_page():
    assert blocks(parse(PAGE.replace("{n}", "7"))) == [
        "Title & 7", "First bold text more", "Second <tag> é", "Sign up here", "one", "two",
        "Shared quote."]


@pytest.mark.parametrize("page, text", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("</div></p>x<", ["x<"]),
    ("<p title='>'>q</p>", ["q"]), ("<p 'unclosed>z</p> end", ["z", "end"]),
    ("<!-- <p>no</p> --><p>yes", ["yes"]), ("<script>if (a<b) {}", []),
    ("<main><p>in</p></main><p>out</p>", ["in"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]),
    ("<body><div class='comment-list'><p>bad</p></div><p>good&nbsp; x</p>", ["good x"]),
    ("<p hidden>a</p><div aria-hidden=true>b</div><p>c</p>", ["c"]), ("<p>a" + "<b>" * 5000 + "x", ["ax"]),
])
def test_odd_pages(page, text):
    assert blocks(parse(page)) == text


def test_recurring_subtrees_go_and_running_text_stays(spark):
    rows = [(i, f"https://A.example/{i}", PAGE.replace("{n}", str(i))) for i in range(40)]
    # A copied page and a host with the same parts on few pages are no evidence.
    rows += [(100 + i, "https://b.example/", "<body><div><p>rare</p></div><p>same</p>") for i in range(30)]
    rows += [(200 + i, f"https://c.example/{i}",
              f"<body><div class=top>Site name</div><p>page {i}</p></body>") for i in range(10)]
    found = {r.page_id: r.text for r in
             main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "Title & 3\nFirst bold text more\nSecond <tag> é\none\ntwo\nShared quote."
    assert found[100] == "rare\nsame"
    assert found[204] == "page 4"


def test_awkward_pages(spark):
    schema = "page_id long, url string, html string, text string, host int, template string, digest int"
    rows = [(1, None, None, "t", 1, "x", 1), (None, "u", "", None, None, None, None),
            (2, "http://h/a", "<p>" + "long " * 100_000, None, 1, None, 2),
            (3, "http://h/a", "<p>x", None, 1, None, 2), (3, "http://h/a", "<p>x", None, 1, None, 2)]
    pages = spark.createDataFrame(rows, schema)
    found = sorted((r.page_id or 0, r.text[:9]) for r in main_texts(pages).collect())
    assert found == [(0, ""), (1, ""), (2, "long long"), (3, "x"), (3, "x")]
    assert main_texts(pages.where("false")).count() == 0


@pytest.mark.parametrize("url, host, path", [
    ("https://A.Example.com/en/X?y#z", "a.example.com", "/en/X"), (None, "", ""), ("nothing", "", ""),
    ("a://b://c/d", "b:", "//c/d"), ("http://h?x/y", "h", ""), ("://ÄB\n/p\n#", "Äb\n", "/p\n"),
    ("x#://h/p", "h", "/p"),
])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(
        host_of("url").alias("h"), path_of("url").alias("p")).first()
    assert (row.h, row.p) == (host, path)


def brute_rule(host: str, path: str):
    fits = [(len(r), r, v) for v, r in urls.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def test_verdicts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    rows = urls.judge(pages).collect()
    assert len(rows) == pages.count()
    for r in rows:
        rule, verdict = brute_rule(r.host, r.path)
        assert r.rule == rule
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    special = ["http://com/x", "http://xcom/", "http://net/es/", "http://net/es", "http://www.example.com/en/",
               "http://a.www.example.com/en/q", "http://b.example.com/en/", "http://notexample.com/en/"]
    rows = urls.judge(spark.createDataFrame(list(enumerate(special)), "page_id long, url string")).collect()
    assert {r.url: r.rule for r in rows} == {u: brute_rule(u[7:].split("/")[0], "/" + u[7:].split("/", 1)[1]
                                                           if "/" in u[7:] else "")[0] for u in special}


def test_trees_tell_kinds_of_urls(spark):
    good = [f"http://site{i % 7}.com/en/page{i}" for i in range(300)]
    bad = [f"http://x{i}9{i}.net/es/{i * 7919}?a={i}&b=1&c=2" for i in range(300)]
    asked = ["http://site3.org/about", "http://q11.org/es/998877?a=1&b=2&c=3"]
    rows = urls.judge(spark.createDataFrame(
        list(enumerate(good + bad + asked)), "page_id long, url string")).where("rule is null").collect()
    assert {r.url: r.verdict for r in rows} == dict(zip(asked, ("allow", "block")))


def test_awkward_urls(spark):
    schema = "page_id long, url string, host int, rule string, verdict string, depth int"
    rows = [(1, None, 1, "r", "v", 2), (None, "", 1, None, None, 2), (2, "x" * 20_000, 1, None, None, 2),
            (3, "http://a.com/", 1, None, None, 2), (3, "http://a.com/", 1, None, None, 2)]
    pages = spark.createDataFrame(rows, schema)
    found = urls.judge(pages)
    assert sorted(found.columns) == sorted(pages.columns + ["path"])
    assert found.count() == 5 and found.where(F.col("verdict") != "allow").count() == 0
    assert urls.judge(pages.where("false")).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<div style='overflow:hidden'><article><p>a</p></article></div>", ["a"]),
    ("<article><p title='the hidden valley'>a <a href='/s?id=related'>b</a>"
     "<i data-id=comment-7>c</i><a href=/s?id=related>d</a></article>", ["a bcd"]),
    ("<article><h2 id='search-algorithms'>a</h2><section id=social-history><p id=sharing-b>b</p>"
     "</section></article>", ["a", "b"]),
    ("<h2 id='search-algorithms'>a</h2><section id='social-history'>b</section>", ["a", "b"]),
    ("<article><div id=comments>a</div><p class='ad-slot'>b</p><p data-class=ad>c</p>"
     "<p HIDDEN>d</p><p id='x' hidden>e</p></article>", ["c"]),
    ("<div id=comment-list>a</div><p>b<ul id=breadcrumbs><li>c</ul>", ["b"]),
])
def test_attributes_are_read_name_by_name(page, text):
    assert blocks(parse(page)) == text


def test_running_text_without_article_stays(spark):
    page = ("<body><div class=top><h3>Site</h3><p>Slogan</p></div><ul><li><a>Home</a><li>More</ul>"
            "<div><h2>Conclusion</h2><p>In <a>Paris</a> {n} <b>people</b> eat <acronym>BLT</acronym>.</p>"
            "<p>The end.</p><ul><li>Bread<li>{n}</ul><table><tr><td>Yes<td>{n}</table></div></body>")
    rows = [(i, f"http://h/{i}", page.replace("{n}", str(i))) for i in range(12)]
    rows += [(100 + i, f"http://i/{i}", f"<article><p>The <acronym>WHO</acronym> met {i}.</p></article>")
             for i in range(12)]
    found = {r.page_id: r.text for r in
             main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "Conclusion\nIn Paris 3 people eat BLT.\nThe end.\nBread\n3\nYes 3"
    assert found[104] == "The WHO met 4."


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    def page(i):
        menu = "<div class=part>Section menu</div>" if i < 8 else ""
        return i, f"http://h/{'a' if menu else 'b'}/{i}", f"<body>{menu}<p>text {i}</p></body>"

    for size in (20, 400):
        df = spark.createDataFrame([page(i) for i in range(size)], "page_id long, url string, html string")
        found = {r.page_id: r.text for r in main_texts(df).collect()}
        assert found == {i: f"text {i}" for i in range(size)}


@pytest.mark.parametrize("page, text", [
    ("<main><article class='related'>teaser</article><p>The body</p></main>", ["The body"]),
    ("<article><p>Story</p></article><article class='comment'>I like it</article>", ["Story"]),
    ("<article><p>Story</p><article class='comment-item x'>No</article></article>", ["Story"]),
    ("<article><p class='search'>a</p><p class='notice'>b</p><h2 class='notification'>c</h2>"
     "<div class='share'>d</div><div class='sidebar-free'>e</div></article>", ["a", "b", "c", "d", "e"]),
    ("<article class='post with-sidebar'><p>Story</p></article>", ["Story"]),
    ("<body><article class='teaser'>One</article><div class='share'>x</div><p>Own</p></body>", ["Own"]),
])
def test_main_parts_are_the_pages_own(page, text):
    assert blocks(parse(page)) == text
