from __future__ import annotations

import html as entities
import random
import re
import time

import pytest

from runledger.llm.html_blocks import texts
from runledger.llm.style_tree import main_text

SCHEMA = "page_id long, url string, html string"


def result(spark, rows):
    # Extra columns with names that the operator uses inside.
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as page", "'x' as text", "2 as key", "3 as n", "4 as at")
    out = main_text(df).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return sorted(((r.page_id, r.url, r.text) for r in out), key=str)


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain &amp; simple", ["plain & simple"]),
    ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<p>a  <b>b</b>\n\tc<br>d&nbsp;e</p>", ["a b c d e"]),
    ("<p>x<b>y</p><p>z</b>w", ["xy", "zw"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
    ("a<!-- <p>no</p> --!>b<!-->c<!--->d", ["abcd"]),
    ("a<!-- open", ["a"]), ("a<p class='x", ["a"]), ("a < b <3 </ x>c", [
        "a < b <3 c"]),
    ("x<script>if (a</b) '</p>'</script >y<style>p{}</style>z", ["xyz"]),
    ("<script>never closed <p>x", []),
    ("<title>T</title><p title='a>b'>x</p>", ["x"]),
    ("<nav>a<p>b</nav><p>c<aside>d</aside><footer>e</footer>", ["c"]),
    ("<body class='has-sidebar'><div id=main-menu>m</div>t", ["t"]),
    ("<div class='post no-comments'>a<div class=comment>b</div></div>",
     ["a"]),
    ("<h2 id=related-search>head</h2><p id=related>r</p>", ["head"]),
    ("<header>h</header><article><header><h1>T</h1></header><p>a</p>"
     "<div class='article-header'>k</div><form>f</form></article>z",
     ["T", "a", "k"]),
    ("<form><p>f<article>a<p>b</article>g</form>", ["a", "b"]),
    ("<div class=sidebar><p>s</p><main>m</main></div>t", ["m"]),
    ("<article>a</article><article class=comment>c</article>", ["a"]),
    ("<div><p>a<span class=ad>b</span>c</p><button>d</button></div>", ["ac"]),
    ("<p hidden>a</p><p style='display: none'>b</p><p>c</p>", ["c"]),
    ("&lt;p&gt; &am &amp &#x41;&notit; &unknown;", ["<p> &am & A¬it; "
                                                   "&unknown;"]),
    ("a<p>\x00 　b</p></p></div></b>c", ["a", "\x00 b", "c"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_long_and_deep_pages():
    """Time grows with the page, whatever is nested or left open."""
    for page in ("<div>" * 60_000 + "x", "<p><b>" * 60_000 + "x",
                 "<p>" + "<i>" * 60_000 + "</u>" * 60_000 + "x",
                 "<p><table><td>" + "<div>" * 60_000 + "x",
                 "<a href='x" + "<a href=\"" * 60_000, "<" * 300_000 + "x",
                 "x<!--" * 60_000, "<p a" + " =" * 60_000 + ">x",
                 "<script>" + "</scrip" * 60_000):
        t0 = time.perf_counter()
        texts(page)
        assert time.perf_counter() - t0 < 5
    assert texts("<p>" + "word " * 400_000) == [("word " * 400_000).strip()]


def test_given_pages(spark):
    """The pages of the test tables: headings and paragraphs of the article
    element, read by a plain search."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def plain(page):
        found = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", found)
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>|<[^>]*$", " ",
                                                   p)).split())
                 for p in parts]
        return " ".join(p for p in parts if p)

    want = sorted((r.page_id, r.url, plain(r.html)) for r in pages.collect())
    got = sorted((r.page_id, r.url, r.text)
                 for r in main_text(pages).collect())
    assert got == want


def sentence(rng):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
                    for _ in range(12))


def test_style_tree_removes_what_pages_share(spark):
    rng = random.Random(4)
    own = {k: [sentence(rng) for _ in range(3)] for k in range(12)}
    page = ("<div class=q7><p>{0}</p><p>{1}</p><p>{2}</p></div><div class=z1>"
            "<p>All rights</p><p>of this site</p><p>Top</p>"
            "<p>No {3} of all</p></div>"
            "<p>Try our other pages today</p>")
    rows = [(k, f"http://a.example/{k}", page.format(*own[k], k))
            for k in own]
    # The same template on a host with too few pages to judge.
    rows += [(100 + k, f"http://b.example/{k}", page.format(*own[k], k))
             for k in range(2)]
    # One article copied over a whole host, with other surroundings.
    rows += [(200 + k, f"http://c.example/{k}",
              f"<div>{' '.join(own[0])}</div><p>{own[0][1]}</p>"
              f"<i>{sentence(rng)[:20]}</i>") for k in range(9)]
    rows += [(300, None, "<p>x"), (301, None, None), (302, "odd", ""),
             (300, None, "<p>x"), (None, None, "<p>x")]
    got = {r[0]: r[2] for r in result(spark, rows)}
    for k in own:
        assert got[k] == " ".join(own[k])
    for k in range(2):
        assert got[100 + k] == " ".join(own[k]) + (
            f" All rights of this site Top No {k} of all Try our other "
            "pages today")
    for k in range(9):
        assert got[200 + k].startswith(" ".join(own[0]) + " " + own[0][1])
    assert (got[300], got[301], got[302], got[None]) == ("x", "", "", "x")
    assert len(result(spark, rows)) == len(rows)


def test_plain_paragraphs_of_an_article(spark):
    """A paragraph of all articles goes, one of many articles stays, and a
    marked-up box of all articles goes with its odd lines."""
    rng = random.Random(6)
    own = {k: [sentence(rng), sentence(rng)] for k in range(20)}
    rows = [(k, f"http://a.example/{k}", (
        f"<p>menu</p><article><h1>{own[k][0]}</h1><p>{own[k][1]}</p>"
        + ("<p>shared by most</p>" if k % 4 else "")
        + f"<div class=k2><p>Send to a friend</p><p>by post</p>"
          f"<p>or copy</p><p>nr {k}</p></div><p>Thanks for reading</p></article>"))
        for k in own]
    got = {r[0]: r[2] for r in result(spark, rows)}
    for k in own:
        assert got[k] == " ".join(own[k]) + (
            " shared by most" if k % 4 else "")


def test_empty_table(spark):
    assert result(spark, []) == []
