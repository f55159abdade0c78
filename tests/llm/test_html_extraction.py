import html as H
import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom.llm import html_extraction as hx
from wordloom.llm.pages import Text, read

DATA = "/root/testdata"


def plain_article(page):
    """The article of the given tables' pages, taken out with patterns."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    blocks = [" ".join(H.unescape(b).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet")
    rows = hx.extracted(pages).collect()
    assert len(rows) == 250
    for r in rows:
        assert r.text == plain_article(r.row.html)


def learned(*pages):
    w = None
    for p in pages:
        new = hx.wrapper_of(read(p))
        w = new if w is None else hx.absorb(w, new)
    return w


def texts(*pages):
    rules = hx.rules_of(learned(*pages))
    return [hx.main_text(p, rules) for p in pages]


def pattern(x):
    """The regular expression over keys of a wrapper's sequence, one level."""
    said, opened = [], dict(x.groups)
    closed = set(opened.values())
    for n, c in enumerate(x.body):
        mark = {(True, True): "*", (True, False): "?", (False, True): "+", (False, False): ""}[c.optional, c.repeated]
        said.append(("(?:" if n in opened else "") + f"(?:{re.escape(c.key)};){mark}" + (")+" if n in closed else ""))
    return "".join(said)


def matches(wrapper, page, whole):
    keys = "".join((hx.TEXT if isinstance(c, Text) else c.key) + ";" for c in page.children)
    assert re.fullmatch(pattern(wrapper), keys), (pattern(wrapper), keys)
    by = {c.key: c for c in wrapper.body}
    assert len(by) == len(wrapper.body)
    for c in page.children:
        if not isinstance(c, Text) and not hx.excluded(c, whole):
            matches(by[c.key], c, whole)


@pytest.mark.parametrize("seed", range(30))
def test_a_wrapper_matches_all_its_pages(seed):
    rng = random.Random(seed)

    def made(depth):
        out = []
        for _ in range(rng.randint(0, 6)):
            tag = rng.choice(["div", "p", "ul", "h2", "section", "pre"])
            inner = made(depth - 1) if depth and tag in ("div", "section") else rng.choice(["one", "two", "three"])
            out.append(f"<{tag}>{inner}</{tag}>")
        return rng.choice(["", "text"]).join(out)

    pages = [made(3) for _ in range(rng.randint(2, 8))]
    whole = learned(*pages)
    # merged in another way: parts of the pages first
    half = hx.absorb(learned(*pages[: len(pages) // 2]) or hx.Item(""), learned(*pages[len(pages) // 2 :]))
    for wrapper in (whole, half, hx.Item.of_list(whole.to_list())):
        for p in pages:
            tree = read(p)
            matches(wrapper, tree, tree.chars)


def test_repeated_and_optional_groups():
    one = "<article><h1>A</h1><p>x</p></article>"
    two = "<article><h1>B</h1><h2>s</h2><p>x</p><p>y</p><h2>t</h2><p>z</p><ul><li>1</li></ul></article>"
    assert learned(one, two).expression() == (
        "<> <article> <h1> #slot </> ( ( <h2> #slot </> )? ( <p> #slot </> )+ )+ ( <ul> <li> #same </> </> )? </> </>"
    )


def test_an_unmarked_template_is_found_by_what_differs():
    page = """<html><head><title>{t}</title></head><body><div class=c1><div class=c2>Welcome to our site, the best place on the net</div>
    <div class=c3><h2>{t}</h2><p>{a}</p><p>Written by us</p><table><tr><td>{b}</table></div><div class=c4>All rights reserved</div></div></body></html>"""
    got = texts(*(page.format(t=f"Title {i}", a=f"Words of page {i} that differ, all of them.", b=f"More {i * 7} words") for i in range(4)))
    assert got[2] == "Title 2\nWords of page 2 that differ, all of them.\nWritten by us\nMore 14 words"


def test_template_text_inside_the_article():
    page = "<article><h1>{0}</h1><div class=s>Read on our app</div><p>Text {0} here</p><p>And {0}</p></article>"
    assert texts(*(page.format(i) for i in "abc"))[0] == "a\nText a here\nAnd a"
    # copies of one page are no template
    assert texts(*(page.format("a") for _ in "abc"))[0] == "a\nRead on our app\nText a here\nAnd a"


def test_what_is_not_the_article():
    page = """<!DOCTYPE html><body class="has-sidebar no-ads"><header><h1>Site</h1></header><form id=f><main>
    <div class="cookie-notice">We use cookies</div><article class="post hentry"><header><h1>T&eacute;st &amp; more&hellip;</h1><p>by X</p></header>
    <p>One<b> two</b>&nbsp; <i>three
    four</p><div class="ad-slot">Buy</div><p>five <span class="advert">Buy</span>six<script>var x = "<p>no</p>"</script></p>
    <aside>Side</aside><ul><li>a<li>b</ul><figure><img src="x>y"><figcaption>Caption</figcaption></figure>
    <form><input value=1><p>Mail</p></form><div hidden>secret</div><nav>Next</nav>
    <section id="comments"><article class="comment">Nice!</article></section><footer>Tags</footer></article></main></form>
    <div class="sidebar"><article>Teaser</article></div><footer>&copy; me</footer></body>"""
    assert texts(page)[0] == "Tést & more…\nOne two three four\nfive six\na\nb\nCaption"


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""), ("   ", ""), ("plain text &lt;b&gt; a < b", "plain text <b> a < b"), ("<article>cut <b>off", "cut off"),
        ("<article><p>a<!-- x > --><p>b</article><script>", "a\nb"), ("<article>a<script>never closed", "a"),
        ("<article title='a>b' x=\"c\">t</article>", "t"), ("<article><p>a</div>b</p></article>", "a\nb"),
        ("<article>&#x41;&#66;&am &nosuch; &#0;</article>", "AB&am &nosuch; �"), ("<p>a<p>b", "a\nb"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("<nav>only</nav>", ""), ("<article>a<br>b<hr>c</article>", "a b\nc"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<a " * 2000, ""), ("<" * 2000, "<" * 2000),
        ("<article>" + "<p>x" * 5000, "\n".join("x" * 5000)),
    ],
)
def test_broken_markup(page, text):
    assert hx.main_text(page, None) == text


def test_many_classes_stay_small():
    pages = ["".join(f"<div class='k{chr(97 + a)}x{chr(97 + b)}'><p>{a} {b}</p></div>" for a in range(20)) for b in range(20)]
    w = learned(*pages)
    assert len(w.body) <= hx.WIDE
    assert texts(*pages)[3] == "\n".join(f"{a} 3" for a in range(20))


def test_hosts(spark):
    urls = ["http://User@A.example:80/x", "//a.example", "a.example/x", "", None, "https://a.example?x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(hx.host_of(F.col("url"))).collect()] == ["a.example", "a.example", "", "", "", "a.example"]


def test_wrappers_do_not_depend_on_how_pages_are_dealt(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet")
    one = {r.host: (r.rules, r.pages) for r in hx.wrappers(pages.repartition(1)).collect()}
    many = {r.host: (r.rules, r.pages) for r in hx.wrappers(pages.repartition(16)).collect()}
    assert one == many and sum(n for _, n in one.values()) == 250


def test_odd_rows(spark):
    """Nulls, empty and long pages, repeated rows, clashing columns, an empty table."""
    good = "<article><p>a</p></article>"
    rows = [
        (1, "http://a.b/", good, "h", "r"), (1, "http://a.b/", good, "h", "r"), (2, None, good, None, None), (None, "x", None, None, None),
        (3, "http://a.b/", "", "h", "r"), (4, "http://a.b/", "<article>" + "<p>word word</p>" * 20_000 + "</article>", "h", "r"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rules string").repartition(3)
    got = hx.extracted(df).collect()
    assert sorted((r.row.page_id or 0, len(r.text)) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 0), (4, 200_000 - 1)]
    assert hx.extracted(df.limit(0)).count() == 0 and hx.wrappers(df.limit(0)).count() == 0
