import html
import time
import re

from playstream.llm.html import blocks, extract, host_paths, main_texts, op4_html_extraction
from tests.llm.util import SF001


def plain(page):
    """The article of the test pages, by patterns that fit these pages only."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", m[1]))
    return "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if x)


def test_query_equals_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = op4_html_extraction(spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


PAGES = [
    (1, None, None), (2, "", ""), (3, "x", "no tags &amp; nothing"), (4, "http://a.example/1", "<div class='content-12'><p>One &lt;two&gt;<p>Three<br>four</div><div class=sidebar><p>side side side side side</div>"),
    (5, "http://a.example/2", "<div id=nav>menu menu</div><div class='content-77'>Text <i>in</i> line<ul><li>x<li>y</ul></div><aside>no</aside><form>f<input value='>'></form>"),
    (5, "http://a.example/2", "<div id=nav>menu menu</div><div class='content-77'>Text <i>in</i> line<ul><li>x<li>y</ul></div><aside>no</aside><form>f<input value='>'></form>"),
    (6, "//b.example", "<article><h1>T</h1><p>body<section class=comments><p>reader</section><script>if (a<b) '</p>'</script><p>end</article><footer>f</footer>"),
    (None, "http://A.example:80/3", "<div class=content-1><p>short</div>" + "<p>" + "long text " * 3000), (8, "http://c", "<p>unclosed <b>bold<p>next</b> one<div"),
    (9, "http://d", "<!-- <p>hidden</p> --><p>a&nbsp;b&#x41;&copy &bogus;</p><style>p{}</style><script>never ends <p>x"), (10, "http://e", "<article></article><nav>n</nav>"),
]


def test_edge_pages(spark):
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in PAGES], "page_id long, url string, html string, host string, path string")
    got = {(r.page_id, r.url): r.text for r in main_texts(df).collect()}
    assert got[1, None] == got[2, ""] == got[10, "http://e"] == ""
    assert got[3, "x"] == "no tags & nothing"
    assert got[4, "http://a.example/1"] == "One <two>\nThree four"
    assert got[5, "http://a.example/2"] == "Text in line\nx\ny"
    assert got[6, "//b.example"] == "T\nbody\nend"
    assert got[8, "http://c"] == "unclosed bold\nnext one"
    assert got[9, "http://d"] == "a bA© &bogus;"
    assert main_texts(df).count() == len(PAGES)
    assert main_texts(df.limit(0)).collect() == []


def test_host_consensus(spark):
    good = "<div class=main-text><p>{}</div><div class=extra><p>{}</div>"
    rows = [(i, "http://h/x", good.format("real words " * 30, "tiny")) for i in range(20)]
    odd = (99, "http://h/y", good.format("short real", "a much longer extra block " * 20))
    df = spark.createDataFrame(rows + [odd], "page_id long, url string, html string")
    assert host_paths(df).first().paths[0] == ">div.main-text"
    assert {r.page_id: r.text for r in main_texts(df).collect()}[99] == "short real"


def test_paths_drop_digits():
    assert blocks("<div class='post-123 x'>t</div>") == [(">div.post-", "t", 0)]
    assert extract("<p>a</p>", []) == "a"


def test_layout_wrappers_keep_their_article():
    side = "<div class=sidebar><p>side side side</div><div class=comments><article>a reader</article></div>"
    for name in ("layout has-sidebar", "no-sidebar", "site-content with-sidebar", "page sticky-header", "page_with-sidebar sticky-header-2"):
        for page in (f"<div class='{name}'><article><p>the text of it</article>{side}</div>", f"<body><div class='{name}'><p>the text of it</p>{side}</div></body>"):
            assert extract(page, []) == "the text of it", page
    assert [t for _, t, _ in blocks("<div class='x main-nav'>menu menu menu</div><main>text</main>")] == ["text"]
    assert [t for _, t, _ in blocks("<div class=post>text</div><div id=comments>much longer than the text</div>")] == ["text"]


def test_text_outside_containers_is_scored():
    page = PAGES[7][2]
    assert extract(page, []) == "short\n" + ("long text " * 3000).strip()
    assert extract(page, [">div.content-"]) == "short"   # the host's path goes before the page's own best
    assert extract(page, [">div.other", ""]) == extract(page, [])


def test_host_of_many_paths(spark):
    """The list of a host is made of a few paths a salt, however many it has."""
    letters = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:04}")
    rows = [(i, "http://h/x", f"<div class='z{letters(i)}'><p>words of it</div>") for i in range(900)]
    rows += [(i, "http://h/x", f"<div class='z{letters(i % 7 + 800)}'><p>words of it</div>") for i in range(900, 935)]
    top = host_paths(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert top.first().paths == ["", *[f">div.z{letters(i)}" for i in range(800, 803)]]   # the implied body is around all
    assert "row_number" in top._jdf.queryExecution().toString()


def test_quotes_count_after_an_equals_sign_only():
    assert extract("<p title=it's>Hello world and more</p><p>We don't stop here</p><p>end</p>", []) == "Hello world and more\nWe don't stop here\nend"
    assert extract('<p class="a>', []) == ""
    assert extract('<p class="a>shown</p>', []) == "shown"   # a quote that is never closed
    assert extract("<p title='a > b' data-x=\"<p>\">text</p><p a = 'x>y' b>more", []) == "text\nmore"
    assert extract("<p 'odd' =x \"y>text</p>", []) == "text"
    assert blocks("<div data-x='class=\"ad\"' class=post>t</div>") == [(">div.post", "t", 0)]


def test_places_do_not_shift_with_lower_case():
    assert extract("İ" * 10 + "<script>x</script><p>Hello world", []) == "İ" * 10 + "\nHello world"
    assert extract("<p>a<SCRIPT>İ</p></ScRiPt >b</p>", []) == "ab"
    assert extract("<p>a<script>ſ</ſcript>no</script>b</p>", []) == "ab"


def test_unclosed_elements_do_not_swallow_the_page():
    assert extract("One<button>Copy<p>Two and the rest", []) == "One\nTwo and the rest"
    for name in ("button", "select", "svg", "noscript", "template"):
        assert extract(f"<p>One<{name} x='1'><p>gone</p></{name}> and<p>two", []) == "One and\ntwo"
        assert extract(f"<div><p>One<{name}>gone</div><p>two<{name}>gone</{name}> three", []).replace("One\n", "") == "two three"
    assert extract("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", []) == "so x=2 holds"
    assert extract("a < b <3 </> c <!----> d <!x> e <?y?> f </ g> h <", []) == "a < b <3 c d e f h <"


def test_deep_and_broken_pages_take_time_in_proportion():
    began, n = time.process_time(), 100_000
    text = "words " * 30
    assert extract("<div class=post>" * n + text, []) == text.strip()
    assert extract("<div class=ad>" * n + text, []) == ""
    assert extract("<div class=x-nav>" * n + text, []) == text.strip()   # lifted one by one
    assert extract("<a '" * n + "><p>" + text, []) == text.strip()
    assert extract("<p a=\"" * n + "><p>" + text, []).endswith(text.strip())
    assert extract("<span>" * n + ("<p>" + text) * 3 + "</section>" * n + text, []) == "\n".join([text.strip()] * 3) + " " + text.strip()
    assert extract("<svg>" * n + "<p>" + text, []) == text.strip()
    assert extract("<" * n + "<!" * n + "><p>" + text, []).endswith(text.strip())
    assert extract(("<ul><li>" * n) + text, []) == text.strip()
    assert len(extract("<p>x" * n, [])) == 2 * n - 1
    assert time.process_time() - began < 40
