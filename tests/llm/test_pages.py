import re
import time
from html import unescape

from ordertide.llm.html_text import extract_pages, extraction_report, main_text
from ordertide.llm.url_filter import judge_urls, segmented_names, split_name, url_report

PAGE = """<!doctype html><html><head><title>T &amp; t</title><script>var a="</p><p>no";</script></head><body>
<header class="site-header"><a href=/>Site</a> Welcome, one, and all, to this site of ours</header>
<nav><ul><li><a href=/a>Menu a</a><li><a href=/b>Menu b</a></ul></nav>
<div id="cookie-notice"><p>We use cookies, many, many, of them, all of the time, on all pages.</p></div>
<div class=wrap><aside><p>Side story, with commas, and more, and a good deal of length to it.</p></aside>
<div class=content><h1>Title</h1><p>First  paragraph, with&nbsp;commas &lt;and&gt; length,\nfor scoring well.<p>Second <b>bold, one
<br>more line, closed by nothing<ul><li>item one<li>item two</ul><p>Third, with a <a href=x>link</a> inside, of some length.</p>
<div class="ad-box">Buy, buy, buy, this thing, and that one too, today</div><form><p>Name, please, and address, and so on and on</p></form></div>
<div class=comments><p>I liked it, really, very much, all of it, from first to last.</p></div></div>
<footer>&copy; us, and nobody else, all rights reserved, for ever</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == (
        "Title\nFirst paragraph, with commas <and> length, for scoring well.\nSecond bold, one more line, closed by nothing\n"
        "item one\nitem two\nThird, with a link inside, of some length."
    )


def test_awkward_pages():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<!-- only <p>this</p>") == ""
    assert main_text("just text &amp; more") == "just text & more"
    assert main_text("<article><p>Open, and cut off in the mid") == "Open, and cut off in the mid"
    deep = "<div>" * 3000 + "deep text, with a comma, long enough to score" + "</div>" * 3000
    assert main_text(deep).startswith("deep text")


def test_given_pages(spark, sf):
    for r in extraction_report(spark.read.parquet(f"{sf}/pages.parquet")).join(spark.read.parquet(f"{sf}/pages.parquet"), ["page_id", "url"]).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x", "y"), (1, PAGE, "x", "y")], "page_id int, html string, text string, row string")
    assert sorted(r["n_chars"] for r in extract_pages(df).collect()) == [0, len(main_text(PAGE))]


def test_deeply_nested_inline_elements():
    words = "deep text, with a comma, long enough to score"
    for name in ("b", "font", "span"):
        for close in ("", f"</{name}>" * 3000):
            assert main_text("<div><p>" + f"<{name}>" * 3000 + words + close + "</p></div>") == words
    assert main_text("<p>" + "".join(f"<b>w{i}, " for i in range(3000)) + "</p>") == ", ".join(f"w{i}" for i in range(3000)) + ","


ARTICLE = "<article><p>The article, with commas, and long enough to be found by score.</p><p>And more, of the same.</p></article>"
TEXT = "The article, with commas, and long enough to be found by score.\nAnd more, of the same."
PLAIN = ARTICLE.replace("article>", "div>")


def test_wrappers_with_marked_words():
    for wrapper in (
        '<div class="site has-sidebar">', '<div class="layout with-banner">', '<div class="post comments-open">',
        '<div class="page page-notice">', '<section class="share-price">', '<div id="header-main">', '<div class=sidebar><div class=widget>',
    ):
        for inner in (ARTICLE, PLAIN):
            page = f"<body><nav><a href=/>Home</a></nav>{wrapper}{inner}</div></section></div><footer>The end, of it all, for ever</footer>"
            assert main_text(page) == TEXT, (wrapper, inner)


def test_marked_parts_beside_an_article_are_cut():
    long = "<p>" + "Words, and words, and more of them. " * 40 + "</p>"
    for mark in ("sidebar", "ad-box", "comments", "cookie-notice", "comment-list", "site-footer", "share-links"):
        for inner in (ARTICLE, PLAIN):
            assert main_text(f'<div class="{mark}">{"<p>Some, short, text of the marked part.</p>"}</div>{inner}') == TEXT, mark
        assert main_text(f'{ARTICLE}<div class="{mark}">{long}</div>') == TEXT, mark
    assert main_text('<div class=ad>An advert, with commas, longer than the text</div><article><h1>Hi</h1></article>') == "Hi"


def test_lists_of_links_in_an_article_stay():
    links = "<ul>" + "".join(f"<li><a href=/{i}>Source number {i}</a></li>" for i in range(4)) + "</ul>"
    page = ARTICLE.replace("</article>", links + "</article>")
    assert main_text(page) == TEXT + "".join(f"\nSource number {i}" for i in range(4))
    assert main_text(PLAIN.replace("</div>", links + "</div>")) == TEXT


def test_words_in_values_hide_nothing():
    assert main_text(ARTICLE.replace("<p>", '<p title="a hidden gem, display: none">', 1)) == TEXT
    assert main_text(ARTICLE + '<div hidden><p>Not, shown, to any reader of this page</p></div>') == TEXT
    assert main_text('<p>It is <a title="a > b">linked</a> and "quoted", isn\'t it, <b don\'t>really</b>?') == 'It is linked and "quoted", isn\'t it, really?'


def test_broken_pages_take_linear_time():
    n = 30_000
    pieces = [
        '<a "' * n, "<b x='" * n, "<span>" * n + "</b>" * n, "<span>" * n + "<div></div>" * n, "<b '><b'" * n, "<b x='><b'" * n,
        "</" * n, "<title>" * n, "<!--" * n, "<div><span>" * n, "<b><article>" + "<span>" * n + "</b>" * n, "<header>" * n, "<" * n, "<p>" * n,
        '<b x="' * n + ">", "<ul><li>" * n,
    ]
    for p in pieces:
        for page in (p, p + ARTICLE):
            start = time.process_time()
            main_text(page)
            assert time.process_time() - start < 4, (p[:20], time.process_time() - start)


def test_empty_table_and_repeats(spark):
    schema = "page_id bigint, url string, html string"
    assert extraction_report(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, None), (2, "u", "")]
    got = sorted(r["text"] for r in extraction_report(spark.createDataFrame(rows, schema)).collect())
    assert got == ["", "", TEXT, TEXT]


def test_names_are_split(spark):
    counts = {"river": 50, "stone": 40, "riverstone": 0, "run": 9, "runs": 3}
    assert split_name("riverstoneruns", counts, 1000) == ["river", "stone", "runs"]
    names = spark.createDataFrame([("riverstone",), ("zzz",)], "name string")
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {r["name"]: list(r["words"]) for r in segmented_names(names, table).collect()}
    assert got["riverstone"] == ["river", "stone"] and "".join(got["zzz"]) == "zzz"


URLS = [
    (1, "http://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    (5, "ftp://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    (6, "http://notexample.org?q=/a://b", "notexample.org", "", None, "allow"),
    (7, None, "", "", None, "allow"),
    (8, "no scheme", "", "", None, "allow"),
    (9, "a://b://c/d", "b:", "//c/d", None, "allow"),
]


def test_rules(spark):
    df = spark.createDataFrame([(p, u, "words of a page" if p % 2 else None) for p, u, *_ in URLS], "page_id int, url string, html string")
    got = sorted(tuple(r) for r in url_report(df).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == [(p, *rest) for p, _, *rest in URLS]
    assert url_report(df.limit(0)).count() == 0


def test_seeded_hosts_and_their_like_are_blocked(spark):
    urls = [f"http://cheap-pills.net/en/{i}" for i in range(5)] + [f"http://quietriver.net/en/{i}" for i in range(60)] + ["http://cheaper.net/x"]
    df = spark.createDataFrame([(i, u, "a quiet river runs quiet river") for i, u in enumerate(urls)], "page_id int, url string, html string")
    assert {r["row"]["page_id"] for r in judge_urls(df).filter("verdict = 'block'").collect()} == {0, 1, 2, 3, 4, 65}
