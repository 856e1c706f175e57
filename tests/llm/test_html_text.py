import html
import re

from lodequill.llm.html_text import extract, main_text

PAGE = """<!doctype html><html><head><title>T</title><script>var a="</p><article>x</article>"</script></head><body>
<nav><a href=/>Home</a></nav><header>Site</header><div class="ad">Buy</div><div class='cookie-notice'>We use cookies</div>
<article><h1>A &amp;amp; B</h1><p>One  <b>two</b>
three<br>four<p>Five &lt;tag&gt; <!-- gone > --> six<ul><li>x<li>y</ul><aside>side</aside><div class="comments"><p>me too</p></div>
<form><input name=q>ask</form><p title="a > b">last</article><div id=sidebar>more</div><footer>&copy; foot</footer></body></html>"""


def brute(page):
    """The generated pages' articles by plain patterns."""
    body = re.search(r"(?s)<article>(.*)</article>", page)[1]
    parts = re.split(r"</?(?:p|h1|div|ul|li)(?:\s[^>]*)?>", body)
    return "\n\n".join(t for x in parts if (t := " ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if "br" in m[0] else "", x)).split())))


def test_page():
    assert main_text(PAGE) == "A &amp; B\n\nOne two three four\n\nFive <tag> six\n\nx\n\ny\n\nlast"


def test_without_article_keeps_surge_to_dive():
    text = "word " * 60
    page = f"<div><a href=a>menu one</a></div><div><a href=b>menu two</a></div><div><a href=b>menu 3</a></div><div><h1>Title</h1><p>{text}</p><p>{text}</p></div>" + "<p><a href=x>link</a></p>" * 4
    assert main_text(page) == "\n\n".join(["Title", text.strip(), text.strip()])


def test_edges():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<!-- never closed") == main_text("<script>x") == ""
    assert main_text("plain &amp; simple") == "plain & simple"
    assert main_text("<article>a<div class=ad>b</article>") == "a"
    assert main_text("<article>1 < 2 <b") == "1 < 2 <b"
    long = "x " * 500_000
    assert main_text(f"<article><p>{long}</article>") == long.strip()
    assert main_text("<a '" * 3000) != None  # noqa: E711


def test_names_inside_an_article_drop_boxes_only():
    kept = ['<h2 id="related-work">a b</h2>', '<section id="social-policy">a b</section>', '<p class="notice-period">a b</p>', '<h3 id="menu">a b</h3>', '<p id="search">a b</p>', '<h1 class="header">a b</h1>', '<div class="menu-planning">a b</div>', '<dl><dt id="search">a b</dt></dl>']
    gone = ["<div class=ad>no</div>", "<div class='x cookie-notice'>no</div>", "<section id=comments>no</section>", "<div class=related-posts>no</div>", "<div class='ad-300x250'>no</div>", "<p class=ad>no</p>", "<ul class=share-buttons><li>no</ul>"]
    for tag in ("article", "main"):
        for x in kept:
            assert main_text(f"<{tag}><p>one</p>{x}<p>two</p></{tag}>") == "one\n\na b\n\ntwo", x
        for x in gone:
            assert main_text(f"<{tag}><p>one</p>{x}<p>two</p></{tag}>") == "one\n\ntwo", x
    assert main_text("<div class='social-policy'>no</div><article>one</article>") == "one"


def test_nested_and_split_articles_are_whole():
    long, links = "word " * 80, "<p><a href=x>a link</a></p>" * 4
    body = long.strip()
    whole = lambda *x: "\n\n".join(x)
    assert main_text(f"<p>out</p><main><h1>Title</h1><p>lead</p><article>{long}</article><p>end</p></main><p>out</p>") == whole("Title", "lead", body, "end")
    assert main_text(f"<article><h1>T</h1><p>before</p><article>{long}</article><p>after</p></article><p>out</p>") == whole("T", "before", body, "after")
    assert main_text(f"<div><article><p>one</p></article><article>{long}</article><article>three</article></div><p>out</p>") == whole("one", body, "three")
    assert main_text(f"<main>{links}<article><h1>T</h1>{links}<p>{long}</article>{links}<p>far</p></main>") == whole("T", *["a link"] * 4, body)
    assert main_text(f"<main><p>lead</p><article><h2>A</h2><p>part</p></article><article>{long}</article></main>") == whole("lead", "A", "part", body)
    assert main_text(f"<main><h1>T</h1>{links}<p>{long}</p><article>x</article></main>") == whole("T", *["a link"] * 4, body, "x")
    assert main_text(f"<div><article>card</article></div><div><article>{long}</article></div>") == body


def test_query_against_plain_patterns(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: (r.url, brute(r.html)) for r in pages.collect()}
    from lodequill.llm.queries import QUERIES

    got = QUERIES["op10_html_text"](spark, sf_dir).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string").selectExpr("*", "1 AS text")
    got = extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(main_text(PAGE)))] + [(1, len(main_text(PAGE)))]
    assert extract(df.limit(0)).count() == 0


def test_pages_without_articles_against_plain_patterns(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        plain = r.html.replace("<article>", "<div>").replace("</article>", "</div>")
        assert main_text(plain) == brute(r.html)


def test_headings_of_an_articles_header_stay():
    assert main_text("<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by me</p><nav>x</nav></header><p>text</p></article>") == "Title\n\ntext"


def test_malformed_pages_take_linear_time():
    import time

    n = 1_000_000
    for page in ("<a " * (n // 3), "<a '" * (n // 4), '<a ">"' * (n // 6), "<b>" * (n // 8) + "</i>" * (n // 8), "<p><td>" + "<h1>" * (n // 4), "<article>x" * (n // 10), "<li>x" * (n // 5), "<!--" * (n // 4), '<a x="' * (n // 6) + ">"):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 20, page[:10]  # a quadratic scan takes hours
