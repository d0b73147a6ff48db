import numpy as np

from blockloom.llm import html_text

TREE = html_text.train()

PAGE = """<!DOCTYPE html><HTML><head><title>No title</title><style>p{}</style><script>var t = "</p>"; a<b;</script></head>
<body><header>Site <a href="/">home</a></header><nav><ul><li><a href=1>One<li><a href=2>Two</ul></nav>
<!-- a comment <p>with markup</p> --><div class='ad banner'>Buy</div><div class="cookie-notice">We use cookies, many of them, for you</div>
<article><h1>The &amp; head</h1><p>First
 paragraph with <b>bold</b> and <a href="x?a=1&b=>2">a link</a>.<p>Short.<br>&lt;tag&gt; &eacute;&#33;
<aside>Related: other thing</aside><p>Last one</p><form>Name <input name=n> <button>Send</button></form>
<section id="comments"><p>I like this article very much indeed, as it says all that needs to be said.</p></section></article>
<div class="sidebar">Things</div><footer>&copy; someone</footer>"""


def test_a_page():
    wanted = ["The & head", "First paragraph with bold and a link.", "Short.", "<tag> é!", "Last one"]
    assert html_text.main_text(PAGE, TREE).split("\n") == wanted


def test_pages_without_marks_go_by_length_links_and_neighbours():
    menu = "<div><a href=1>One thing</a> <a href=2>Another</a></div>"
    long = "word " * 60
    page = f"{menu}{menu}<h1>A title of some words</h1><p>{long}<p>tiny<p>{long}{menu}<p>All rights reserved here"
    assert html_text.main_text(page, TREE).split("\n") == ["A title of some words", long.strip(), "tiny", long.strip()]


def test_broken_pages():
    for page in ("", "<", "a < b", "<<<p>>>", "</article></p>", "<script>never closed", "<!-- never closed", '<a href="never closed>x'):
        html_text.main_text(page, TREE)
    assert html_text.main_text("<article><p>kept<nav><a>x</a></nav>kept too", TREE) == "kept\nkept too"
    assert html_text.main_text("<article><div><p>in</article><p>out of it", TREE) == "in"
    assert html_text.main_text("<head><body><main>text", TREE) == "text"


def test_long_pages_take_linear_time():
    many = 200_000
    for page in ("<" * many, '<a "' * many, "<p " * many, "&" * many, "<!--" * many):
        html_text.main_text(page, TREE)
    text = html_text.main_text("<article>" + "<p>one two" * many, TREE)
    assert text.count("\n") == many - 1


def test_tree_separates_its_table():
    rows, truth = np.array([r for r, _ in html_text.LABELLED], dtype=float), np.array([y for _, y in html_text.LABELLED])
    assert (html_text.verdicts(TREE, rows) == truth.astype(bool)).all()


def test_rows(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", "<main>x  y</main>"), (1, "u", ""), (3, "w", "<nav>a</nav>")]
    pages = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(pages).collect()
    text = html_text.main_text(PAGE, TREE)
    wanted = [(1, "u", text, len(text)), (2, None, "", 0), (None, "v", "x y", 3), (1, "u", "", 0), (3, "w", "", 0)]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_whole_pages_table_against_the_articles(spark):
    """Every page of the small table: the text between its article tags, block by block."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|br|div)[^>]*>", inside)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts]
        assert found[row.page_id] == "\n".join(x for x in blocks if x)


def test_names_of_articles_and_of_holders_around_them():
    real, side = "The article says this. " * 20, "<div class='sidebar'>Side thing</div><div id='comments'><p>I like it very much</div>"
    body = f"<p>{real}<p>Short."
    wanted = f"{real.strip()}\nShort."
    for page in (
        f"<article class='post has-comments'>{body}</article>{side}",
        f"<article class='post category-social tag-search related'>{body}</article>{side}",
        f"<div class='site no-sidebar'><article>{body}</article>{side}</div>",
        f"<div class='page with-sidebar'><main class='comments-open'>{body}</main>{side}</div>",
        f"<div class='sidebar-right'><div class='search'><article>{body}</article>{side}</div></div>",
        f"<div class='site comments'><article>{body}</article><ol class='comment-list'><li><article class='comment-body'>{real * 3}</article></ol></div>",
        f"<form id='aspnetForm'><main>{body}<form>Send</form></main>{side}</form>",
        f"<div class='post has-comments'>{body}</div>{side}",
        f"<div class='ad'><article>Teaser</article></div><article>{body}</article>{side}",
        f"<aside><article>{real * 2}</article></aside><div class='sidebar_right'><article>{body}</article></div>",
    ):
        assert html_text.main_text(page, TREE) == wanted, page


def test_holders_of_bad_names_stay_bad():
    for name in ("sidebar", "sidebar-left", "post-comments", "site_header", "td-post-sharing-top", "cookie-notice", "comments-area", "author-bio"):
        page = f"<article><p>kept<div class='x {name}'>All of it, some words long</div></article>"
        assert html_text.main_text(page, TREE) == "kept", name


def test_deep_pages_take_linear_time():
    many = 50_000
    assert html_text.main_text("<div class='sidebar'><p>x" * many + "<article><p>kept</article>", TREE) == "kept"
    assert html_text.main_text("<div class='ad'><article>kept</article>" * many, TREE).count("kept") >= 1
