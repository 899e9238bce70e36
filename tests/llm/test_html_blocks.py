"""op 9: the tree on held-out layouts, and a plain cut of all pages of a table."""

import html
import re

from tidemart.llm import htmlblocks, queries

from .data import SF

TREE = htmlblocks.grow(*htmlblocks.labelled_table())


def text(page):
    return htmlblocks.main_text(page, TREE)


def test_the_tree_fits_its_table():
    rows, labels = htmlblocks.labelled_table()
    assert [htmlblocks.decide(TREE, r) for r in rows.tolist()] == labels.tolist() and len(labels) > 60


def test_all_pages_of_a_table(spark):
    """Every page there has its article between <article> tags."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op9_text_blocks(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_markup():
    assert text("<article>1 &lt; 2 <b>a</b>b<br>c &nbsp; d&#x41;\n e</article>") == "1 < 2 ab c dA e"
    assert text("<ARTICLE><P>Up<p>Two<div>Three</ARTICLE>four") == "Up\n\nTwo\n\nThree"
    assert text("<script>var a='<article><p>no</p>'</script><style>p{}</style><!-- <article>no -->") == ""
    assert text("<article><p>a<script>x</script>b</p><select><option>no</select></article>") == "ab"
    assert text("<article><table><tr><td>1<td>2<tr><td>3</table></article>") == "1 2\n\n3"
    assert text("<article><p title='a>b' class=x>quoted") == "quoted"
    for page in ("", "<", "<p", "<p class=\"", "</p></div>", "<!--", "<script>", "&", "&#xFFFFFFFF;", "<article"):
        assert isinstance(text(page), str)


def test_elements_without_text_end_where_they_do():
    assert text('<article><p>a<svg class="i"/>b</p><p>c</p></article>') == "ab\n\nc"
    assert text("<article><p>a<iframe src='x'/>b<audio />c<object/>d</p><script src='x'/><p>e</p></article>") == "abcd\n\ne"
    assert text("<article><p>a<button>no</p><p>b</p><select><option>no<p>c</p></article>") == "a\n\nb\n\nc"
    assert text("<article><p>a</p><button>no<p>b</p><p>c</p><button>no</button><p>d</article>") == "a\n\nb\n\nc\n\nd"
    assert text("<article><p>a<video-player>b</video-player>c</p><title-bar>d</title-bar><p>e<svg-icon>f</p></article>") == "abc\n\nd\n\nef"
    assert text("<head><title>no</head><body><article><p>a</p><svg><title>no</title><path d=''/></svg><p>b</p></article>") == "a\n\nb"
    assert text("<title>The <script> and <p> tags</title><article><p>a<button><b>no</b></button>b<video><p>no</p></video>c</article>") == "abc"
    assert text("<article><p>a<!-->b</p><script src=//x/>no</script><p>c<style>no</style >d</p></article>") == "ab\n\ncd"


def test_surroundings_are_dropped():
    body = "word " * 60
    page = f"""<body><header><h1>Site</h1><a href=/>Home</a></header><div id="menu"><a>A</a><a>B</a></div><div class="cookie-banner">{body}</div>
    <main><h1>Title</h1><p>{body}</p><p>Short.</p><aside>{body}</aside><div class="advert">{body}</div><form>{body}</form><p>{body}</p>
    <section class="comments"><h2>Comments</h2><p>{body}</p></section></main><div class="sidebar">{body}</div><footer>{body}</footer></body>"""
    long = body.strip()
    assert text(page) == "\n\n".join(["Title", long, "Short.", long])


def test_page_wide_wrappers_are_not_what_they_are_named_for():
    body = " ".join(["word"] * 45)
    main = f"<h1>Title words</h1><p>{body}</p><p>{body}</p>"
    want = f"Title words\n\n{body}\n\n{body}"
    around = "<div class=menu><a>A</a> <a>B</a></div>", f"<div class=footer>{body}</div>"
    for begin, end in (("<form id=aspnetForm>", "</form>"), ("<div class='content-sidebar-wrap'>", "</div>"), ("<div class='content has-sidebar'>", "</div>"), ("<article class='post has-comments'>", "</article>"),
                       ("<div class='search-page'>", "</div>"), ("<div id=page class='comments-open menu-open'>", "</div>"), ("<div class='main-menu-page'><main>", "</main></div>"),
                       ("<div class='widget'><article>", "</article></div>")):
        assert text(f"{begin}{main}{end}") == want, begin
        assert text(f"{around[0]}{begin}{main}{end}{around[1]}") == want, begin
        assert text(f"<form>{around[0]}{begin}{main}{end}{around[1]}</form>") == want, begin
    long = f"<p>{body}</p>" * 20
    for zone in ("<section class=comments>", "<aside>", "<footer>", "<div class='main-nav'>", "<div class='post-comments-wrap'>", "<div style='display: none'>"):
        assert text(f"<div>{main}</div>{zone}{long}</div></section></aside></footer>") == want, zone
        assert text(f"<article>{main}</article>{zone}{long}") == want, zone


def test_wrappers_named_for_what_is_around_and_short_pages():
    """Layouts whose main text must not be lost."""
    w = lambda n: " ".join(["word"] * n)
    join = "\n\n".join
    for name in ("menu-open-wrapper", "footer-layout", "cookie-layout", "nav-page", "layout-pagination"):
        assert text(f'<div class="{name}"><div class="content"><h1>{w(3)}</h1><p>{w(60)}</p></div></div>') == join([w(3), w(60)]), name
        assert text(f'<div class="{name}"><div class="content"><p>{w(200)}</p></div></div>') == w(200), name
        assert text(f'<div class="{name}"><nav><a>{w(2)}</a></nav><div id="main-content"><p>{w(90)}</p><p>{w(4)}</p><p>{w(30)}</p></div><footer>{w(20)}</footer></div>') == join([w(90), w(4), w(30)]), name
    assert text(f'<article><p>{w(50)}</p><section class="related-work"><p>{w(60)}</p></section></article>') == join([w(50), w(60)])
    assert text(f"<article><p>{w(50)}</p></article><div class='related'><p>{w(60)}</p></div>") == w(50)
    for a, b, c in ((3, 8, 6), (6, 12, 4), (2, 5, 9), (9, 15, 15)):
        assert text(f"<html><body><h1>{w(a)}</h1><p>{w(b)}</p><p>{w(c)}</p></body></html>") == join([w(a), w(b), w(c)]), (a, b, c)
    for a, b, c in ((4, 3, 40), (2, 1, 25), (7, 6, 120)):
        assert text(f"<div><h2>{w(a)}</h2><p>{w(b)}</p><p>{w(c)}</p></div>") == join([w(a), w(b), w(c)]), (a, b, c)
    # what is around an article stays out
    for zone in ("<nav>", "<footer>", "<aside>", "<div class=comments>"):
        assert text(f"<div><h1>{w(3)}</h1><p>{w(60)}</p></div>{zone}<div class=content><p>{w(70)}</p></div></nav></footer></aside></div>") == join([w(3), w(60)]), zone


def test_pages_without_semantic_tags():
    body = " ".join(["word"] * 60)
    page = f"<div><a>Home</a> <a>News</a></div><div><h1>Title words</h1><p>{body}</p><p>short one</p><p>{body} <a>link</a></p></div><div><a>More stories here</a></div>"
    assert text(page) == "\n\n".join(["Title words", body, "short one", f"{body} link"])


def test_table(spark):
    rows = [(1, None, None, "x", 1), (None, "u", "", "y", 2), (2, "u", "<article><p>" + "a " * 100_000, None, None)]
    out = htmlblocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, words int"))
    assert out.columns == ["page_id", "url", "words", "text", "n_chars"]
    assert sorted((r.n_chars for r in out.collect())) == [0, 0, 199_999]
