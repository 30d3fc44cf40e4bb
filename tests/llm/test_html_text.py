import pytest

from tillwright.llm import html_text

LONG = "This sentence is long enough to be a paragraph, with commas, and so it gets points."


def page(inside, around="", tag="article"):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><a href="/">Home</a></nav>{around}<{tag}>{inside}</{tag}><footer>foot</footer></body></html>'


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (page(f"<h1>Head</h1><p>{LONG}</p><p>{LONG}"), f"Head {LONG} {LONG}"),
        (page(f"<p><b>{LONG}<br><p>Two  &amp;\n three&nbsp;&lt;x&gt;</p>"), f"{LONG} Two & three <x>"),
        (page(f"<p>a<i>b</i>c{LONG}</p><script>var t='<p>x</p>';</script><!-- <p>no</p> -->"), f"abc{LONG}"),
        (page(f"<p>{LONG}</p>", '<div class="ad">Buy, now, this, thing, and, more, of, it, today!</div>'), LONG),
        (page(f"<p>{LONG}</p>", "<aside><p>" + LONG + "</p></aside><form><p>" + LONG + "</p></form>"), LONG),
        (page(f"<p>{LONG}</p>", f'<div id="cookie-notice"><p>{LONG}</p></div><header><p>{LONG}</p></header>'), LONG),
        (page(f"<p>{LONG}</p><section class='comments'><p>{LONG}</p></section>"), LONG),
        (page(f"<p>{LONG}</p><div hidden>{LONG}</div><p style='display: none'>x</p>"), LONG),
        (page(f"<header><h1>Title</h1></header><p>{LONG}</p>"), f"Title {LONG}"),
        (page(f"<div><p>{LONG}</p></div><div><p>{LONG}</p><ul><li>one<li>two</ul></div>"), f"{LONG} {LONG} one two"),
        (page(f"<p>{LONG}</p><p>{LONG}</p>", tag="div"), f"{LONG} {LONG}"),
        (page(f'<table><tr><td>a<td title="x>y">b<tr><td>{LONG}</table>'), f"a b {LONG}"),
        (page("<p>Short.</p>"), "Short."),
        ("just text", "just text"),
        ("<p>1 < 2 and a<b", "1 < 2 and a<b"),
        ("", ""),
        (None, ""),
        ("<script>never closed", ""),
        ("<!-- never closed <p>x</p>", ""),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        f"<div class='site has-sidebar'><article><p>{LONG}</p></article></div>",
        f"<div id='page' class='with-sidebar no-footer'><div><p>{LONG}</p></div></div>",
        f"<div class='search page'><article><p>{LONG}</p></article><div class='related'><article><p>Short.</p></article></div></div>",
        f"<div class='widget'><p>{LONG}</p></div>",
        f"<article><svg viewBox='0 0 1 1'/><iframe src='x' /><p>{LONG}</p></article>",
        f"<div class='sidebar'><article><p>An aside, of one line.</p></article></div><article><p>{LONG}</p><p>{LONG}</p></article>",
    ],
)
def test_class_words_and_closed_elements_keep_the_article(html):
    assert html_text.main_text(html).replace(f"{LONG} {LONG}", LONG) == LONG


@pytest.mark.parametrize(
    ("html", "text"),
    [
        # A form around the page, and forms in it.
        (f"<body><form id='aspnetForm'><div><p>{LONG}</p><form><p>Your name, please, and your mail.</p><input></form></div></form>", LONG),
        (f"<form><article><h1>Head</h1><p>{LONG}</p></article></form>", f"Head {LONG}"),
        # Noise that is never closed ends where the article begins; closed noise holds its own articles.
        (f"<nav><ul><li><a href='/'>Home</a><article><p>{LONG}</p></article><footer><nav>foot</nav></footer>", LONG),
        (f"<aside><article><p>{LONG} Aside.</p></article></aside><main><p>{LONG}</p></main>", LONG),
        # Adverts and notices beside a short article.
        (page("<h1>Head.</h1><p><b>Short.<br>", '<div class="ad">Buy, now, this, thing, and, more, of, it!</div>'), "Head. Short."),
        (page("<h1>Head.</h1>", f'<div id="cookie-notice"><p>{LONG}</p></div>'), "Head."),
        # Comments that are longer than the text.
        (page(f"<p>{LONG}</p><section class='comments'>" + f"<p>{LONG}</p>" * 30 + "</section>"), LONG),
        (page("<p>Short.</p>", "<div id='comments'>" + f"<article><p>{LONG}</p></article>" * 9 + "</div>"), "Short."),
        (f"<div><p>{LONG}</p></div><div class='comments'>" + f"<p>{LONG}</p>" * 30 + "</div>", LONG),
        (f"<main><p>{LONG}</p><div class='replies'>" + f"<p>{LONG}</p>" * 30 + "</div></main>", LONG),
        # Words of layout around everything there is.
        (f"<article><div class='widget'><p>{LONG}</p></div></article>", LONG),
        (f"<div class='comments'><p>{LONG}</p></div>", LONG),
    ],
)
def test_wrappers_and_parts(html, text):
    assert html_text.main_text(html) == text


def test_deep_and_long_pages_are_whole():
    deep = "<div>" * 3000 + f"<p>{LONG}</p>" + "</div>" * 3000
    assert html_text.main_text(deep) == LONG
    many = "".join(f"<p>{LONG} {i}</p>" for i in range(5000))
    assert html_text.main_text(page(many)) == " ".join(f"{LONG} {i}" for i in range(5000))
    assert html_text.main_text("<p>" + "<" * 20_000) is not None


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_pages_give_their_articles(spark, scale):
    import re
    from html import unescape

    table = spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")
    rows = html_text.extract(table).collect()
    pages = {r["page_id"]: r["html"] for r in table.collect()}
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        want = [" ".join(unescape(re.sub("<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
        assert r["text"].split() == " ".join(w for w in want if w).split()


def test_columns_nulls_repeats_and_empty_table(spark):
    schema = "page_id bigint, url string, html string, text string"
    rows = [(1, "u", page(f"<p>{LONG}</p>"), "old"), (1, "u", page(f"<p>{LONG}</p>"), "old"), (None, None, None, None)]
    out = html_text.extract(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(r["text"] for r in out.collect()) == ["", LONG, LONG]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
