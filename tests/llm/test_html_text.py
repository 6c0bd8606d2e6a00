import html
import re
import time

import numpy as np
import pytest

from imagelab.llm import html_text
from imagelab.llm.queries import QUERIES

LONG = "This sentence is part of the article and says a little about rivers. " * 3


def brute(page):
    """The article of the generated pages, by splitting at their own tags."""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub("</?b>", "", block)).split()) for block in blocks]
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    got = QUERIES["op1_html_tag_ratio"](spark, f"/root/testdata/{sf}")
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        expected = brute(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], expected, len(expected))


PAGE = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><a href=/>Home</a> <a href=/x>More</a></nav>
<div class="cookie-notice">We use cookies &amp; more, {LONG}</div><div id="topBanner">Buy now</div>
<main><article class="post"><header><h1>The  title</h1><div>By someone</div></header>
<p>First &lt;b&gt; &eacute;&nbsp;para<b>graph</b>. {LONG}<br>next<!-- c --><script>var a = "</p>";</script>
<p>Short.
<ul><li>One<li>Two</ul><table><tr><td>cell<td>other</table>
<form><p>Your name</p><input></form><aside>{LONG}</aside><div class="ad">{LONG}</div>
<blockquote>Quote</blockquote><footer>Tags</footer></article>
<section id="comments"><article class="comment"><p>{LONG}</p></article></section></main>
<div class="sidebar"><p>{LONG}</p></div><div hidden>{LONG}</div><div role="dialog">{LONG}</div>
<footer>&copy; me</footer>"""


def test_what_is_left_out():
    first = " ".join(f"First <b> é paragraph. {LONG} next".split())
    assert html_text.article_lines(PAGE) == ["The title", first, "Short.", "One", "Two", "cell", "other", "Quote"]


def test_pages_without_article_elements():
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(20))
    body = "".join(f"<p>{LONG}{i}</p>" for i in range(6))
    page = f"<body><div><ul>{links}</ul></div><div id=c><h2>Head</h2>{body}<p>End.</p></div><div><ul>{links}</ul></div>"
    lines = html_text.article_lines(page)
    assert [line[-1] for line in lines if line.startswith("This")] == list("012345")
    assert not any("link" in line for line in lines)


@pytest.mark.parametrize("outlier", [1000, 3000, 6000, 60_000])
@pytest.mark.parametrize("tag", ["p", "div", "li"])
def test_outlier_paragraph_and_short_lines(outlier, tag):
    texts = [(LONG * 3)[: 120 + 15 * i] + f"{i}." for i in range(13)]
    texts.insert(6, (LONG * 1000)[:outlier] + "x.")
    texts = ["Title", "By someone", *texts, "End."]
    blocks = "".join(f"<{tag}>{t}</{tag}>" for t in texts[1:])
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(20))
    menu = f"<div><ul>{links}</ul></div>"
    for page in (
        f"<body><h1>Title</h1>{blocks}</body>",
        f"<body>{menu}<div><h1>Title</h1>{blocks}</div>{menu}</body>",
        f"<body>{menu}<h1>Title</h1><div>{blocks}</div>{menu}</body>",
        f"{menu}<h1>Title</h1>{blocks}{menu}",
    ):
        assert html_text.article_lines(page) == texts


def test_siblings_of_the_region_are_text_too():
    parts = [f"<div><h2>Part {i}</h2>{f'<p>{LONG * n}</p>' * 2}</div>" for i, n in enumerate((1, 40, 1))]
    menu = "<div>" + "".join(f"<p><a href=/{i}>A longer link to page {i}</a></p>" for i in range(9)) + "</div>"
    got = html_text.article_lines(f"<body>{menu}<div><h1>Title</h1>{''.join(parts)}</div>{menu}</body>")
    assert [line for line in got if len(line) < 20] == ["Title", "Part 0", "Part 1", "Part 2"] and len(got) == 10
    assert not any("link" in line for line in got)


@pytest.mark.parametrize("word", "social search form forms related share consent notice promotion discussion reply respond subscribers alert".split())
def test_words_of_boilerplate_in_articles(word):
    page = f"""<article><h1 class="{word}">Title</h1><p>{LONG}</p>
    <section id="{word}"><h2 id="{word}">Short</h2><p>None.</p></section><section class="{word}"><h2>Long</h2><p>{LONG}</p></section>
    <h2><span class="mw-headline" id="{word}_structure">Span</span></h2><p id="{word}">Said in <span class="{word}">short</span>.</p></article>"""
    long = " ".join(LONG.split())
    assert html_text.article_lines(page) == ["Title", long, "Short", "None.", "Long", long, "Span", "Said in short."]


def test_listed_blocks_of_low_ratio_are_left_out():
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(4))
    body = f"<h1>Title</h1><p>{LONG}</p>" * 2
    for block in ('class="related"', 'class="social"', 'id="sidebar"', 'class="share-buttons"', 'role="search"'):
        for page in (f"<article>{body}<div {block}><ul>{links}</ul></div><p>{LONG}</p></article>",):
            got = html_text.article_lines(page)
            assert len(got) == 5 and not any("link" in line for line in got)


def test_several_articles():
    first, second = f"<h2>One</h2>{f'<p>{LONG * 20}</p>' * 3}", f"<h2>Two</h2>{f'<p>{LONG}</p>' * 3}<p>End.</p>"
    teaser = "<article><h3><a href=/x>Another article</a></h3><p>In short.</p></article>"
    got = html_text.article_lines(f"<main><article>{first}</article><article>{second}</article>{teaser}</main>")
    assert [line for line in got if len(line) < 20] == ["One", "Two", "End."] and len(got) == 9


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("just text", "just text"), ("<article><p>a<p>b", "a\nb"),
        ("</div></p><article>x</article></article>", "x"), ("<article>a < b &am; &#233; &bogus;</article>", "a < b &am; é &bogus;"),
        ("<article><p>a\n\t b \x0b c</p></article><nav>m", "a b c"), ("<script>let a = '<article>';", ""),
        ("<title>t</title><div class='content-with-sidebar no-ads'><p>x</p></div>", "x"),
        ("<div class=page-header><h1>Site</h1></div><article><div class=entry-header><h1>T</h1><p>by</div><p>x</article>", "T\nx"),
        ("<article><h1>T</h1></article>", "T"), ("<div class=ad>x</div>", ""), ("<article>\U0001f600</article>", "\U0001f600"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "wrap",
    [
        '<form id="aspnetForm">{}</form>', '<div class="modal-open page">{}</div>', '<div class="layout sidebar-right">{}</div>',
        '<div id="app" class="nav-collapsed">{}</div>', '<div class="comments">{}</div>', '<div role="dialog" class="modal">{}</div>', "<aside>{}</aside>",
        '<section id="search" class="ad-hoc"><div class="widget">{}</div></section>',
    ],
)
@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_wrappers_of_the_article(wrap, mark):
    """What holds the article is never left out by name, whether the article is marked or not."""
    body = f"<{mark}><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></{mark}>"
    menu = "<nav><ul>" + "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(9)) + "</ul></nav>"
    long = " ".join(LONG.split())
    for page in (menu + wrap.format(body), wrap.format(menu + body + f'<div class="ad">{LONG}</div><footer>{LONG}</footer>')):
        assert html_text.article_lines(page) == ["Title", long, "Short.", long]


@pytest.mark.parametrize(
    "part",
    ['<p class="modal-verbs">{}</p>', '<div class="ad-hoc">{}</div>', '<div class="toolbar-history">{}</div>', "<form><p>{}</p></form>",
     '<section class="header-parsing">{}</section>', '<p id="ads">{}</p>', '<div class="comments-in-code">{}</div>'],
)
def test_compounds_of_boilerplate_words_go_by_ratio(part):
    long = " ".join(LONG.split())
    assert html_text.article_lines(f"<article><h1>T</h1><p>{LONG}</p>{part.format(LONG)}<p>End.</p></article>") == ["T", long, long, "End."]


@pytest.mark.parametrize("start", ["", "<article>", "<article><p>text</p>"])
@pytest.mark.parametrize("piece", ["<div>word here", "<div>", "<span>a", "<ul><li>item", "<b><p>x", "<div><h2>a", "<table><tr><td>b", "</b><i>"])
def test_time_is_linear_in_nesting(start, piece):
    def seconds(times):
        began = time.perf_counter()
        html_text.main_text(start + piece * times)
        return time.perf_counter() - began

    few, many = min(seconds(6250) for _ in range(3)), seconds(50_000)
    assert many < 2 * piece.count("<") or many < 16 * few  # eight times the page; a busy machine may take longer


def test_ratios_choose_the_region(spark, monkeypatch):
    """With constant ratios the votes of the given pages go elsewhere, and those of pages without marks give other texts."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]

    def regions():
        found = []
        voted = html_text._voted
        monkeypatch.setattr(html_text, "_voted", lambda page: found.append(page.elements[voted(page)].tag) or voted(page))
        texts = [html_text.main_text(re.sub("</?(article|nav|footer)>", lambda m: m[0].replace(m[1], "div"), p)) for p in pages]
        monkeypatch.setattr(html_text, "_voted", voted)
        return found, texts

    with_ratios, texts = regions()
    monkeypatch.setattr(html_text, "tag_ratios", lambda lines: np.ones(len(lines)))
    constant, others = regions()
    assert with_ratios != constant
    assert sum(a != b for a, b in zip(texts, others)) > len(pages) / 10


def test_long_page_and_slices(monkeypatch):
    page = "<article>" + "".join(f"<p>{LONG}&amp;{i}</p>" for i in range(3000)) + "</article>"
    long = " ".join(LONG.split())
    assert html_text.main_text(page).split("\n") == [f"{long} &{i}" for i in range(3000)]
    texts = {size: [] for size in (1 << 16, 7, 1)}
    for size in texts:
        monkeypatch.setattr(html_text, "SLICE", size)
        texts[size] = [html_text.main_text(page[:20_000]), html_text.main_text(PAGE), html_text.main_text("<p>a &eacute;<!-- x --><b>c")]
    assert texts[7] == texts[1] == texts[1 << 16]


def test_columns_and_repeated_rows(spark):
    rows = [(None, None, "<p>a", "old", 1), (1, "u", "<p>a", "old", 1), (1, "u", "<p>a", "old", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n int")
    got = html_text.extract_articles(df)
    assert got.columns == ["page_id", "url", "n", "text", "n_chars"]
    assert [tuple(r)[3:] for r in got.collect()] == [("a", 1)] * 3
    assert html_text.extract_articles(df.limit(0)).count() == 0
    clashing = df.withColumnsRenamed({"text": "Text", "n": "N_chars", "html": "Html"})
    got = html_text.extract_articles(clashing, "Html")
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.first()["text"] == "a"
