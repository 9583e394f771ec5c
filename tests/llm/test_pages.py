"""Main text of pages: the test table against its own mark-up, and odd pages."""

import html
import re

import pytest

from tessera.llm import html_text

PARA = "<p>" + "The long paragraph goes on with many words in it, and never ends until here. " * 3 + "</p>"
TEXT = re.sub(r"</?p>", "", PARA).strip()


def by_markup(page):
    """What stands in the article element of the test pages."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    inner = re.sub(r"<[^>]*\Z", "", re.sub(r"</?b>", "", re.sub(r"<br>", " ", m[1])))
    blocks = [re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"</?(?:p|h\d)[^>]*>", inner)]
    return "\n\n".join(x for x in blocks if x)


def test_all_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {r["page_id"]: by_markup(r["html"]) for r in pages.collect()}
    got = html_text.extract_text(pages).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_density_finds_the_article_without_names():
    menu = "<div class='top-menu'><a href=a>Home</a> <a href=b>News</a></div>"
    plain = "<div><span><a href=a>One</a></span> <a href=b>Two</a> <a href=c>Three</a></div>"
    body = f"<div><div><h2>Title</h2>{PARA * 4}</div></div>"
    page = f"<html><body>{menu}{plain}{body}<div id='comments'>{PARA}</div><div class='site-footer'>Imprint</div></body></html>"
    assert html_text.main_text(page) == "\n\n".join(["Title", *[TEXT] * 4])


def test_noise_is_cut():
    inner = f"<article><header>By X</header><h1>T</h1>{PARA}<aside>{PARA}</aside><form>{PARA}<input></form><script>if (a<b) x('</p>')</script><style>p{{}}</style><div class='ad'>{PARA}</div><!-- {PARA} -->{PARA}<section class='comments'>{PARA}</section></article>"
    page = f"<body><nav><ul><li><a>a</a></ul></nav><div class='cookie-notice'>{PARA}</div>{inner}<footer>{PARA}</footer></body>"
    assert html_text.main_text(page) == f"T\n\n{TEXT}\n\n{TEXT}"


def test_names_of_noise():
    noise = lambda tag, attrs: html_text._is_noise(tag, attrs)
    for attrs in ('class="main-menu"', "id=cookieNotice", "class='x entry-footer'", ' role="navigation"', 'class="ad"', 'class="ad_slot2"', 'class="post-comments"', 'id="SideBar" class="sidebar"'):
        assert noise("div", attrs), attrs
    for attrs in ('class="has-sidebar content"', 'class="no-comments"', 'class="addendum"', 'class="loading headers2x"', 'title="menu"', ""):
        assert not noise("div", attrs), attrs
    assert not noise("body", 'class="home sidebar-left"') and noise("article", 'class="comment depth-1"') and noise("nav", "")


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='content-sidebar-wrap'>{}</div><div class='sidebar'>More to read</div></body>",
        "<body><div id='content' class='site-content sidebar-right'><article>{}</article></div><div>Other words of the page</div></body>",
        "<body><div class='elementor-widget-theme-post-content'>{}</div></body>",
        "<html><body class='comments-open'><div>{}</div><div id='comments'><p>First!</p></div></body></html>",
        "<body><div class='widget'>{}</div><div class='related'>See more</div></body>",
    ],
)
def test_a_noise_word_does_not_cut_the_article(page):
    body = [f"This is paragraph {k} of the article, and it goes on for quite a while." for k in range(6)]
    assert html_text.main_text(page.format("".join(f"<p>{p}</p>" for p in body))) == "\n\n".join(body)


ARTICLE = ["The first paragraph of the article tells what happened, and where it did so.", "The second one adds who was there and what they had to say about all of it."]
OTHER = "This box is far longer than the article beside it and tells of something else entirely, again and again. "


@pytest.mark.parametrize("name", ["sidebar", "cookie-consent", "newsletter", "related", "banner", "widget"])
@pytest.mark.parametrize("frame", ["<body>{}</body>", "<body><main>{}</main></body>"])
def test_longer_noise_never_wins(name, frame):
    inner = "<div class='entry'>" + "".join(f"<p>{p}</p>" for p in ARTICLE) + f"</div><div class='{name}'>" + f"<p>{OTHER * 3}</p>" * 4 + "</div>"
    assert html_text.main_text(frame.format(inner)) == "\n\n".join(ARTICLE)


def test_two_articles_come_back_in_order():
    first, second = (f"<article><h2>Part {k}</h2>" + f"<p>{ARTICLE[k]}</p>" * n + "</article>" for k, n in ((0, 5), (1, 2)))
    teaser = "<article><a href=x>Read on about quite another thing, which has a long headline of its own here</a></article>"
    got = html_text.main_text(f"<body><nav><a href=a>Home</a></nav><div>{first}{second}{teaser}</div><footer>Imprint</footer></body>")
    assert got == "\n\n".join(["Part 0", *[ARTICLE[0]] * 5, "Part 1", *[ARTICLE[1]] * 2])


def test_all_text_in_noise_is_not_lost():
    page = "<body><div class='widget'><p>One half of the whole text.</p></div><div class='promo'><p>One half of the whole text.</p></div></body>"
    assert "One half of the whole text." in html_text.main_text(page)


def test_broken_and_odd_pages():
    f = html_text.main_text
    assert f(None) == f("") == f("   ") == f("<html><body></body></html>") == f("<script>x</script>") == ""
    assert f("plain &lt;b&gt; &amp; text &copy;") == "plain <b> & text ©"
    assert f("<p>a<p>b<p>c  \n d</p>") == "a\n\nb\n\nc d"
    assert f("<p>one<br>two<b>bold</b>three</p><p>cut <a href='x") == "one twoboldthree\n\ncut"
    assert f("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert f("<p title='a>b'>quoted</p>") == "quoted"
    assert f("<div>" * 30_000 + "deep" + "</div>" * 10) == "deep"
    assert f("<div>" * 30_000 + "</p></b>" * 30_000 + "x") == "x"  # linear
    assert f('<a "' * 50_000 + "x") == "" and f("<a title=\"x' >y</a><p>z</p>") == "y\n\nz"
    assert f("</p></div>stray") == "stray"
    assert f("<ul><li>one<li>two<ul><li>three</ul><li>four</ul>") == "one\n\ntwo\n\nthree\n\nfour"
    assert f("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
    assert len(f("<p>" + "word " * 400_000 + "</p>")) == 400_000 * 5 - 1


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, None, "<p>x</p>"), (None, "u", "<p>y</p>")], "page_id long, url string, html string")
    got = html_text.extract_text(pages.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got] == [(1, "u", "", 0), (1, None, "x", 1), (None, "u", "y", 1)]
    assert html_text.extract_text(pages.limit(0)).count() == 0
