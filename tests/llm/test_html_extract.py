from __future__ import annotations

import math
import random
import time
from statistics import fmean

import pytest

from riskweave.llm.html_extract import extract, main_lines, smoothed, threshold
from tests.conftest import DATA

PAGE = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{}</style></head><body>
<header class="site"><a href="/">Home</a><form><input name=q><button>Search</button></form></header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="adTop">Buy now</div>
<main><article class="post"><h1>Title &amp; more</h1>
<p>First   para&shy;graph<br>with &lt;code&gt; &eacute; and <b>bold <i>words</b> here.<p>Short.
<script>var t = "</p><p>no";</script><div class="ad">Advert</div><aside>Side</aside>
<ul><li>Item one</li><li>Item two</ul><blockquote>Said so</blockquote>
<table><tr><td>a<td>b<tr><td>c</table><!-- hidden <p>not this</p> -->
<section class="comments"><p>Reader says a very long thing that must not be taken for the article itself, ever.</p></section></article></main>
<div class="sidebar"><p>Related things to read on this site, many of them and long ones, too.</p></div>
<footer>&copy; Someone</footer></body></html>"""


def test_article_only():
    assert main_lines(PAGE) == [
        "Title & more", "First para\xadgraph with <code> é and bold words here.", "Short.", "Item one", "Item two", "Said so", "a", "b", "c",
    ]


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<script>x</script>", "<!-- a", "<p", "</p></div>"])
def test_no_text(html):
    assert main_lines(html) == []


def test_page_without_article():
    body = "<div class=menu><a>x</a></div>" + "".join(f"<p>A sentence number {i} that is long enough to be content.</p>" for i in range(6))
    assert len(main_lines(f"<body>{body}<div class='footer'>f</div></body>")) == 6


def test_unclosed_tags_do_not_swallow_the_article():
    assert main_lines("<nav><ul><li><a>x</nav><article><p><b>one<p>two</article>") == ["one", "two"]


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    assert main_lines(deep) == ["deep text"]
    assert len(main_lines("<article>" + "<p>word word</p>" * 20_000 + "</article>")) == 20_000


def test_smoothing_keeps_the_level():
    assert smoothed([3.0] * 9) == pytest.approx([3.0] * 9)


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(pages).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2]
    assert got[0][1:] == ("x", 1) and got[3][1:] == ("", 0) and got[1] == got[2]
    assert extract(pages.where("false")).collect() == []


def test_all_pages_have_their_article(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    assert extract(pages).where("n_chars = 0").count() == 0


SENTENCE = "A sentence that is long enough to be taken for the body of a text, with several clauses in it."
PLAIN_PAGE = (
    "<body><div>Home News Sport</div><div><a href=1>Home</a> <a href=2>World</a> <a href=3>About</a></div><div class='story'><h1>Title</h1>"
    + "".join(f"<p>{SENTENCE} {i}</p>" for i in range(8)) + "<p>Short.</p>" + f"<p>{SENTENCE}</p></div><div>More <a href=4>this</a> <a href=5>that</a></div><div>Imprint</div></body>"
)
PLAIN_TEXT = ["Title", *[f"{SENTENCE} {i}" for i in range(8)], "Short.", SENTENCE]


def test_clusters_find_the_region_without_an_article_element():
    assert main_lines(PLAIN_PAGE) == PLAIN_TEXT


def test_result_rests_on_the_ratios(monkeypatch):
    flat = "<body>" + "".join(f"<div>Entry {i}</div>" for i in range(9)) + "".join(f"<div>{SENTENCE} {i}</div>" for i in range(6)) + "<div>End</div></body>"
    wanted = [f"{SENTENCE} {i}" for i in range(6)]
    assert main_lines(flat) == wanted
    monkeypatch.setattr("riskweave.llm.html_extract.smoothed", lambda values, sigma=1.5: [1.0] * len(values))
    assert main_lines(flat) != wanted


def test_links_inside_the_article_go_where_the_clusters_leave_them_out():
    links = "<div><ul>" + "".join(f"<li><a href={i}>See {i}</a>" for i in range(9)) + "</ul></div>"
    page = "<article><h1>T</h1>" + f"<p>{SENTENCE}</p>" * 9 + links + "</article>"
    assert main_lines(page) == ["T", *[SENTENCE] * 9]


def test_a_container_with_far_more_text_beats_a_teaser_article():
    page = "<body><article><p>Teaser.</p></article><div>" + f"<p>{SENTENCE}</p>" * 9 + "</div></body>"
    assert main_lines(page) == [SENTENCE] * 9


@pytest.mark.parametrize("mark", ["share-price", "article-header", "notice-of-death", "has-sidebar", "adobe"])
def test_names_that_only_hint_at_furniture_delete_nothing(mark):
    page = f"<article><p>{SENTENCE}</p><p class='{mark}'>{SENTENCE} {mark}</p><div class='{mark}'><p>{SENTENCE}</p></div><p>{SENTENCE}</p></article>"
    assert main_lines(page) == [SENTENCE, f"{SENTENCE} {mark}", SENTENCE, SENTENCE]


@pytest.mark.parametrize("mark", ["ad", "adTop", "ad-3", "cookie-notice", "site-footer", "post-comments", "comments", "sidebar left", "newsletter_box", "share-buttons"])
def test_names_of_furniture_do(mark):
    assert main_lines(f"<article><p>{SENTENCE}</p><div class='{mark}'><p>{SENTENCE} more</p></div></article>") == [SENTENCE]


@pytest.mark.parametrize("page", ["<b>" * 60_000 + "<div>x" * 60_000, "<div>" * 60_000 + "x", "<p><span>y" * 60_000, "<li>" * 90_000])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    main_lines(page)
    assert time.process_time() - began < 10


def test_threshold_is_the_best_of_all_cuts():
    """Against trying every cut."""
    dice = random.Random(3)
    for _ in range(200):
        values = [dice.choice([dice.gauss(1, 0.3), dice.gauss(4, 0.5)]) for _ in range(dice.randint(1, 30))]
        cuts = {}
        for cut in sorted(set(values))[1:]:
            low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
            if fmean(high) - fmean(low) > math.log(2):
                cuts[cut] = len(low) * len(high) * (fmean(high) - fmean(low)) ** 2
        wanted = max(cuts, key=cuts.get) if cuts else min(values)
        assert threshold(values) == pytest.approx(wanted)


def test_smoothing_equals_the_weighted_sum():
    values = [random.Random(i).random() for i in range(40)]
    for i, got in enumerate(smoothed(values, 1.5)):
        weights = {j: math.exp(-((i - j) ** 2) / 4.5) for j in range(40) if abs(i - j) <= 5}
        assert got == pytest.approx(sum(w * values[j] for j, w in weights.items()) / sum(weights.values()))


def test_planted_articles_come_back_whole():
    """Random articles among furniture of every kind: the result is the article, block by block."""
    dice = random.Random(5)
    furniture = [
        "<nav><ul><li><a href=x>Menu</a></ul></nav>", "<header><p>Site</p></header>", "<div class='ad'>Buy this now and save</div>", "<aside>By the way</aside>",
        "<form><input><button>Go</button></form>", "<div id='cookie-banner'>We use cookies</div>", "<footer>Imprint</footer>", "<script>var a='<p>x</p>'</script>",
        "<section class='comments'><p>" + SENTENCE + "</p></section>",
    ]
    for _ in range(100):
        blocks = [" ".join(f"w{dice.randint(0, 999)}" for _ in range(dice.choice([1, 3, 12, 40, 200]))) for _ in range(dice.randint(1, 25))]
        body = "".join(f"<p>{b}" + dice.choice(["</p>", "", "</p>" + dice.choice(furniture)]) for b in blocks)
        around = ["".join(dice.choices(furniture, k=4)) for _ in range(2)]
        assert main_lines(f"<html><body>{around[0]}<article>{body}</article>{around[1]}</body></html>") == blocks
