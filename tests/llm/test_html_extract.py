import random
import time

import pytest

from reviewloom.llm.html_extract import DEFAULT, extract, fit_weights, main_text, pieces, score

BODY = " ".join(f"word{i}" for i in range(30))
PAGE = f"""<!DOCTYPE html><html lang=en><head><title>Title words here</title><style>p{{x}}</style>
<script>var t="</p><article>"; if (a<b) {{}}</script></head><body class="x">
<header><div>Site name and slogan</div></header><nav><ul><li><a href="/a">One</a><li><a href='/b>c'>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site</p></div>
<article><h1>Head&amp;line</h1><p>First <b>bold</b>  text&nbsp;here &lt;tag&gt;<br>next<p>{BODY}
<!-- <p>comment</p> --><aside>Side box</aside><div class='ad'>Buy now</div><form><label>Mail</label></form>
<ul><li>item one<li>item two</ul><table><tr><td>cell</td></tr></table><p>{BODY}</p>
<section id="comments"><p>Reader says things</p></section></article>
<div id=sidebar><p>Other stories</p></div><footer>&copy; 2020 Footer</footer></body></html>"""


@pytest.mark.parametrize("weights", [DEFAULT])
def test_article_without_what_stands_aside(weights):
    want = [
        "Head&line", "First bold text here <tag> next", BODY, "item one", "item two", "cell", BODY,
    ]
    assert main_text(PAGE, weights) == "\n\n".join(want)


def test_regions_without_semantic_elements():
    page = f"<body><div class='menu'><a>x</a></div><div><p>{BODY}</p><p>{BODY}</p></div><div class=footer>end</div>"
    assert main_text(page, DEFAULT) == f"{BODY}\n\n{BODY}"


@pytest.mark.parametrize("page", ["", "<", "<p", "<p>", "<!--", "<script>x", "</p></p>", "<a href='x", "&", "<nav>a b c</nav>"])
def test_broken_pages_give_no_text_or_what_they_hold(page):
    assert main_text(page, DEFAULT) in ("", "<", "&")


def test_cut_off_page_and_long_page():
    cut = PAGE[: PAGE.index("Reader")]
    assert main_text(cut, DEFAULT).endswith(BODY)
    long = "<article>" + "<p>some words here</p>" * 20_000
    assert main_text(long, DEFAULT).count("\n\n") == 19_999
    assert main_text("text without any markup", DEFAULT) == "text without any markup"


def test_best_run_equals_all_runs():
    """The scan's score is the best over all contiguous runs."""
    from reviewloom.llm.html_extract import scored

    found = pieces(PAGE)
    scores = [score(p, DEFAULT) if p.words or p.kind.startswith("tag:") else 0 for p in found]
    start, end = scored(found, DEFAULT)
    best = max(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    assert sum(scores[start:end]) == pytest.approx(best)


def test_rows(spark):
    rows = [(i, f"http://h/{i}", PAGE) for i in range(20)] + [(20, None, None), (None, "u", ""), (20, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' as text", "1 as n_chars", "2 as id")
    weights = fit_weights(pages)
    assert weights["word"] > 0 > weights["tag:nav"] and weights["tag:p"] < 0
    got = extract(pages).collect()
    assert len(got) == 23
    for r in got:
        want = main_text(PAGE, weights) if r.page_id is not None and r.page_id < 20 else ""
        assert r.text == want and r.n_chars == len(want)
    assert main_text(PAGE, weights).split("\n\n")[0] == "Head&line"
    assert extract(pages.limit(0)).count() == 0
    nothing = fit_weights(pages.where("page_id = 20"))
    assert nothing == DEFAULT


@pytest.mark.parametrize("body, article", [
    ("<body>", "<article>"), ("<body class='has-sidebar'>", "<article>"), ("<body class='single comments-open'>", "<article>"),
    ("<body class='header-fixed'>", "<article>"), ("<body id='newsletter-archive'>", "<article>"),
    ("<body>", "<article class='post comments-open'>"), ("<body><div id='sidebar-left'>", "<article class=related>"),
])
def test_class_words_never_void_the_article(body, article):
    page = PAGE.replace('<body class="x">', body).replace("<article>", article, 1).replace('var t="</p>' + article, 'var t="</p><article>')
    assert main_text(page, DEFAULT) == main_text(PAGE, DEFAULT) != ""


def test_comments_in_article_elements_go():
    comments = "<div id=comments>" + f"<article class=comment><p>{BODY[:90]}</p></article>" * 9 + "</div>"
    page = f"<body><main><article><p>{BODY}</p></article>{comments}</main></body>"
    assert main_text(page, DEFAULT) == BODY


def test_wrapper_of_most_words_stays():
    page = f"<body><div class='header'>Site</div><div class='with-sidebar'><p>{BODY}</p><p>{BODY}</p></div></body>"
    assert main_text(page, DEFAULT) == f"{BODY}\n\n{BODY}"


@pytest.mark.parametrize("page", [
    "<div>x " * 100_000, "<ul>" + "<span>" * 30_000 + "<li>y</li>" * 30_000, "<b>" * 40_000 + "</i>z" * 40_000,
    "<p><i>q" * 50_000,
])
def test_time_is_linear_in_open_elements(page):
    start = time.perf_counter()
    assert pieces(page)
    assert time.perf_counter() - start < 5


def test_fitted_weights_keep_articles_whole(spark):
    """Menus hold all lists of the labelled pages; an article with lists, adverts and short blocks stays."""
    rng = random.Random(6)
    rows = []
    for i in range(60):
        menu = "<nav><ul>" + "".join(f"<li><a href=x>m{rng.randrange(99)}</a></li>" for _ in range(30)) + "</ul></nav>"
        text = "".join(f"<p>{BODY}</p>" for _ in range(rng.randrange(1, 6)))
        rows.append((i, f"u{i}", f"<body>{menu}<article><h1>Title</h1>{text}</article><div class=ad>{BODY}</div></body>"))
    weights = fit_weights(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert weights["tag:li"] < -2
    first = " ".join(f"start{i}" for i in range(20))
    advert = "<div class=ad>" + "buy this now " * 30 + "</div><ul>" + "<li>one</li>" * 40 + "</ul>"
    page = rows[0][2].split("<article>")[0] + f"<article><h1>Head</h1><p>{first}</p>{advert}<p>{BODY}</p></article>"
    assert main_text(page, weights) == "\n\n".join(["Head", first, *["one"] * 40, BODY])
