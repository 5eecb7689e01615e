from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavefold.llm import html_text
from wavefold.llm.html_text import best_run, fit_weights, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head  line</h1><p><b>First &amp; bold.<br><p>Second <a href='#'>link</a>ed, 3 &lt; 4.</p>
<div class="ad-box">Buy now</div><p>Third&nbsp;par&#97;.</p><form><input>Mail</form>
<section id="comments"><p>Reader says</p></section></article><aside>Side</aside><footer>&copy; Site</footer></body></html>"""
TEXT = "Head line First & bold. Second linked, 3 < 4. Third para."
PAGES = "page_id bigint, url string, html string"
WEIGHTS = fit_weights([PAGE] * 3)


def test_article_without_the_rest():
    assert main_text(PAGE, WEIGHTS) == TEXT


def test_markup_that_was_cut_off():
    for cut in range(0, len(PAGE), 7):
        main_text(PAGE[:cut], WEIGHTS)
    cut = PAGE.index("Third")
    assert main_text(PAGE[:cut] + "Thi<p class='x", WEIGHTS) == "Head line First & bold. Second linked, 3 < 4. Thi"
    assert main_text("<p>a &am", WEIGHTS) == "a &am"


def test_page_without_article_takes_the_best_run():
    page = "<div><a>x</a></div>" * 5 + "<p>" + "word " * 50 + "</p>" + "<div><a>y</a></div>" * 5
    assert main_text(page, WEIGHTS) == ("word " * 50).strip()


def test_unclosed_noise_ends_with_its_parent():
    page = "<article><p>" + "a " * 20 + "<div class=ad><p>noise</article>"
    assert main_text(page, WEIGHTS) == ("a " * 20).strip()
    assert main_text("<body><p class=ad>noise<p>" + "text " * 9, WEIGHTS) == ("text " * 9).strip()


def test_attributes_hold_angle_brackets_and_quotes():
    assert main_text('<p title="a>b">in <i data-x=\'>\'>side</i></p>', WEIGHTS) == "in side"
    assert main_text('<p title="open>text here', WEIGHTS) == "text here"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=12))
def test_best_run(scores):
    first, end = best_run([float(x) for x in scores])
    best = max([0, *(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))])
    assert sum(scores[first:end]) == best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<", ">", "word ", "<!--", "-->", "<script>", "</script>", "&lt;", '"', "<a href=", "<li>"]), max_size=30).map("".join))
def test_any_markup_is_read(page):
    assert main_text(page, WEIGHTS) == " ".join(main_text(page, WEIGHTS).split())


def test_table(make):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>" + "word " * 10)]
    pages = make(rows, PAGES).withColumn("text", F.lit("old")).withColumn("n_chars", F.lit("old"))
    got = sorted(tuple(r) for r in html_text.extract(pages).na.fill(-1, ["page_id"]).na.fill("", ["url"]).collect())
    assert got == [(-1, "w", ("word " * 10).strip(), 49), (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, "", "", 0), (3, "v", "", 0)]
    assert html_text.extract(make([], PAGES)).count() == 0


BODY = "".join(f"<p>{'word ' * 20}number {i}.</p>" for i in range(5))
WORDS = " ".join(f"{'word ' * 20}number {i}." for i in range(5))


def test_noise_names_around_the_article():
    for wrap in ('<div class="content-sidebar-wrap">', '<div class="wrap has-sidebar">', '<div id="page" class="site no-header">',
                 "<form id=aspnetForm>", '<div role="search" style="display:none">'):
        assert main_text(f"<body>{wrap}<article>{BODY}</article></body>", WEIGHTS) == WORDS
        assert main_text(f"<body>{wrap}<main>{BODY}</main><div class=ad>Buy this</div></body>", WEIGHTS) == WORDS


def test_noise_names_around_most_words():
    for wrap in ('<div class="wrap has-sidebar">', '<div id="page" class="site no-header">'):
        assert main_text(f"<body>{wrap}{BODY}</div><div>few other words</div></body>", WEIGHTS) == WORDS
        assert main_text(f"<body><article>teaser</article>{wrap}{BODY}</div></body>", WEIGHTS) == WORDS
    # An advert longer than a short article stays out.
    assert main_text("<body><div class=ad>" + "buy " * 15 + "</div><article><p>A short note.</article>", WEIGHTS) == "A short note."


def test_names_inside_quoted_values():
    for attribute in ('title="a hidden gem"', "title='x class=ad y'", 'data-x="a id=comments" class="lead"', 'title="1 > 0 hidden"'):
        assert main_text(f"<article><p>{'one ' * 9}</p><p {attribute}>two three</p></article>", WEIGHTS) == "one " * 9 + "two three"
    assert main_text("<article><p>one</p><p hidden>two</p><p data-a='b' class=ad>three</p></article>", WEIGHTS) == "one"


def test_blocks_and_lists_of_a_page_without_article():
    """Labelled pages with div, ul and li outside their articles only: other layouts keep their text."""
    blocks = [f"{'word ' * 30}block {i}" for i in range(4)]
    assert WEIGHTS["div"] < -40 and WEIGHTS["li"] < -40
    page = "<body><div>" + "".join(f"<div>{b}</div>" for b in blocks) + "</div></body>"
    assert main_text(page, WEIGHTS) == " ".join(blocks)
    items = "<ul>" + "".join(f"<li>{i} eggs</li>" for i in range(6)) + "<li>milk</li></ul>"
    words = " ".join(f"{i} eggs" for i in range(6)) + " milk"
    page = f"<body><div><p>{blocks[0]}</p>{items}<p>{blocks[1]}</p></div><div><div>{blocks[2]}</div></div></body>"
    assert main_text(page, WEIGHTS) == f"{blocks[0]} {words} {blocks[1]} {blocks[2]}"
    assert main_text(f"<body><div><p>{blocks[0]}</p>{items}</div>", WEIGHTS) == f"{blocks[0]} {words}"
    table = "<table>" + "<tr><td>a b</td><td>c d</td></tr>" * 5 + "</table>"
    assert main_text(f"<body><div>{blocks[0]}{table}</div><div>{blocks[1]}</div>", WEIGHTS) == f"{blocks[0]} {' '.join(['a b c d'] * 5)} {blocks[1]}"


def test_lists_that_close_an_article():
    page = f"<article><p>{'word ' * 30}</p><ul>" + "<li>egg</li>" * 5 + "</ul><div><div><p>End</p></div></div></article><div>Share this page now</div>"
    assert main_text(page, WEIGHTS) == "word " * 30 + "egg " * 5 + "End"
