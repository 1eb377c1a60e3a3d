import random

import pytest

from voltdrift.llm import page_text as p

NAV = '<nav><ul><li><a href="/a">Home page</a></li><li><a href="/b">News and more</a></li></ul></nav>'
PAGE = (
    "<!DOCTYPE html><html><head><title>Title words</title><style>p{{a:b}}</style><script>var t='</p> x';</script></head><body>"
    + NAV
    + '<!-- c --><div class="ad">Buy this now please do</div>{}<footer>&copy; us</footer></body></html>'
)


@pytest.fixture(scope="module")
def weights():
    return p.fitted([PAGE.format("<article><h1>A title</h1><p>" + "some words " * 20 + "</p></article>")] * 5)


def test_labelled_page(weights):
    body = "<article><h1>A &amp; B</h1><p>one\n two&nbsp;<b>th</b>ree<br>four</p><p></p><p>x &lt; y &#233;</article>"
    assert p.main_text(PAGE.format(body), weights) == "A & B\none two three four\nx < y é"


def test_what_is_beside_goes_inside_and_outside(weights):
    body = (
        "<div class='cookie-notice'>We use cookies on this site</div><main><header><h1>Head</h1></header><p>First words here.</p>"
        "<aside>Other stories to read</aside><form>Sign up <button>Go</button></form><script>if (a < b) x()</script><p>Last words.</p>"
        "<section id=comments><article class='comment'>I say this here</article></section></main><div id='sidebar'>Side text words</div>"
    )
    assert p.main_text(PAGE.format(body), weights) == "Head\nFirst words here.\nLast words."


def test_page_without_labels(weights):
    text = "<div><p>" + "plain words of the text " * 5 + "</p><p>and more words here</p></div>"
    assert p.main_text(PAGE.format(text), weights).split("\n") == [("plain words of the text " * 5).strip(), "and more words here"]


@pytest.mark.parametrize(
    "body, outer",
    [("page has-sidebar", "content"), ("search", "content"), ("page", "content no-comments"), ("page", "content related-wide"), ("page", "content sidebar")],
)
def test_names_around_a_whole_page_without_labels(weights, body, outer):
    text = "plain words of the text " * 5
    page = f'<html><body class="{body}"><div class="{outer}"><div class="text"><p>{text}</p><p>and more here</p></div></div>' + NAV + "</body></html>"
    assert p.main_text(page, weights).split("\n") == [text.strip(), "and more here"]


def test_best_run_matches_all_runs():
    r = random.Random(0)
    for _ in range(200):
        scores = [r.choice([-3, -1, -0.5, 1, 2]) for _ in range(r.randrange(12))]
        start, stop = p.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        assert sum(scores[start:stop]) == max(best, 0)


def test_rows(spark):
    body = PAGE.format("<article><p>Words of it here</p></article>")
    rows = [(1, "u", body), (1, "u", body), (2, None, None), (3, "v", ""), (None, "w", "<p>Unclosed <b>words go on"), (4, "x", "<" * 5000 + "a \"" * 9), (5, "y", "<div>" * 3000)]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    found = p.extracted(frame, p.train(frame)).collect()
    texts = {(r.page_id, r.url): r.text for r in found}
    assert len(found) == len(rows)
    assert texts[1, "u"] == "Words of it here" and texts[2, None] == "" and texts[3, "v"] == ""
    assert texts[None, "w"] == "Unclosed words go on" and texts[5, "y"] == ""
    empty = frame.limit(0)
    assert p.extracted(empty, p.train(empty)).count() == 0
