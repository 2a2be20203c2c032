"""Host paths on broken, deep and named markup."""

import time

import pytest

from plaintscope.llm import host_paths
from plaintscope.llm.host_paths import extract

CASES = [
    ("<p title=Tom's>First paragraph.</p><p>It's fine.</p>", "First paragraph.\nIt's fine."),
    ("<p id=don't>One</p><p id=don't>Two</p>", "One\nTwo"),
    ('<p data-x="a"b">Text</p>', "Text"),
    ('<p a=">" b>x</p>', "x"),
    ('<p title="abc>never closed</p><p>more</p>', "never closed\nmore"),
    ("<p>3 < 4 and 5 > 2</p>", "3 < 4 and 5 > 2"),
    ('<article><h2 id="legal-basis">Legal</h2><p id="related-notes">Notes</p><section class="legal"><p>Part</p></section>'
     '<p class="ad">Buy</p><div class="related-posts"><p>Else</p></div></article>', "Legal\nNotes\nPart"),
    ('<main><p>The body text of the page</p><article class="comment"><p>A reader</p></article></main>', "The body text of the page"),
    ('<article class="post comments-open has-comments"><p>The post</p></article>', "The post"),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be</p>", "Let x=1 be"),
    ("<p>a</p><option>b<p>rest</p>", "a\nb\nrest"),
    ("<p>a</p><svg><p>rest</p>", "a\nrest"),
    ("<p>a</p><select><option>1<option>2</select><p>rest</p>", "a\nrest"),
    ("<p>a</p><script>if (x) {<p>rest</p>", "a"),
    ("<p>x<!-- c > d --> y</p><p>z<!-- open", "x y\nz"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_markup(page, want):
    assert extract(page, None) == want


LARGE = {"unclosed tags": "<a " * 350_000, "one long tag": "<a " * 350_000 + ">x", "quotes": '<a x=">" ' * 100_000,
         "unclosed quotes": '<a x="' * 150_000, "nested div": "<div>" * 100_000 + "x", "nested lists": "<ul>" * 100_000 + "x",
         "stray ends": "<div>" * 50_000 + "</section>" * 50_000 + "x", "options": "<option>a" * 100_000,
         "wrappers": "<div class=ad><form>" * 10_000 + "<p>text", "signs": "<" * 500_000 + ">",
         "unclosed div with text": "<div><p>some text" * 40_000}


@pytest.mark.parametrize("name", LARGE)
def test_large_pages_take_linear_time(name):
    start = time.perf_counter()
    extract(LARGE[name], None)
    assert time.perf_counter() - start < 6  # a quadratic reading needs minutes


def test_scores_equal_the_sum_over_all_ancestors():
    page = "<body><div class=a><p>%s<div class=b><p>%s<td>%s</div></div><div class=c><p>%s</div>" % tuple("word " * n for n in (5, 9, 20, 30))
    found = host_paths.blocks(page)
    scores = {}
    for e, text, in_links in found:
        share, up = 1.0, e
        while up is not None:
            if up.tag in host_paths._CONTAINERS:
                scores[up] = scores.get(up, 0.0) + max(0, len(text) - 2 * in_links) * share
                share *= host_paths.DISCOUNT
            up = up.up
    best, most = host_paths.best_container(found)
    assert most == pytest.approx(max(s * e.weight for e, s in scores.items())) and scores[best] * best.weight == pytest.approx(most)


def test_winning_path_takes_a_page_that_scores_otherwise(spark):
    body = '<div class="post"><p>%s</p></div><div class="more"><p>%s</p></div>'
    rows = [(i, f"http://h/{i}", body % ("Long text. " * 50, "Short.")) for i in range(5)]
    rows.append((9, "http://h/9", body % ("Brief.", "A long list of other things. " * 40)))
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, path string, host string")
    got = {r["page_id"]: r["text"] for r in host_paths.extract_pages(pages).collect()}
    assert got[9] == "Brief." and got[0] == ("Long text. " * 50).strip()


def test_paths_have_a_bounded_name():
    found = host_paths.blocks("<div class=%s>" % ("x" * 5_000) * 300 + "<p>text of the page")
    best, _ = host_paths.best_container(found)
    assert len(best.path) < 300 and extract("<div class=%s>" % ("x" * 5_000) * 300 + "<p>text", best.path) == "text"
