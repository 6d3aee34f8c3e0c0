"""Pages with broken markup: defined results, and time in proportion to the page."""

import time

import pytest
from lapframe.llm import html_text

LONG = {
    "open tags": "<a " * 3_300_000,
    "open quotes": '<a b="' * 400_000,
    "quoted ends": '<a ">" ' * 200_000,
    "stray ends": "<div></span>" * 100_000,
    "rules in inline elements": "<p><td>" + "<b>" * 50_000 + "<hr>" * 50_000,
    "items in inline elements": "<ul>" + "<b>" * 50_000 + "<li>x" * 50_000,
    "declarations": "<!" * 500_000,
    "headings": "<h1>t</h1>" + "<i>x</i> y " * 50_000,
    "open scripts": "<script " * 200_000,
    "script ends": "<script>" + "</script " * 200_000,
}


@pytest.fixture(scope="module")
def weights():
    return html_text.learn()


@pytest.mark.parametrize("name", LONG)
def test_time_grows_with_the_page(weights, name):
    start = time.time()
    html_text.main_text(LONG[name], weights)
    assert time.time() - start < 15


def test_tags_end_outside_quotes_if_they_can():
    def found(source):
        return [(kind, name, rest) for _, _, kind, name, rest in html_text.tokens(source)]

    assert found('<a b=">" c>') == [("open", "a", ' b=">" c')]
    assert found('<a b=">c') == [("open", "a", ' b="')]
    assert found("<a <b> x < y") == [("open", "a", " <b")]
    assert found("<script>a<b></SCRIPT ></p>") == [("raw", "script", ""), ("close", "p", "")]
    assert found("<!-- a > <b> -->c<!--d") == [("other", "", "")] * 2
    assert found("1 < 2 <3> <a") == []
    assert found("<!doctype html><?x y><br/>") == [("other", "", ""), ("other", "", ""), ("open", "br", "/")]


def test_character_references_of_any_length(weights):
    text = "&#65;&#0065;&#x41;&#" + "0" * 9000 + "66; &#" + "9" * 9000 + "; &amp; &#xffffffffff; end of it"
    assert html_text.main_text(f"<article><p>{text}</p></article>", weights) == "AAAB � & � end of it"


def test_empty_and_broken_pages(sent):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<"), (None, "u", "<a b='"), (5, "u", "plain words only")]
    frame = sent.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(frame).collect()}
    assert got == {1: "", 2: "", 3: "<", None: "<a b='", 5: "plain words only"}
    assert html_text.extract(frame.limit(0)).collect() == []
