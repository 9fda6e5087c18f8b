from __future__ import annotations

import pytest

from layerloom.llm import html_text

CASES = {
    None: "",
    "": "",
    "plain": "plain",
    "<article><h1>T &amp; x</h1><p>One <b>two</b>\n three<br>four.<p>Sh.</article><footer>f</footer>": "T & x\n\nOne two three four.\n\nSh.",
    "<nav><ul><li>a</li></ul></nav><article><p>x</p></article><aside>s</aside>": "x",
    "<article><p>a</p><div class='ad'>buy</div><p>b</p><form><p>mail</p></form><script>var t='</p>';</script></article>": "a\n\nb",
    "<header><h1>Site</h1></header><main><p>m</p></main><div class='cookie-notice'>c</div>": "m",
    "<article><p>a</p></article><section class='comments'><article class='comment'><p>c</p></article></section>": "a",
    "<article><p>cut &lt;3 &am": "cut <3 &am",
    "<article><p>1&nbsp; 2&#x20AC;</p><!-- x --><p> </p></article>": "1 2€",
    "<article></article>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_main_text(page):
    assert html_text.main_text(page) == CASES[page]


def test_page_without_marks_keeps_its_dense_lines():
    long = "This is a long paragraph of the page's own text, as one would write it. "
    page = (
        "<div><a href=x>Home</a></div><div><a href=x>About</a></div><div><a href=x>News</a></div>"
        f"<div>{long}</div><div>Short.</div><div>{long}</div>"
        "<div><a href=x>More</a></div><div><a href=x>Next</a></div><div><a href=x>Last</a></div><div>(c) me</div>"
    )
    assert html_text.main_text(page) == f"{long.strip()}\n\nShort.\n\n{long.strip()}"


def test_page_without_marks_keeps_sections_split_by_stripped_blocks():
    long = " ".join(["The first section goes on for a good while."] * 40)
    source = "An article in full that the text links to as its source."
    ads = "<div class=ad>x</div>" * 3
    page = (
        f"<div>Tuesday</div>{ads}<h2>Short head.</h2>{ads}<p>{long}</p><p><a href=x>{source}</a></p><p>{long}</p>{ads}"
        f"<p>The end, short.</p>{ads}<p><a href=x>Read all of our other pages.</a></p>{ads}<div>(c) me</div>"
    )
    assert html_text.main_text(page) == f"Short head.\n\n{long}\n\n{source}\n\n{long}\n\nThe end, short."


def test_the_sums_choose_on_marked_and_unmarked_pages(monkeypatch):
    """With the sums switched off no page has a text, and with any window a loose line stays."""
    ads = "<div class=ad>x</div>" * 3
    pages = ["<article><p>a</p></article>", f"<p>One paragraph.</p>{ads}<div>loose</div>"]
    assert [html_text.main_text(page) for page in pages] == ["a", "One paragraph."]
    assert html_text.main_text(pages[1], surge_chars=0) == "One paragraph.\n\nloose"
    monkeypatch.setattr(html_text, "_passages", lambda counts, *options: [])
    assert [html_text.main_text(page) for page in pages] == ["", ""]


def test_doubtful_names_inside_an_article():
    work = "What others did before on this question, in so many words that it is a section of the article's own."
    links = "".join(f"<a href=x>{work}</a>" for _ in range(3))
    page = (
        f"<article><p>a</p><div class='related work'><p>{work}</p><p>b</p></div><div class=related>See also</div>"
        f"<ul class='share'>{links}</ul><p>c</p><div class=advert>{work}</div></article><div class=notice>{work}</div>"
    )
    assert html_text.main_text(page) == f"a\n\n{work}\n\nb\n\nc"


def test_very_long_and_deep_pages():
    assert html_text.main_text("<div>" * 30_000 + "x").strip() == "x"
    words = "word " * 200_000
    assert html_text.main_text(f"<article><p>{words}</p></article>") == words.strip()


def test_passage_begins_with_its_short_lines():
    long = "A paragraph that is long enough for a surge of the sums over any window of three lines."
    page = f"<p>One.</p><p>Two.</p><p>Three.</p><p>Four.</p><p>{long}</p>"
    assert html_text.main_text(page) == f"One.\n\nTwo.\n\nThree.\n\nFour.\n\n{long}"


def test_rows(spark):
    rows = [(1, "u", "<article>é&#128578;</article>", "mine", 5), (2, None, None, "mine", 5)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, row string, n_chars int")
    found = html_text.extracted(pages)
    assert found.columns == ["page_id", "url", "row", "text", "n_chars"]
    assert sorted(map(tuple, found.select("page_id", "text", "n_chars").collect())) == [(1, "é🙂", 2), (2, "", 0)]
    twice = html_text.extracted(pages.unionAll(pages)).select("page_id", "text").collect()
    assert sorted(map(tuple, twice)) == [(1, "é🙂"), (1, "é🙂"), (2, ""), (2, "")]
    assert html_text.extracted(pages.limit(0)).count() == 0
