"""Main text of web pages by line-block distribution.

A page becomes lines: each block of the markup is one, its white space turned into single
spaces. Lines that the markup itself names as something else (navigation, a page header or
footer, a sidebar, an advert, a form, a notice, reader comments, code) are stripped to
length zero, and so is everything outside the articles of a page that marks its articles, and
a line outside of articles that is mostly links. Every other line counts its characters, and a
line that is marked as running text, as part of an article, a paragraph, a heading, a list item,
a quote or a table, counts so many more as a window needs to surge.

The counts of the lines in a sliding window are then summed. A stretch of lines begins where
the sum rises from zero and ends where it dives to zero; if it surges above the threshold
anywhere within, the stretch is a passage and all its text is kept, mostly linked lines
between its others included. So what goes beside stripped lines is loose text in bare blocks
that never amounts to a window's worth: labels, dates, a line of copyright. If no window
of a page surges, the fullest one does: a page with any text has a main text.

Names of classes that may stand for a page's parts as well as for an article's own (``related``,
``notice``) strip a block inside a marked article only if it is short or mostly links.

Defined cases: null or empty HTML has an empty text. Broken, unclosed or cut markup is read
as far as it goes. Very long pages are read whole, and rows that repeat a page are read each. An
empty table gives an empty result. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import others

WINDOW_LINES = 3
SURGE_CHARS = 80
LINK_SHARE = 0.6

# Element names of the HTML standard and the names pages use for their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav ol p pre search section summary table tbody tfoot thead title tr ul""".split()
)
SPACED = frozenset("br td th option img".split())
STRIPPED = frozenset(
    """aside button dialog footer form head iframe menu nav noscript object option script search
    select style svg template textarea title""".split()
)
STRIPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu navigation search".split()
)
STRIPPED_NAMES = frozenset(
    """ad ads advert advertisement advertising breadcrumb breadcrumbs comment comments consent
    cookie cookies disqus footer gdpr login navbar navigation newsletter popup promo promoted
    sidebar signup sponsored subscribe toolbar""".split()
)
DOUBTFUL_NAMES = frozenset(
    "banner menu modal nav notice notification related share sharing skip social sponsor widget".split()
)
RUNNING = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())

_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class _Line:
    text: str
    linked: int  # characters in links
    article: bool
    running: bool
    block: int | None  # the outermost doubtful block around it


@dataclass
class _Open:
    tag: str
    stripped: bool
    article: bool
    block: int | None


class _Lines(HTMLParser):
    """Collects the page's lines; stripped ones are empty."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.lines: list[_Line] = []
        self.links = self.blocks = 0
        self._parts: list[str] = []
        self._linked = 0
        self._stripped = False  # whether the line holds text that is stripped

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        elif tag in SPACED:
            self._parts.append(" ")
        if tag in VOID:
            return
        around = self.open[-1] if self.open else _Open("", False, False, None)
        strips, doubtful = self._judged(tag, dict(attrs), around.article)
        stripped, block = around.stripped or strips, around.block
        if doubtful and not around.article:
            stripped = True
        elif doubtful and block is None:
            block, self.blocks = self.blocks, self.blocks + 1
        article = around.article or (tag in ("article", "main") and not stripped)
        self.open.append(_Open(tag, stripped, article, block))
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        elif tag in SPACED:
            self._parts.append(" ")
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag), None)
        if at is not None:
            self.links -= sum(one.tag == "a" for one in self.open[at:])
            del self.open[at:]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].stripped:
            self._stripped = self._stripped or not data.isspace()
            return
        self._parts.append(data)
        if self.links:
            self._linked += len(data)

    def end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text or self._stripped:
            around = self.open[-1] if self.open else _Open("", False, False, None)
            running = any(one.tag in RUNNING for one in self.open)
            self.lines.append(_Line(text, self._linked, around.article, running, around.block))
        self._parts, self._linked, self._stripped = [], 0, False

    @staticmethod
    def _judged(tag: str, attrs: dict[str, str | None], article: bool) -> tuple[bool, bool]:
        """Whether an element is stripped for sure, and whether only perhaps."""
        if tag in STRIPPED or "hidden" in attrs or (tag == "header" and not article):
            return True, False
        if tag in ("html", "body", "article", "main") and "comment" not in str(attrs.get("class")):
            return False, False
        if (attrs.get("role") or "").lower() in STRIPPED_ROLES:
            return True, False
        names = _NAME.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
        return not STRIPPED_NAMES.isdisjoint(names), not DOUBTFUL_NAMES.isdisjoint(names)


def main_text(
    html: str | None,
    window_lines: int = WINDOW_LINES,
    surge_chars: int = SURGE_CHARS,
) -> str:
    reader = _Lines()
    reader.feed(html or "")
    reader.close()
    reader.end_line()
    lines = reader.lines
    for block in range(reader.blocks):
        own = [line for line in lines if line.block == block]
        chars, linked = sum(len(line.text) for line in own), sum(line.linked for line in own)
        if chars - linked < surge_chars or linked > LINK_SHARE * chars:
            for line in own:
                line.text = ""
    marked = any(line.text and line.article for line in lines)
    texts = [line.text if line.article or not marked else "" for line in lines]
    counts = [_counted(text, line, surge_chars) for text, line in zip(texts, lines, strict=True)]
    passages = _passages(counts, window_lines, surge_chars)
    return "\n\n".join(text for start, end in passages for text in texts[start:end] if text)


def _counted(text: str, line: _Line, surge_chars: int) -> int:
    """What a line adds to the sums: its length, and more if it is marked as running text."""
    if not text or (not line.article and line.linked > LINK_SHARE * len(text)):
        return 0
    return len(text) + (surge_chars if line.article or line.running else 0)


def _passages(counts: list[int], window_lines: int, surge_chars: int) -> list[tuple[int, int]]:
    """The stretches between dive points in which a window surges.

    If no window reaches the threshold, the fullest window is the surge.
    """
    sums = [sum(counts[i : i + window_lines]) for i in range(len(counts))]
    surge = min(surge_chars, max(sums, default=0) - 1)
    passages, at = [], 0
    while at < len(sums):
        if counts[at]:
            end = at
            while end < len(sums) and sums[end]:
                end += 1
            if max(sums[at:end]) > surge:
                passages.append((at, end))
            at = end
        at += 1
    return passages


def text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return extract(html)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows with ``text`` and ``n_chars`` in place of the HTML."""
    found = pages.select(F.struct("*").alias("row"), text_column(F.col(html)).alias("text"))
    return found.select(
        *(F.col("row").getField(c).alias(c) for c in others(pages.columns, html, "text", "n_chars")),
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
    )
