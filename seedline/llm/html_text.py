"""Main text of HTML pages by tag-path ratios.

A page is parsed into blocks of text, each with its tag path from the root; a path ends at an article or main
element, so that all blocks of an article share one. Per path the lengths and the punctuation marks of its blocks
are added up and divided by their number; the two ratios are fused by product, smoothed along the page, and
blocks above a share of the page's mean (weighted by length) are the content. Blocks inside elements that name
themselves as something else (navigation, adverts, notices, forms, comments, ...) take no part. Where a page has
an article or main element with text, the mean is that of its blocks, and blocks outside count little.

Null and empty pages have an empty text. White space inside a block becomes one blank, blocks are joined by a line
end. Markup that is not closed ends with the page. Rows are handled one by one: repeated rows, ties and null ids or
urls come back as they are; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

SHARE = 0.3  # of the mean score that content must reach
OUTSIDE = 0.05  # weight of blocks outside the article of a page that has one

# HTML element and attribute names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
LANDMARKS = frozenset(["article", "main"])
NOT_CONTENT = frozenset(
    "aside button dialog footer form head header iframe menu nav noscript object option script select style svg template textarea title".split()
)
NOT_CONTENT_NAMES = frozenset(
    "ad ads adv advert advertisement advertisements adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply search share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
NOT_CONTENT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
# an element's start ends an open one of the second group
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
}
SCOPES = frozenset("table ul ol dl select td th button body html".split())  # an implied end does not reach past these
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟]")
NAME_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass
class _Open:
    tag: str
    path: tuple[str, ...]
    hidden: bool
    landmark: bool


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    hidden: bool
    landmark: bool
    score: float = field(default=0.0)


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [_Open("", (), False, False)]
        self.pieces: list[str] = []
        self.blocks: list[Block] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            at = self.open[-1]
            self.blocks.append(Block(text, at.path, at.hidden, at.landmark))

    def _leave(self, index: int) -> None:
        """Close the open elements from a place on."""
        if any(o.tag in BLOCKS or o.hidden != self.open[index - 1].hidden for o in self.open[index:]):
            self._end_block()
        del self.open[index:]

    def _imply(self, tags: frozenset[str]) -> None:
        for index in range(len(self.open) - 1, 0, -1):
            if self.open[index].tag in tags:
                self._leave(index)
                return
            if self.open[index].tag in SCOPES:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag in CLOSES:
            self._imply(CLOSES[tag])
        if tag in BLOCKS:
            self._imply(frozenset(["p"]))
        parent = self.open[-1]
        named = {k: (v or "").lower() for k, v in attrs}
        hidden = parent.hidden or self._names_itself(tag, named, parent.landmark)
        if tag in BLOCKS or hidden != parent.hidden:
            self._end_block()
        if tag in VOID:
            return
        landmark = parent.landmark or tag in LANDMARKS or named.get("role") in LANDMARKS or named.get("itemprop") == "articlebody"
        path = parent.path if parent.landmark or tag not in BLOCKS else (*parent.path, "landmark" if landmark else tag)
        self.open.append(_Open(tag, path, hidden, landmark))

    @staticmethod
    def _names_itself(tag: str, named: dict[str, str], inside: bool) -> bool:
        if tag in NOT_CONTENT and not (tag == "header" and inside):
            return True
        if "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", ""):
            return True
        if named.get("role") in NOT_CONTENT_ROLES:
            return True
        if tag in ("html", "body"):
            return False
        names = set(NAME_PARTS.split(named.get("class", "") + " " + named.get("id", "")))
        return not names.isdisjoint(NOT_CONTENT_NAMES) if tag not in LANDMARKS else not names.isdisjoint(("comment", "reply", "ad", "advert"))

    def handle_endtag(self, tag: str) -> None:
        for index in range(len(self.open) - 1, 0, -1):
            if self.open[index].tag == tag:
                self._leave(index)
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)

    def finish(self) -> list[Block]:
        self.close()
        self._end_block()
        return self.blocks


def _smoothed(values: list[float]) -> list[float]:
    """Each value with half of it replaced by its neighbours' mean; an end stands for its missing neighbour."""
    padded = [values[0], *values, values[-1]] if values else []
    return [0.25 * padded[i - 1] + 0.5 * padded[i] + 0.25 * padded[i + 1] for i in range(1, len(padded) - 1)]


def content_blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    blocks = [b for b in parser.finish() if not b.hidden]
    if not blocks:
        return []
    lengths: dict[tuple[str, ...], int] = {}
    marks: dict[tuple[str, ...], int] = {}
    counts: dict[tuple[str, ...], int] = {}
    for b in blocks:
        lengths[b.path] = lengths.get(b.path, 0) + len(b.text)
        marks[b.path] = marks.get(b.path, 0) + len(PUNCTUATION.findall(b.text))
        counts[b.path] = counts.get(b.path, 0) + 1
    has_article = any(b.landmark for b in blocks)
    fused = {p: lengths[p] / counts[p] * (1.0 + marks[p] / counts[p]) for p in counts}
    raw = [fused[b.path] * (1.0 if b.landmark or not has_article else OUTSIDE) for b in blocks]
    for b, score in zip(blocks, _smoothed(raw)):
        b.score = score
    measured = [(len(b.text), r) for b, r in zip(blocks, raw) if b.landmark or not has_article]
    mean = sum(n * r for n, r in measured) / sum(n for n, _ in measured)
    return [b for b in blocks if b.score >= SHARE * mean]


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in content_blocks(html)) if html else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars; one row per page."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return chosen.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
