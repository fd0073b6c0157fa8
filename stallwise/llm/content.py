"""The main text of web pages by tag-path ratios.

A page becomes its blocks: runs of text between block tags, each under the path of block tags from the root. Blocks of
one path share a role, so the length of text, the punctuation and the linked text are added up per path and divided by
the path's blocks. Each ratio is smoothed towards what stands around the path: the subtree of its parent and of its
grandparent count a half and a quarter. The smoothed ratios, set against the page's own means, are fused as evidence for
and against content (odds multiply), together with what the path's tags and class names say. Paths at even odds or above
are content, and their blocks are the text, in page order. Pages are independent: each is read in one pass, in its row.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stallwise.llm import words

# Tags by their role in HTML.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Inside these nothing is text of the article.
SILENT = frozenset(
    "aside audio button canvas dialog datalist footer head iframe label map math menu meter nav noembed noframes noscript object "
    "optgroup option progress script search select style svg template textarea title video".split()
)
# An open element of the first kind ends where one of the second begins, unless one of the third stands between.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead"}, {"table"}),
}
ENDS_P = BLOCK - {"body", "caption", "colgroup", "dd", "dt", "head", "html", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
ENDS_P |= {"hr", "li", "dd", "dt"}
P_STOPS = frozenset("table td th caption button object html".split())
# Words of class names and ids that name what is not the article.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo promoted promotion "
    "recommended related reply replies respond share sharing sidebar sidenav signup skip social sponsor sponsored subscribe teaser toolbar topbar "
    "widget header alert notification paywall reactions discussion complementary contentinfo".split()
)
PUNCTUATION = re.compile("[.,;:!?…،؛؟।。、，．！？：；]")

ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)("|\Z)|'([^']*)('|\Z)|([^\s>]*)))?|=)?""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORD = re.compile(r"[A-Za-z]+")
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
COMMENT_END = re.compile("--!?>")
OF_OTHERS = re.compile(r"(?:has|no|with|without|is|not)[-_]", re.IGNORECASE)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

# What a path's tags and names say of it.
NOTHING, MAIN, SIDE, HEAD = range(4)
# The odds that go with it where some of the page is marked as the article, and the weights of smoothing.
LANDMARK, ELSEWHERE = 60.0, 1 / 60
# The odds of a heading where nothing is marked: it is short by nature and stands for what follows.
HEADED = 4.0
SMOOTH = (1.0, 0.5, 0.25)
# A side name says nothing on an element that holds so much of the page's text.
MOST = 0.9


class Page:
    """The blocks of one page (path, text, linked signs), and its paths as a tree in which a path follows the one above."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.above, self.mark, self.silent, self.heading, self.outer = [-1], [NOTHING], [False], [False], [True]
        self.known: dict[tuple, int] = {}
        # Open elements: tag, path, and where on the stack the paragraph is that a block here would end (-1: none).
        self.stack: list[tuple[str, int, int]] = []
        self.open: Counter[str] = Counter()
        self.blocks: list[tuple[int, str, int]] = []
        self.held: list[str] = []
        self.place = self.linked = self.link = 0
        self.articles: Counter[int] = Counter()  # by path
        self.read()

    def at(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def end_block(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                self.blocks.append((self.place, text, min(self.linked, len(text))))
            self.held, self.linked = [], 0

    def text(self, piece: str) -> None:
        if not self.silent[self.at()]:
            if not self.held:
                if piece.isspace():
                    return
                self.place = self.at()
            self.held.append(html.unescape(piece) if "&" in piece else piece)
            self.linked += len(piece) * self.link

    def push(self, tag: str, named: dict[str, str]) -> None:
        up, outer = self.at(), tag in ("html", "body")
        names = [] if outer or tag in HEADINGS else names_of(named)
        side = tag == "form" or not SIDE_WORDS.isdisjoint(names) and tag != "main"
        # A paragraph's names tell nothing of its role but that it is side matter.
        names = names if tag != "p" or side else []
        main = tag == "main" or not side and (tag == "article" or named.get("role") in ("main", "article"))
        mark = MAIN if main else HEAD if tag == "header" or names == ["header"] else SIDE if side else NOTHING
        hidden = "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "")
        silent = self.silent[up] or hidden or tag in SILENT
        key = (up, tag, *names, silent)
        path = self.known.get(key)
        if path is None:
            path = self.known[key] = len(self.above)
            for column, value in ((self.above, up), (self.mark, mark), (self.silent, silent), (self.heading, tag in HEADINGS), (self.outer, outer)):
                column.append(value)
        self.articles[path] += mark == MAIN
        around = self.stack[-1][2] if self.stack else -1
        self.stack.append((tag, path, len(self.stack) if tag == "p" else -1 if tag in P_STOPS else around))
        self.open[tag] += 1

    def pop(self) -> None:
        self.open[self.stack.pop()[0]] -= 1

    def end_paragraph(self) -> None:
        at = self.stack[-1][2] if self.stack else -1
        while 0 <= at < len(self.stack):
            self.pop()

    def close(self, tags: set[str], stops: set[str] | frozenset[str]) -> None:
        """End the nearest open element of `tags` that no element of `stops` shields."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in stops:
                return

    def start(self, tag: str, named: dict[str, str]) -> None:
        if tag == "br":
            self.text("\n")
        elif tag in BLOCK or tag == "hr":
            self.end_block()
            if tag in ENDS_P:
                self.end_paragraph()
            if tag in ENDED_BY:
                self.close(*ENDED_BY[tag])
            if tag != "hr":
                self.push(tag, named)
        elif tag in SILENT:
            self.push(tag, named)
        elif tag == "a":
            self.link = 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        elif self.open[tag]:
            if tag in BLOCK:
                self.end_block()
                self.link = 0
            if tag == "p":
                self.end_paragraph()
            else:
                self.close({tag}, frozenset())

    def read(self) -> None:
        source, at, end = self.source, 0, len(self.source)
        while at < end:
            mark = source.find("<", at)
            if mark < 0 or mark + 1 >= end:
                self.text(source[at:])
                break
            sign = source[mark + 1]
            name = NAME.match(source, mark + 1 + (sign == "/"))
            if not name and sign not in "!/?" or source.startswith("</", mark) and not name and mark + 2 >= end:
                self.text(source[at : mark + 1])
                at = mark + 1
                continue
            if mark > at:
                self.text(source[at:mark])
            if not name:
                at = self.skip(mark)
                continue
            tag, at, named = name[0].lower(), name.end(), {}
            while at < end and source[at] != ">":
                found = ATTRIBUTE.match(source, at)
                if found.end() == at:
                    at += 1
                    continue
                at = found.end()
                if found[1]:
                    named.setdefault(found[1].lower(), found[2] or found[4] or found[6] or "")
            if at >= end:
                break  # a tag that never ends isn't one
            at += 1
            if sign == "/":
                self.end(tag)
                continue
            if tag in RAW:
                found = RAW_ENDS[tag].search(source, at)
                at = found.start() if found else end
                close = source.find(">", at)
                at = close + 1 if close >= 0 else end
                continue
            self.start(tag, named)
        self.end_block()

    def skip(self, mark: int) -> int:
        """The place behind a comment or declaration."""
        source = self.source
        if source.startswith("<!--", mark):
            if source.startswith((">", "->"), mark + 4):
                return source.index(">", mark) + 1
            found = COMMENT_END.search(source, mark + 4)
            return found.end() if found else len(source)
        found = source.find(">", mark)
        return found + 1 if found >= 0 else len(source)


def names_of(named: dict[str, str]) -> list[str]:
    """The words of an element's class names, id and role; names such as `has-sidebar` tell of others and are left out."""
    own = " ".join(named.get(key, "") for key in ("class", "id", "role")).split()
    return [w.lower() for x in own if not OF_OTHERS.match(x) for w in WORD.findall(HUMP.sub(" ", x))]


def subtrees(page: Page, values: list[float]) -> list[float]:
    """The sums over each path and all below it."""
    sums = list(values)
    for path in range(len(sums) - 1, 0, -1):
        sums[page.above[path]] += sums[path]
    return sums


def roles(page: Page) -> list[int]:
    """What each path is: the outermost side matter decides, then the article.

    A side name says nothing on an element that holds all articles of the page, or, where there is none, nearly all text.
    Of an article's own header only the headings belong to it.
    """
    n = len(page.above)
    articles = subtrees(page, [float(page.articles[path]) for path in range(n)])
    sizes = [0.0] * n
    for path, text, _ in page.blocks:
        sizes[path] += len(text)
    sizes = subtrees(page, sizes)
    out = [NOTHING] * n
    for path in range(1, n):
        up, mark = out[page.above[path]], page.mark[path]
        holds_all = articles[path] == articles[0] if articles[0] else sizes[path] >= MOST * sizes[0]
        if up == SIDE or mark in (SIDE, HEAD) and not holds_all and up != MAIN or mark == SIDE and up == MAIN:
            out[path] = SIDE
        elif mark == HEAD and up == MAIN:
            out[path] = HEAD
        else:
            out[path] = MAIN if mark == MAIN or up == HEAD and page.heading[path] else up
    return out


def odds(page: Page) -> list[float]:
    """The odds of each path that its blocks are content."""
    n, role = len(page.above), roles(page)
    blocks, chars, marks, linked = ([0.0] * n for _ in range(4))
    for path, text, own in page.blocks:
        if role[path] not in (SIDE, HEAD):
            blocks[path] += 1
            chars[path] += len(text)
            marks[path] += len(PUNCTUATION.findall(text))
            linked[path] += own
    below = [subtrees(page, x) for x in (blocks, chars, marks, linked)]
    # Means over signs of text, so that many short blocks (menus) don't pull them down.
    usual = [sum(c * x / b for c, x, b in zip(chars, y, blocks) if b) / max(below[1][0], 1.0) for y in (chars, marks)]
    landmark = any(role[path] == MAIN and blocks[path] for path in range(n))
    out = [0.0] * n
    for path in range(n):
        if not blocks[path]:
            continue
        weight, up, sums = 0.0, path, [blocks, chars, marks, linked]
        length = punctuation = links = 0.0
        for part in SMOOTH:
            weight += part
            length += part * sums[1][up] / sums[0][up]
            punctuation += part * sums[2][up] / sums[0][up]
            links += part * sums[3][up] / sums[1][up]
            up, sums = page.above[up], below
            if up < 0 or page.outer[up]:
                break
        by_length = min((length / weight + 1) / (0.3 * usual[0] + 1), 10.0)
        by_marks = min(max((punctuation / weight + 0.2) / (0.3 * usual[1] + 0.2), 0.25), 4.0)
        by_links = max(2 * (1.02 - links / weight), 0.05)
        prior = LANDMARK if role[path] == MAIN else ELSEWHERE if landmark else HEADED if page.heading[path] else 1.0
        out[path] = prior * max(by_length, 0.1) * by_marks * by_links
    return out


def main_text(source: str | None) -> str:
    """The content blocks of a page, joined by an empty line; '' where there are none."""
    page = Page(source or "")
    good = odds(page)
    return "\n\n".join(text for path, text, _ in page.blocks if good[path] >= 1.0)


def with_main_text(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """Add `out`, the main text of the page in `source`, to each row (a column of that name is replaced).

    A NULL or empty page has an empty text. Repeated rows stay; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], out])

    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() != out.lower()]
    rows = pages.select(*kept, F.col(f"`{source}`").cast("string").alias(words.free(pages, "_html")))
    return rows.mapInArrow(run, pages.select(*kept).schema.add(out, StringType()))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
