"""Pages to elements. The only per-row Python in the package: a tag scanner and two walkers over it.

`with_elements` adds two arrays to each page: its text pieces and its elements in document order. An element names its
range of text pieces and its last descendant, so text and containment are plain array expressions, no text is stored
twice, and nothing about a page ever leaves its row: extraction needs no shuffle.

`with_found` gives, in place of all elements, an index by selector of those that the selectors asked for name. Elements
that others are looked for in carry, for each such selector, the range of its matches that stand inside them. So every
look-up is a map access or a slice, and the work on a page is linear in what it holds.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without content, and elements whose text is not part of the page's text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split()
)
SILENT = frozenset("rp rt script style template".split())
PAGES_PER_BATCH = 200
# Places in an element's record.
LAST, TEXT_FROM, TEXT_TO, NEXT, WITHIN, WITHIN_TO = 1, 4, 5, 6, 7, 8
FOUND_DDL = (
    "array<struct<idx:int,last:int,tag:string,attrs:map<string,string>,text_from:int,text_to:int,next_from:int,next_to:int,"
    "within:array<int>,within_to:array<int>>>"
)

ELEMENT_DDL = (
    "struct<idx:int,parent:int,last:int,tag:string,id:string,classes:array<string>,attrs:map<string,string>,"
    "text_from:int,text_to:int>"
)


# Elements whose content is text up to their end tag; of the first kind character references are text too.
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in ("script", "style")}
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*(?:([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?|=)?""")
COMMENT_END = re.compile("--!?>")


class _Scanner:
    """Calls `handle_starttag`, `handle_endtag`, `handle_data` and `handle_comment` along a page, in one pass.

    Tolerant: a sign that opens no markup is text; a tag, comment or quoted value that never ends takes the rest.
    """

    def scan(self, source: str) -> None:
        at, end, find = 0, len(source), source.find
        while at < end:
            mark = find("<", at)
            if mark < 0:
                self.handle_data(unescape(source[at:]) if "&" in source else source[at:])
                return
            if mark > at:
                piece = source[at:mark]
                self.handle_data(unescape(piece) if "&" in piece else piece)
            closing = source.startswith("</", mark)
            name = NAME.match(source, mark + 1 + closing)
            if name is None:
                at = self._other(source, mark, closing)
                continue
            tag, at = name[0].lower(), name.end()
            attrs, last = [], None
            while at < end and source[at] != ">":
                last = ATTRIBUTE.match(source, at)
                at = last.end()
                if last[1]:
                    value = next((v for v in last.group(2, 3, 4) if v is not None), None)
                    attrs.append((last[1].lower(), unescape(value) if value and "&" in value else value))
            if at >= end:
                return
            at += 1
            if closing:
                self.handle_endtag(tag)
            elif source[at - 2] == "/" and not (last and last.end(4) == at - 1):
                self.handle_startendtag(tag, attrs)
            else:
                self.handle_starttag(tag, attrs)
                if tag in RAW_ENDS:
                    found = RAW_ENDS[tag].search(source, at)
                    stop = found.start() if found else end
                    self.handle_data(source[at:stop])
                    at = stop

    def _other(self, source: str, mark: int, closing: bool) -> int:
        """What follows a `<` that opens no tag; gives the place to go on from."""
        if source.startswith("<!--", mark):
            self.handle_comment("")
            if source.startswith((">", "->"), mark + 4):
                return source.index(">", mark) + 1
            found = COMMENT_END.search(source, mark + 4)
            return found.end() if found else len(source)
        if source.startswith("<![CDATA[", mark):
            found = source.find("]]>", mark)
            stop = found if found >= 0 else len(source)
            self.handle_comment("")
            self.handle_data(source[mark + 9 : stop])
            self.handle_comment("")
            return stop + 3
        if closing and mark + 2 < len(source) or source.startswith(("<!", "<?"), mark):
            self.handle_comment("")
            found = source.find(">", mark)
            return found + 1 if found >= 0 else len(source)
        self.handle_data("<")
        return mark + 1


class _Walker(_Scanner):
    """Gathers the texts and elements of many pages as columns, one `read` per page."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.text_ends = [0]
        self.element_ends = [0]
        self.idx: list[int] = []
        self.parent: list[int] = []
        self.last: list[int] = []
        self.tag: list[str] = []
        self.id: list[str | None] = []
        self.classes: list[list[str]] = []
        self.attrs: list[list[tuple[str, str]]] = []
        self.text_from: list[int] = []
        self.text_to: list[int] = []

    def read(self, html: str | None) -> None:
        self.open: list[int] = []
        self.pending: list[str] = []
        self.silent = 0
        self.first, self.first_text = len(self.idx), len(self.texts)
        self.scan(html or "")
        self._end_text()
        while self.open:
            self._close(self.open.pop())
        self.element_ends.append(len(self.idx))
        self.text_ends.append(len(self.texts))

    def _end_text(self) -> None:
        if self.pending:
            piece = "".join(self.pending).strip()
            self.pending.clear()
            if piece and not self.silent:
                self.texts.append(piece)

    def _close(self, at: int) -> None:
        self.silent -= self.tag[at] in SILENT
        self.last[at] = len(self.idx) - 1 - self.first
        self.text_to[at] = len(self.texts) - self.first_text

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        named = {k: v or "" for k, v in attrs}
        at = len(self.idx)
        self.idx.append(at - self.first)
        self.parent.append(self.open[-1] - self.first if self.open else -1)
        self.last.append(at - self.first)
        self.tag.append(tag)
        self.id.append(named.get("id"))
        self.classes.append(named["class"].split() if "class" in named else [])
        self.attrs.append(list(named.items()))
        self.text_from.append(len(self.texts) - self.first_text)
        self.text_to.append(len(self.texts) - self.first_text)
        if tag not in VOID:
            self.open.append(at)
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if any(self.tag[at] == tag for at in self.open):
            while True:
                at = self.open.pop()
                self._close(at)
                if self.tag[at] == tag:
                    return

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def columns(self) -> tuple[pa.Array, pa.Array]:
        """(texts, elements), each one list per page."""
        def whole(values: list[int]) -> pa.Array:
            return pa.array(values, pa.int32())

        attrs = pa.array(self.attrs, pa.map_(pa.string(), pa.string()))
        fields = {
            "idx": whole(self.idx), "parent": whole(self.parent), "last": whole(self.last),
            "tag": pa.array(self.tag, pa.string()), "id": pa.array(self.id, pa.string()),
            "classes": pa.array(self.classes, pa.list_(pa.string())), "attrs": attrs,
            "text_from": whole(self.text_from), "text_to": whole(self.text_to),
        }
        elements = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return (
            pa.ListArray.from_arrays(whole(self.text_ends), pa.array(self.texts, pa.string())),
            pa.ListArray.from_arrays(whole(self.element_ends), elements),
        )


class _Finder(_Scanner):
    """Gathers the texts of many pages, and their elements by selector, as columns."""

    def __init__(self, wanted: list[str], inner: list[str]) -> None:
        self.rules: dict[str, list[tuple[str, str | None, str | None]]] = {}
        for css in wanted:
            selector = Selector(css)
            self.rules.setdefault(selector.tag, []).append((css, selector.attr, selector.value))
        self.inner = inner
        self.texts: list[str] = []
        self.text_ends, self.found_ends = [0], [0]
        self.keys: list[str] = []
        self.key_ends = [0]
        self.hits: list[list] = []

    def read(self, html: str | None) -> None:
        # Open elements: tag, its record if anything asks for it, the record of its last child.
        self.open: list[list] = [["", None, None]]
        self.tags: Counter[str] = Counter()
        self.pending: list[str] = []
        self.silent = self.idx = 0
        self.first_text = len(self.texts)
        self.found: dict[str, list[list]] = {}
        self.scan(html or "")
        self._end_text()
        while len(self.open) > 1:
            self._close()
        for css, hits in self.found.items():
            self.keys.append(css)
            self.hits.extend(hits)
            self.key_ends.append(len(self.hits))
        self.found_ends.append(len(self.keys))
        self.text_ends.append(len(self.texts))

    def _end_text(self) -> None:
        if self.pending:
            piece = "".join(self.pending).strip()
            self.pending.clear()
            if piece and not self.silent:
                self.texts.append(piece)

    def _counts(self) -> list[int]:
        return [len(self.found.get(css, ())) for css in self.inner]

    def _end(self, record: list | None) -> None:
        if record:
            record[TEXT_TO] = len(self.texts) - self.first_text
            record[LAST] = self.idx - 1
            if record[WITHIN] is not None:
                record[WITHIN_TO] = self._counts()

    def _close(self) -> None:
        tag, record, _ = self.open.pop()
        self.tags[tag] -= 1
        self.silent -= tag in SILENT
        self._end(record)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_text()
        named, own = {k: v or "" for k, v in attrs}, []
        if tag in self.rules:
            classes = named.get("class", "").split()
            own = [css for css, attr, value in self.rules[tag] if attr is None or (value in classes if attr == "class" else named.get(attr) == value)]
        record, before = None, self.open[-1][2]
        if own or before:
            at = len(self.texts) - self.first_text
            record = [self.idx, self.idx, tag, list(named.items()), at, at, None, None, None]
        if before:
            before[NEXT] = record
        for css in own:
            self.found.setdefault(css, []).append(record)
        if own:
            record[WITHIN] = record[WITHIN_TO] = self._counts()
        # Only a wanted element is asked for the one after it.
        self.open[-1][2] = record if own else None
        self.idx += 1
        if tag not in VOID:
            self.open.append([tag, record, None])
            self.tags[tag] += 1
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if self.tags[tag]:
            while self.open[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    def columns(self) -> tuple[pa.Array, pa.Array]:
        """(texts, found), one list and one map per page."""
        def whole(values) -> pa.Array:
            return pa.array(values, pa.int32())

        numbers, counts = pa.int32(), pa.list_(pa.int32())
        column = list(zip(*self.hits)) if self.hits else [()] * 9
        after = [(r[TEXT_FROM], r[TEXT_TO]) if r else (None, None) for r in column[NEXT]]
        fields = {
            "idx": whole(column[0]), "last": whole(column[LAST]), "tag": pa.array(column[2], pa.string()),
            "attrs": pa.array(column[3], pa.map_(pa.string(), pa.string())), "text_from": whole(column[TEXT_FROM]),
            "text_to": whole(column[TEXT_TO]), "next_from": pa.array([x for x, _ in after], numbers),
            "next_to": pa.array([x for _, x in after], numbers), "within": pa.array(column[WITHIN], counts),
            "within_to": pa.array(column[WITHIN_TO], counts),
        }
        lists = pa.ListArray.from_arrays(whole(self.key_ends), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
        return (
            pa.ListArray.from_arrays(whole(self.text_ends), pa.array(self.texts, pa.string())),
            pa.MapArray.from_arrays(whole(self.found_ends), pa.array(self.keys, pa.string()), lists),
        )


def walk(pages: Iterable[str | None]) -> tuple[pa.Array, pa.Array]:
    walker = _Walker()
    for html in pages:
        walker.read(html)
    return walker.columns()


def _walk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, PAGES_PER_BATCH):
            batch = whole.slice(start, PAGES_PER_BATCH)
            keep = [n for n in batch.schema.names if n != "html"]
            columns = [batch.column(n) for n in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, *walk(batch.column("html").to_pylist())], names=[*keep, "texts", "elements"]
            )


# Ship the walker itself with each job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_elements(pages: DataFrame) -> DataFrame:
    """Replace `html` by `texts` and `elements`; every other column is kept."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != "html"]
    return pages.mapInArrow(_walk_batches, ", ".join([*kept, "texts array<string>", f"elements array<{ELEMENT_DDL}>"]))


def with_found(pages: DataFrame, wanted: list[str], inner: list[str]) -> DataFrame:
    """Replace `html` by `texts` and `found`: the elements of each selector in `wanted`, in document order.

    `inner` are the selectors of `wanted` that are also looked for inside elements. Every other column is kept.
    """
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES_PER_BATCH):
                batch = whole.slice(start, PAGES_PER_BATCH)
                finder = _Finder(wanted, inner)
                for html in batch.column("html").to_pylist():
                    finder.read(html)
                keep = [n for n in batch.schema.names if n != "html"]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *finder.columns()], names=[*keep, "texts", "found"])

    return pages.mapInArrow(run, ", ".join([*kept, "texts array<string>", f"found map<string,{FOUND_DDL}>"]))


def element_rows(pages: DataFrame) -> DataFrame:
    """One row per element: (page_id, idx, parent, tag, id, classes, attrs, text)."""
    walked = with_elements(pages.select("page_id", "html"))
    rows = walked.select("page_id", "texts", F.explode("elements").alias("e"))
    return rows.select(
        "page_id", "e.idx", "e.parent", "e.tag", "e.id", "e.classes", "e.attrs", text_of(F.col("e")).alias("text")
    )


def text_of(element: Column, texts: Column | None = None) -> Column:
    """An element's text: its stripped pieces, joined without a separator. Empty for a missing element."""
    texts = F.col("texts") if texts is None else texts
    pieces = F.slice(texts, element["text_from"] + 1, element["text_to"] - element["text_from"])
    return F.coalesce(F.array_join(pieces, ""), F.lit(""))


def attribute(element: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(element["attrs"], F.lit(name)), F.lit(""))


class Selector:
    """Elements of one tag, by class, id or other attribute: `span.price`, `span#title`, `div[data-hook=review]`."""

    def __init__(self, css: str) -> None:
        self.attr = self.value = None
        if "[" in css:
            self.tag, rest = css.rstrip("]").split("[", 1)
            self.attr, self.value = rest.split("=", 1)
        elif "#" in css:
            (self.tag, self.value), self.attr = css.split("#", 1), "id"
        elif "." in css:
            (self.tag, self.value), self.attr = css.split(".", 1), "class"
        else:
            self.tag = css


class Found:
    """Look-ups in the `found` column of `with_found(pages, wanted, inner)`."""

    def __init__(self, inner: list[str]) -> None:
        self.place = {css: i for i, css in enumerate(inner)}

    def of(self, css: str, within: Column | None = None) -> Column:
        """Elements of one selector: all of them, or those inside an element."""
        hits = F.coalesce(F.try_element_at("found", F.lit(css)), F.array().cast(FOUND_DDL))
        if within is None:
            return hits
        start, end = (F.get(within[c], F.lit(self.place[css])) for c in ("within", "within_to"))
        return F.slice(hits, start + 1, end - start)

    def all_of(self, *selectors: str, within: Column | None = None) -> Column:
        """Elements of the first selector, then those of the next."""
        found = [self.of(s, within) for s in selectors]
        return found[0] if len(found) == 1 else F.concat(*found)

    def first_nonempty(self, *selectors: str, within: Column | None = None) -> Column:
        """All elements of the first selector that has any."""
        *options, chosen = [self.of(s, within) for s in selectors]
        for option in reversed(options):
            chosen = F.when(F.size(option) > 0, option).otherwise(chosen)
        return chosen

    def first_of(self, *selectors: str, within: Column | None = None) -> Column:
        """The first element of the first selector that has any, else NULL."""
        return F.coalesce(*[F.get(self.of(s, within), F.lit(0)) for s in selectors])


def next_text(element: Column) -> Column:
    """The text of the element after this one, under the same parent; NULL where there is none."""
    pieces = F.slice(F.col("texts"), element["next_from"] + 1, element["next_to"] - element["next_from"])
    return F.array_join(pieces, "")
