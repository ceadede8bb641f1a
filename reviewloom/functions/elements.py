"""HTML pages as elements: nesting, implied ends and character references.

A page is read once by the standard library's event parser, with a stack of open
elements. An element owns all text up to its end, whatever is nested in it, so two
elements of one name inside each other do not end each other. ``page_record`` does
this for many facts in one Arrow batch function; a column asks only for the facts it
needs, and several of them should be asked for together.

Rules of the reading: an element ends with its end tag, with the end of an element
around it, or where HTML implies it (a list item before the next one, a paragraph
before a block); an end tag that nothing opened is ignored; scripts, styles and
comments have no text; a tag separates words unless it only formats them (``FORMATTING``);
white space is collapsed. A null page reads as an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FORMATTING = frozenset("abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time u var wbr".split())
HIDDEN = frozenset(("script", "style", "template", "noscript"))
BLOCKS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: Elements that the start of another one ends, if they are the innermost open ones.
IMPLIED_ENDS = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "tbody": frozenset(("thead", "tbody", "tr", "td", "th")), **dict.fromkeys(BLOCKS, frozenset(("p",))),
}
_SPACES = re.compile(r"[ \t\n\r\f\v]+")


@dataclass
class Element:
    tag: str
    attributes: dict[str, str]
    begin: int  # where its text begins and ends in the page's pieces of text
    end: int = -1
    stop: int = -1  # the first element, in page order, that is no longer inside

    @property
    def marks(self) -> str:
        return self.attributes.get("class", "")


@dataclass
class Page:
    pieces: list[str] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)

    def text(self, at: int | None = None) -> str:
        """Text of an element, or of the whole page."""
        pieces = self.pieces if at is None else self.pieces[self.elements[at].begin : self.elements[at].end]
        return _SPACES.sub(" ", "".join(pieces)).strip(" ")

    def marked(self, marker: str, within: int | None = None) -> Iterator[int]:
        """Elements, in page order, whose class or test id holds a marker; also only those inside another element."""
        for at in range(0, len(self.elements)) if within is None else range(within + 1, self.elements[within].stop):
            e = self.elements[at]
            if marker in e.marks or marker in e.attributes.get("data-testid", ""):
                yield at

    def first_text(self, markers: Sequence[str], within: int | None = None) -> str:
        """Text of the first element of the first marker that yields any; the first element of a marker speaks for it."""
        for marker in markers:
            at = next(self.marked(marker, within), None)
            if at is not None and (text := self.text(at)):
                return text
        return ""


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page, self.open, self.names, self.hidden = Page(), [], Counter(), 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        page = self.page
        ends = IMPLIED_ENDS.get(tag)
        while ends and self.open and page.elements[self.open[-1]].tag in ends:
            self._close()
        if tag not in FORMATTING:
            page.pieces.append(" ")
        attributes = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        page.elements.append(Element(tag, attributes, len(page.pieces)))
        if tag in VOID:
            page.elements[-1].end, page.elements[-1].stop = len(page.pieces), len(page.elements)
        else:
            self.open.append(len(page.elements) - 1)
            self.names[tag] += 1
            self.hidden += tag in HIDDEN

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if self.names[tag]:
            while self._close() != tag:
                pass
        if tag not in FORMATTING:
            self.page.pieces.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.page.pieces.append(data)

    def handle_comment(self, data: str) -> None:
        self.page.pieces.append(" ")

    def _close(self) -> str:
        element = self.page.elements[self.open.pop()]
        element.end, element.stop = len(self.page.pieces), len(self.page.elements)
        self.names[element.tag] -= 1
        self.hidden -= element.tag in HIDDEN
        return element.tag


def parse_page(html: str | None) -> Page:
    reader = _Reader()
    try:
        reader.feed(html or "")
        reader.close()
    except AssertionError:  # a malformed declaration: what was read before it counts
        pass
    while reader.open:
        reader._close()
    return reader.page


# ---- facts of a page ------------------------------------------------------

_FACTS = {
    "text": "string", "title": "string", "name": "string", "price": "string", "cards": "array<string>",
    "packages": "array<struct<package_number:int,name:string,price:string,description:string>>",
    "links": "array<struct<href:string,text:string>>",
}


@dataclass(frozen=True)
class Markers:
    """Ordered class markers of the facts; the first that yields something wins."""

    name: tuple[str, ...] = ()
    price: tuple[str, ...] = ()
    items: tuple[str, ...] = ()
    item_name: tuple[str, ...] = ()
    item_price: tuple[str, ...] = ()
    item_description: tuple[str, ...] = ()
    cards: tuple[str, ...] = ()


def read_facts(page: Page, markers: Markers, wanted: Sequence[str]) -> dict[str, object]:
    """The wanted facts of one page."""
    out: dict[str, object] = {}
    for fact in wanted:
        if fact == "text":
            out[fact] = page.text()
        elif fact == "title":
            out[fact] = next((page.text(i) for i, e in enumerate(page.elements) if e.tag == "title"), "")
        elif fact in ("name", "price"):
            out[fact] = page.first_text(getattr(markers, fact))
        elif fact == "cards":
            texts = (page.text(i) for i, e in enumerate(page.elements) if any(m in e.marks for m in markers.cards))
            out[fact] = [t for t in texts if t]
        elif fact == "links":
            out[fact] = [{"href": e.attributes["href"], "text": page.text(i)} for i, e in enumerate(page.elements) if e.tag == "a" and "href" in e.attributes]
        elif fact == "packages":
            items = next((found for m in markers.items if (found := list(page.marked(m)))), [])
            out[fact] = [
                {"package_number": n + 1, "name": page.first_text(markers.item_name, i), "price": page.first_text(markers.item_price, i),
                 "description": page.first_text(markers.item_description, i)}
                for n, i in enumerate(items)
            ]
    return out


def page_record(html: Column | str, wanted: Sequence[str], markers: Markers = Markers()) -> Column:
    """Struct of the wanted facts (``text title name price cards packages links``) from one reading of the page."""
    fields = [(f, _FACTS[f]) for f in wanted]
    kind = pa.struct([(f, _arrow(t)) for f, t in fields])

    @F.arrow_udf(", ".join(f"{f} {t}" for f, t in fields))
    def record(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([read_facts(parse_page(html.as_py()), markers, wanted) for html in batch], kind)

    return record(html)


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    if kind.startswith("struct<"):
        return pa.struct([(name, _arrow(of)) for name, of in (x.split(":") for x in kind[7:-1].split(","))])
    return pa.int32() if kind == "int" else pa.string()
