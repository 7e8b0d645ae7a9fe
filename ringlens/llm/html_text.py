"""Visible text of web pages, laid out as a browser would space it.

A tree is built from the tags with the end tags and rows that authors leave
out. A walk over it applies the visibility rules and lays out what is left:
blocks on lines of their own, blank lines around paragraphs, marked and
indented list items, aligned table columns, and kept white space in ``pre``.
Neither step recurses, and open tags are found by their places, so the time
does not depend on the depth of nesting. What does is the layout of lists and
quotes: each line carries the indents of all that are open around it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_SHOWN = frozenset(
    "head title meta link style script template noscript datalist iframe object audio video canvas noframes rp area base param source track".split()
)
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset menu".split())
BLOCK = MARGIN | frozenset(
    "address article aside body center dd details dialog div dt figcaption footer form header hgroup html legend li main nav "
    "section summary caption thead tbody tfoot tr td th hr optgroup".split()
)
ENDS_PARAGRAPH = BLOCK - frozenset("html body thead tbody tfoot tr td th caption optgroup".split())
HEAD_PARTS = frozenset("html head title meta link style script template noscript base".split())
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: An open element that a start tag ends, and where the search for it stops.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"tr", "table"}),
    "th": (CELLS, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": (SECTIONS | {"tr", "caption"}, {"table"}),
    "tbody": (SECTIONS | {"tr", "caption"}, {"table"}),
    "tfoot": (SECTIONS | {"tr", "caption"}, {"table"}),
}
TABLE_PARTS = CELLS | SECTIONS | {"table", "tr", "caption"}
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u span mark sub sup label".split())

SPACES = re.compile(r"[ \t\n\r\f]+")
COMMENT = re.compile(r"(?s)/\*.*?(?:\*/|$)")
#: Braces and semicolons outside of strings.
MARKS = re.compile(r"""(?s)"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[{};]""")
DISPLAY = re.compile(r"(?:^|[;{\s])display\s*:\s*([\w-]+)[^;!]*(!\s*important)?", re.IGNORECASE)
#: What media queries are asked about, in pixels.
SCREEN = {"width": 1280, "height": 800, "device-width": 1280, "device-height": 800}
MEDIA_TYPE = re.compile(r"\s*(?:(not|only)\s+)?([a-z]+)?")
MEDIA_FEATURE = re.compile(r"\(([^()]*)\)")
MEDIA_SIZE = re.compile(r"\s*(min|max)-(width|height|device-width|device-height)\s*:\s*([0-9.]+)(px|em|rem)?\s*")
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
SIMPLE_SELECTOR = re.compile(r"[a-z0-9]*(?:[.#][\w-]+)?", re.IGNORECASE)
#: Cells up to this width are padded to their column; longer ones are whole but not padded to, lest one cell widen all rows.
PADDED = 48
GAP = "  "


@dataclass
class Element:
    tag: str
    attributes: dict[str, str]
    children: list[Element | str] = field(default_factory=list)


class TreeBuilder(HTMLParser):
    """Elements of a page, with implied end tags; wrong nesting never loses text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        #: Open elements; None where formatting ended while a block inside it went on.
        self.stack: list[Element | None] = [self.root]
        #: Places in the stack by tag; those of all blocks once more.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.styles: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            self.end_nearest("head", frozenset())
            return
        if tag not in HEAD_PARTS:
            self.end_nearest("head", frozenset())
        if tag in ENDS_PARAGRAPH:
            self.end_nearest("p", TABLE_PARTS | {"button"})
        if tag in IMPLIED_ENDS:
            ended, bounds = IMPLIED_ENDS[tag]
            self.end_open(ended, bounds)
        element = Element(tag, {name: value or "" for name, value in attrs})
        self.stack[-1].children.append(element)
        if tag not in VOID:
            self.places[tag].append(len(self.stack))
            if tag in BLOCK:
                self.blocks.append(len(self.stack))
            self.stack.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.stack[-1].children.append(Element("br", {}))
            return
        if tag in FORMATTING:
            self.unformat(tag)
        else:
            self.end_nearest(tag, frozenset() if tag in TABLE_PARTS else CELLS | {"table"})

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "style":
            self.styles.append(data)
        elif self.stack[-1].tag == "head" and data.strip():
            self.end_from(len(self.stack) - 1)
        self.stack[-1].children.append(data)

    def nearest(self, tags: frozenset[str] | set[str]) -> int:
        """Place of the innermost open one of ``tags``; 0, where the root is, if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places[tag]), default=0)

    def end_from(self, place: int) -> None:
        """Ends the element at a place and all inside it."""
        while len(self.stack) > place or self.stack[-1] is None:
            element = self.stack.pop()
            if element is not None:
                self.places[element.tag].pop()
                if element.tag in BLOCK:
                    self.blocks.pop()

    def end_nearest(self, tag: str, bounds: frozenset[str] | set[str]) -> None:
        """Ends the innermost open ``tag`` and all inside it, unless a bound lies in between."""
        place = self.nearest({tag})
        if place and place >= self.nearest(bounds):
            self.end_from(place)

    def end_open(self, tags: set[str] | frozenset[str], bounds: set[str]) -> None:
        """Ends the outermost of ``tags`` above the nearest bound, and all inside it."""
        bound = self.nearest(bounds)
        above = [(self.places[tag], bisect_right(self.places[tag], bound)) for tag in tags]
        outermost = min((places[i] for places, i in above if i < len(places)), default=None)
        if outermost is not None:
            self.end_from(outermost)

    def unformat(self, tag: str) -> None:
        """Ends formatting but leaves the blocks that were opened inside it."""
        place = self.nearest({tag})
        if not place or place < self.nearest(CELLS | {"table"}):
            return
        if self.blocks and self.blocks[-1] > place:
            self.stack[place] = None
            self.places[tag].pop()
        else:
            self.end_from(place)


class Flow:
    """Lines of one block context, with collapsed margins and pending list markers."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.margin = 0
        self.indents: list[str] = []
        self.marker: str | None = None

    def text(self, data: str) -> None:
        words = SPACES.split(data)
        if len(words) > 1 and not words[0]:
            self.space = True
        inner = " ".join(word for word in words if word)
        if inner:
            if self.space and self.parts:
                self.parts.append(" ")
            self.parts.append(inner)
            self.space = len(words) > 1 and not words[-1]

    def kept(self, data: str) -> None:
        """Text whose white space is kept."""
        first, *others = data.split("\n")
        self.parts.append(first)
        for line in others:
            self.end_line(empty=True)
            self.parts.append(line)

    def end_line(self, empty: bool = False) -> None:
        line = "".join(self.parts)
        self.parts, self.space = [], False
        if not line and not empty:
            return
        if self.margin and self.lines:
            self.lines.append("")
        self.margin = 0
        indents = self.indents
        if self.marker is not None and line:
            indents, self.marker = [*self.indents[:-1], self.marker], None
        self.lines.append(("".join(indents) + line) if line else "")

    def edge(self, margin: bool) -> None:
        self.end_line()
        self.margin = max(self.margin, int(margin))

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


@dataclass
class Table:
    rows: list[list[list[str]]] = field(default_factory=list)
    before: list[str] = field(default_factory=list)

    def add(self, lines: list[str], span: int) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append(lines)
        self.rows[-1].extend([[] for _ in range(span - 1)])

    def render(self) -> list[str]:
        """Each row as lines of cells, padded to the widest cell of the column that is not overlong."""
        widths: dict[int, int] = {}
        for row in self.rows:
            for i, cell in enumerate(row):
                wide = max((len(line) for line in cell if len(line) <= PADDED), default=0)
                widths[i] = max(widths.get(i, 0), wide)
        out = list(self.before)
        for row in self.rows:
            for level in range(max((len(cell) for cell in row), default=0)):
                cells = [cell[level] if level < len(cell) else "" for cell in row]
                out.append(GAP.join(cell.ljust(widths[i]) for i, cell in enumerate(cells)).rstrip())
        return out


def applies(prelude: str) -> bool | None:
    """Whether a nested at-rule holds on a wide screen; None if it holds no rules of elements."""
    name, _, condition = prelude[1:].partition(" ") if " " in prelude else (prelude[1:].partition("(")[0], "", prelude[1:].partition("(")[2])
    name = name.lower()
    if name == "media":
        return any(media_matches(query) for query in condition.lower().split(","))
    # What a browser supports or a container measures is not known; rules there count as those for most readers do.
    return True if name in ("supports", "layer") else None


def media_matches(query: str) -> bool:
    """One media query on a screen of ``SCREEN`` pixels; an unknown feature does not match."""
    said = MEDIA_TYPE.match(query)
    negated, kind = said.group(1) == "not", said.group(2) or "all"
    holds = kind in ("all", "screen") and all(feature_matches(f) for f in MEDIA_FEATURE.findall(query))
    return holds != negated


def feature_matches(feature: str) -> bool:
    said = MEDIA_SIZE.fullmatch(feature)
    if not said:
        return feature.replace(" ", "") in ("orientation:landscape", "hover:hover", "pointer:fine", "color", "hover", "scripting:none")
    bound, axis, number, unit = said.groups()
    size, limit = SCREEN[axis], float(number) * (16 if unit in ("em", "rem") else 1)
    return size <= limit if bound == "max" else size >= limit


def shown_rules(style: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on a wide screen, in their order."""
    style = COMMENT.sub(" ", style).replace("<!--", " ").replace("-->", " ")
    # Per open block whether its rules hold; a rule inside a rule is passed over.
    open_blocks: list[bool] = []
    prelude, start, body = "", 0, None
    for mark in MARKS.finditer(style):
        sign, before = mark.group(), style[start : mark.start()].strip()
        if sign == "{":
            if body is not None:
                open_blocks.append(False)
            elif before.startswith("@"):
                open_blocks.append(bool(applies(before)) and all(open_blocks))
            else:
                body, prelude = len(open_blocks), before
            start = mark.end()
        elif sign == "}":
            if body is not None and body == len(open_blocks):
                if all(open_blocks):
                    yield prelude, before
                body = None
            elif open_blocks:
                open_blocks.pop()
            start = mark.end()
        elif sign == ";" and body is None:
            start = mark.end()
    if body is not None and body == len(open_blocks) and all(open_blocks):
        yield prelude, style[start:].strip()


def hiding_selectors(styles: list[str]) -> dict[str, tuple[bool, bool, int]]:
    """Per selector of one element name, class or id its last display: (important, hidden, place in the sheets).

    Print and narrow-screen blocks do not count. Of the displays of one
    selector the last important one wins, or else the last one.
    """
    found: dict[str, tuple[bool, bool, int]] = {}
    place = 0
    for style in styles:
        for selectors, body in shown_rules(style):
            displays = DISPLAY.findall(body)
            if not displays:
                continue
            important = [d for d in displays if d[1]]
            value, urgent = (important or displays)[-1]
            for selector in (s.strip() for s in selectors.split(",")):
                if not selector or not SIMPLE_SELECTOR.fullmatch(selector):
                    continue
                place += 1
                if urgent or not found.get(selector, (False,))[0]:
                    found[selector] = (bool(urgent), value.lower() == "none", place)
    return found if any(hidden for _, hidden, _ in found.values()) else {}


def is_hidden(tag: str, attributes: dict[str, str], rules: dict[str, tuple[bool, bool, int]]) -> bool:
    """By the winner among the matching rules: the important, then the more specific, then the later one."""
    best, hidden = None, False
    named = [(f".{name}", 10) for name in attributes.get("class", "").split()]
    if attributes.get("id"):
        named.append((f"#{attributes['id']}", 100))
    for selector, weight in [(tag, 1), *named, *((tag + name, weight + 1) for name, weight in named)]:
        if selector in rules:
            important, none, place = rules[selector]
            if best is None or (important, weight, place) > best:
                best, hidden = (important, weight, place), none
    inline = DISPLAY.findall(attributes.get("style", ""))
    if inline and (best is None or not best[0] or any(urgent for _, urgent in inline)):
        hidden = ([d for d in inline if d[1]] or inline)[-1][0].lower() == "none"
    return hidden


def is_removed(element: Element, hidden: dict[str, tuple[bool, bool, int]]) -> bool:
    """Neither the element nor anything inside it is displayed."""
    tag, attributes = element.tag, element.attributes
    if tag in NEVER_SHOWN or "hidden" in attributes or (tag == "dialog" and "open" not in attributes):
        return True
    return tag == "input" or is_hidden(tag, attributes, hidden)


def span_of(element: Element) -> int:
    value = element.attributes.get("colspan", "")
    return min(int(value), 1000) if value.isascii() and value.isdigit() and int(value) else 1


class Renderer:
    """Lays out a tree; contexts of nested tables and cells are stacked."""

    def __init__(self, hidden: dict[str, tuple[bool, bool, int]]) -> None:
        self.hidden = hidden
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.lists: list[list] = []

    def run(self, root: Element) -> str:
        # Entries: (element, text or what closes an element; whether it is visible; whether white space is kept)
        work: list[tuple] = [(root, True, False)]
        while work:
            item, visible, kept = work.pop()
            if callable(item):
                item()
            elif isinstance(item, str):
                if visible:
                    (self.flows[-1].kept if kept else self.flows[-1].text)(item)
            elif not is_removed(item, self.hidden):
                said = VISIBILITY.search(item.attributes.get("style", ""))
                shown = said.group(1).lower() == "visible" if said else visible
                keeps = kept or item.tag in ("pre", "textarea", "listing", "xmp")
                leave = self.enter(item)
                if leave:
                    work.append((leave, shown, keeps))
                children = item.children
                if item.tag == "details" and "open" not in item.attributes:
                    children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
                work.extend((child, shown, keeps) for child in reversed(children))
        return "\n".join(self.flows[0].result())

    def enter(self, element: Element):
        """Opens the layout of an element and gives what closes it."""
        tag, flow = element.tag, self.flows[-1]
        if tag == "br":
            flow.end_line(empty=True)
            return None
        if tag == "hr":
            flow.edge(True)
            return None
        if tag == "table":
            flow.edge(True)
            self.tables.append(Table())
            self.flows.append(Flow())
            return self.leave_table
        if tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
            return None
        if tag in CELLS and self.tables:
            self.flows.append(Flow())
            return lambda: self.tables[-1].add(self.flows.pop().result(), span_of(element))
        if tag in ("ul", "ol", "menu"):
            start = element.attributes.get("start", "")
            self.lists.append([tag, int(start) if start.isascii() and start.isdigit() else 1])
            flow.edge(len(self.lists) == 1)
            return lambda: (self.lists.pop(), flow.edge(not self.lists))
        if tag == "li":
            flow.edge(False)
            marker = "- "
            if self.lists and self.lists[-1][0] == "ol":
                marker = f"{self.lists[-1][1]}. "
                self.lists[-1][1] += 1
            flow.indents.append(" " * len(marker))
            flow.marker = marker
            return lambda: self.leave_item(flow)
        if tag in ("dd", "blockquote"):
            flow.edge(tag in MARGIN)
            flow.indents.append("    ")
            return lambda: (flow.edge(tag in MARGIN), flow.indents.pop())
        if tag in BLOCK:
            flow.edge(tag in MARGIN)
            return lambda: flow.edge(tag in MARGIN)
        if tag in ("option", "img", "button", "select"):
            flow.text(" ")
            return lambda: flow.text(" ")
        return None

    @staticmethod
    def leave_item(flow: Flow) -> None:
        flow.edge(False)
        flow.indents.pop()
        flow.marker = None

    def leave_table(self) -> None:
        """Text beside the cells, such as a caption, comes before the rows."""
        beside, table = self.flows.pop().result(), self.tables.pop()
        table.before = beside
        flow = self.flows[-1]
        for line in table.render():
            flow.parts.append(line)
            flow.end_line(empty=True)
        flow.edge(True)


def visible_text(html: str | None) -> str:
    """The visible text of a page; null and empty pages have none."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return Renderer(hiding_selectors(builder.styles)).run(builder.root)


def extract_text(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """One row per page: its id and ``text``.

    A null or empty page gives an empty text. Repeated rows and null ids give
    rows like others; other columns are not read. Pages are rendered one at a
    time, whole, so memory follows the largest page.
    """

    @F.arrow_udf("string")
    def rendered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for htmls in batches:
            yield pa.array([visible_text(html) for html in htmls.to_pylist()], pa.string())

    plain = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{html_column}`").alias("html"))
    return plain.select(F.col("id").alias(id_column), rendered("html").alias("text"))
