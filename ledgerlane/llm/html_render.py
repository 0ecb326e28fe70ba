"""Visible text of HTML, laid out: a tree with implied tags, visibility rules, blocks, lists, tables.

The tree builder closes what a start tag implies is over (paragraphs, list items, rows, cells,
options), opens rows around stray cells, and ignores end tags that match nothing. Hidden are head
matter, scripts, styles, templates, closed details, dialogs that are not open, elements with
``hidden``, and what the page's style sheets and own styles hide on a screen (``page_styles``):
``display:none`` with all inside, ``visibility`` inherited and undone further in. What a browser shows
only if it cannot show better (inside video, audio, canvas, frames, an object with data) is hidden.
Texts of drawings and formulas are shown, but for their titles, descriptions and annotations. Blocks
start new lines; paragraphs, headings, lists and tables stand between blank lines; list items are
marked and indented; cells of a table are padded to the width of their column, and cells that span
rows keep their columns in the rows below. Everything is iterative, so depth is no limit.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlane.llm.common import text_slices
from ledgerlane.llm.page_styles import Place, Styles

WIDEST = 40  # cells up to this width set the width of their column; longer ones run over
ALIGNED = 1000  # columns of a table that are aligned; cells beyond follow one another

# Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title meta link base iframe noembed noframes audio video canvas datalist".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
select summary table ul tr caption""".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul""".split())
LISTS = frozenset("ul ol menu dir".split())
GROUPS = frozenset("thead tbody tfoot".split())
# Drawings and formulas: what they never show, what shows text, what ends them, where that may stand inside.
FOREIGN = frozenset("svg math".split())
FOREIGN_UNSEEN = frozenset("title desc metadata defs symbol clippath mask annotation annotation-xml".split())
DRAWN_TEXT = frozenset("text foreignobject".split())
ENDS_FOREIGN = CLOSES_P | frozenset("b big br code em embed i img s small span strike strong sub sup tt u".split())
HOLDS_HTML = frozenset("foreignobject mtext mi mo mn ms desc title annotation-xml".split())
SET_APART = frozenset("text mtr mtd".split())
# What a start tag ends, if open, and the elements beyond which it does not look.
IMPLIED_END = {
    "li": (frozenset({"li"}), LISTS | {"table", "td", "th"}),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "td", "th"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table", "td", "th"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "td": (frozenset({"td", "th", "caption"}), frozenset({"table"})),
    "th": (frozenset({"td", "th", "caption"}), frozenset({"table"})),
    "tr": (frozenset({"tr", "td", "th", "caption"}), frozenset({"table"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
}
IMPLIED_END["tbody"] = IMPLIED_END["tfoot"] = IMPLIED_END["colgroup"] = IMPLIED_END["thead"]

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.S)
_CUT_OFF = re.compile(r"<[a-zA-Z/]")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(page: str) -> Node:
    """The tree of a page; texts are str children."""
    root = Node("html", {})
    stack = [root]
    opened: Counter[str] = Counter()  # elements on the stack by name

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)
        opened[node.tag] += 1

    def cut(depth: int) -> None:
        opened.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    def close(names: frozenset[str], fence: frozenset[str]) -> None:
        """Close the outermost of these elements on this side of the fence."""
        left = sum(opened[name] for name in names)
        outermost = 0
        for depth in range(len(stack) - 1, 0, -1):
            if not left or stack[depth].tag in fence:
                break
            if stack[depth].tag in names:
                outermost, left = depth, left - 1
        if outermost:
            cut(outermost)

    def in_row() -> bool:
        inner = next((node.tag for node in reversed(stack) if node.tag in ("tr", "table")), None)
        return inner == "tr"

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(html.unescape(piece) if "&" in piece else piece)

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            rest = page[at:]
            over = _CUT_OFF.search(rest)  # a tag that never ends is none
            text(rest[:over.start()] if over else rest)
            break
        text(page[at:found.start()])
        at = found.end()
        end_tag, start_tag = found.group(1), found.group(2)
        if end_tag:
            tag = end_tag.lower()
            if tag == "p" and not opened["p"]:
                stack[-1].children.append(Node("p", {}))
            elif opened[tag]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        cut(depth)
                        break
                    if stack[depth].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                        break
        elif start_tag:
            tag = start_tag.lower()
            raw = found.group(3)
            attributes = {
                m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)
            } if raw else {}
            if tag in ("html", "body"):
                (root if tag == "html" else stack[0]).attributes |= attributes
                close(frozenset({"head"}), frozenset())
                continue
            if stack[-1].tag == "head" and tag not in UNSEEN | {"noscript"}:
                cut(len(stack) - 1)
            foreign = opened["svg"] or opened["math"]
            if foreign and tag in ENDS_FOREIGN:
                close(FOREIGN, HOLDS_HTML)
            if tag in CLOSES_P:
                close(frozenset({"p"}), frozenset({"button", "table", "td", "th", "caption"}))
            if tag in IMPLIED_END:
                close(*IMPLIED_END[tag])
            if tag in ("td", "th") and not (opened["tr"] and in_row()):
                push(Node("tr", {}))
            node = Node(tag, attributes)
            push(node)
            if tag in RAW and not (foreign and raw.endswith("/")):
                over = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                body = page[at:over.start()] if over else page[at:]
                node.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
                at = over.end() if over else size
            if tag in RAW or tag in VOID or (raw.endswith("/") and (tag in FOREIGN or (foreign and not opened["foreignobject"]))):
                cut(len(stack) - 1)
    return root


def _styles(root: Node) -> Styles:
    """The style sheets of a page, in the order of the page."""
    styles, todo = Styles(), [root]
    while todo:
        node = todo.pop()
        if node.tag == "style":
            styles.add("".join(map(str, node.children)), node.attributes.get("media", ""))
        todo += [child for child in reversed(node.children) if isinstance(child, Node)]
    return styles


class _Sight:
    """What can be seen where the walk is: one entry for each element it is inside of."""

    def __init__(self, styles: Styles):
        self._styles = styles
        self._places = [Place()]
        self._visible = [True]
        self._drawn = [True]  # whether text shows here: not between the shapes of a drawing
        self._foreign = [""]
        self._next = (Place(), True, True, "")

    def enters(self, node: Node) -> bool:
        """Whether the element is displayed; sets what can be seen inside it."""
        tag, attributes = node.tag, node.attributes
        place, says = Place(), {}
        if tag == "head":
            return False
        if self._styles:
            place, says = self._styles.meet(tag, attributes, self._places[-1])
            if len(self._places) == 1:  # the root stands for the body too
                place, inner = self._styles.meet("body", attributes, place)
                says |= inner
        elif "style" in attributes:
            says = Styles().meet(tag, attributes, place)[1]
        foreign = self._foreign[-1]
        if tag in UNSEEN or (foreign and tag in FOREIGN_UNSEEN):
            return False
        if tag == "input" and attributes.get("type", "").lower() in ("hidden", "checkbox", "radio", "image", "file", "password"):
            return False
        if tag == "object" and attributes.get("data"):
            return False
        display = says.get("display", "revert")
        if display == "none" or (
            display.startswith("revert") and ("hidden" in attributes or (tag == "dialog" and "open" not in attributes))
        ):
            return False
        said = says.get("visibility", "inherit")
        visible = said in ("visible", "initial") or (self._visible[-1] and said not in ("hidden", "collapse"))
        drawn = tag != "svg" and (self._drawn[-1] or tag in DRAWN_TEXT)
        inside = tag if tag in FOREIGN else "" if tag == "foreignobject" else foreign
        self._next = (place, visible, drawn, inside)
        return True

    @property
    def visible_next(self) -> bool:
        return self._next[1]

    def enter(self) -> None:
        for stack, value in zip((self._places, self._visible, self._drawn, self._foreign), self._next, strict=True):
            stack.append(value)

    def leave(self) -> None:
        for stack in (self._places, self._visible, self._drawn, self._foreign):
            stack.pop()

    @property
    def text(self) -> bool:
        return self._visible[-1] and self._drawn[-1]

    @property
    def foreign(self) -> str:
        return self._foreign[-1]


class _Flow:
    """Lines of one block context; the width of its own prefixes is kept per list level."""

    def __init__(self):
        self.lines: list[str] = []
        self._line: list[str] = []
        self._blank = self._space = False
        self.indents: list[str] = []
        self.mark = ""

    def inline(self, text: str) -> None:
        if not text:
            return
        flat = _BLANKS.sub(" ", text)
        if flat[0] == " ":
            self._space = bool(self._line)
            flat = flat[1:]
        if flat:
            if self._space:
                self._line.append(" ")
            self._space = flat[-1] == " "
            self._line.append(flat[:-1] if self._space else flat)

    def raw(self, text: str) -> None:
        for k, line in enumerate(text.split("\n")):
            if k:
                self.end(keep=True)
            if line:
                self._line.append(line)

    def end(self, keep: bool = False) -> None:
        """End the line; ``keep`` keeps an empty one."""
        if self._line or keep or self.mark:
            if self._line or keep:
                if self._blank and self.lines:
                    self.lines.append("")
                self._blank = False
                prefix = "".join(self.indents[:-1]) + self.mark if self.mark else "".join(self.indents)
                self.lines.append((prefix + "".join(self._line)).rstrip())
                self.mark = ""
        self._line, self._space = [], False

    def space(self) -> None:
        self.end()
        self._blank = bool(self.lines)

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def _span(node: Node, name: str) -> int:
    """Columns or rows a cell spans; no end (0) is as far as its group of rows goes."""
    value = node.attributes.get(name, "1").strip()
    if not value.isdecimal() or len(value) > 9:
        return 1
    return min(max(int(value), 1), 1000) if name == "colspan" else min(int(value) or 65534, 65534)


def _placed(rows: list[list[tuple[str, int, int]] | None]) -> list[list[tuple[str, int]]]:
    """Rows of (text, columns spanned), with empty texts where cells of rows above reach down.

    None starts a group of rows, beyond which no cell reaches.
    """
    placed, taken = [], {}
    for row in rows:
        if row is None:
            taken = {}
            continue
        out, column = [], 0
        left = {at: rest - 1 for at, rest in taken.items() if rest > 1}
        for text, columns, deep in row:
            begin = column
            while taken.get(column):
                column += 1
            if column > begin:
                out.append(("", column - begin))
            out.append((text, columns))
            if deep > 1:
                left |= dict.fromkeys(range(column, min(column + columns, ALIGNED)), deep - 1)
            column += columns
        if row:
            placed.append(out)
        taken = left
    return placed


def _table_lines(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Rows of (text, columns spanned) as lines with aligned columns."""
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for text, span in row:
            widest = max(map(len, text.split("\n")))
            if span == 1 and widest <= WIDEST:
                widths[column] = max(widths.get(column, 0), widest)
            column += span
    for row in rows:
        column = 0
        for text, span in row:
            if span > 1 and text:
                widest = max(map(len, text.split("\n")))
                short = widest - sum(widths.get(column + n, 0) for n in range(span)) - 2 * (span - 1)
                if short > 0 and widest <= WIDEST:  # a spanning cell widens its last column
                    widths[column + span - 1] = widths.get(column + span - 1, 0) + short
            column += span
    lines = []
    for row in rows:
        cells = [(text.split("\n"), span) for text, span in row]
        for k in range(max((len(cell) for cell, _ in cells), default=0)):
            out, column = [], 0
            for cell, span in cells:
                width = sum(widths.get(column + n, 0) for n in range(span)) + 2 * (span - 1)
                out.append((cell[k] if k < len(cell) else "").ljust(width))
                column += span
            lines.append("  ".join(out).rstrip())
    return lines


def render(page: str | None) -> str:
    """The visible text of a page; an empty string for a null or empty one."""
    if not page:
        return ""
    root = parse(page)
    sight = _Sight(_styles(root))
    flows, tables, lists, pre = [_Flow()], [], [], 0
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if sight.text:
                flow.raw(node) if pre else flow.inline(node)
            continue
        tag = node.tag
        if not leaving:
            if not sight.enters(node):
                continue
            children = node.children
            if tag == "br":
                if sight.visible_next:
                    flow.end(keep=True)
                continue
            if tag == "input":
                if sight.visible_next:
                    flow.inline(node.attributes.get("value", "") or node.attributes.get("placeholder", ""))
                continue
            sight.enter()
            if sight.foreign and tag in SET_APART:
                flow.inline(" ")
            if tag in GROUPS and tables:
                tables[-1][1].append(None)
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag in ("td", "th"):
                flows.append(_Flow())
            elif tag == "tr":
                flow.end()
                if not tables:
                    tables.append([None, []])
                    node.attributes["_own"] = ""
                tables[-1][1].append([])
            elif tag == "table":
                flow.space()
                tables.append([len(flows), []])
            elif tag in BLOCKS:
                nested = tag in LISTS and lists
                flow.space() if tag in SPACED and not nested else flow.end()
                if tag in LISTS:
                    start = node.attributes.get("start", "1")
                    lists.append([tag, int(start) if start.lstrip("-").isdecimal() else 1])
                    flow.indents.append("")
                elif tag == "li":
                    mark = "- "
                    if lists and lists[-1][0] == "ol":
                        mark = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    flow.indents.append("  " if len(mark) < 3 else " " * len(mark))
                    flow.mark = mark
                elif tag in ("blockquote", "dd"):
                    flow.indents.append("  ")
                elif tag == "pre":
                    pre += 1
                    if children and isinstance(children[0], str):
                        children = [children[0].removeprefix("\n"), *children[1:]]
            todo.append((node, True))
            todo.extend((child, False) for child in reversed(children))
            continue
        shown = sight.text
        if sight.foreign and tag in SET_APART:
            flow.inline(" ")
        sight.leave()
        if tag in ("td", "th"):
            text = flows.pop().text()
            if tables and tables[-1][1] and tables[-1][1][-1] is not None:
                tables[-1][1][-1].append((text, _span(node, "colspan"), _span(node, "rowspan")))
            else:
                flows[-1].raw(text)
        elif tag == "tr":
            if not shown and tables[-1][1][-1] and not any(text for text, _, _ in tables[-1][1][-1]):
                tables[-1][1].pop()
            if "_own" in node.attributes:
                _pour(flow, tables.pop()[1])
        elif tag == "table":
            _pour(flow, tables.pop()[1])
            flow.space()
        elif tag in BLOCKS:
            if tag == "pre":
                pre -= 1
            flow.end()
            if tag == "li" and flow.mark:
                flow.mark = ""
            if tag in LISTS or tag in ("li", "blockquote", "dd"):
                flow.indents.pop()
            if tag in LISTS:
                lists.pop()
            if tag in SPACED and not (tag in LISTS and lists):
                flow.space()
    return flows[0].text()


def _pour(flow: _Flow, rows: list) -> None:
    flow.end()
    for line in _table_lines(_placed(rows)):
        flow.raw(line)
        flow.end(keep=True)


def rendered(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_lines, n_chars. A null or empty page has an empty text.

    Rows are kept as they come, repeated ones too; an empty table gives none. Further columns, whatever
    their names, are not read. A page is laid out whole, however long, in memory that grows with it.
    """
    def lay_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "html"):
            texts = [render(page) for page in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id").cast(pa.int64()), piece.column("url"), pa.array(texts, pa.string()),
                 pa.array([text.count("\n") + bool(text) for text in texts], pa.int32()),
                 pa.array([len(text) for text in texts], pa.int64())],
                names=["page_id", "url", "text", "n_lines", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        lay_out, "page_id long, url string, text string, n_lines int, n_chars long"
    )
