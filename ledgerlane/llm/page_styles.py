"""Which elements of a page its style sheets show: display and visibility after the cascade.

Of a sheet only declarations of ``display`` and ``visibility`` are kept, with those inside blocks
that hold on a screen of ``SCREEN`` pixels. A declaration wins by importance, then inline style, then
specificity, then order. Selectors may use element names, classes, ids, attributes, ``:not()`` of
those and all four combinators. A selector with another pseudo-class or a pseudo-element is about a
state or place that the plain page does not have, and matches nothing.

Selectors are matched from the root down: each element has a bit for every part of a selector that
ends at it, found from the bits of its parent and its elder siblings. No selector walks back up the
tree, so work is elements times parts and depth does not matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

SCREEN = {"width": 1280.0, "height": 800.0}

# Fixed words of the style language.
DISPLAYS = frozenset("""none block inline inline-block flow-root flex inline-flex grid inline-grid contents list-item
table inline-table table-row table-cell table-caption table-row-group table-header-group table-footer-group table-column
table-column-group run-in ruby math initial inherit unset revert revert-layer -webkit-box -webkit-flex""".split())
VISIBILITIES = frozenset("visible hidden collapse initial inherit unset revert revert-layer".split())
ENTERED = frozenset("supports layer".split())  # at-rules whose blocks hold
FEATURES = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "scripting": "none", "update": "fast",
}

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_STRING = re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_STOP = re.compile(r"[{};]")
_BRACE = re.compile(r"[{}]")
_PARENTHESES = re.compile(r"\(([^()]*)\)")
_QUERY = re.compile(r"(?:(not|only)\s+)?(?:([a-z-]+)(?:\s+and\s+|\s*$))?(.*)", re.S)
_RANGE = re.compile(r"(width|height)\s*(<=|>=|<|>|=)\s*([^<>=]+)")
_LENGTH = re.compile(r"([\d.]+)(px|em|rem)?")
_SIMPLE = re.compile(
    r"(?P<tag>\*|[a-zA-Z][\w-]*)|\.(?P<class>-?[^\W\d][\w-]*)|#(?P<id>[\w-]+)"
    r"|\[\s*(?P<name>[\w-]+)\s*(?:(?P<how>[~|^$*]?=)\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[\w-]+))\s*)?\]"
    r"|:not\(\s*(?P<not>[^()]*?)\s*\)"
)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")


def _length(text: str) -> float | None:
    found = _LENGTH.fullmatch(text.strip())
    if not found or found[1].count(".") > 1 or found[1] == ".":
        return None
    return float(found[1]) * (16 if found[2] in ("em", "rem") else 1)


def _feature(text: str) -> bool:
    name, colon, value = (part.strip() for part in text.partition(":"))
    if not colon:
        found = _RANGE.fullmatch(name)
        if not found:
            return name in ("color", "hover", "pointer", "width", "height")
        size, bound = SCREEN[found[1]], _length(found[3])
        return bound is not None and {
            "<=": size <= bound, ">=": size >= bound, "<": size < bound, ">": size > bound, "=": size == bound
        }[found[2]]
    if name in FEATURES:
        return value == FEATURES[name]
    edge, _, side = name.partition("-")
    bound = _length(value)
    if side not in SCREEN or edge not in ("min", "max") or bound is None:
        return False
    return SCREEN[side] >= bound if edge == "min" else SCREEN[side] <= bound


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds on the screen; one that cannot be read does not."""
    def holds(query: str) -> bool:
        negated, kind, rest = _QUERY.fullmatch(query.strip()).groups()
        tests = [_feature(x) for x in _PARENTHESES.findall(rest)]
        if re.sub(r"\([^()]*\)|\band\b|\bor\b|\s", "", rest) or (not kind and not tests):
            return False
        true = kind in (None, "all", "screen") and (any(tests) if re.search(r"\bor\b", rest) else all(tests))
        return true != (negated == "not")

    media = media.strip().lower()
    return not media or any(map(holds, media.split(",")))


def declared(body: str) -> dict[str, tuple[bool, str]]:
    """(important, value) of display and visibility in the declarations of a rule."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _STRING.sub('""', body).split(";"):
        name, colon, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        plain, mark, word = value.partition("!")
        important = bool(mark) and word.strip() == "important"
        plain = " ".join(plain.split())
        known = DISPLAYS if name == "display" else VISIBILITIES
        if (mark and not important) or not plain or not all(word in known for word in plain.split()):
            continue  # what cannot be read does not count
        if name not in found or important >= found[name][0]:
            found[name] = (important, plain)
    return found


def _rules(sheet: str) -> list[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on the screen, in order."""
    sheet = _COMMENT.sub(" ", sheet).replace("<!--", " ").replace("-->", " ")
    found, at = [], 0
    while stop := _STOP.search(sheet, at):
        before, at = sheet[at:stop.start()].strip(), stop.end()
        if stop[0] != "{":
            continue  # a statement such as @import, or the end of a block that was entered
        name = re.match(r"@([\w-]+)", before)
        if name:
            kind, rest = name[1].lower(), before[name.end():]
            if (kind == "media" and on_screen(rest)) or (kind in ENTERED and not rest.strip().lower().startswith("not")):
                continue
        depth, begin = 1, at
        while depth and (brace := _BRACE.search(sheet, at)):
            depth += 1 if brace[0] == "{" else -1
            at = brace.end()
        if depth:
            at = len(sheet)
        if not name:
            body = sheet[begin:at - (not depth)]
            found.append((before, body.partition("{")[0]))
    return found


@dataclass(frozen=True)
class _Compound:
    tag: str | None
    ids: frozenset[str]
    classes: frozenset[str]
    tests: tuple[tuple[str, str | None, str], ...]
    excluded: tuple[_Compound, ...]

    def matches(self, tag: str, attributes: dict[str, str], classes: frozenset[str]) -> bool:
        if (self.tag and self.tag != tag) or not self.classes <= classes or not self.ids <= {attributes.get("id")}:
            return False
        return all(_attribute(attributes.get(name), how, value) for name, how, value in self.tests) and not any(
            other.matches(tag, attributes, classes) for other in self.excluded
        )

    def weight(self) -> tuple[int, int, int]:
        own = (len(self.ids), len(self.classes) + len(self.tests), int(self.tag is not None))
        return tuple(map(sum, zip(own, *(other.weight() for other in self.excluded), strict=True)))


def _attribute(held: str | None, how: str | None, value: str) -> bool:
    if held is None or how is None:
        return held is not None
    if how == "=":
        return held == value
    if how == "~=":
        return value in held.split()
    if how == "|=":
        return held == value or held.startswith(value + "-")
    if not value:
        return False
    return {"^=": held.startswith(value), "$=": held.endswith(value), "*=": value in held}[how]


def _compound(text: str) -> tuple[_Compound, int] | None:
    """The compound a text starts with, and its length; None if it starts with none."""
    tag, ids, classes, tests, excluded, at = None, set(), set(), [], [], 0
    while found := _SIMPLE.match(text, at):
        if found["tag"]:
            if at:
                return None
            tag = None if found["tag"] == "*" else found["tag"].lower()
        elif found["class"]:
            classes.add(found["class"])
        elif found["id"]:
            ids.add(found["id"])
        elif found["name"]:
            value = next((found[k] for k in "abc" if found[k] is not None), "")
            tests.append((found["name"].lower(), found["how"], value))
        else:
            inner = _compound(found["not"])
            if not inner or inner[1] != len(found["not"]):
                return None
            excluded.append(inner[0])
        at = found.end()
    return (_Compound(tag, frozenset(ids), frozenset(classes), tuple(tests), tuple(excluded)), at) if at else None


def _parts(selector: str) -> list[tuple[str, _Compound]] | None:
    """(combinator before it, compound) of a selector; None if it says more than is understood."""
    parts, at, link = [], 0, ""
    while at < len(selector):
        found = _compound(selector[at:])
        if not found:
            return None
        parts.append((link, found[0]))
        at += found[1]
        if at < len(selector):
            between = _COMBINATOR.match(selector, at)
            if not between:
                return None
            link, at = between[1] or " ", between.end()
    return parts if parts and at == len(selector) else None


@dataclass
class Place:
    """Bits of selector parts: at an element, at those above it, at the children met so far."""

    at: int = 0
    above: int = 0
    last_child: int = 0
    children: int = 0


@dataclass
class Styles:
    """The sheets of a page, ready to match."""

    _links: list[str] = field(default_factory=list)
    _compounds: list[_Compound] = field(default_factory=list)
    _ends: dict[int, list] = field(default_factory=dict)  # part: (weight, order, declarations)
    _by_key: dict[str, list[int]] = field(default_factory=dict)
    _order: int = 0

    def add(self, sheet: str, media: str = "") -> None:
        if not on_screen(media) or not ("display" in (low := sheet.lower()) or "visibility" in low):
            return
        for selectors, body in _rules(sheet):
            says = declared(body)
            if not says:
                continue
            for selector in _split(selectors):
                if parts := _parts(selector.strip()):
                    self._order += 1
                    for link, compound in parts:
                        number = len(self._links)
                        self._links.append(link)
                        self._compounds.append(compound)
                        key = min(map("#".__add__, compound.ids), default=None) or min(map(".".__add__, compound.classes), default=None)
                        self._by_key.setdefault(key or compound.tag or "*", []).append(number)
                    weight = tuple(map(sum, zip(*(compound.weight() for _, compound in parts), strict=True)))
                    self._ends[len(self._links) - 1] = (weight, self._order, says)

    def __bool__(self) -> bool:
        return bool(self._ends)

    def meet(self, tag: str, attributes: dict[str, str], parent: Place) -> tuple[Place, dict[str, str]]:
        """The place of an element below its parent, and its display and visibility where declared."""
        classes = frozenset(attributes.get("class", "").split())
        keys = ["*", tag, *("." + name for name in classes)]
        if "id" in attributes:
            keys.append("#" + attributes["id"])
        place = Place(0, parent.above | parent.at)
        best: dict[str, tuple] = {}

        def offer(name: str, important: bool, inline: bool, weight, order: int, value: str) -> None:
            rank = (important, inline, weight, order)
            if name not in best or rank >= best[name][0]:
                best[name] = (rank, value)

        for key in keys:
            for number in self._by_key.get(key, ()):
                link, before = self._links[number], 1 << number >> 1
                where = (
                    -1 if not link else place.above if link == " " else parent.at if link == ">"
                    else parent.last_child if link == "+" else parent.children
                )
                if (link and not where & before) or not self._compounds[number].matches(tag, attributes, classes):
                    continue
                place.at |= 1 << number
                if number in self._ends:
                    weight, order, says = self._ends[number]
                    for name, (important, value) in says.items():
                        offer(name, important, False, weight, order, value)
        parent.last_child = place.at
        parent.children |= place.at
        style = attributes.get("style", "")
        if style:
            for name, (important, value) in declared(_COMMENT.sub(" ", style)).items():
                offer(name, important, True, (0, 0, 0), 0, value)
        return place, {name: value for name, (_, value) in best.items()}


def _split(selectors: str) -> list[str]:
    """A list of selectors at its commas, but for those in brackets."""
    out, depth, begin = [], 0, 0
    for k, char in enumerate(selectors):
        if char in "([":
            depth += 1
        elif char in ")]":
            depth -= 1
        elif char == "," and not depth:
            out.append(selectors[begin:k])
            begin = k + 1
    return [*out, selectors[begin:]]
