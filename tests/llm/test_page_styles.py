"""Visible text against a slow renderer that asks every rule about every element on the way up."""

from __future__ import annotations

import random

import pytest

from ledgerlane.llm.html_render import render
from ledgerlane.llm.page_styles import on_screen

CASES = {
    "print": ("<style>@media print{.n{display:none}}</style><p class=n>a", "a"),
    "narrow": ("<style>@media (max-width:600px){.n{display:none}} @media (min-width:600px){.m{display:none}}</style><p class=n>a<p class=m>b", "a"),
    "sheet for print": ("<style media=print>p{display:none}</style><p>a", "a"),
    "blocks within blocks": ("<style>@supports (display:grid){@media screen{i{display:none}}b{display:none}} u{display:none}</style><i>a</i><b>b</b><u>c</u>d", "d"),
    "keyframes": ("<style>@keyframes x{from{visibility:hidden}to{visibility:visible}} i{display:none}</style><i>a</i>b", "b"),
    "specificity": ("<style>.m.open{display:block}.m{display:none}</style><p class='m open'>a<p class=m>b", "a"),
    "order": ("<style>.m{display:none}.m{display:block}</style><p class=m>a", "a"),
    "own style wins": ("<style>#m{display:none}</style><p id=m style='display:block'>a", "a"),
    "important wins": ("<style>p{display:none!important}</style><p style='display:block'>a</p>b", "b"),
    "unreadable value": ("<p style='display:nonesuch'>a", "a"),
    "comment and string": ("<style>/* p{display:none} */ i{content:';display:none';color:red}</style><p>a<i>b", "ab"),
    "visible inside hidden": ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b></div>", "yes"),
    "not displayed stays": ("<div style='display:none'>no <b style='visibility:visible;display:block'>no</b></div>x", "x"),
    "shown again": ("<p hidden style='display:block'>a</p><dialog style='display:block'>b</dialog>", "a\n\nb"),
    "states": ("<style>p:hover,p::before,p:first-child{display:none}</style><p>a", "a"),
    "siblings": ("<style>li+li,.a~p{display:none}</style><ul><li>1<li>2<li>3</ul><i class=a></i><p>x</p>y", "- 1\n\ny"),
    "body": ("<style>body>.a{display:none} html body.k .b{display:none}</style><body class=k><p class=a>a<div><p class=a>b<p class=b>c</div>", "b"),
    "attributes": ("<style>[data-x=q],[role^=no]{display:none}</style><p data-x=q>a<p data-x=z>b<p role=none>c", "b"),
    "collapsed row": ("<table><tr><td>a<tr style=visibility:collapse><td>b<tr><td>c</table>", "a\nc"),
    "drawing": ("a<svg><title>t</title><path d='x'/><text>one</text><g>zz<text>two</text></g></svg>b", "a one two b"),
    "hidden drawing": ("a<svg style='display:none'><text>one</text></svg>b", "ab"),
    "html in a drawing": ("<svg><foreignObject><p>a</p></foreignObject></svg>", "a"),
    "drawing left open": ("<svg><path d=1><p>x", "x"),
    "formula": ("so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>.", "so x=1."),
    "object": ("<object>a</object><object data=x>b</object>", "a"),
    "rowspan": ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    "rowspan in the middle": ("<table><tr><td>a<td rowspan=0 colspan=2>bbb<td>c<tr><td>d<td>e</table>", "a  bbb  c\nd       e"),
    "rowspan and groups": ("<table><tbody><tr><td rowspan=9>a<td>b<tbody><tr><td>c<td>d</table>", "a  b\nc  d"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, text = CASES[name]
    assert render(page) == text


@pytest.mark.parametrize("media, holds", [
    ("", True), ("all", True), ("print", False), ("screen, print", True), ("not print", True), ("only screen", True),
    ("not screen and (min-width: 10px)", False), ("screen and (min-width: 40em) and (orientation: landscape)", True),
    ("(width >= 2000px)", False), ("(max-width: 2000px)", True), ("(prefers-color-scheme: dark)", False), ("((", False),
])
def test_media(media, holds):
    assert on_screen(media) is holds


def test_depth_and_width_cost_little():
    rules = "<style>.x div{display:none}.q div div p{display:none}</style>"
    assert render(rules + "<div class=q>" + "<div>" * 20_000 + "x") == "x"
    assert render("<table>" + "<tr><td rowspan=65534 colspan=1000>a" * 300).count("a") == 300


# A slow oracle: elements are (tag, classes, id, own style, children), rules (parts, declaration, important).
TAGS, NAMES = ("div", "span", "b"), ("a", "c", "e")
SAYS = [("display", "none"), ("display", "block"), ("visibility", "hidden"), ("visibility", "visible")]


def grown(draw, depth, count):
    children = []
    for _ in range(draw.randrange(1, 5)):
        if depth and draw.random() < 0.7:
            own = draw.choice(SAYS) if draw.random() < 0.15 else None
            classes = [n for n in NAMES if draw.random() < 0.3]
            children.append((draw.choice(TAGS), classes, draw.choice([None, None, "i"]), own, grown(draw, depth - 1, count)))
        else:
            count[0] += 1
            children.append(f"w{count[0]}")
    return children


def ruled(draw):
    parts = []
    for k in range(draw.randrange(1, 4)):
        tag = draw.choice([None, *TAGS])
        classes = [n for n in NAMES if draw.random() < 0.25]
        ident = "i" if draw.random() < 0.15 else None
        parts.append((draw.choice(" >+~") if k else "", tag or (None if classes or ident else "*"), classes, ident))
    return parts, draw.choice(SAYS), draw.random() < 0.1


def fits(parts, path):
    """Whether the selector matches the last of (elder siblings, element) on the path."""
    link, tag, classes, ident = parts[-1]
    elders, (own_tag, own_classes, own_id, _, _) = path[-1]
    if (tag not in (None, "*", own_tag)) or not set(classes) <= set(own_classes) or ident not in (None, own_id):
        return False
    if link == "":
        return True
    if link in " >":
        ups = range(len(path) - 1, 0, -1) if link == " " else [len(path) - 1] if len(path) > 1 else []
        return any(fits(parts[:-1], path[:up]) for up in ups)
    near = range(len(elders)) if link == "~" else range(len(elders))[-1:]
    return any(fits(parts[:-1], [*path[:-1], (elders[:k], elders[k])]) for k in near)


def words(children, rules, path, visible):
    elders = []
    for child in children:
        if isinstance(child, str):
            if visible:
                yield child
            continue
        here = [*path, (list(elders), child)]
        elders.append(child)
        won = {}
        for order, (parts, (name, value), important) in enumerate(rules):
            if fits(parts, here):
                weight = tuple(sum(x) for x in zip(*((int(p[3] is not None), len(p[2]), int(p[1] not in (None, "*"))) for p in parts), strict=True))
                won.setdefault(name, []).append(((important, False, weight, order), value))
        if child[3]:
            won.setdefault(child[3][0], []).append(((False, True, (0, 0, 0), 0), child[3][1]))
        best = {name: max(offers)[1] for name, offers in won.items()}
        if best.get("display") != "none":
            seen = visible if "visibility" not in best else best["visibility"] == "visible"
            yield from words(child[4], rules, here, seen)


def written(children):
    out = []
    for child in children:
        if isinstance(child, str):
            out.append(f" {child} ")
        else:
            tag, classes, ident, own, inside = child
            attributes = f' class="{" ".join(classes)}"' + (f' id="{ident}"' if ident else "")
            attributes += f' style="{own[0]}: {own[1]}"' if own else ""
            out.append(f"<{tag}{attributes}>{written(inside)}</{tag}>")
    return "".join(out)


def said(parts):
    return "".join(
        ({"": "", " ": " "}.get(link) if link in ("", " ") else f" {link} ")
        + (tag or "") + "".join(f".{n}" for n in classes) + (f"#{ident}" if ident else "")
        for link, tag, classes, ident in parts
    )


def test_same_words_as_the_slow_renderer():
    draw = random.Random(5)
    hidden = 0
    for _ in range(400):
        count = [0]
        tree = grown(draw, 5, count)
        rules = [ruled(draw) for _ in range(draw.randrange(6))]
        sheet = "".join(f"{said(parts)} {{ {name}: {value}{' !important' if hard else ''} }}" for parts, (name, value), hard in rules)
        want = list(words([("html", [], None, None, [("body", [], None, None, tree)])], rules, [], True))
        hidden += count[0] - len(want)
        assert render(f"<head><style>{sheet}</style></head>{written(tree)}").split() == want
    assert hidden > 200
