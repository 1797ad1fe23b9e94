"""Blocks of a web page: a forgiving scan of the markup, no tree is built."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Elements whose content is no text of the page, and those that are void or begin a block.
RAW = frozenset("script style template noscript iframe object svg math canvas audio video textarea select datalist title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr button".split())
CLOSED_BY_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"},
                     "th": {"td", "th"}, "option": {"option"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
SCOPES = frozenset("ul ol dl table article section div main body td th blockquote aside nav header footer form".split())


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    path: tuple[int, ...]  # numbers of the open elements, outermost first
    names: tuple[str, ...]  # their names, in the same order
    marks: tuple[str, ...]  # their class, id and role, in the same order
    numbers: tuple[int, ...]  # their numbers, in the same order
    linked: int  # characters inside links
    hidden: bool


def blocks(html: str) -> list[Block]:
    """Blocks of text in page order; white space inside is one space, character references are decoded."""
    found: list[Block] = []
    stack: list[tuple[str, int, str, bool]] = []  # name, number, marks, hidden
    pieces: list[str] = []
    links: list[str] = []
    number, in_link, at, n = 0, 0, 0, len(html)

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                tag = next((s[0] for s in reversed(stack) if s[0] not in INLINE), "body")
                linked = len(" ".join(unescape("".join(links)).split()))
                found.append(Block(text, tag, tuple(s[1] for s in stack if s[0] not in INLINE),
                                   tuple(s[0] for s in stack), tuple(s[2] for s in stack),
                                   tuple(s[1] for s in stack), linked,
                                   any(s[3] for s in stack)))
            pieces.clear()
            links.clear()

    def shut(depth: int) -> None:
        nonlocal in_link
        for name, *_ in stack[depth:]:
            in_link -= name == "a"
        del stack[depth:]

    def words(text: str) -> None:
        pieces.append(text)
        if in_link > 0:
            links.append(text)

    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            words(html[at:])
            break
        m = _MARKUP.match(html, mark)
        if m is None:  # a plain less-than sign
            words(html[at : mark + 1])
            at = mark + 1
            continue
        if mark > at:
            words(html[at:mark])
        at = m.end()
        if m["cdata"] is not None:
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["close"]:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != tag:
                if tag in INLINE and stack[depth][0] not in INLINE:
                    depth = -1  # an inline end does not close blocks
                    break
                depth -= 1
            if tag not in INLINE:
                flush()
            if depth >= 0:
                shut(depth)
            continue
        if tag == "br":
            words(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "img":
                words(" ")
            continue
        if tag == "button":
            # A control, its caption is no text; one that is never closed is passed over as a tag.
            end = re.compile(r"</button\s*[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else at
            words(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else n
            if tag not in ("svg", "math"):
                words(" ")
            continue
        if tag not in INLINE:
            flush()
            # A block ends open inline elements and paragraphs; list items and cells end their like.
            depth = len(stack)
            while depth and (stack[depth - 1][0] in INLINE or stack[depth - 1][0] == "p"):
                depth -= 1
            if tag in CLOSED_BY_SIBLING:
                for d in range(depth - 1, -1, -1):
                    if stack[d][0] in CLOSED_BY_SIBLING[tag]:
                        depth = d
                        break
                    if stack[d][0] in SCOPES:
                        break
            shut(depth)
        marks, hidden = "", False
        if m["attrs"] and not m["attrs"].isspace():
            for name, a, b, c in _ATTRIBUTE.findall(m["attrs"]):
                value, name = a or b or c, name.lower()
                if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                    hidden = True
                elif name in ("class", "id", "role", "itemprop"):
                    marks += " " + value.lower()
        if m["attrs"].endswith("/") and tag not in INLINE and tag not in SCOPES and tag != "p":
            continue
        number += 1
        in_link += tag == "a"
        stack.append((tag, number, marks, hidden))
    flush()
    return found
