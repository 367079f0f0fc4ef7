"""Leaf blocks of an HTML page: a small tolerant reader. A block is the text between two block-level
tags, with the path of open block elements (tag names and the words of class, id and role)."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

# Element names of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SKIPPED = frozenset("noscript template svg iframe select object".split())  # left out with all they hold
DEEP = 200
CLOSED_BY_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*>?"
    # a quote counts after an equals sign only and where it is closed; a tag without an end stops before the next
    # one; possessive, so that no text is tried twice
    r"""|<(/?)([a-z][a-z0-9:-]*+)((?:[^<>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?|["'])*+)(?:>|(?=<)|\Z)""",
    re.DOTALL | re.IGNORECASE)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # "div", ".sidebar", ..., outermost first
    text: str  # character references decoded, white space runs as one space
    linked: int  # characters of it within links


def names(attributes: str) -> list[str]:
    found = []
    for m in _NAMES.finditer(attributes):
        found += ["." + w for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower())]
    return found


def _tag(m: re.Match) -> tuple[str, bool]:
    """(lower-case name, whether it is an end tag) of a match; no name for comments, scripts and the like."""
    return (m[3] or "").lower(), bool(m[2])


def _skips(tags: list[re.Match]) -> dict[int, int]:
    """For the start tags of skipped elements the place of the end tag that belongs to it, by name with
    nesting. A start tag that nothing closes, and a self-closing svg, are not in it: they stand alone."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for n, m in enumerate(tags):
        tag, closing = _tag(m)
        if tag in SKIPPED:
            if not closing:
                if not (tag == "svg" and m[0].endswith("/>")):
                    opened.setdefault(tag, []).append(n)
            elif opened.get(tag):
                out[opened[tag].pop()] = n
    return out


def blocks(html: str | None) -> list[Block]:
    html = html or ""
    stack: list[tuple[str, tuple[str, ...]]] = []  # open block elements with their path
    opened: Counter[str] = Counter()  # how many of each are in the stack
    out: list[Block] = []
    text: list[str] = []
    linked = links = at = 0

    def flush():
        nonlocal linked
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            out.append(Block(stack[-1][1] if stack else (), joined, min(linked, len(joined))))
        text.clear()
        linked = 0

    def close(these):
        if not any(opened[t] for t in these):
            return
        while True:
            tag, _ = stack.pop()
            opened[tag] -= 1
            if tag in these:
                return

    tags = list(_TAG.finditer(html))
    skips, skipped = _skips(tags), -1
    for n, m in enumerate(tags):
        if n <= skipped:
            continue
        if m.start() > at:
            piece = html[at:m.start()]
            text.append(piece)
            if links:
                linked += len(piece.strip())
        at = m.end()
        tag, closing = _tag(m)
        if not tag:
            continue
        if tag in SKIPPED and not closing:
            skipped = skips.get(n, n)
            at = tags[skipped].end()
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if closing:
            close((tag,))
            continue
        if tag in ENDS_P and stack and stack[-1][0] == "p":
            close(("p",))
        if tag in CLOSED_BY_SAME:
            own = CLOSED_BY_SAME[tag]
            if stack and stack[-1][0] in own:
                close(own)
        path = stack[-1][1] if stack else ()
        # an element below DEEP others keeps the path of its ancestor, so that paths stay short
        stack.append((tag, (*path, tag, *names(m[4] or "")) if len(stack) < DEEP else path))
        opened[tag] += 1
    text.append(html[at:])
    flush()
    return out
