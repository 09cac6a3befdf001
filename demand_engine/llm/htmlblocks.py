"""Text blocks of a web page: a small reader of tags, tolerant of mistakes.

A block is the text between two block-level tags, with character references
decoded and white space runs as one space; it carries the open elements
around it (tag names, words of class, id and role) and its share of linked
text. Scripts, styles and other raw elements hold no text.
"""

from __future__ import annotations

import re
from html import unescape

# HTML's elements that start or end a block, hold no text to
# show, have no end tag, and end an open element of the same kind.
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "label legend li main menu nav ol optgroup option p pre search section select summary table caption tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title iframe noembed noframes noscript template svg math object canvas audio video xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select", "optgroup")),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")),
    "tbody": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",)), "thead": ("tbody thead tfoot tr td th", ("table",)),
}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _names(attributes: str) -> list[str]:
    """The words of class, id and role, each with a mark of its kind."""
    return [f".{w.lower()}" for _, a, b, c in _ATTR.findall(attributes) for w in _NAME.findall(a or b or c)]


def blocks(html: str) -> list[tuple[list[str], str, float]]:
    """(names of the open elements, text, linked share) of each block with text."""
    out: list[tuple[list[str], str, float]] = []
    stack: list[tuple[str, list[str]]] = []
    text: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(([n for tag, names in stack for n in (tag, *names)], joined, min(1.0, linked / len(joined))))
            text.clear()
        linked = 0

    def close(names: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        """Ends the innermost open element of ``names`` and what it holds."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    at, end = 0, len(html)
    while at < end:
        found = _TAG.search(html, at)
        said = html[at : found.start() if found else end]
        if said:
            said = unescape(said) if "&" in said else said
            text.append(said)
            linked += len(said) if in_link else 0
        if not found:
            break
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                # raw text up to its own end tag, or to the page's end
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = over.end() if over else end
        elif name == "br":
            text.append(" ")
        elif name == "a":
            in_link = 0 if closing else 1
        elif name in BLOCK:
            flush()
            if closing:
                close((name,))
            else:
                if name in SIBLINGS:
                    kinds, until = SIBLINGS[name]
                    while any(x[0] in kinds.split() for x in stack[_inner(stack, until) :]):
                        close(tuple(kinds.split()), until)
                elif stack and stack[-1][0] == "p":
                    stack.pop()
                if name not in VOID:
                    stack.append((name, _names(attributes)))
            in_link = in_link if name not in ("body", "html") else 0
    flush()
    return out


def _inner(stack: list[tuple[str, list[str]]], until: tuple[str, ...]) -> int:
    """Where the innermost element of ``until`` begins to hold others."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in until:
            return i + 1
    return 0
