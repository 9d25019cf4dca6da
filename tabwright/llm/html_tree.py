"""A small lenient parser of web pages: what extraction needs of a page, as a tree."""

from __future__ import annotations

import re
from html import unescape

# Fixed values of HTML: elements without content, elements whose content is no markup, what ends a paragraph, and what
# ends when a sibling of its kind begins.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",), "optgroup": ("optgroup", "option"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
            "tfoot": ("thead", "tbody", "tr", "td", "th")}
#: Where the search for an open sibling ends.
SCOPES = frozenset("html body table ul ol dl menu select article section main div td th nav aside header footer form".split())
#: Deeper elements are taken as children of the one at this depth.
DEEPEST = 150

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden|hidden|property|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)
DIGITS = re.compile(r"\d+")


class Element:
    __slots__ = ("attributes", "children", "key", "name")

    def __init__(self, name: str, attributes: dict[str, str]) -> None:
        self.name, self.attributes = name, attributes
        self.children: list[Element | str] = []
        # Numbers in names tell pages apart, not places on a page.
        label = DIGITS.sub("", attributes.get("class", "").lower())
        own = DIGITS.sub("", attributes.get("id", "").lower())
        self.key = name + "".join(f".{c}" for c in label.split()) + (f"#{own}" if own else "")


def _attributes(more: str) -> dict[str, str]:
    if not more or more.isspace():
        return {}
    return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in reversed(list(ATTRIBUTE.finditer(more)))}


def parse(page: str) -> Element:
    """The page as a tree; text is decoded, content of scripts and the like is left out."""
    root = Element("#page", {})
    stack, at, n = [root], 0, len(page)
    while at < n:
        found = TOKEN.search(page, at)
        if found is None:
            stack[-1].children.append(unescape(page[at:]))
            break
        if found.start() > at:
            stack[-1].children.append(unescape(page[at : found.start()]))
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        name = name.lower()
        if found["close"] or found["close2"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                # A stray end of an inline element does not end the block it stands in.
                if name not in BLOCKS and stack[depth].name in BLOCKS:
                    break
            else:
                if name in ("p", "br"):
                    stack[-1].children.append(Element(name, {}))
            continue
        more = found["more"] if found["name"] else found["more2"]
        if name in BLOCKS:
            _end_open(stack, ("p",), ())
            if name in SIBLINGS:
                _end_open(stack, SIBLINGS[name], SCOPES)
        element = Element(name, _attributes(more))
        stack[-1].children.append(element)
        if name in RAW:
            end = re.compile(rf"</{name}[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and len(stack) < DEEPEST and not (more.endswith("/") and name not in BLOCKS):
            stack.append(element)
    return root


def _end_open(stack: list[Element], names: tuple[str, ...], scopes: frozenset[str] | tuple) -> None:
    """Ends the outermost open element of these names that no scope hides."""
    cut = None
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name in names:
            cut = depth
        elif stack[depth].name in (scopes or BLOCKS):
            break
    if cut:
        del stack[cut:]
