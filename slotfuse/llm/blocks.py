"""HTML to leaf blocks: the text between two block-level tags, with the path it is on."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements by how they end a block or hide their content.
HIDDEN = frozenset("script style noscript template iframe svg head title select textarea".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                  "th": ("td", "th"), "option": ("option",)}


class Block(NamedTuple):
    path: tuple[str, ...]  # open elements from the root
    names: tuple[str, ...]  # their classes, ids and roles, but for those of html and body
    text: str
    linked: int  # code points inside links


def _close(stack: list, tags: tuple[str, ...], stop: frozenset[str] = frozenset()) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in tags:
            del stack[i:]
            return
        if stack[i][0] in stop:
            return


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a page in page order, white space collapsed, references decoded.

    Script, style and other hidden elements give none. Unclosed tags end where HTML lets
    them end; a `<` that opens no tag is text. An empty page has no blocks.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[tuple[str, bool]] = []
    links, hidden, at = 0, 0, 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
        if text:
            linked = " ".join(html.unescape(" ".join(p for p, in_link in pieces if in_link)).split())
            path, names = tuple(t for t, _ in stack), tuple(n for _, ns in stack for n in ns)
            blocks.append(Block(path, names, text, len(linked)))
        pieces.clear()

    while True:
        m = TOKEN.search(page, at)
        if not hidden:
            pieces.append((page[at:m.start() if m else len(page)], links > 0))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if tag in BLOCK and not hidden:
                flush()
            if tag == "a":
                links = max(0, links - 1)
            if any(t == tag for t, _ in stack):
                _close(stack, (tag,))
                hidden = sum(t in HIDDEN for t, _ in stack)
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            pieces.append((" ", False))
            continue
        if tag == "br":
            pieces.append((" ", links > 0))
        if tag in VOID and tag != "hr":
            continue
        if tag == "a":
            links += 1
        elif tag in BLOCK or tag in HIDDEN:
            if not hidden:
                flush()
            links = 0
            if tag in BLOCK:
                _close(stack, ("p",), BLOCK - {"p"})
            if tag in CLOSED_BY_SAME:
                _close(stack, CLOSED_BY_SAME[tag], frozenset(("ul", "ol", "dl", "table")))
            if tag == "body":
                _close(stack, ("head",))
                hidden = 0
            if tag != "hr" and not attributes.endswith("/"):
                found = [a or b or c for a, b, c in NAMES.findall(attributes)] if attributes else []
                names = tuple(n for value in found for n in html.unescape(value).lower().split())
                # What html and body are called says something about the page and nothing about a block.
                stack.append((tag, () if tag in ("html", "body") else names))
                hidden += tag in HIDDEN
    if not hidden:
        flush()
    return blocks
