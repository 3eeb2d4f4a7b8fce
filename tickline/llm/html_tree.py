"""A small fault-tolerant HTML tree of block elements, as wrapper inference needs it.

Inline markup is transparent: its text belongs to the block around it, and text
in links is told apart. Comments, declarations and the contents of raw-text
elements are skipped; missing end tags are supplied as HTML's parsing rules
say for paragraphs, headings, list items, table parts and options.
"""

from __future__ import annotations

import html
import re

# Element kinds of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KNOWN_BLOCKS = CLOSES_P | frozenset(
    "html head body button select option optgroup noscript template svg canvas object video audio map caption colgroup tbody thead tfoot tr td th legend".split()
)
#: An open element of the first kind is ended by the start of one of these, unless an element of the last kind lies between.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir", "td", "th", "table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "td", "th", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "td", "th", "table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
#: An end tag doesn't reach out of these.
SCOPE = {"table": frozenset(["template"]), "tr": frozenset(["table"]), "tbody": frozenset(["table"])}
DEFAULT_SCOPE = frozenset(["td", "th", "caption", "template"])

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)([^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^>]*+)>|<[!?/][^>]*+>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I) for tag in RAW}
_HAS_DIGIT = re.compile(r"\d")


class Node:
    """A block element: ``label`` is the tag with its stable class and id names, ``kids`` are nodes and ``(text, in_link)`` pieces."""

    __slots__ = ("tag", "label", "names", "role", "kids", "inline")

    def __init__(self, tag: str, label: str, names: tuple[str, ...] = (), role: str = "", inline: bool = False):
        self.tag, self.label, self.names, self.role, self.inline = tag, label, names, role, inline
        self.kids: list = []


def _attributes(tag: str, raw: str) -> tuple[str, tuple[str, ...], str]:
    """Label, class and id names, role. Names with digits are left out of the label: they number pages and items."""
    if "=" not in raw:
        return tag, (), ""
    names, role = [], ""
    for m in _ATTRIBUTE.finditer(raw):
        value = html.unescape(m.group(2) or m.group(3) or m.group(4) or "")
        if m.group(1).lower() == "role":
            role = value.strip().lower()
        else:
            names += value.split()
    stable = sorted({n for n in names if not _HAS_DIGIT.search(n)})
    return tag + "".join(f".{n}" for n in stable) + (f"[{role}]" if role else ""), tuple(names), role


def parse(page: str, wanted_inline) -> Node:
    """The tree of ``page``. Inline elements for which ``wanted_inline(names)`` holds become nodes too."""
    root = Node("#root", "#root")
    stack: list[tuple[Node, int]] = [(root, 0)]
    link = 0
    top = root
    at, n = 0, len(page)

    def text(piece: str) -> None:
        if piece:
            top.kids.append((html.unescape(piece) if "&" in piece else piece, link > 0))

    def pop_to(depth: int) -> None:
        nonlocal top, link
        link = stack[depth][1]
        del stack[depth:]
        top = stack[-1][0]

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m.group(2) or m.group(5)
        if not tag:
            continue
        tag = tag.lower()
        closing = m.group(1) or m.group(4)
        raw = m.group(3) or m.group(6) or ""
        if closing:
            if tag in INLINE:
                if tag == "a":
                    link = max(0, link - 1)
                # a wanted inline element ends here; others have no node
                for d in range(len(stack) - 1, 0, -1):
                    own = stack[d][0]
                    if not own.inline:
                        break
                    if own.tag == tag:
                        pop_to(d)
                        break
                continue
            stop = SCOPE.get(tag, DEFAULT_SCOPE)
            for d in range(len(stack) - 1, 0, -1):
                own = stack[d][0].tag
                if own == tag:
                    pop_to(d)
                    break
                if own in stop and tag not in ("body", "html", "table"):
                    break
            else:
                if tag == "p":
                    top.kids.append(Node("p", "p"))
            continue
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                if top.tag == "p":
                    pop_to(len(stack) - 1)
                top.kids.append(Node("hr", "hr"))
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in INLINE or tag not in KNOWN_BLOCKS:
            if tag == "a":
                link = link + 1 if not raw.endswith("/") else link
            nested = top.inline and top.tag == tag
            if nested or ("=" in raw and tag not in ("a", "font")):
                label, names, role = _attributes(tag, raw)
                if nested or wanted_inline(names, role):
                    own = Node(tag, label, names, role, inline=True)
                    top.kids.append(own)
                    stack.append((own, link))
                    top = own
            continue
        if tag in CLOSES_P:
            while top.inline and len(stack) > 1:
                pop_to(len(stack) - 1)
            if top.tag == "p" or (tag in HEADINGS and top.tag in HEADINGS):
                pop_to(len(stack) - 1)
        if tag in IMPLIED_END:
            ends, bound = IMPLIED_END[tag]
            for d in range(len(stack) - 1, 0, -1):
                own = stack[d][0].tag
                if own in ends:
                    pop_to(d)
                    if tag != "optgroup":
                        break
                elif own in bound:
                    break
        label, names, role = _attributes(tag, raw)
        own = Node(tag, label, names, role)
        top.kids.append(own)
        stack.append((own, link))
        top = own
    return root
