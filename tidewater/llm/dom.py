"""A page as a tree of block elements and text runs.

Inline elements do not make nodes: their text joins the run of the block
around them, formulas included.  Elements that show no text (scripts, images,
buttons) add nothing to a run and do not end it.  ``parse`` follows the HTML rules that matter for that: void
elements, elements whose content is not markup, implied end tags, stray and
missing end tags.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("script style head title noscript template svg annotation annotation-xml iframe object audio video canvas "
             "select button textarea datalist noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s "
             "samp small span strike strong sub sup time tt u var wbr input meta link "
             "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder "
             "mover munderover mmultiscripts mprescripts mtable mtr mtd maction menclose semantics".split())
ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hr main menu nav ol p pre section table ul".split())
#: start tag -> (tags that it ends, tags that such a search does not leave)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P_AT = set("table td th button caption object foreignobject noscript template canvas audio video".split())   # a p outside stays open

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Page:
    """Nodes in page order: parents come before children."""
    tag: list[str] = field(default_factory=list)        # "#text" for a text run
    parent: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)      # class, id and role of an element
    text: list[str] = field(default_factory=list)       # of a text run, white space collapsed
    linked: list[int] = field(default_factory=list)     # characters of it inside links

    def add(self, tag: str, parent: int, names: str = "", text: str = "", linked: int = 0) -> int:
        for column, value in zip((self.tag, self.parent, self.names, self.text, self.linked),
                                 (tag, parent, names, text, linked)):
            column.append(value)
        return len(self.tag) - 1


def parse(source: str) -> Page:
    page = Page()
    root = page.add("#page", -1)
    stack: list[tuple[str, int]] = [("#page", root)]     # open elements and their nodes
    run: list[str] = []
    linked = 0
    links = hidden = 0

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.add("#text", stack_node(), text=text, linked=min(linked, len(text)))
            run.clear()
        linked = 0

    def stack_node() -> int:
        return stack[-1][1]

    def text(raw: str) -> None:
        nonlocal linked
        if hidden or not raw:
            return
        plain = html.unescape(raw) if "&" in raw else raw
        run.append(plain)
        if links:
            linked += len(" ".join(plain.split()))

    def pop() -> None:
        nonlocal links, hidden
        tag, _ = stack[-1]
        if tag not in INLINE and tag not in UNSEEN and not hidden:
            flush()
        if tag == "a":
            links -= 1
        if tag in UNSEEN:
            hidden -= 1
        stack.pop()

    def close(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                while len(stack) > k:
                    pop()
                return

    at = 0
    n = len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        if m.start() > at:
            text(source[at:m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            if source.startswith("<![CDATA[", m.start()):
                text(html.escape(m.group()[9:].removesuffix("]]>"), quote=False))
            continue
        tag = name.lower()
        end, attributes = (m.group(1), m.group(3)) if m.group(2) else (m.group(4), m.group(6))
        if end:
            if tag == "br":
                run.append(" ") if not hidden else None
            elif tag not in VOID:
                close(tag)
            continue
        if tag == "br":
            if not hidden:
                run.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ENDS_P_AT:
                    break
                if stack[k][0] == "p":
                    while len(stack) > k:
                        pop()
                    break
        if tag in IMPLIED:
            ends, stop = IMPLIED[tag]
            for k in range(len(stack) - 1, 0, -1):
                if k >= len(stack):
                    continue
                if stack[k][0] in stop:
                    break
                if stack[k][0] in ends:
                    while len(stack) > k:
                        pop()
                    if tag != "tr":        # a row also ends its open cells
                        break
        if tag in INLINE:
            node = stack_node()
            if tag == "a":
                links += 1
        elif tag in UNSEEN or hidden:
            node = stack_node()
        else:
            flush()
            names = " ".join(a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(attributes))
            node = page.add(tag, stack_node(), names.lower())
        if tag in UNSEEN:
            hidden += 1
        stack.append((tag, node))
        if tag in RAW:
            stop_at = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = stop_at.start() if stop_at else n
    while len(stack) > 1:
        pop()
    flush()
    return page
