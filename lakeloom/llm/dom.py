"""A small tolerant HTML tree and simple tree matching."""

from __future__ import annotations

import html
import re

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Element kinds of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead
 tr ul""".split())
#: Elements nested deeper become siblings, as in browsers.
DEPTH = 150
#: An opening tag ends open elements of these kinds, up to the nearest element of the second kinds.
_CELL = frozenset({"td", "th"})
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": (_CELL, {"table", "tr"}), "th": (_CELL, {"table", "tr"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "body": ({"head"}, set())}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth", "shape", "size", "text")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.depth: int = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []
        self.shape = self.size = 0
        self.text = ""

    def elements(self) -> list[Node]:
        return [c for c in self.children if not isinstance(c, str)]

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(self.attrs)}


def parse(page: str) -> Node:
    """The element tree; comments, scripts, styles and other raw text are left out, what is not closed ends where it must."""
    root = here = Node("#root", "", None)
    at, end = 0, len(page)
    while at < end:
        token = TOKEN.search(page, at)
        if token is None:
            here.children.append(html.unescape(page[at:]))
            break
        if token.start() > at:
            here.children.append(html.unescape(page[at:token.start()]))
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            if tag != "p" or _open(here, "p"):
                node = _open(here, tag)
                if node is not None:
                    here = node.parent
            continue
        if tag in BLOCK:
            node = _open(here, "p", stop=frozenset({"table", "td", "th", "button", "object", "caption"}))
            if node is not None:
                here = node.parent
        if tag in ENDS:
            kinds, scope = ENDS[tag]
            node, found = here, None
            while node.parent is not None and node.tag not in scope:
                if node.tag in kinds:
                    found = node
                node = node.parent
            if found is not None:
                here = found.parent
        node = Node(tag, token[3], here)
        here.children.append(node)
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and (tag in BLOCK or not token[3].rstrip().endswith("/")) and node.depth < DEPTH:
            here = node
    return root


def _open(node: Node, tag: str, stop: frozenset[str] = frozenset()) -> Node | None:
    while node.parent is not None:
        if node.tag == tag:
            return node
        if node.tag in stop:
            return None
        node = node.parent
    return None


def measure(root: Node) -> None:
    """Size, shape (equal for equal trees of tags) and text of every node, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += node.elements()
    for node in reversed(order):
        kids = node.elements()
        node.size = 1 + sum(c.size for c in kids)
        node.shape = hash((node.tag, tuple(c.shape for c in kids)))
        node.text = "".join(c if isinstance(c, str) else (f" {c.text} " if c.tag in BLOCK or c.tag == "br" else c.text) for c in node.children)


def matching(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes of the largest common top-down ordered tree of a and b (simple tree matching)."""
    pairs: list[tuple[Node, Node]] = []
    memo: dict[tuple[int, int], int] = {}
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.tag != y.tag:
            continue
        pairs.append((x, y))
        todo += _align(x, y, memo)
    return pairs


def _weight(x: Node, y: Node, memo: dict) -> int:
    if x.tag != y.tag:
        return 0
    if x.shape == y.shape:
        return x.size
    if x.size == 1 or y.size == 1:
        return 1
    key = (id(x), id(y))
    if key not in memo:
        memo[key] = 1 + sum(_weight(p, q, memo) for p, q in _align(x, y, memo))
    return memo[key]


def _align(x: Node, y: Node, memo: dict) -> list[tuple[Node, Node]]:
    """The best alignment of the children in order: equal ends first, dynamic programming between."""
    p, q = x.elements(), y.elements()
    head = 0
    while head < len(p) and head < len(q) and p[head].shape == q[head].shape:
        head += 1
    tail = 0
    while tail < len(p) - head and tail < len(q) - head and p[-1 - tail].shape == q[-1 - tail].shape:
        tail += 1
    out = list(zip(p[:head], q[:head], strict=True)) + list(zip(p[len(p) - tail:], q[len(q) - tail:], strict=True))
    p, q = p[head:len(p) - tail], q[head:len(q) - tail]
    if not p or not q:
        return out
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i, u in enumerate(p):
        row, above = best[i + 1], best[i]
        for j, v in enumerate(q):
            both = above[j] + _weight(u, v, memo) if u.tag == v.tag else 0
            row[j + 1] = max(above[j + 1], row[j], both)
    i, j = len(p), len(q)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((p[i], q[j]))
    return out
