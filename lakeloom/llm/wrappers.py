"""Main text of web pages by wrapper induction over pages of one host."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import table, text_of
from lakeloom.llm.dom import BLOCK, Node, matching, measure, parse

#: Pages that one wrapper is induced from at most, and characters of HTML.
GROUP_PAGES, GROUP_CHARS = 256, 8 << 20
#: Hosts that are dealt to several tasks at most: those with more than this fraction of all pages.
MOST_HOT = 10_000
#: A node is template if so many different pages have it with the same text, and this share of those that have it.
LEAST_PAGES, CONSTANT = 4, 0.8

# Element kinds, roles and words of class and id that mark what is not the article
ASIDE_TAGS = frozenset("""head script style noscript template nav footer aside form button select option textarea input label iframe svg
 canvas object embed dialog menu audio video map datalist""".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
ASIDE_WORDS = frozenset("""nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars aside ad ads
 adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsors sponsored promo promos promotion cookie
 cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login search searchbox share sharing
 social related recommended recommendations comment comments commentlist reply replies respond disqus discussion widget widgets
 pagination pager toolbar skip copyright""".split())
#: Never text of a page, wherever they stand; and blocks that a slot does not end in.
UNSEEN = frozenset("""head script style noscript template button select option textarea input label iframe svg canvas object embed audio video
 map datalist""".split())
TEXT_TAGS = frozenset("p li td h1 h2 pre".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def is_unseen(node: Node) -> bool:
    """Whether the node is never read as text: controls, scripts, what is hidden."""
    if node.tag in UNSEEN:
        return True
    if not node.attrs:
        return False
    attrs = node.attributes()
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")


def is_aside(node: Node, in_article: bool, names: bool = True) -> bool:
    """Whether the node is by kind, role or (with ``names``) words of class and id something else than article."""
    if node.tag in ASIDE_TAGS or (node.tag == "header" and not in_article):
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main") and "comment" not in node.attrs.lower():
        return False
    attrs = node.attributes()
    if is_unseen(node) or attrs.get("role", "").lower() in ASIDE_ROLES:
        return True
    words = {w.lower() for w in _WORD.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
    return names and bool(words & ASIDE_WORDS)


def _plain(text: str) -> str:
    return " ".join(text.split())


def _is_mark(node: Node) -> bool:
    return node.tag in ("article", "main") or 'role="main"' in node.attrs


class Wrapper:
    """What the pages of one host share: constant nodes of the first page's tree, and how many different pages tell."""

    def __init__(self, trees: list[Node]) -> None:
        seen: set[str] = set()
        different = [t for t in trees if not ((own := _own_text(t)) in seen or seen.add(own))]
        self.pivot = different[0] if different else None
        self.pairs: dict[int, list[tuple[Node, Node]]] = {}
        texts: dict[int, Counter] = {}
        for tree in different:
            self.pairs[id(tree)] = matching(self.pivot, tree)
            for own, node in self.pairs[id(tree)]:
                texts.setdefault(id(own), Counter())[_plain(node.text)] += 1
        #: Whether enough pages differ for what is not constant to be a slot; else marks and names decide alone.
        self.tells = len(different) >= LEAST_PAGES
        inside = _below_marks(self.pivot) if different else set()
        self.constant = {}
        for key, counts in texts.items():
            text, most = counts.most_common(1)[0]
            pages = len(different) if key in inside else counts.total()  # near copies of an article share what others lack
            if text and most >= LEAST_PAGES and most >= CONSTANT * pages:
                self.constant[key] = text

    def template(self, tree: Node) -> set[int]:
        """Nodes of a page that are constant on its host."""
        if not self.constant:
            return set()
        pairs = self.pairs.get(id(tree)) or matching(self.pivot, tree)
        return {id(node) for own, node in pairs if self.constant.get(id(own)) == _plain(node.text)}


def _nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.elements())


def _own_text(tree: Node) -> str:
    """What tells pages apart: the text of the marked containers, else of the whole page, so that copies count once."""
    return "\n".join(n.text for n in _nodes(tree) if _is_mark(n)).strip() or tree.text


def _below_marks(root: Node) -> set[int]:
    return {id(n) for m in _nodes(root) if _is_mark(m) for n in _nodes(m)}


def _main_path(root: Node, template: set[int]) -> list[Node]:
    """From the root down to the main slot: always the child that holds at least half of the text which is not template.

    What is marked as article weighs ten times as much, what is named as something else a tenth.
    """
    weight: dict[int, float] = {}
    kind: dict[int, float] = {id(root): 1.0}
    order = []
    stack = [root]
    while stack:
        node = stack.pop()
        if id(node) in template or node.tag in UNSEEN:
            continue
        order.append(node)
        for child in node.elements():
            own = kind[id(node)]
            kind[id(child)] = 10.0 if own == 10.0 or _is_mark(child) else 0.1 if own == 0.1 or is_aside(child, False) else 1.0
            stack.append(child)
    for node in reversed(order):
        weight[id(node)] = sum(len(c.strip()) * kind[id(node)] if isinstance(c, str) else weight.get(id(c), 0.0) for c in node.children)
    path, total = [root], weight.get(id(root), 0.0)
    while total > 0:
        best = max(path[-1].elements(), key=lambda c: weight.get(id(c), 0.0), default=None)
        if best is None or best.tag not in BLOCK or best.tag in TEXT_TAGS or weight.get(id(best), 0.0) < 0.5 * total:
            break
        path.append(best)
        if _is_mark(best):
            break
    return path


def main_blocks(root: Node, template: set[int], tells: bool) -> list[str]:
    """Texts of a page's blocks in order, without template and without what is by kind, role or name something else.

    Kinds and names are a tie-break: they discard nothing that leads to the
    main slot, and nothing that varies inside it. Outside of marked containers
    blocks stay where the wrapper tells that they vary, unless they are mostly
    links; where it cannot tell, a page's marks decide.
    """
    path = _main_path(root, template)
    kept = {id(n) for n in path}
    if tells:  # a varying article is kept whatever the nodes around it are called
        for node in _nodes(root):
            up = node.parent
            if _is_mark(node) and not _aside_above(node, template, kept):
                while up is not None:
                    kept.add(id(up))
                    up = up.parent
    marks = False
    stack = [root]
    while stack and not marks:
        node = stack.pop()
        if id(node) in template or (id(node) not in kept and is_aside(node, False)):
            continue
        marks = _is_mark(node) and bool(_plain(node.text))
        stack += node.elements()
    only = "article" if marks and not tells else ""
    if only and not any(n.tag == "article" and not _aside_above(n, template, kept, names=True) for n in _nodes(root)):
        only = "main"
    slot = path[-1] if not marks and tells and path[-1].tag not in ("#root", "html", "body") else None

    out: list[str] = []
    line: list[str] = []
    linked = [0, False]

    def flush() -> None:
        text = _plain("".join(line))
        if text and (linked[1] or linked[0] < 0.6 * len(text)):
            out.append(text)
        line.clear()
        linked[0], linked[1] = 0, False

    todo: list[tuple[Node | str | None, bool, bool, bool]] = [(root, False, False, False)]
    while todo:
        node, link, inside, in_slot = todo.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            if inside or not only:
                line.append(node)
                linked[0] += len(node.strip()) if link else 0
                linked[1] = linked[1] or inside
        else:
            named = id(node) not in kept and (
                is_unseen(node) if tells and inside else is_aside(node, inside, names=not in_slot))
            block = node.tag in BLOCK
            if block:
                flush()
            if named or id(node) in template:
                continue
            if block:
                todo.append((None, False, False, False))
            if node.tag == "br":
                line.append(" ")
            begins = _is_mark(node) and (not only or (node.tag == "article") == (only == "article"))
            below = (link or node.tag == "a", inside or begins, in_slot or node is slot)
            todo += [(c, *below) for c in reversed(node.children)]
    flush()
    return out


def _aside_above(node: Node, template: set[int], kept: set[int], names: bool = False) -> bool:
    """Whether a node stands in template or in something that is not the article by kind or role (with ``names`` also by name)."""
    up = node
    while up is not None:
        if id(up) in template or (id(up) not in kept and is_aside(up, False, names=names)):
            return True
        up = up.parent
    return False


def extract_group(pages: list[str]) -> list[str]:
    """The main text of each of a few pages of one host."""
    trees = [parse(p) for p in pages]
    for tree in trees:
        measure(tree)
    wrapper = Wrapper(trees)
    return ["\n".join(main_blocks(tree, wrapper.template(tree), wrapper.tells)) for tree in trees]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size, last = 0, None

    def done(share: float) -> Iterator[pa.RecordBatch]:
        """Extracts the first ``share`` of the pages held, in groups of even size."""
        nonlocal held, size
        pages, held = held[:math.ceil(len(held) * share)], held[math.ceil(len(held) * share):]
        whole = sum(len(r[4]) for r in pages)
        size -= whole
        groups = max(1, min(max(-(-len(pages) // GROUP_PAGES), -(-whole // GROUP_CHARS)), len(pages) // LEAST_PAGES))
        cuts = [len(pages) * k // groups for k in range(groups + 1)]
        for rows in (pages[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)):
            texts = extract_group([r[4] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.string()),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "page_id", "url", "html")), strict=True):
            if held and row[:2] != last:
                yield from done(1)
            elif len(held) >= 2 * max(GROUP_PAGES, LEAST_PAGES) or (size >= 2 * GROUP_CHARS and len(held) >= 2 * LEAST_PAGES):
                yield from done(0.5)
            last = row[:2]
            held.append(row)
            size += len(row[4])
    if held:
        yield from done(1)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The article of every page: id, url, ``text`` (blocks joined by line feeds) and ``n_chars``.

    Pages are dealt by host, a host with more than ``GROUP_PAGES`` pages to
    groups of even size, and each group induces its wrapper: the element trees
    of all its different pages are aligned with the first one by simple tree
    matching. A node with the same text on nearly all of them is template and
    left out on every page, also inside ``<article>`` or ``<main>``; what varies
    is a slot. The main slot is where most of the rest stands. Marks, element
    kinds and names (menus, headers, footers, sidebars, notices, adverts,
    forms, comments, ...) break ties: they discard other nodes, but none that
    leads to the main slot and none that varies inside a marked one. Pages with
    the same article count once for the wrapper, so copies keep their text.

    Defined results: null pages and pages without text give an empty text; a
    null or malformed URL counts as a host of its own kind; pages alone on
    their host go by marks and names only, as do pages in groups of fewer than
    ``LEAST_PAGES`` different ones; unclosed elements end where the next
    block begins, a tag or comment cut off at the end of the page is dropped.
    Copies of a page count once for the wrapper. Repeated rows repeat. An empty
    table gives an empty result. Only the three columns named are read.
    """
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    slim = slim.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)))
    share = -(-slim.count() // MOST_HOT)
    hot = slim.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") > max(2 * GROUP_PAGES, share))
    return (slim.join(F.broadcast(hot), "host", "left")  # fewer than MOST_HOT hosts can have so many pages
            .withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce(F.ceil(F.col("n") / (2 * GROUP_PAGES)), F.lit(1))).cast("int"))
            .select("host", "part", "page_id", "url", "html")
            .repartition("host", "part").sortWithinPartitions("host", "part", "page_id", "url")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
            .withColumnsRenamed({"page_id": id_col, "url": url_col}))


def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
