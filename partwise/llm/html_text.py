"""Main text of web pages by tree scoring.

A page is read once into a tree of block elements. Every run of text gives points for its length and
its commas to the elements above it, less the higher they are; an element's points count by the share
of its text outside links. The best element is kept with those siblings that look like it, or the
whole article element around it.

Elements that are no article by their tag are dropped while reading. Words in a class or id, and forms,
only make an element suspect: it is dropped unless it holds most of the text that is there to hold.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm.tables import in_slices

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
CLASSES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Elements of HTML by what they mean here.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "noembed", "noframes", "xmp"}
DROPPED = RAW | {"head", "nav", "header", "footer", "aside", "menu", "dialog", "button", "select", "option", "label", "fieldset", "canvas", "audio", "video"}
BLOCKS = DROPPED | set(
    "html body main article section form div p ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre "
    "h1 h2 h3 h4 h5 h6 figure figcaption address details summary center hgroup hr".split()
)
HEADINGS = {"h1", "h2", "h3"}
VOID = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CLOSES_P = BLOCKS - {"html", "body", "head", "option", "label", "button"}
# An opening tag ends these open elements, up to the given container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id or role that mark what is no article.
NOISE = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager header masthead banner footer sidebar aside complementary contentinfo "
    "widget related recommended comment comments disqus respond reply replies share sharing social cookie cookies "
    "consent gdpr notice notification alert newsletter subscribe signup login popup modal overlay search toolbar "
    "skip copyright".split()
)
NEVER_NOISE = {"html", "body", "article", "main"}
REPLIES = {"comment", "comments", "disqus", "respond", "reply", "replies"}
LANDMARKS = ("article", "main")
# A suspect element has to hold more than this share of the text around it to be kept: comments are often
# longer than what they comment on.
NEEDED, NEEDED_OF_REPLIES = 0.5, 0.9
# A form with less text than this is a form, not a page in a form.
LEAST_OF_FORM = 250


class Node:
    __slots__ = ("tag", "parent", "dropped", "needs", "points", "chars", "linked", "children")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, needs: float = 0.0) -> None:
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.needs = needs  # share of text that a suspect element needs; 0 for others
        self.points, self.chars, self.linked, self.children = 0.0, 0, 0, []
        if parent is not None:
            parent.children.append(self)

    @property
    def plain(self) -> int:
        return self.chars - self.linked


def _needs(tag: str, attrs: str) -> float:
    words = set()
    if attrs and tag not in NEVER_NOISE:
        words = {w.lower() for m in CLASSES.finditer(attrs) for w in WORD.findall(m[2] or m[3] or m[4] or "")} & NOISE
    if words & REPLIES:
        return NEEDED_OF_REPLIES
    return NEEDED if words or tag == "form" else 0.0


def read_page(source: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """All elements, parents first, and the runs of text with their elements and numbers of characters in links."""
    root = node = Node("html", None, False)
    nodes, open_tags = [root], Counter()
    runs: list[tuple[Node, str, int]] = []
    texts: list[str] = []
    links: list[str] = []
    in_link, at, raw_end = False, 0, None

    def flush() -> None:
        if texts:
            if not node.dropped:
                text = " ".join(html.unescape("".join(texts)).split())
                if text:
                    runs.append((node, text, min(len(text), len(" ".join(html.unescape("".join(links)).split())))))
            texts.clear()
            links.clear()

    def leave(upto: Node) -> None:
        nonlocal node, in_link
        flush()
        while True:
            gone, node = node, node.parent or root
            open_tags[gone.tag] -= 1
            if gone is upto:
                break
        in_link = False

    def opened(tags: set[str], stop: set[str]) -> Node | None:
        """The outermost open element of these tags inside the nearest container."""
        found, up = None, node if any(open_tags[t] for t in tags) else root
        while up is not root and up.tag not in stop:
            if up.tag in tags:
                found = up
            up = up.parent
        return found

    while True:
        m = TAG.search(source, at)
        text = source[at : m.start() if m else len(source)]
        if text:
            texts.append(text)
            if in_link:
                links.append(text)
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        attrs, closing = m["attrs"] or m["attrs2"] or "", m[0].startswith("</")
        if name not in BLOCKS:
            if name == "a":
                in_link = not closing
            if name in ("br", "img", "wbr") and name == "br":
                texts.append(" ")
            continue
        if closing:
            up = node if open_tags[name] else root
            while up is not root and up.tag != name:
                up = up.parent
            if up is not root:
                leave(up)
            continue
        flush()
        if name in CLOSES_P:
            stop = {"td", "th", "div", "section", "article", "main", "li", "blockquote", "body", "figure"}
            if p := opened({"p"}, stop):
                leave(p)
        if name in HEADINGS and node.tag in HEADINGS:
            leave(node)
        if name in ENDS and (old := opened(*ENDS[name])):
            leave(old)
        if name == "body" and (head := opened({"head"}, set())):
            leave(head)
        if name in VOID or name in ("html",):
            continue
        made = Node(name, node, node.dropped or name in DROPPED, _needs(name, attrs))
        nodes.append(made)
        if name in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|\\Z)|\\Z", re.I).search(source, at)
            at = end.end()
            continue
        node, in_link = made, False
        open_tags[name] += 1
    flush()
    return nodes, runs


def _measure(nodes: list[Node], runs: list[tuple[Node, str, int]]) -> None:
    """Sets the characters of each element, and those in links."""
    for node in nodes:
        node.chars = node.linked = 0
    for node, text, linked in runs:
        node.chars += len(text)
        node.linked += linked
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked


def _drop_suspects(nodes: list[Node]) -> None:
    """Drops suspect elements, but for those that hold most of the text of the landmark or page around them.

    One beside a landmark goes, unless it has a landmark too and far more text. One that holds a main
    element stays. A landmark counts if no suspect with less than half of the page's text is around it.
    """
    page = nodes[0].plain
    clean: dict[int, bool] = {}  # no small suspect and nothing dropped at or above
    around: dict[int, Node | None] = {}  # nearest landmark above
    inside = {id(n): [0, 0, False] for n in nodes}  # clean landmarks, their text, any main element
    for n in nodes:
        up = n.parent
        small = n.needs > 0 and 2 * n.plain <= page
        clean[id(n)] = not n.dropped and not small and (up is None or clean[id(up)])
        around[id(n)] = None if up is None else up if up.tag in LANDMARKS else around[id(up)]
    for n in reversed(nodes):
        own = inside[id(n)]
        if n.tag in LANDMARKS and clean[id(n)]:
            own[0], own[1] = 1, n.plain
        own[2] = own[2] or n.tag == "main" and not n.dropped
        if n.parent is not None:
            above = inside[id(n.parent)]
            above[0] += own[0]
            above[1] += own[1]
            above[2] = above[2] or own[2]
    all_marks, all_text, _ = inside[id(nodes[0])]

    def wraps(n: Node) -> bool:
        if 2 * n.linked > n.chars:
            return False
        marks, text, main = inside[id(n)]
        if main:
            return True
        landmark = around[id(n)]
        if landmark is None and all_marks > marks and (not marks or 5 * (all_text - text) >= n.plain):
            return False
        return n.plain > n.needs * (landmark or nodes[0]).plain and (n.tag != "form" or n.plain >= LEAST_OF_FORM)

    for n in nodes:
        n.dropped = n.dropped or n.parent is not None and n.parent.dropped or n.needs > 0 and not wraps(n)


def _score(nodes: list[Node], runs: list[tuple[Node, str, int]]) -> None:
    """Passes points to the elements above each run: a half to the next one, then a third each time."""
    for node, text, linked in runs:
        points = (1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "li", "figcaption"):
            points /= 4
        own = node.tag in ("div", "section", "article", "main", "body", "html", "td", "form")
        (node if own else node.parent or node).points += points
    below = dict.fromkeys(map(id, nodes), 0.0)
    for node in reversed(nodes):
        passed = node.points / 2 + below[id(node)] / 3
        node.points += below[id(node)]
        if node.parent is not None:
            below[id(node.parent)] += passed


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def main_text(source: str | None) -> str:
    """Blocks of the main text joined by empty lines; empty if there is none."""
    if not source:
        return ""
    nodes, runs = read_page(source)
    if any(n.needs for n in nodes):
        _measure(nodes, runs)
        _drop_suspects(nodes)
        runs = [run for run in runs if not run[0].dropped]
    if not runs:
        return ""
    _measure(nodes, runs)
    _score(nodes, runs)
    candidates = [n for n in nodes if n.points > 0 and not n.dropped and n.tag not in ("p", "tr", "table", "tbody", "ul", "ol", "html")]
    best = max(candidates, key=lambda n: n.points * (1 - _density(n)), default=nodes[0])
    landmark = best
    while landmark is not None and landmark.tag not in ("article", "main"):
        landmark = landmark.parent
    kept = {id(landmark or best)}
    top = landmark or best
    if top.parent is not None:
        least = max(10.0, 0.2 * top.points * (1 - _density(top)))
        for other in top.parent.children:
            if other is top or other.dropped or not other.chars:
                continue
            dense = _density(other)
            plain = other.tag == "p" and (dense < 0.25 if other.chars > 80 else dense == 0)
            if other.points * (1 - dense) >= least or landmark is None and (plain or other.tag in HEADINGS and dense < 0.3):
                kept.add(id(other))

    for node in nodes:
        if node.parent is not None and id(node.parent) in kept:
            kept.add(id(node))
    return "\n\n".join(text for node, text, _ in runs if id(node) in kept)


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id_col, url_col, text, n_chars) for each row of pages; n_chars counts code points.

    Null and empty pages, and pages without any text of their own, have an empty text. Ids and URLs may
    be null or repeated. Whole pages are read, however long; other columns are ignored.
    """
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def extract(batches):
        for batch in in_slices(batches):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return (
        picked.mapInArrow(extract, f"id {types[id_col]}, url {types[url_col]}, text string, n_chars long")
        .withColumnsRenamed({"id": id_col, "url": url_col})
    )
