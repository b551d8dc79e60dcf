"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by tag path: the names (with class, id and role) of the block elements from the root to the node; inline
elements share their block's path. For each path: characters of text a node, punctuation a node, the share of text outside links, and
whether its names say that it is no article text (navigation, footers, forms, adverts, notices, comments and so on). The ratios are smoothed
over the paths in page order and fused as a product. Two thresholds select: paths above a share of the mean are core, and the container that
holds most of the core is the article; in it, nodes on paths above a much lower share are content, so headings and short paragraphs
beside a long text stay. No path below the low share is content, wherever it stands.

Parsing, paths and weights take one pass each over tags and nodes, however deep or broken a page is.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.session import ship

#: Fixed values from the HTML standard: elements without content, with raw content, and those that are blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select option xmp noembed noframes canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose start ends an open paragraph, and what each list or table part ends.
ENDS_P = BLOCK - {"br", "body", "head", "html", "caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset("ul ol dl table div section article main aside nav footer header form body html".split())
#: Elements that never hold article text, and words of class, id and role values that say the same.
OUT = frozenset("nav footer aside form head button menu dialog label input search".split())
OUT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsbox banner sponsor sponsored sponsors promo promotion promoted nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside complementary footer foot contentinfo copyright cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist comment-list disqus respond reply replies pagination pager masthead header site-header page-header main-header top-header topbar hidden".split())
WRAPS = frozenset("has with no without is".split())
ARTICLE_OUT = frozenset("comment comments reply replies ad ads advert promo sponsored related teaser".split())
#: Words that say so only of an element that is mostly links.
SOFT_WORDS = frozenset("share sharing social toolbar widget related recommended recommendations promo side discussion".split())
ROLES_OUT = frozenset("navigation banner contentinfo complementary search dialog alert".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[^a-z0-9]+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")


class Node:
    """An element: out, if its names or those around it say that it is no article text; soft, if they do so should it be mostly links."""

    __slots__ = ("name", "label", "parent", "out", "soft", "depth", "link", "path")

    def __init__(self, name: str, label: str, parent: Node | None, out: bool, soft: bool = False):
        self.name, self.label, self.parent = name, label, parent
        self.out, self.soft = out or bool(parent and parent.out), soft or bool(parent and parent.soft)
        self.depth = parent.depth + 1 if parent else 0
        self.link = name == "a" or bool(parent and parent.link)
        self.path = 0


class Stack:
    """The open elements, with counts by name of all of them and of those in the innermost container."""

    def __init__(self, root: Node):
        self.nodes, self.open, self.inner = [root], Counter(), [Counter()]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.open[node.name] += 1
        self.inner[-1][node.name] += 1
        if node.name in SCOPES:
            self.inner.append(Counter())

    def pop(self) -> str:
        name = self.nodes.pop().name
        if name in SCOPES:
            self.inner.pop()
        self.open[name] -= 1
        self.inner[-1][name] -= 1
        return name

    def end(self, name: str) -> None:
        """Ends the nearest open element of that name; one that is no block only inside the innermost container."""
        if self.open[name] if name in BLOCK else self.inner[-1][name]:
            while self.pop() != name:
                pass

    def end_any(self, names: set[str]) -> None:
        """Ends the nearest open element with one of the names in the innermost container."""
        if any(self.inner[-1][n] for n in names):
            while self.pop() not in names:
                pass


def _marked(attributes: str) -> tuple[bool, bool, str]:
    """Whether class, id or role name something that is no article text, or is not if it is mostly links; class, id and role for the path."""
    out, soft, label = False, False, ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES_OUT:
            out, label = True, f"{label}#{name}"
        if name in ("class", "id"):
            label += "." + value
            out = out or any(_names_out(p) for p in value.split())
            soft = soft or any(w in SOFT_WORDS for w in _WORDS.split(value))
    return out, soft, label


def _names_out(token: str) -> bool:
    """A class or id token that is one of the words, begins with one, or ends with one; a heading block is no page header."""
    if token in OUT_WORDS:
        return True
    parts = [w for w in _WORDS.split(token) if w]
    if not parts or parts[0] in WRAPS:
        return False
    return parts[0] in OUT_WORDS - {"header", "side", "social"} or parts[-1] in OUT_WORDS - {"header"}


def _tag_end(page: str, at: int, gone: set[str]) -> int:
    """Place of the tag's ">", or the page's end. A quote without an end (``gone`` keeps which occur no more) is a plain character."""
    while (stop := _STOP.search(page, at)) and stop[0] != ">":
        at = stop.end()
        if stop[0] not in gone:
            other = page.find(stop[0], at)
            if other < 0:
                gone.add(stop[0])
            at = max(at, other + 1)
    return stop.start() if stop else len(page)


def text_nodes(page: str) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """(element, text with references decoded, number of its block) in page order, and all elements, parents first; raw elements and
    comments are left out."""
    root = Node("#root", "", None, False)
    stack, made, found, block, at, size = Stack(root), [root], [], 0, 0, len(page)
    paths, gone, ends, lower, text_from = {}, set(), {}, None, 0

    def text(upto: int) -> None:
        if upto > text_from:
            found.append((stack.nodes[-1], entities.unescape(page[text_from:upto]), block))

    while (start := page.find("<", at)) >= 0:
        m = _NAME.match(page, start + 1)
        if not m:
            if not page.startswith(("!", "?"), start + 1):
                at = start + 1  # a plain character
                continue
            mark = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
            end = page.find(mark, start + (4 if mark == "-->" else 2))
            text(start)
            at = text_from = size if end < 0 else end + len(mark)
            continue
        stop = _tag_end(page, m.end(), gone)
        text(start)
        at = text_from = min(size, stop + 1)
        name, attributes = m[2].lower(), page[m.end() : stop]
        if name in BLOCK:
            block += 1
        if m[1]:
            stack.end(name)
            continue
        closed = attributes.rstrip().endswith("/")
        if name in VOID:
            continue
        if name in RAW and not closed:
            lower = page.lower() if lower is None else lower
            if ends.get(name, 0) >= 0 and ends.get(name, 0) < at:
                ends[name] = lower.find(f"</{name}", at)
            at = text_from = size if ends[name] < 0 else min(size, _tag_end(page, ends[name], gone) + 1)
            continue
        if name in ENDS_P:
            stack.end_any({"p"})
        if name in ENDS_OWN:
            stack.end_any(ENDS_OWN[name])
        if name == "a":
            stack.end_any({"a"})
        out, soft, label = _marked(attributes) if attributes else (False, False, "")
        if name in ("html", "body", "main"):
            out = False
        elif name == "article":
            out = out and any(w in ARTICLE_OUT for w in _WORDS.split(label))
        elif name == "header":
            out = out or not (stack.open["article"] or stack.open["main"])
        parent = stack.nodes[-1]
        node = Node(name, name + label, parent, out or name in OUT, soft)
        inline = name not in BLOCK and node.out == parent.out and node.soft == parent.soft
        node.path = parent.path if inline else paths.setdefault((parent.path, node.label), len(paths) + 1)
        if not closed or name in BLOCK:
            made.append(node)
            stack.push(node)
    text(size)
    return found, made


def path_scores(nodes: list[tuple[Node, str, int]]) -> tuple[list[int], np.ndarray]:
    """Tag paths in page order and the fused, smoothed ratio of each.

    With c characters and m punctuation marks a node on the path, s the share of its text outside links (0.05 at least) and p its prior (0 for names
    that are no article text, or may be none where most of the text is links): smooth(c) * smooth(1 + m) * s * p * ln(1 + all characters)."""
    order: dict[int, list[float]] = {}
    for node, text, _ in nodes:
        n = len(text.strip())
        if not n:
            continue
        got = order.setdefault(node.path, [0, 0, 0, 0, 0, 0])
        got[0] += n
        got[1] += len(_MARKS.findall(text))
        got[2] += 1
        got[3] += n if node.link else 0
        got[4] |= node.out
        got[5] |= node.soft
    if not order:
        return [], np.empty(0)
    t = np.array(list(order.values()), dtype=np.float64)
    chars, marks, links = t[:, 0] / t[:, 2], t[:, 1] / t[:, 2], t[:, 3] / t[:, 0]
    prior = (t[:, 4] == 0) & ((t[:, 5] == 0) | (links < 0.5))
    weights = np.array([0.1, 0.8, 0.1])
    smooth = (lambda x: np.convolve(np.pad(x, 1, mode="edge"), weights, mode="valid")) if len(t) > 1 else (lambda x: x)
    return list(order), smooth(chars) * smooth(1 + marks) * np.maximum(1 - links, 0.05) * prior * np.log1p(t[:, 0])


def main_text(page: str | None, share: float = 0.5, low: float = 3e-4, low_elsewhere: float = 1e-2) -> str:
    """The article's text: blocks in page order joined by one space, white space inside a block turned into one space.

    share: of the mean score, from which a path is core; low: from which it is content inside an article or main element, low_elsewhere inside any
    other container. A null or empty page, or one without text outside menus, footers and the like, has the empty string.
    """
    if not page:
        return ""
    nodes, made = text_nodes(page)
    paths, scores = path_scores(nodes)
    mean = scores[scores > 0].mean() if (scores > 0).any() else 0.0
    score = dict(zip(paths, scores.tolist(), strict=True))
    weight = dict.fromkeys(map(id, made), 0)
    for node, text, _ in nodes:
        if score.get(node.path, 0.0) >= share * mean > 0:
            weight[id(node)] += len(text.strip())
    for node in reversed(made[1:]):
        weight[id(node.parent)] += weight[id(node)]
    total = weight[id(made[0])]
    if not total:
        return ""
    holders = [x for x in made if x.name in ("article", "main") and 2 * weight[id(x)] >= total] or [x for x in made if 10 * weight[id(x)] >= 8 * total]
    root = max(holders, key=lambda x: (x.depth, weight[id(x)]))
    while root.parent and root.name not in SCOPES:
        root = root.parent
    least = mean * (low if root.name in ("article", "main") else low_elsewhere)
    inside: set[int] = set()
    for node in made:
        if node is root or node.parent and id(node.parent) in inside:
            inside.add(id(node))
    blocks: dict[int, list[str]] = {}
    for node, text, block in nodes:
        if id(node) in inside and score.get(node.path, 0.0) >= least:
            blocks.setdefault(block, []).append(text)
        elif id(node) in inside and not text.strip():
            blocks.setdefault(block, []).append(text)
    return " ".join(x for x in (" ".join("".join(b).split()) for b in blocks.values()) if x)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(p) for p in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page; null html gives the empty text. Repeated rows give repeated
    rows, an empty table none; other columns are left out."""
    ship(pages.sparkSession)
    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return given.transform(mapped, _extract, "page_id long, url string, text string, n_chars long")
