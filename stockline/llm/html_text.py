"""Main text of web pages by composite text density.

For every node of the page's tree the operator counts characters, tags, link
characters and link tags of the subtree, and from them the composite density:
characters per tag, adjusted by the logarithm of how rarely the node links,
to a base that grows with the share of linked text. Densities of a node's
children are summed; the node with the largest sum holds the main text. The
smallest density on the path from the body to that node is the threshold: other
branches at or above it belong to the text as well. Where the chosen node lies in an
``article`` or ``main`` element, branches outside of it count a quarter of their density.
Beside the path to the chosen node (within that element, if there is one) the text grows to
short blocks between blocks of the text and to headings that lead to one, unless half of them is linked.

Before counting, elements that never hold main text are left out: scripts,
styles, navigation, asides, footers, forms and their controls, page headers, hidden
elements, comment sections and comments with all they hold (unless that is the page's
``h1`` or ``main``, or all its text), and elements whose class, id or role names an
advert, menu, sidebar, notice or the like, if they do not hold the article itself. On
pages without an article of some length, those with half of the unlinked text or more
are left to the densities.

Defined cases: null or empty html gives an empty text; html without a body is
read as one; unclosed tags, comments and attributes end where a browser would
end them or at the end of the page; text is never cut.
"""

from __future__ import annotations

import html as entities
import math
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCHEMA = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>"
    r"""|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<bad>[a-zA-Z][^\s/>]*)(?P<badattrs>[^>]*)>", re.S)
_ATTR = re.compile(r"""(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names of the HTML standard, and names that pages give to what is not main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul".split())
DROPPED = frozenset(
    "head script style noscript template iframe noembed noframes object embed svg canvas math audio video map nav aside footer "
    "form button select option textarea input datalist dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup social share sharing related recommended recommendations comment comments disqus respond replies "
    "widget widgets login pagination pager copyright disclaimer toolbar skip".split())
COMMENT_WORDS = frozenset("comment comments disqus respond replies".split())
# Words around them that tell of the whole page: has-comments, comments-open.
_BEFORE_STATE, _AFTER_STATE = frozenset("no has with without hide show".split()), frozenset("open closed on off enabled disabled".split())
# Shares of the page's unlinked text: what an element holds that its name cannot drop, and articles that make names safe.
LARGE_SHARE, ARTICLE_SHARE = 1 / 2, 1 / 4
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
# What the density of a branch counts for where the densest node lies in an article or main element and the branch does not.
OUTSIDE_WEIGHT = 1 / 4
CLOSES = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"])}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}


def _names_comments(value: str) -> bool:
    for token in value.split():
        words = re.findall("[a-z0-9]+", token)
        if words and (words[0] in COMMENT_WORDS and words[-1] not in _AFTER_STATE or words[-1] in COMMENT_WORDS and words[0] not in _BEFORE_STATE):
            return True
    return False


def _named_out(attrs: str) -> tuple[bool, bool, bool]:
    """Whether the attributes hide the element, name it as something else than main text, and name it as comments."""
    hidden = named = comments = False
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif key == "role":
            named |= value in DROPPED_ROLES
        elif key in ("class", "id"):
            named |= not DROPPED_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", value))
            comments |= named and _names_comments(value)
    return hidden, named, comments


class _Tree:
    """Nodes in page order: tag, parent, end of the subtree, and how the node is left out."""

    def __init__(self, page: str) -> None:
        self.tags, self.parents, self.ends, self.outs = ["#page"], [-1], [0], [0]
        self.pieces: list[tuple[int, str]] = []
        self._stack, self._open = [0], {"#page": 1}
        at, size = 0, len(page)
        while at < size:
            found = _TOKEN.search(page, at)
            if found is None:
                self._text(page[at:])
                break
            if found.start() > at:
                self._text(page[at:found.start()])
            at = found.end()
            tag, attrs = found["open"] or found["bad"], found["attrs"] or found["badattrs"] or ""
            if tag:
                at = self._start(tag.lower(), attrs, page, at)
            elif found["close"]:
                self._end(found["close"].lower())
        while self._stack:
            self._pop()

    def _text(self, text: str) -> None:
        self.pieces.append((self._stack[-1], entities.unescape(text) if "&" in text else text))

    def _pop(self) -> None:
        node = self._stack.pop()
        self._open[self.tags[node]] -= 1
        self.ends[node] = len(self.tags)
        if self.tags[node] in BLOCK:
            self.pieces.append((-1, " "))

    def _close_implied(self, tag: str) -> None:
        for name, closers in CLOSES.items():
            if tag in closers and self._open.get(name):
                for depth in range(len(self._stack) - 1, 0, -1):
                    open_tag = self.tags[self._stack[depth]]
                    if open_tag == name:
                        while len(self._stack) > depth:
                            self._pop()
                        break
                    if open_tag in _SCOPE.get(name, ("table", "td", "th", "button", "object")):
                        break

    def _start(self, tag: str, attrs: str, page: str, at: int) -> int:
        if tag in ("html", "body", "head") and self._open.get(tag):
            return at
        if tag in BLOCK or tag in ("option", "optgroup"):
            self._close_implied(tag)
            self.pieces.append((-1, " "))
        node = len(self.tags)
        hidden, named, comments = _named_out(attrs) if attrs and not attrs.isspace() else (False, False, False)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.ends.append(node + 1)
        self.outs.append(2 if hidden or tag in DROPPED and tag != "form" else 3 if comments else 1 if named or tag == "form" or tag == "header" else 0)
        if tag in VOID:
            return at
        self._stack.append(node)
        self._open[tag] = self._open.get(tag, 0) + 1
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            self._pop()
        return at

    def _end(self, tag: str) -> None:
        if self._open.get(tag) and tag not in ("body", "html"):
            while self.tags[self._stack[-1]] != tag:
                self._pop()
            self._pop()


def _unlinked(tree: _Tree, keep: list[bool]) -> list[int]:
    """Characters outside links in the subtree of each node that stays."""
    n = len(tree.tags)
    chars, linked = [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parents[i]] or tree.tags[i] == "a"
    for node, text in tree.pieces:
        if node >= 0 and keep[node] and not linked[node]:
            chars[node] += len("".join(text.split()))
    for i in range(n - 1, 0, -1):
        chars[tree.parents[i]] += chars[i]
    return chars


def _holders(tree: _Tree, keep: list[bool], tags: tuple[str, ...]) -> list[bool]:
    """Whether a node is or holds an element of ``tags`` that stays."""
    holds = [k and t in tags for k, t in zip(keep, tree.tags, strict=True)]
    for i in range(len(holds) - 1, 0, -1):
        holds[tree.parents[i]] |= holds[i]
    return holds


def _kept(tree: _Tree, by_name: bool) -> list[bool]:
    """Which nodes stay; ``by_name``: comments and elements with telling names go too, unless they hold the article or much text."""
    def without(out: list[bool]) -> list[bool]:
        keep = [True] * len(out)
        for i in range(1, len(out)):
            keep[i] = keep[tree.parents[i]] and not out[i]
        return keep

    out = [o == 2 for o in tree.outs]
    keep = without(out)
    whole = ("html", "body")
    if by_name and 3 in tree.outs:
        head = _holders(tree, keep, ("h1", "main"))
        out = [gone or o == 3 and t not in whole and not h for gone, o, t, h in zip(out, tree.outs, tree.tags, head, strict=True)]
        keep = without(out)
    if by_name and not {1, 3}.isdisjoint(tree.outs):
        core, chars = _holders(tree, keep, ("article", "main", "h1")), _unlinked(tree, keep)
        held, i = 0, 1
        while i < len(chars):
            top = keep[i] and tree.tags[i] in ("article", "main")
            held += chars[i] if top else 0
            i = tree.ends[i] if top else i + 1
        most = math.inf if held and held >= ARTICLE_SHARE * chars[0] else LARGE_SHARE * chars[0]
        small = [c < most or not c for c in chars]
        out = [gone or o in (1, 3) and t not in whole and not c and s for gone, o, t, c, s in zip(out, tree.outs, tree.tags, core, small, strict=True)]
        keep = without(out)
    return keep


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, less the more of them are linked."""
    if not chars:
        return 0.0
    t, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * lc + share * chars + math.e)
    return chars / t * max(0.0, math.log(chars / lc * t / lt)) / math.log(base)


def _densities(tree: _Tree, keep: list[bool]) -> tuple[list[float], list[float], list[int], list[int]]:
    """Density, sum of the children's densities, characters and linked characters of each node.

    Elements inside a line are no children and, but for links, no tags: ``<p><b>`` is as dense as ``<p>``.
    Text that stands between a node's blocks counts as one child more; a node without blocks sums to its own density.
    """
    n = len(tree.tags)
    chars, tags, link_chars, link_tags, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    linked, block, around = [False] * n, [True] * n, [0] * n
    for i in range(1, n):
        up = tree.parents[i]
        linked[i] = linked[up] or tree.tags[i] == "a"
        block[i] = tree.tags[i] in BLOCK and tree.tags[i] not in VOID
        around[i] = up if block[up] else around[up]
    for node, text in tree.pieces:
        if node >= 0 and keep[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if linked[node]:
                link_chars[node] += size
            else:
                own[node if block[node] else around[node]] += size
    for i in range(n - 1, 0, -1):
        if keep[i]:
            up = tree.parents[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + (block[i] or tree.tags[i] == "a")
            link_tags[up] += link_tags[i] + (tree.tags[i] == "a")
    share = link_chars[0] / max(chars[0], 1)
    density = [_density(c, t, lc, lt, share) if k else 0.0 for k, c, t, lc, lt in zip(keep, chars, tags, link_chars, link_tags, strict=True)]
    sums, leaf = [0.0] * n, list(block)
    for i in range(1, n):
        if keep[i] and block[i]:
            leaf[around[i]] = False
            sums[around[i]] += density[i]
    for i in range(n):
        if leaf[i]:
            sums[i] = density[i]
        elif block[i] and own[i]:
            sums[i] += _density(own[i], 1, 0, 0, share)
    return density, sums, chars, link_chars


def _marked(tree: _Tree, keep: list[bool]) -> list[bool] | None:
    """The nodes of the main text; None if no node that stays holds a character."""
    density, sums, chars, link_chars = _densities(tree, keep)
    n = len(tree.tags)
    if not chars[0]:
        return None
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        up = tree.parents[i]
        if keep[i] and chars[i] and (sums[best[i]] > sums[best[up]] or best[up] != up and sums[best[i]] == sums[best[up]]):
            best[up] = best[i]  # the first of equals, a node before those it holds
    top, marks = best[0], [False] * n

    def mark(node: int) -> None:
        marks[node:tree.ends[node]] = [True] * (tree.ends[node] - node)

    path, i, threshold, whole = [], top, density[top], 0
    while i > 0:
        if tree.tags[i] in ("article", "main") and (not whole or tree.tags[i] == "article"):
            whole = i
        threshold = min(threshold, density[i]) if tree.tags[i] != "html" else threshold
        i = tree.parents[i]
        path.append(i)

    def inside(node: int) -> bool:
        return whole <= node < tree.ends[whole]

    def children(node: int) -> list[int]:
        found, child = [], node + 1
        while child < tree.ends[node]:
            if keep[child] and chars[child]:
                found.append(child)
            child = tree.ends[child]
        return found

    mark(top)
    todo = [0]
    while todo:
        node = todo.pop()
        weight = 1 if inside(node) or node <= top < tree.ends[node] else OUTSIDE_WEIGHT
        if tree.tags[node] in ("#page", "html") or density[node] * weight >= threshold:
            if chars[node] and not marks[best[node]]:
                mark(best[node])
            todo += [x for x in children(node) if not marks[x]]
    # Short blocks around the chosen node: those between marked ones, and headings that lead to one.
    marked = [0, *accumulate(marks)]
    for up in path:
        if not inside(up):
            break
        row = children(up)
        held = [marked[tree.ends[x]] > marked[x] for x in row]
        first, last = held.index(True), len(held) - 1 - held[::-1].index(True)
        leads = True
        for k in range(last, -1, -1):
            heading = tree.tags[row[k]] in HEADINGS
            if not held[k] and (k > first or heading and leads) and 2 * link_chars[row[k]] <= chars[row[k]]:
                mark(row[k])
            leads = held[k] or heading and leads
    return marks


def main_text(page: str | None) -> str:
    """The main text of one page: blocks in page order, joined by single spaces."""
    if not page:
        return ""
    tree = _Tree(page)
    for by_name in (True, False):
        keep = _kept(tree, by_name)
        marks = _marked(tree, keep)
        if marks is not None:
            return " ".join("".join(t for i, t in tree.pieces if i < 0 or keep[i] and marks[i]).split())
    return ""


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; no shuffle, one page in memory at a time beside its batch."""

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return own.mapInArrow(run, SCHEMA)
