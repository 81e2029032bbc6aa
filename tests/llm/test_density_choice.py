"""The choice of the main text against densities worked out node by node, from nested lists instead of a page."""

from __future__ import annotations

import math
import random

import pytest

from stockline.llm.html_text import main_text

INLINE = ("b", "i", "span")
HEADINGS = ("h1", "h2")


def size(text: str) -> int:
    return len("".join(text.split()))


def page(node) -> str:
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(page, node[1:]))}</{node[0]}>"


def walk(node, linked=False):
    """``(node or text, whether in a link)`` of everything below a node, itself included."""
    yield node, linked
    if not isinstance(node, str):
        for child in node[1:]:
            yield from walk(child, linked or node[0] == "a")


def facts(node, linked=False):
    texts = [(size(x), k) for x, k in walk(node, linked) if isinstance(x, str)]
    tags = [x[0] for x, _ in walk(node, linked) if not isinstance(x, str)][1:]
    return sum(s for s, _ in texts), sum(t not in INLINE for t in tags), sum(s for s, k in texts if k), tags.count("a")


def formula(chars, tags, links, link_tags, share):
    if not chars:
        return 0.0
    weight = math.log(chars / max(links, 1) * max(tags, 1) / max(link_tags, 1))
    base = math.log(chars / max(chars - links, 1) * max(links, 1) + share * chars + math.e)
    return chars / max(tags, 1) * max(0.0, weight) / math.log(base)


def blocks(node):
    """The block children of a node, through inline elements and links, and the unlinked text between them."""
    found, own = [], 0
    for child in node[1:]:
        if isinstance(child, str):
            own += size(child)
        elif child[0] in INLINE:
            inner, text = blocks(child)
            found, own = found + inner, own + text
        elif child[0] != "a":
            found.append(child)
    return found, own


def naive(body) -> str:
    """Main text of a body without article, main, links around blocks, or names."""
    total, _, links, _ = facts(body)
    if not total:
        return ""
    share = links / total
    density = lambda x: formula(*facts(x), share)

    def summed(node):
        if node[0] in INLINE or node[0] == "a":
            return 0.0
        inner, own = blocks(node)
        return sum(map(density, inner)) + formula(own, 1, 0, 0, share) if inner else density(node)

    def nodes(node):
        return [x for x, _ in walk(node) if not isinstance(x, str) and facts(x)[0]]

    def densest(node):
        return max(nodes(node), key=summed)  # the first of equals, outer before inner

    def route(node, to):
        if node is to:
            return [node]
        for child in node[1:]:
            if not isinstance(child, str) and (rest := route(child, to)):
                return [node, *rest]
        return []

    marked: set[int] = set()

    def mark(node):
        marked.update(id(x) for x, _ in walk(node) if not isinstance(x, str))

    top = densest(body)
    path = route(body, top)
    threshold = min(map(density, path))
    mark(top)
    todo = [body]
    while todo:
        node = todo.pop(0)
        if id(node) in marked or not facts(node)[0] or density(node) < threshold:
            continue
        mark(densest(node))
        todo += [x for x in node[1:] if not isinstance(x, str)]
    for up in reversed(path[:-1]):
        row = [x for x in up[1:] if not isinstance(x, str) and facts(x)[0]]
        held = [any(id(y) in marked for y, _ in walk(x) if not isinstance(y, str)) for x in row]
        for k, child in enumerate(row):
            after = held[k + 1:]
            leads = child[0] in HEADINGS and any(after) and all(x[0] in HEADINGS for x in row[k + 1:k + 1 + after.index(True)])
            if not held[k] and (any(held[:k]) and any(after) or leads) and 2 * facts(child)[2] <= facts(child)[0]:
                mark(child)

    def text(node):
        inner = "".join(text(x) if not isinstance(x, str) else x if id(node) in marked else "" for x in node[1:])
        return inner if node[0] in INLINE or node[0] == "a" else f" {inner} "

    return " ".join(text(body).split())


def drawn(draw: random.Random, depth: int):
    words = lambda most: " ".join("w" * draw.randint(1, 9) + str(draw.randint(0, 999)) for _ in range(draw.randint(1, most)))
    inline = lambda: draw.choice([words(12), words(40), ["b", words(5)], ["a", words(4)], ["span", words(3), ["i", words(2)]]])
    if depth == 0 or draw.random() < 0.4:
        return [draw.choice(["p", "p", "h2", "div"]), *(inline() for _ in range(draw.randint(0, 4)))]
    return [draw.choice(["div", "section"]), *(drawn(draw, depth - 1) if draw.random() < 0.9 else words(6) for _ in range(draw.randint(1, 5)))]


@pytest.mark.parametrize("seed", range(150))
def test_the_choice_is_that_of_densities_worked_out_node_by_node(seed):
    draw = random.Random(seed)
    body = ["body", *(drawn(draw, 3) for _ in range(draw.randint(1, 5)))]
    assert main_text(f"<html>{page(body)}</html>") == naive(body)


POST = "".join(f"<p>Paragraph {i} of the post says what happened, <b>at some length</b>, and what came of it afterwards.</p>" for i in range(5))
TEASERS = "".join(f"<div><a href=/{i}>Other story {i}</a><span>short</span></div>" for i in range(12))


@pytest.mark.parametrize("other", [TEASERS, "".join(f"<article><a href=/{i}>Story {i}</a></article>" for i in range(12))])
def test_density_alone_tells_the_post_from_the_rest(other):
    text = main_text(f"<body><div class=x1>{other}</div><div class=x2><h2>Head</h2>{POST}</div><div class=x3>{other}</div></body>")
    assert text.startswith("Head Paragraph 0") and text.endswith("afterwards.") and "tory" not in text


def test_an_article_does_not_make_the_text():
    """The densest text decides, not the element's name: a short article beside a long post without one."""
    text = main_text(f"<body><article><p><a href=/>Read this</a> too</p></article><div><h2>Head</h2>{POST}</div></body>")
    assert "Paragraph 4" in text and "Read this" not in text


def test_many_blocks_in_one_node_take_linear_time():
    text = main_text("<article><div>" + "<p>A word or two.</p><p></p>" * 40_000 + "</div></article>")
    assert text.count("two.") == 40_000
