"""Main text: what a story keeps, what it never holds, deep pages, and its densities by a plain walk over the tree."""

import math
import random
import time

import pytest

from opslens.llm import html

STORY = "Words of a long paragraph that runs on and on for a while. " * 5


def page(inside, beside=""):
    return f"<body><article><h1>Title</h1><p>{STORY}</p>{inside}<p>{STORY}</p></article>{beside}</body>"


@pytest.mark.parametrize("name", ["social-policy", "ad-hoc", "share-price", "notice-of-death", "promo-code-law", "related-work", "menu-cost", "cookie-recipe"])
def test_names_that_hold_a_mark_and_more_do_not_cut_a_paragraph(name):
    assert "One sentence of the story." in html.main_text(page(f"<p class='{name}'>One sentence of the story.</p>"))


@pytest.mark.parametrize("name", ["ad", "share-buttons", "cookie-notice", "related-links", "text ad-slot"])
def test_names_that_are_marks_cut_a_paragraph(name):
    assert "Buy now" not in html.main_text(page(f"<p class='{name}'>Buy now</p>"))


@pytest.mark.parametrize("tag", sorted(html.CONTROLS))
def test_controls_in_a_sentence_are_text(tag):
    assert "then results in 42 points." in html.main_text(page(f"<p>It then results in <{tag}>42</{tag}> points.</p>"))
    assert "Press" not in html.main_text(page(f"<div><{tag}>Press</{tag}></div>"))
    assert "Press" not in html.main_text(page(f"<form><p>Name <{tag}>Press</{tag}></p></form>"))


def test_a_list_of_links_in_the_story_stays():
    sources = "<ul>" + "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(4)) + "</ul>"
    text = html.main_text(page(sources))
    assert [f"Source {i}" in text for i in range(4)] == [True] * 4


@pytest.mark.parametrize("thread", ["<section id='comments'>{}</section>", "<div class='comment-list'>{}</div>", "<div class='x comments'>{}</div>"])
def test_comments_longer_than_the_story_go(thread):
    comments = "".join(f"<article><p>{'A reader has much to say about this. ' * 40}</p></article>" for _ in range(5))
    text = html.main_text(page("", thread.format(comments)))
    assert text.split("\n\n") == ["Title", STORY.strip(), STORY.strip()]


@pytest.mark.parametrize("deep", [
    "<div>" * 20_000 + "<p>deep text</p>", "<ul>" * 20_000 + "<p>deep text", "<div>" * 20_000 + "</span>" * 20_000 + "deep text",
    "<main>" + "<header>" * 20_000 + "<h1>deep text</h1>"])
def test_deep_pages_take_linear_time(deep):
    began = time.monotonic()
    assert html.main_text(deep) == "deep text"
    assert time.monotonic() - began < 5


def plain_density(n, body):
    """chars, linked chars, tags, link tags, density and sum of a node by recursion."""
    own = sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
    below = [plain_density(c, None) for c in n.children if isinstance(c, html._Node) and not c.cut]
    chars = own + sum(b[0] for b in below)
    links = chars if n.tag == "a" else sum(b[1] for b in below)
    tags = sum(b[2] + 1 for b in below)
    link_tags = sum(b[3] + (b[4] == "a") for b in below)
    return chars, links, tags, link_tags, n.tag


def test_densities_and_best_subtrees_equal_a_plain_walk():
    rng = random.Random(5)

    def some(depth):
        if depth == 0 or rng.random() < 0.3:
            words = "word " * rng.randint(0, 30)
            return f"<a href=/>{words}</a>" if rng.random() < 0.4 else words
        return "".join(f"<div>{some(depth - 1)}</div>" for _ in range(rng.randint(1, 4)))

    for _ in range(40):
        tree = html._Tree(f"<body>{some(5)}</body>")
        body = next(n for n in tree.nodes if n.tag == "body")
        html._prune(tree.nodes)
        html._measure(tree.nodes, body)
        whole = plain_density(body, None)
        want = {}
        for n in tree.nodes:
            chars, links, tags, link_tags, _ = plain_density(n, None)
            assert (n.chars, n.links, n.tags, n.link_tags) == (chars, links, tags, link_tags)
            base = math.log(chars / max(chars - links, 1) * links + whole[1] / max(whole[0], 1) * chars + math.e)
            ratio = chars / max(links, 1) * max(tags, 1) / max(link_tags, 1)
            want[id(n)] = chars / max(tags, 1) * math.log(max(ratio, 1)) / math.log(max(base, math.e)) if chars else 0.0
            assert n.density == pytest.approx(want[id(n)])

        def total(n):
            below = [c for c in n.children if isinstance(c, html._Node)]
            return sum(want[id(c)] for c in below) if below else want[id(n)]

        def under(n):
            yield n
            for c in n.children:
                if isinstance(c, html._Node):
                    yield from under(c)

        for n in tree.nodes:
            assert n.best.total == pytest.approx(max(total(x) for x in under(n)))
