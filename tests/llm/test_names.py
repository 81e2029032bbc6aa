"""Names of elements and the main text."""

from __future__ import annotations

import pytest

from stockline.llm.html_text import main_text

POST = "".join(f"<p>Paragraph {i} of the post says what happened, at some length, and what came of it.</p>" for i in range(6))


@pytest.mark.parametrize("name", ["content with-sidebar", "no-sidebar", "post social", "entry related-on"])
def test_a_named_wrapper_keeps_the_main_text(name):
    text = main_text(f"<body><h1>T</h1><div class='{name}'>{POST}</div><div class=sidebar>Side words</div><div id=footer>Foot</div></body>")
    assert all(f"Paragraph {i} " in text for i in range(6)) and "Side" not in text and "Foot" not in text


@pytest.mark.parametrize("around", ["<article>%s</article>", "<div class='post'>%s</div>", "<article class='post comments-open'>%s</article>"])
def test_a_long_thread_is_not_the_main_text(around):
    thread = "".join(f"<li><article class='comment'><p>Reader {i} says a lot, and then some more, about the post above.</p></article></li>" for i in range(200))
    text = main_text(f"<body><h1>T</h1>{around % POST}<div id='comments'><ol>{thread}</ol></div></body>")
    assert all(f"Paragraph {i} " in text for i in range(6)) and "Reader" not in text
    assert "Reader 199 " in main_text(f"<body><div id='comments'><ol>{thread}</ol></div></body>")


def test_an_advert_longer_than_a_short_article_goes():
    assert main_text("<body><div class='ad'>Buy this now, and that too.</div><article><h1>Head</h1><p>Short post.</article></body>") == "Head Short post."
