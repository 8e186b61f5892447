"""Pages whose article lies inside wrappers with the words or elements of boilerplate."""

import pytest

from loamfold.llm.main_text import main_text

from .test_main_text import ARTICLE, WANT

LONG = "This is a paragraph of some length that tells a story, with commas and a full stop at the end of it."
AROUND = "<nav><a href=/a>Home</a></nav><div class=sidebar><p>Related stories that are long enough to look like text.</p></div>{}<footer>&copy; site</footer>"


@pytest.mark.parametrize("opening, closing", [("<div class='layout with-sidebar'>", "</div>"), ("<div class=no-comments>", "</div>"), ("<div id=page-header>", "</div>"), ("<form action=/>", "</form>"), ("<div class=has-share><form><main class='no-sidebar'>", "</main></form></div>")])
def test_the_article_stays(opening, closing):
    page = f"<html><body>{opening}{AROUND.format(ARTICLE)}{closing}</body></html>"
    assert main_text(page)[0] == WANT
    story = "<div class='content'>" + f"<p>{LONG}</p>" * 4 + "</div>"
    plain = f"<html><body>{opening.replace('main', 'div')}{AROUND.format(story)}{closing.replace('main', 'div')}</body></html>"
    assert main_text(plain)[0] == "\n".join([LONG] * 4)


def test_words_inside_and_on_the_article():
    body = f"<p>{LONG}</p>" * 3
    assert main_text(f"<body><article class='post has-comments'>{body}</article></body>")[0] == "\n".join([LONG] * 3)
    assert main_text(f"<body><article><div class='content has-share'>{body}</div></article></body>")[0] == "\n".join([LONG] * 3)


def test_long_comments_and_cards_still_go():
    comments = "<div id=comments>" + "<p>Reader: I do not agree with a word of this long piece, and I say so at length.</p>" * 20 + "</div>"
    cards = "<div class=related><article><p>Another story, told in short, of which this is the beginning.</p></article></div>"
    assert main_text(f"<body><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>{comments}{cards}</body>")[0] == "\n".join([LONG] * 3)
    assert main_text(f"<body><main><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>{comments}</main></body>")[0] == "\n".join([LONG] * 3)
