"""Long notices, sidebars and comments go; headings and tables stay; pages whose tags never end take time in proportion."""

import time

import pytest

from loamfold.llm.main_text import main_text

LONG = "This is a paragraph of some length that tells a story, with commas and a full stop at the end of it."
NOTICE = "We and our partners store information on this device, and you may object to it at any time. "
READER = "<p>Reader: I do not agree with a word of this piece, and I say so at length here.</p>"
TWO = "The bridge was closed on Monday. It opens again next week."


@pytest.mark.parametrize("inner", ["", "<article>{}</article>", "<main>{}</main>"])
def test_long_comments_go(inner):
    story = f"<h1>Flood</h1><p>{LONG}</p>"
    page = f"<body><div>{story}</div><section id='comments'>{READER * 20}</section></body>"
    if inner:
        page = f"<body>{inner.format(story + f'<section id=comments>{READER * 20}</section>')}</body>"
    assert main_text(page)[0] == f"Flood\n{LONG}"


def test_long_notices_and_sidebars_go():
    assert main_text(f"<body><div class='cookie-consent'><p>{NOTICE * 6}</p></div><div class=post><p>{TWO}</p></div></body>")[0] == TWO
    assert main_text(f"<body><div class='cookie-consent'><p>{NOTICE * 60}</p></div><div class=post><p>{TWO}</p></div></body>")[0] == TWO
    assert main_text(f"<body><div class=sidebar>{f'<p>{LONG}</p>' * 9}</div><div class=content><p>{TWO}</p><p>{TWO}</p></div></body>")[0] == f"{TWO}\n{TWO}"
    comments = "".join(f"<article class=reply>{READER}</article>" for _ in range(9))
    assert main_text(f"<body><div class=content><h1>Flood</h1><p>{LONG}</p></div><div id=comments>{comments}</div></body>")[0] == f"Flood\n{LONG}"
    assert main_text(f"<body><div class=masthead><h1>The Site</h1></div><div class=content><p>{LONG}</p><p>{LONG}</p></div></body>")[0] == f"{LONG}\n{LONG}"


def test_headings_tables_and_inline_elements_stay():
    table = "<table><tr><th>Town</th><th>Level</th></tr><tr><td>Aford</td><td>3 m</td></tr></table>"
    page = f"<body><nav><a href=1>Home</a></nav><div><h2>Results</h2>{table}<p>{LONG}</p></div></body>"
    assert main_text(page)[0] == f"Results\nTown\nLevel\nAford\n3 m\n{LONG}"
    assert main_text(f"<article><p>Press <button>Go</button> now, when <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><button>Share</button></article>")[0] == "Press Go now, when x=1 holds."


def test_wrappers_with_the_article():
    for words in ("page-header", "sidebar-layout", "layout with-sidebar"):
        page = f"<body><div class='{words}'><nav><a href=1>Home</a></nav><h1>Flood</h1><p>{LONG}</p><p>{LONG}</p></div><div class=footer><p>{LONG}</p></div></body>"
        assert main_text(page)[0] == f"Flood\n{LONG}\n{LONG}"
    assert main_text(f"<body><article class='post tag-newsletter category-cookies'><p>{LONG}</p></article></body>")[0] == LONG


@pytest.mark.parametrize("page", ["<a " * 80000, "<a title='" * 30001, "<a title='>' " * 30000, "<a t=\"'>" * 40000, "<![CDATA[ x>" * 30000, "<script>" + "</script " * 40000, "<div>" * 20000 + "<p>word</p></div></p>" * 20000, "<div class=ad><p>x" * 20000, "<!--" * 80000 + "x>", "<div><p>x" * 20000 + "</section>" * 20000])
def test_time_in_proportion(page):
    begun = time.process_time()
    main_text(page)
    assert time.process_time() - begun < 3
