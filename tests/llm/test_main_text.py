import html
import itertools
import random
import re

import pytest

from loamfold.llm import queries
from loamfold.llm.main_text import blocks_of, extracted, main_text, minimum_cut


def test_minimum_cut_against_all_labellings():
    draw = random.Random(3)
    for _ in range(300):
        n = draw.randrange(1, 9)
        costs = [draw.choice([-3, -1, -0.5, 0.25, 1, 2.5]) * draw.random() for _ in range(n)]
        edges = [(i, j, draw.random() * 2) for i, j in itertools.combinations(range(n), 2) if draw.random() < 0.5]

        # a block on the wrong side costs its capacity, an edge between the sides its weight
        def cut(label, costs=costs, edges=edges):
            return sum(max(c, 0) if not x else max(-c, 0) for c, x in zip(costs, label, strict=True)) + sum(w for i, j, w in edges if label[i] != label[j])

        best = min(cut(x) for x in itertools.product([False, True], repeat=n))
        assert cut(minimum_cut(costs, edges)) == pytest.approx(best)


ARTICLE = "<article><h1>The head</h1><p>First paragraph of the text, with a <a href='x'>link</a> in it.<p>Second one &amp; more\n text.</p><div class='ad'>Buy now!</div><p>Ok.</p></article>"
WANT = "The head\nFirst paragraph of the text, with a link in it.\nSecond one & more text.\nOk."


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>{}<footer>&copy; site</footer>",
        "<header><h2>The site of news and more</h2></header>{}<aside><p>A long sidebar paragraph that says something else entirely, at length.</p></aside>",
        "<div class='cookie-notice'><p>We use cookies to make this site better for you. Accept?</p></div>{}<section id='comments'><p>Reader: I do not agree with a word of this long piece.</p></section>",
        "<form><p>Your name here, please, and your address as well.</p><input></form>{}<script>var t = '</p><p>not text';</script><style>p{{}}</style><!-- <p>no</p> -->",
        "<div class=sidebar><p>Related stories that are long enough to look like text.</p></div>{}<div hidden><p>Hidden text which nobody sees, long enough.</p></div>",
    ],
)
def test_boilerplate_goes_and_the_article_stays(around):
    assert main_text(f"<html><head><title>T</title></head><body>{around.format(ARTICLE)}</body></html>")[0] == WANT


def test_a_page_without_an_article_element():
    long = "This is a paragraph of some length that tells a story, with commas and a full stop at the end of it."
    page = f"<div id=top><a href=1>Home</a> | <a href=2>About</a></div><div><div><p>{long}</p><p>{long}</p><p>Short.</p><p>{long}</p></div></div><div><a href=3>Imprint</a></div>"
    assert main_text(page)[0] == "\n".join([long, long, "Short.", long])


def test_query_against_the_template(spark, folder):
    """All given pages have one article without boilerplate inside: its blocks are the main text."""
    pages = {r.page_id: r for r in queries.table(spark, folder, "pages").collect()}
    got = queries.RUNNERS["op1_minimum_cut_text"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " " if "br" in x else "", x)).split()) for x in re.split("</?(?:p|h1)>", article.replace("<b>", "").replace("</b>", "").replace("<br>", " ")))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_pages(spark):
    pages = ["", None, "plain text only, no tags at all in here.", "<p>a < b and c > d", "<article><p>x &#233;&eacute;&nbsp;&bogus; &#x1F600;", "<div title='a > b'><article><p>kept", "<script>never ends <p>x", "<<<>>><p", "<article>" + "<p>word</p>" * 20000, "<p>" + "long " * 100000, "<article><table><tr><td>one<td>two</table>", "</p></div>", "<article><p>a<![CDATA[b<c]]>d"]
    frame = spark.createDataFrame([(i, None, p, "e") for i, p in enumerate(pages)] + [(None, "u", "<article><p>x</p>", "e")] * 2, "page_id long, url string, html string, tag string")
    got = {r.page_id: r.text for r in extracted(frame).collect()}
    assert got[0] == got[1] == "" and got[3].endswith("a < b and c > d") and got[4] == "x éé &bogus; \U0001f600" and got[5] == "kept" and got[6] == "" and got[8] == "\n".join(["word"] * 20000)
    assert got[9] == " ".join(["long"] * 100000) and got[10] == "one\ntwo" and got[12] == "ab<cd" and got[None] == "x"
    assert extracted(frame).count() == len(pages) + 2 and extracted(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="text"):
        extracted(frame.withColumnRenamed("tag", "text"), keep=("text",))
    assert [b.text for b in blocks_of("<ul><li>a<li>b<p>c</ul>d")[0]] == ["a", "b", "c", "d"]
