"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks of text at block-level tags. A linear classifier gives each block a cost for either label,
which become capacities from the source (content) and to the sink (boilerplate). Neighbouring blocks, and blocks that
follow each other under one parent, are joined by edges that weigh less the further apart they are in the DOM. The
blocks on the source side of a minimum cut are the main text. Each page is a problem of its own, so Spark only maps.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from loamfold.llm.words import sliced

#: Page bytes that a task turns into Python strings at once; a longer page is taken alone.
HELD = 1 << 22
# Fixed values of HTML: elements that begin and end a block of text, that have no end, and whose text is never shown.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg annotation annotation-xml object canvas audio video select datalist".split())
CLOSED_BY = {"p": BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "tbody", "tfoot", "thead"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option", "optgroup"}), "head": frozenset({"body"})}
# Fixed values of the classifier: elements and words of class, id and role that mark boilerplate or content.
BOILER_TAGS = frozenset("nav footer aside form dialog menu fieldset address search".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar tabs sitemap skip
    header masthead footer copyright legal imprint sidebar aside widget widgets rail related recommended recommendations
    trending popular share sharing social follow tags meta byline comment comments commentlist disqus reply replies respond responses discussion
    cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe signup login search
    form hidden print contentinfo complementary navigation""".split()
)
CONTENT_WORDS = frozenset("article post entry content story body main text".split())
# Of the words of boilerplate, those of parts that are long on some pages: their length never speaks for them; and those of readers' comments.
FIRM_WORDS = frozenset(
    """comment comments commentlist disqus reply replies respond responses discussion cookie cookies consent gdpr notice notices notification
    alert popup modal overlay paywall newsletter subscribe signup login search sidebar nav navbar navigation menu menubar breadcrumb breadcrumbs
    related recommended recommendations trending popular ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond responses discussion".split())
# Classes that begin so tell of the state or the subject of what they are on, not of its purpose.
STATES = frozenset("no not has with without is hide show category tag type format status".split())
#: Weights of the classifier (positive speaks for content), and of an edge between neighbours, along a parent, and from a heading to what it heads.
WEIGHTS = {"content": 2.5, "boiler": -8.0, "paragraph": 1.0, "heading": 0.5, "item": 1.55, "cell": 1.65, "length": 1.5, "links": -4.0, "short": -0.7, "sentence": 0.5, "sign": -2.0, "start": -0.9}
NEAR, ALONG, HEAD = 1.0, 0.5, 1.5
#: Parts of text in sentences: a wrapper with a listed word that holds the page's article leaves at most the second outside;
#: one that holds the first part of the text in articles counts as holding the article.
MOST, FEW = 0.5, 0.1
#: Tags of a page whose quotes do not end before the page does, after which quotes of other tags count no longer.
UNQUOTED = 8

_MARKUP = r"""<!--.*?(?:-->|\Z)|{data}<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>{rest})>"""
_DATA, _QUOTED, _PLAIN = r"<!\[CDATA\[(?P<data>.*?)\]\]>|", r"""(?:[^>"']|"[^"]*"|'[^']*')*+""", r"[^>]*"
#: By whether sections of character data, and quotes, still count.
_TAGS = {(d, q): re.compile(_MARKUP.format(data=_DATA if d else "(?P<data>(?!))|", rest=f"{_QUOTED}|(?P<open>{_PLAIN})" if q else f"(?P<open>(?!))|{_PLAIN}"), re.S) for d in (True, False) for q in (True, False)}
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMES = re.compile(r"[a-z0-9]+")
_HEADING = re.compile("h[1-6]")
#: Characters that end a sentence, and elements that hold running text.
ENDS = ".!?…\"'”"
INLINE = frozenset("p li td th dd dt h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption".split())


@dataclass
class Element:
    """An open block element; its number is its place in page order, and that of the page itself is 0."""

    name: str
    parent: int
    depth: int
    content: bool = False
    boiler: bool = False
    article: bool = False  # in an article or main part
    words: frozenset[str] | None = None  # listed words of its class, id and role, if it has one or is a form
    near_content: int = 0  # number of the innermost element around that is content


@dataclass
class Block:
    text: str
    element: int
    inner: str
    in_content: bool
    in_boiler: bool
    linked: int

    @property
    def told(self) -> int:
        """Characters outside links of what reads like sentences."""
        return max(len(self.text) - self.linked, 0) if self.text[-1] in ENDS and self.text.count(" ") >= 4 or len(self.text) >= 80 else 0


def _settled(blocks: list[Block], elements: list[Element]) -> None:
    """Mark blocks in wrappers as boilerplate, but for wrappers that hold the page's article.

    What counts is text in sentences, within the wrapper and outside it; that of boilerplate by its elements, and that
    of other wrappers, is not counted outside. A wrapper with the page's heading, or with most of the text in articles,
    holds the article if less is told outside (if it has a firm word and no heading: next to nothing). Without these,
    next to nothing may be told outside, and one with a firm word needs an element of content as well, and nothing outside.
    """
    n = len(elements)
    marked = [0] * n  # number of the innermost marked element, itself included
    own, held, articles = [0] * n, [0] * n, [0] * n
    heads, inner_content = [0] * n, [0] * n
    for i in range(1, n):
        e = elements[i]
        marked[i] = i if e.words is not None else marked[e.parent]
    for b in blocks:
        if not b.in_boiler:
            wrapper = marked[b.element]
            own[wrapper] += b.told
            held[b.element] += b.told
            heads[b.element] += b.inner == "h1"
            inner_content[wrapper] += b.told if elements[b.element].near_content >= wrapper > 0 else 0
    for i in range(n - 1, 0, -1):
        e = elements[i]
        if e.name in CONTENT_TAGS:
            articles[i] = held[i]
        for sums in (held, articles, heads):
            sums[e.parent] += sums[i]
    outside = [0] * n
    for i in range(1, n):
        e = elements[i]
        if e.words is None:
            e.boiler = e.boiler or elements[e.parent].boiler
            continue
        up = marked[e.parent]
        outside[i] = outside[up] + own[up]
        firm, few = bool(e.words & FIRM_WORDS), outside[i] <= FEW * held[i]
        headed, story = heads[i] > 0, 0 < MOST * articles[0] < articles[i]
        if headed:
            holds = held[i] > outside[i]
        elif story:
            holds = (few if firm else held[i] > outside[i]) and heads[0] == 0
        elif firm:
            holds = outside[i] == 0 < inner_content[i] and not e.words & COMMENT_WORDS
        else:
            holds = few and held[i] > 0 and heads[0] == 0
        e.boiler = e.boiler or not holds or elements[e.parent].boiler
    for b in blocks:
        b.in_boiler = b.in_boiler or elements[b.element].boiler


def _opened(name: str, rest: str, number: int, parent: int, around: Element) -> Element:
    """The element of a start tag, with what it has from the one around it."""
    e = Element(name, parent, around.depth + 1, around.content, around.boiler, around.article, near_content=around.near_content)
    words: set[str] = set()
    content = name in CONTENT_TAGS
    if content:
        e.article = True
    e.boiler = e.boiler or (name in BOILER_TAGS and name != "form") or (name == "header" and not e.article)
    if "=" in rest or "hidden" in rest:
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), value.lower()
            if key in ("class", "id", "role"):
                if name not in ("html", "body"):
                    for one in value.strip("\"'").split():
                        parts = _NAMES.findall(one)
                        if parts and not (key == "class" and parts[0] in STATES):
                            words.update(parts)
            elif key == "hidden" or (key == "aria-hidden" and "true" in value) or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                e.boiler = True
    listed = words & BOILER_WORDS - ({"header", "meta", "tags"} if e.article else set())
    if listed or name == "form":
        e.words = frozenset(listed)
    if content or words & CONTENT_WORDS:
        e.content, e.near_content = True, number
    return e


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks of shown text in page order, character references decoded, white space in a block as one space; and the elements.

    Takes time in proportion to the page: what never ends is looked for once.
    """
    out: list[Block] = []
    elements = [Element("", -1, 0)]
    stack = [0]
    opened: Counter[str] = Counter()  # open elements by name
    parts: list[str] = []
    links = linked = at = unquoted = 0
    last, data = page.rfind(">") + 1, page.rfind("]]>")
    loose = ("<!--", "<!", "<?")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                e = elements[stack[-1]]
                out.append(Block(text, stack[-1], e.name, e.content, e.boiler, linked))
        linked = 0

    def close(depth: int) -> None:
        for number in stack[depth:]:
            opened[elements[number].name] -= 1
        del stack[depth:]

    while at < len(page):
        tag = _TAGS[at <= data, unquoted < UNQUOTED].search(page, at, last) if at < last else None
        text = page[at : tag.start()] if tag else page[at:]
        if not tag:
            # a comment or declaration that does not end is none of the text
            text = text[: min((k for k in map(text.find, loose) if k >= 0), default=len(text))]
        if text:
            parts.append(text)
            linked += len(text) if links else 0
        if not tag:
            break
        at = tag.end()
        if tag["data"] is not None:
            parts.append(html.escape(tag["data"]))
        if tag["name"] is None:
            if tag[0].startswith("<!--") and not tag[0].endswith("-->"):
                break  # it ends nowhere, or after the last tag
            continue
        unquoted += tag["open"] is not None
        name = tag["name"].lower()
        if name == "br" or name == "img":
            parts.append(" ")
        if tag["end"]:
            if name == "a":
                links = 0
            elif name in BLOCKS:
                flush()
                if opened[name]:
                    close(next(i for i in range(len(stack) - 1, 0, -1) if elements[stack[i]].name == name))
            continue
        # the text of a button counts where it stands within a sentence
        if name in RAW or (name == "button" and not (elements[stack[-1]].name in INLINE and "".join(parts).strip())):
            if name in BLOCKS or name in ("iframe", "object", "video"):
                flush()
            if not tag["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at, last)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            links = 1
        elif name in BLOCKS:
            flush()
            while len(stack) > 1 and name in CLOSED_BY.get(elements[stack[-1]].name, ()):
                close(len(stack) - 1)
            if name not in VOID:
                elements.append(_opened(name, tag["rest"], len(elements), stack[-1], elements[stack[-1]]))
                stack.append(len(elements) - 1)
                opened[name] += 1
    flush()
    _settled(out, elements)
    return out, elements


def cost(block: Block) -> float:
    """Log odds of content by the linear classifier."""
    w, n = WEIGHTS, len(block.text)
    score = w["start"] + w["content"] * block.in_content + w["boiler"] * block.in_boiler
    heading = bool(_HEADING.fullmatch(block.inner))
    kind = "paragraph" if block.inner in ("p", "pre", "blockquote") else "heading" if heading else "item" if block.inner == "li" else "cell" if block.inner in ("td", "th", "dd", "dt") else None
    score += w[kind] if kind else 0.0
    score += w["length"] * min(n / 120, 1.0) + w["links"] * min(block.linked / n, 1.0) + w["short"] * (block.text.count(" ") < 3 and not heading)
    return score + w["sentence"] * (block.text[-1] in ENDS) + w["sign"] * ("©" in block.text)


def edges_of(blocks: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, between a block and the next under the same parent, and from a heading to what it heads."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            # steps up from both to the element around both; over a page these are at most twice its elements
            a, b, steps = blocks[i - 1].element, block.element, 0
            while a != b:
                if elements[a].depth >= elements[b].depth:
                    a = elements[a].parent
                else:
                    b = elements[b].parent
                steps += 1
            edges.append((i - 1, i, NEAR / (1 + max(steps - 2, 0))))
            if _HEADING.fullmatch(blocks[i - 1].inner) and steps <= 5:
                edges.append((i - 1, i, HEAD))
        parent = elements[block.element].parent
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, ALONG))
        last[parent] = i
    return edges


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the costs of the labels taken plus the weights of edges between different labels.

    A block whose capacity is at least the weight of its undecided edges has its label in some minimum cut; it is fixed
    and passes its edges on to its neighbours' capacities. What is left is solved by augmenting shortest paths.
    """
    n = len(costs)
    capacity = list(costs)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is None and abs(capacity[i]) >= sum(w for j, w in near[i].items() if label[j] is None):
            label[i] = capacity[i] >= 0
            for j, w in near[i].items():
                if label[j] is None:
                    capacity[j] += w if label[i] else -w
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        source, sink = n, n + 1
        flow: dict[int, dict[int, float]] = {i: {j: w for j, w in near[i].items() if label[j] is None} for i in rest}
        flow[source], flow[sink] = {}, {}
        for i in rest:
            flow[source][i], flow[i][source] = max(capacity[i], 0.0), 0.0
            flow[i][sink], flow[sink][i] = max(-capacity[i], 0.0), 0.0
        while True:
            came, queue = {source: source}, deque([source])
            while queue and sink not in came:
                i = queue.popleft()
                for j, w in flow[i].items():
                    if w > 1e-12 and j not in came:
                        came[j] = i
                        queue.append(j)
            if sink not in came:
                break
            path, j = [], sink
            while j != source:
                path.append((came[j], j))
                j = came[j]
            most = min(flow[i][j] for i, j in path)
            for i, j in path:
                flow[i][j] -= most
                flow[j][i] += most
        for i in rest:
            label[i] = i in came
    return [bool(x) for x in label]


def main_text(page: str | None) -> tuple[str, int, int]:
    """The main text of a page, its number of blocks, and of those kept."""
    blocks, elements = blocks_of(page or "")
    content = minimum_cut([cost(b) for b in blocks], edges_of(blocks, elements))
    kept = [b.text for b, c in zip(blocks, content, strict=True) if c]
    return "\n".join(kept), len(blocks), len(kept)


def extracted(pages: DataFrame, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text, n_chars, n_blocks, n_content`` of every page.

    A null or empty page, or one without shown text, gives an empty text. Rows stay, repeated ones too; a kept column
    with an added name is an error; an empty table gives an empty table. Any bytes are taken as HTML: tags that do not
    end are text, elements that do not end reach to the end of their parent.
    """
    added = {"text": StringType(), "n_chars": LongType(), "n_blocks": IntegerType(), "n_content": IntegerType()}
    if clash := set(added) & set(keep):
        raise ValueError(f"columns {sorted(clash)} are added by the extraction")
    chosen = pages.select(*keep, pages[column].cast("string").alias("_page"))
    schema = StructType([chosen.schema[c] for c in keep])
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "_page", HELD):
                rows = [main_text(page) for page in batch.column("_page").to_pylist()]
                texts = [t for t, _, _ in rows]
                new = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), *(pa.array([r[k] for r in rows], pa.int32()) for k in (1, 2))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *added])

    return chosen.mapInArrow(extract, schema)
