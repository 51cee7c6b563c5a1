"""Main text of raw web pages by tree scoring.

A page becomes a small tree of elements. Paragraphs give points for length and commas to their
ancestors, less with every generation; an ancestor's points are discounted by the share of its text that
is links. The best container is kept with the siblings that score like it or belong to it (headings, plain
paragraphs, further sections, and what stands between kept ones). Elements that are no article by their kind
(menus, footers, forms ..) never count. A class or id that names such a part (``comments``, ``cookie-notice``) takes
a block out unless it holds the article, as layouts are named by what they have; a name that only has such a word
in it (``social-history``, ``share-price``) lowers a container's score and takes no text away.

Every step is linear in the length of the page, however deep its elements lie.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamizal.llm.common import bounded_batches, table

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^\"'>]*+(?:\"[^\"]*+\"[^\"'>]*+|'[^']*+'[^\"'>]*+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_COMMA = re.compile("[,،、，;]")

# The elements of HTML by what they mean here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
_SAME_CLOSES = {
    "li": (("li",), frozenset(("ul", "ol", "menu"))),
    "dt": (("dt", "dd"), frozenset(("dl",))),
    "dd": (("dt", "dd"), frozenset(("dl",))),
    "tr": (("tr", "td", "th"), frozenset(("table",))),
    "td": (("td", "th"), frozenset(("tr", "table"))),
    "th": (("td", "th"), frozenset(("tr", "table"))),
    "option": (("option",), frozenset(("select", "datalist"))),
}
_NEVER = frozenset(
    "head nav footer aside form script style noscript template iframe object embed svg math canvas audio video button select "
    "textarea input dialog menu datalist map noembed noframes xmp title search".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
# Words in a class or id that mark what is no article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager pagination paywall popup promo promotion promoted recommended related replies respond share sharing "
    "sidebar sidenav signup skip skyscraper social sponsor sponsored subscribe subscription taboola toolbar widget".split()
)
# Words that may stand beside one of those in a name of the same kind.
_BESIDE = frozenset(
    "area bar block bottom box btn button buttons cell col column container content el floating form group header heading icon icons inner item items "
    "js js2 layer left link links list main message outer page panel post posts right row section site slot stack sticky story text thread top "
    "unit wrap wrapper zone".split()
)
_ARTICLE = frozenset(("article", "main"))
_PARAGRAPHS = frozenset(("p", "pre", "td", "li", "blockquote", *_HEADINGS))
_WEAK = 0.5  # what a container's score is multiplied by if a name has a word of these in it


class _Node:
    __slots__ = ("tag", "parent", "out", "named", "weak", "score", "chars", "linked", "block", "in_article")

    def __init__(self, tag: str, parent: int, out: bool, block: int, in_article: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.block, self.in_article = block, in_article  # the nearest element that is a block; in an article or main
        self.named, self.weak, self.score, self.chars, self.linked = False, False, 0.0, 0, 0


def _name(value: str) -> tuple[bool, bool]:
    """Whether one of the names names a part that is no article, and whether one has a word of such in it."""
    named = weak = False
    for name in value.split():
        words = [w for w in _SPLIT.split(name) if w]
        if not _MARKS.isdisjoint(words):
            if all(w in _MARKS or w in _BESIDE or w.isdigit() for w in words):
                named = True
            else:
                weak = True
    return named, weak


def _marked(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element is out whatever it holds, and whether its class or id names it, or has a word of that."""
    if tag in _NEVER:
        return True, False, False
    named = weak = False
    if not attributes or attributes.isspace():
        return False, False, False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name in ("class", "id"):
            if tag not in ("html", "body"):
                own = _name(value)
                named, weak = named or own[0], weak or own[1]
        elif name == "role":
            if value.strip() in _ROLES:
                return True, named, weak
        elif name == "hidden" and value != "until-found":
            return True, named, weak
        elif name == "aria-hidden" and value.strip() == "true":
            return True, named, weak
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, named, weak
    return False, named, weak


def _parse(page: str) -> tuple[list[_Node], list[tuple[int, str, int]]]:
    """Elements, and blocks in page order: (element, text, characters of it in links)."""
    nodes = [_Node("#root", -1, False, 0, False)]
    open_nodes, blocks = [0], []
    places: dict[str, list[int]] = {}  # where elements of a kind stand among the open ones
    block_places = [0]  # where the open blocks stand
    pieces: list[str] = []
    link_pieces: list[str] = []
    links = 0
    raw_until = ""

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(link_pieces)).split()))
                blocks.append((nodes[open_nodes[-1]].block, text, min(linked, len(text))))
            pieces.clear()
            link_pieces.clear()

    def say(text: str) -> None:
        if text and not nodes[open_nodes[-1]].out:
            pieces.append(text)
            if links:
                link_pieces.append(text)

    def close(index: int) -> None:
        """Close the open elements from place ``index`` on, the innermost first."""
        nonlocal links
        if block_places[-1] >= index:
            flush()
        while len(open_nodes) > index:
            tag = nodes[open_nodes.pop()].tag
            places[tag].pop()
            if block_places[-1] == len(open_nodes):
                block_places.pop()
            links -= tag == "a"

    def last(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    at = 0
    for found in _MARKUP.finditer(page):
        tag = found[3] or found[6]
        if raw_until:
            if not tag or tag.lower() != raw_until or not (found[2] or found[5]):
                continue
            at, raw_until = found.start(), ""
        say(page[at : found.start()])
        at = found.end()
        if found[1]:
            say(found[1].replace("&", "&amp;"))
        if not tag:
            continue
        tag = tag.lower()
        if found[2] or found[5]:
            place = last((tag,))
            # the end of an inline element does not end the blocks around it
            if place and (tag not in _INLINE or place > block_places[-1]):
                close(place)
            elif tag not in _INLINE:
                flush()
            continue
        attributes = found[4] if found[3] else found[7]
        if tag == "br":
            say(" ")
            continue
        if tag not in _INLINE:
            flush()
            if tag in _CLOSES_P and len(open_nodes) > 1 and nodes[nodes[open_nodes[-1]].block].tag == "p":
                close(block_places[-1])
            if tag in _SAME_CLOSES:
                ends, border = _SAME_CLOSES[tag]
                place = last(ends)
                if place > last(border):
                    close(place)
            if len(open_nodes) - 1 > block_places[-1]:  # markup left open by a block
                close(block_places[-1] + 1)
        if tag in _VOID:
            continue
        above = nodes[open_nodes[-1]]
        never, named, weak = _marked(tag, attributes)
        out = above.out or never or (tag == "header" and not above.in_article)
        number, inline = len(nodes), tag in _INLINE
        nodes.append(_Node(tag, open_nodes[-1], out, above.block if inline else number, above.in_article or tag in _ARTICLE))
        nodes[-1].named = named and not out and not inline
        nodes[-1].weak = weak and not inline
        places.setdefault(tag, []).append(len(open_nodes))
        if not inline:
            block_places.append(len(open_nodes))
        open_nodes.append(number)
        links += tag == "a"
        if tag in _RAW:
            raw_until = tag
    if not raw_until:
        say(page[at:])
    close(1)
    flush()
    return nodes, blocks


def _points(text: str) -> float:
    return min(1.0, len(text) / 25) + len(_COMMA.findall(text)) + min(len(text) / 100, 3.0)


def _unnamed(nodes: list[_Node], blocks: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The blocks that are in no element named as no part of the article, unless that element holds it.

    An article or main that is in no other article is spared, and what holds one while there is none
    elsewhere; then what holds most of the points of the page, if it has the first heading too or nearly
    nothing is left without it.
    """
    if not any(node.named for node in nodes):
        return blocks
    own, texts = [0.0] * len(nodes), [0] * len(nodes)
    for n, text, linked in blocks:
        own[n] += _points(text) * (1 - linked / len(text))
        texts[n] += 1
    mass, title = own[:], next((i for i, node in enumerate(nodes) if node.tag == "h1" and texts[i]), 0)
    last = list(range(len(nodes)))  # elements come before what they hold
    for i in range(len(nodes) - 1, 0, -1):
        above = nodes[i].parent
        mass[above] += mass[i]
        texts[above] += texts[i]
        last[above] = max(last[above], last[i])
    in_article, in_main = [False] * len(nodes), [0] * len(nodes)
    articles = [0]  # of the first i elements, how many are an article or main with text
    for i, node in enumerate(nodes):
        if i:
            above = node.parent
            in_article[i] = in_article[above] or nodes[above].tag == "article"
            in_main[i] = in_main[above] + (nodes[above].tag == "main")
        articles.append(articles[-1] + (node.tag in _ARTICLE and texts[i] > 0))
    for i, node in enumerate(nodes):
        if node.named and not in_article[i]:
            held = articles[last[i] + 1] - articles[i]
            if node.tag in _ARTICLE or (held and held + in_main[i] == articles[-1]):
                node.named = False
    clear = own[:]  # points below an element that are in no named one below it
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].named:
            clear[nodes[i].parent] += clear[i]
    left, hidden = clear[0], [False] * len(nodes)
    for i, node in enumerate(nodes):
        hidden[i] = i > 0 and hidden[node.parent]
        if node.named and not hidden[i]:
            if mass[i] > mass[0] / 2 and (i < title <= last[i] or left < mass[0] / 10):
                node.named, left = False, left + clear[i]
            else:
                hidden[i] = True
    return [block for block in blocks if not hidden[block[0]]]


def _with_siblings(nodes: list[_Node], best: int, worth: Callable[[_Node], float]) -> set[int]:
    """The best container and those beside it that belong to the article."""
    if nodes[best].tag == "body" or best == 0:
        return {best}
    row = [i for i, node in enumerate(nodes) if node.parent == nodes[best].parent and node.chars]
    least, article = max(2.0, 0.2 * worth(nodes[best])), nodes[best].tag in _ARTICLE

    def belongs(i: int) -> bool:
        node = nodes[i]
        plain = node.linked / node.chars < 0.25
        if node.tag in _HEADINGS or (node.tag == "p" and node.chars > 80):
            return plain and not article
        alike = node.tag == nodes[best].tag or not article
        return alike and worth(node) >= least

    kept = {i for i in row if i == best or belongs(i)}
    places = [k for k, i in enumerate(row) if i in kept]
    first, end = places[0], places[-1]
    while end + 1 < len(row) and _further(nodes[row[end + 1]]):  # short sections that go on behind the last one
        end += 1
    while first > 0 and _further(nodes[row[first - 1]]):
        first -= 1
    return kept | {i for i in row[first : end + 1] if nodes[i].linked / nodes[i].chars < 0.5}


def _further(node: _Node) -> bool:
    return node.tag in ("section", "article") and not node.weak and node.linked / node.chars < 0.25


def main_text(page: str) -> str:
    """Blocks of the article of ``page`` in page order, joined by one blank; empty if there is none."""
    nodes, blocks = _parse(page)
    blocks = _unnamed(nodes, blocks)
    if not blocks:
        return ""
    for n, text, linked in blocks:
        nodes[nodes[n].parent if nodes[n].tag in _PARAGRAPHS else n].score += _points(text) * (1 - linked / len(text))
        nodes[n].chars += len(text)
        nodes[n].linked += linked
    for node in reversed(nodes[1:]):  # elements come before what they hold
        above = nodes[node.parent]
        above.score += node.score / 2
        above.chars += node.chars
        above.linked += node.linked
    nodes[0].score = 0.0

    def worth(node: _Node) -> float:
        return node.score * (1 - node.linked / node.chars) * (_WEAK if node.weak else 1.0) if node.chars else 0.0

    best = max(range(len(nodes)), key=lambda i: (worth(nodes[i]), -i))
    if nodes[best].tag in ("html", "#root"):
        best = next((i for i, node in enumerate(nodes) if node.tag == "body" and node.chars), best)
    above = best
    while above > 0:  # an article is kept whole
        if nodes[above].tag in _ARTICLE:
            best = above
        above = nodes[above].parent
    kept = _with_siblings(nodes, best, worth)
    inside = [False] * len(nodes)
    menu = [False] * len(nodes)
    for i, node in enumerate(nodes):
        inside[i] = i in kept or (node.parent >= 0 and inside[node.parent])
        listing = node.tag in ("ul", "ol") and node.chars and node.linked / node.chars > 0.8
        menu[i] = bool(listing) or (node.parent >= 0 and menu[node.parent])
    return " ".join(text for n, text, _ in blocks if inside[n] and not menu[n])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row of ``pages`` (which has ``html`` too).

    Null or empty pages, and pages without text outside of menus and the like, have an empty text.
    Repeated rows are read alike; broken markup is closed as browsers do.
    """
    bounded_batches(pages.sparkSession)
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return own.mapInArrow(_extract, own.select("page_id", "url", F.col("html").alias("text")).schema)


def op3_page_text(spark, sf_dir):
    texts = page_texts(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
