"""Operator 2, HTML extraction by tag-path ratios.

A page is a sequence of text nodes, each with the path of block tags from the
root. Over all nodes of a path their text and punctuation are added up; text a
node and punctuation a node are fused into one ratio per path. The ratios, laid
along the page and smoothed, are cut at a share of their standard deviation.
The nodes above select the content element: the deepest that holds nearly all
of their text, or the article or main around it. What stands in it is the
article, and so is what stands outside it on a path above the cut, and the
headings before that, apart from what HTML or its classes name as something
else (menus, forms, adverts, comments, ...). A name that only holds such a word
bars an element when its paths are sparse, and none bars the element that has
the page's content."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pos360.llm.tables import pieces, read_table

CUT = 0.5  # paths count as content above this many standard deviations of the smoothed ratios
HOLDS = 0.9  # share of the content nodes' text that the content element holds at least
KERNEL = np.array([0.25, 0.5, 0.25])

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
NOT_ARTICLE = frozenset("nav header footer aside script style noscript template button select textarea iframe svg canvas object head title menu dialog".split())
#: Words in class, id or role that name something else than the article.
NOT_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs pagination sidebar sidebars aside widget widgets related "
    "recommended share sharing social comment comments reply replies respond responses disqus discussion footer header masthead toolbar search form complementary contentinfo".split()
)
CLOSES = {"p": frozenset("p".split()), "li": frozenset(["li"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["tr", "td", "th"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "option": frozenset(["option"])}
#: An element that an implied end must not reach over.
FENCE = frozenset("article aside body div footer form header html main nav ol section table ul dl td th blockquote".split())
#: Parts of an article, never all of it: the content element is the one around them.
PARTS = frozenset("section table ul ol dl blockquote".split())
PAGE = frozenset("#root html body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。、，；：！？…]")
_SPACE = re.compile(r"\s+")
#: Words that make a name say what else is on the page, or in which state it is.
_KEEP_NAMES = frozenset("has have with no non not without hide show".split())
_STATES = frozenset("open opened opening closed fixed sticky static enabled disabled active inactive visible invisible collapsed expanded allowed free on off true false".split())
#: Words after the one that a compound name is about.
_BOX_WORDS = frozenset("area areas bar bars block blocks body bottom box boxes button buttons card cards center column container content group heading icon icons inner item items large left link links list lists main message messages module outer panel post posts article articles primary region right row secondary section sections slot slots small space text thread title top unit units wrap wrapper zone".split())
SPARED = frozenset("html body article main".split()) | HEADINGS | INLINE
OPEN, DOUBTED, NAMED, BARRED = range(4)  # what tag and names say of an element: article, perhaps not, not by its name, never


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    said: int  # OPEN, DOUBTED, NAMED or BARRED
    weight: float = 0.0


@dataclass
class Node:
    text: str
    element: int  # nearest block element
    path: int  # number of its root-to-leaf tag path
    block: int
    linked: bool  # inside a link


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)


def _said(name: str) -> int:
    """Whether one name of a class, id or role names something else than the article."""
    words = [w.lower() for w in _WORD.findall(name)]
    if NOT_ARTICLE_WORDS.isdisjoint(words) or not _KEEP_NAMES.isdisjoint(words) or words[-1] in _STATES:
        return OPEN
    while words[-1] in _BOX_WORDS:
        words.pop()
    return NAMED if words[-1] in NOT_ARTICLE_WORDS else DOUBTED


def _says(tag: str, attributes: str) -> int:
    if tag in NOT_ARTICLE:
        return BARRED
    said = NAMED if tag == "form" else OPEN
    if not attributes or tag in ("html", "body"):
        return said
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values))
        if name == "hidden" or name == "style" and _NO_DISPLAY.search(value):
            return BARRED
        if name in ("class", "id", "role") and tag not in SPARED:
            said = max([said, *map(_said, value.split())])
    return said


def read_page(source: str) -> Page:
    """Text nodes outside the elements that are never article, with their block elements. Lenient
    like browsers: unknown end tags are skipped, open elements end with their parent."""
    page = Page([Element("#root", -1, 0, OPEN)])
    # Paths are numbered in a trie, from (path, tag); open elements are found by tag, so that
    # a page costs what its tokens cost, however deep it is nested and whatever ends in vain.
    paths: dict[tuple[int, str], int] = {}
    # Open elements: tag, block element inside it, path, barred.
    stack: list[tuple[str, int, int, bool]] = [("#root", 0, 0, False)]
    depths: dict[str, list[int]] = {}  # of the open elements of a tag
    blocks, fences = [0], [0]  # depths of the open block elements, and of those in FENCE
    at, block = 0, 0

    def text(upto: int) -> None:
        tag, element, path, barred = stack[-1]
        if upto > at and not barred:
            page.nodes.append(Node(html.unescape(source[at:upto]), element, path, block, bool(depths.get("a"))))

    def close(depth: int) -> None:
        nonlocal block
        if blocks[-1] >= depth:
            block += 1
        for tag, *_ in stack[depth:]:
            depths[tag].pop()
        while blocks[-1] >= depth:
            blocks.pop()
        while fences[-1] >= depth:
            fences.pop()
        del stack[depth:]

    while found := _TOKEN.search(source, at):
        text(found.start())
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, attributes, ends = tag.lower(), found[3] if found[2] else found[6], found[1] or found[4]
        if ends:
            if (opened := depths.get(tag)) and (tag not in INLINE or opened[-1] > blocks[-1]):
                close(opened[-1])
            continue
        if tag == "br":
            if not stack[-1][3]:
                page.nodes.append(Node(" ", stack[-1][1], stack[-1][2], block, False))
            continue
        if tag in VOID:
            block += tag == "hr"
            continue
        if tag not in INLINE:
            # A paragraph ends where a block begins; list items and cells end where the next one begins.
            ending = CLOSES.get(tag, frozenset()) | CLOSES["p"]
            last = max((depths[t][-1] for t in ending if depths.get(t)), default=0)
            if last and (last > fences[-1] or stack[fences[-1]][0] in ending):
                close(last)
            block += 1
        _, element, path, barred = stack[-1]
        said = _says(tag, attributes)
        barred = barred or said == BARRED
        if tag not in INLINE:
            page.elements.append(Element(tag, element, len(stack), said))
            element, path = len(page.elements) - 1, paths.setdefault((path, tag), len(paths) + 1)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
            if tag == "textarea" or tag not in NOT_ARTICLE:
                stack.append((tag, element, path, barred))
                text(end.start() if end else len(source))
                stack.pop()
            at = end.start() if end else len(source)
            block += 1
            continue
        if not attributes.endswith("/") or tag not in ("svg", "path"):
            depths.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                blocks.append(len(stack))
                if tag in FENCE:
                    fences.append(len(stack))
            stack.append((tag, element, path, barred))
    text(len(source))
    return page


def link_paths(nodes: list[Node]) -> set[int]:
    """Paths with more text inside links than outside: menus and lists of other pages."""
    balance = defaultdict(int)
    for n in nodes:
        size = len(n.text.strip())
        balance[n.path] += size if n.linked else -size
    return {p for p, b in balance.items() if b > 0}


def path_ratios(nodes: list[Node]) -> np.ndarray:
    """Fused ratio of each node's path, smoothed along the page; 0 on link paths, whatever stands beside them."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in nodes:
        body = n.text.strip()
        length[n.path] += len(body)
        marks[n.path] += len(_PUNCTUATION.findall(body))
        count[n.path] += bool(body)
    fused = {p: (length[p] / c) * (1 + marks[p] / c) for p, c in count.items() if c}
    ratio = np.array([fused.get(n.path, 0.0) for n in nodes])
    if not len(ratio):
        return ratio
    links = link_paths(nodes)
    smooth = np.convolve(np.pad(ratio, 1, mode="edge"), KERNEL, "valid")
    return np.where([n.path in links for n in nodes], 0.0, smooth)


def weigh(page: Page, nodes: list[Node]) -> tuple[list[Node], list[int]]:
    """The nodes on paths above the cut, and the text of all nodes by element; `weight` becomes that of the former."""
    ratio = path_ratios(nodes)
    content = [n for n, r in zip(nodes, ratio) if r >= CUT * ratio.std() and r > 0]
    text = [0] * len(page.elements)
    for e in page.elements:
        e.weight = 0.0
    for n in nodes:
        text[n.element] += len(n.text.strip())
    for n in content:
        page.elements[n.element].weight += len(n.text.strip())
    for i in range(len(page.elements) - 1, 0, -1):  # elements stand after their parents
        up = page.elements[i].parent
        text[up] += text[i]
        page.elements[up].weight += page.elements[i].weight
    return content, text


def admitted(page: Page) -> list[Node]:
    """The nodes without those in elements that are named as something else.

    A doubted element goes if the paths of less than half of its text are above
    the cut. A named one stays if it has nearly all of the page's content, or
    more than half of it and what only the article has, main or h1."""
    if all(e.said in (OPEN, BARRED) for e in page.elements):
        return page.nodes
    _, text = weigh(page, [n for n in page.nodes if n.text.strip()])
    all_of_it = page.elements[0].weight
    heads = [e.tag in ("main", "h1") for e in page.elements]
    for i in range(len(page.elements) - 1, 0, -1):
        heads[page.elements[i].parent] |= heads[i]
    out = [False]
    for i, e in enumerate(page.elements[1:], 1):
        if e.said == DOUBTED:
            own = 2 * e.weight < text[i]
        else:
            own = e.said == NAMED and not (e.weight and (e.weight >= HOLDS * all_of_it or heads[i] and 2 * e.weight > all_of_it))
        out.append(out[e.parent] or own)
    return [n for n in page.nodes if not out[n.element]]


def main_text(source: str) -> str:
    """The article of a page: blocks joined by one line feed, white space in a block made one space."""
    page = read_page(source)
    nodes = [n for n in admitted(page) if n.text]
    solid = [n for n in nodes if n.text.strip()]
    links = link_paths(solid)
    if len(links) < len({n.path for n in solid}):  # a page of nothing but links is its links
        solid = [n for n in solid if n.path not in links]
        nodes = [n for n in nodes if n.path not in links]
    if not solid:
        return ""
    content, _ = weigh(page, solid)
    need = HOLDS * page.elements[0].weight
    root = max((i for i, e in enumerate(page.elements) if e.weight >= need), key=lambda i: (page.elements[i].depth, -i))
    at = root
    while page.elements[at].tag not in PAGE:
        if page.elements[at].tag in FENCE:
            root = at
            if page.elements[at].tag not in PARTS:
                break
        at = page.elements[at].parent
    if page.elements[root].tag not in FENCE:
        root = at
    # An article or main with content is kept whole, the outermost of them.
    whole = [e.tag in ("article", "main") and e.weight > 0 or i == root and e.tag not in PAGE for i, e in enumerate(page.elements)]
    for i, e in enumerate(page.elements[1:], 1):
        whole[i] |= whole[e.parent]
    passed = {n.block for n in content}
    # Where no element but the page holds the content, what stands beside it belongs to it.
    beside = {e for n in content for e in (n.element, page.elements[n.element].parent)} if page.elements[root].tag in PAGE else set()
    # An article or main with more than half of the content is all of it, but for a heading right before.
    if any(e.tag in ("article", "main") and 2 * e.weight > page.elements[0].weight for e in page.elements):
        passed, beside = {n.block for n in content if whole[n.element]}, set()
    keep, follows = [], False
    for n in reversed(nodes):
        e = page.elements[n.element]
        heading = e.tag in HEADINGS
        kept = whole[n.element] or n.block in passed or n.element in beside or e.parent in beside or heading and follows
        if not n.text.strip():
            kept |= follows
        elif not heading or kept:
            follows = kept
        if kept:
            keep.append(n)
    parts: dict[int, list[str]] = {}
    for n in reversed(keep):
        parts.setdefault(n.block, []).append(n.text)
    blocks = (_SPACE.sub(" ", "".join(p)).strip() for p in parts.values())
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Defined cases: null html is empty and gives an empty text, as does a page
    without text outside menus and the like; unclosed comments, scripts and tags
    reach to the end of the page; null or repeated ids, equal rows and other
    columns do not matter; an empty table gives no row."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    schema = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches, "html"):
            texts = [main_text(x) for x in b["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op2_tag_path_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
