"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its root-to-leaf tag path. Per path,
text length, punctuation and the share of text in links are aggregated over the page,
smoothed over the sequence of blocks, fused, and compared with a threshold: paths that reach
it are content. The element that holds nearly all content is the article, whatever its name.

What an element is called is a prior only: blocks below menus, footers, forms, adverts,
comments and the like weigh nothing, `article` and `main` twice as much. The prior is left
out where a page would have no text by it.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
NO_ARTICLE = frozenset("head nav footer aside form button select menu dialog fieldset audio video canvas".split())
SECTIONS = frozenset("article main".split())
ENDED_BY_SIBLING = {  # an open element of this kind ends where one of these starts
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
SCOPES = frozenset("html body table ul ol dl div article section main aside nav td th blockquote header footer form".split())
# Words in class, id or role that mark an element as no article text.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav "
    "navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup "
    "modal overlay newsletter subscribe signup login share sharing social related recommended comments comment "
    "disqus respond reply replies pagination pager widget toolbar search contentinfo complementary".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
# one attribute after the other: a name, then its value, so that no value is read as a name
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s"'>/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'|[\s\S]""")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")
_SPACE = re.compile(r"\s+")
# Class words like these tell how an element is laid out, as `has-sidebar` or `share-enabled`.
_MODIFIER = re.compile(r"(?:has|no|with|without|hide|show)[-_]|.*[-_](?:enabled|disabled)\Z", re.S)

# Elements that head or hold a passage and are no container of an article.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PASSAGES = HEADINGS | frozenset("p li dt dd td th tr pre blockquote figcaption caption address center".split())

SMOOTHING, THRESHOLD = 0.5, 0.2
#: The article element's least share of all content, and of the content on the paths that it holds.
ARTICLE_SHARE, PATH_SHARE = 0.6, 0.9
#: Share of a path's text in links that makes it a menu.
LINK_SHARE = 0.5


@dataclass
class Block:
    path: int  # number of the tag path
    text: str
    section: bool
    linked: int  # characters within links
    node: int  # the block element around it
    marked: int  # depth of the innermost element around it that is boilerplate by name; -1 if none is


@dataclass
class Node:
    name: str
    parent: int  # comes before its children; the page's is -1
    is_leaf: bool = True


def _names_boilerplate(word: str) -> bool:
    """Whether a class, id or role word is one of BOILERPLATE_WORDS or made of them, as `ad-slot`."""
    parts = [word, *re.split(r"[-_]+", word)]
    return not BOILERPLATE_WORDS.isdisjoint(parts) and not _MODIFIER.match(word)


def _attributes(attributes: str) -> list[tuple[str, str]]:
    if not attributes:
        return []
    return [(key.lower(), value.strip("\"'").lower()) for key, value in _ATTRIBUTE.findall(attributes)]


def _is_hidden(attributes: list[tuple[str, str]]) -> bool:
    return any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attributes)


def _is_boilerplate(name: str, attributes: list[tuple[str, str]], in_section: bool) -> bool:
    if name in NO_ARTICLE or (name == "header" and not in_section):
        return True
    if name in ("html", "body", "article", "main"):
        return False
    words = (v.split() for k, v in attributes if k in ("class", "id", "role"))
    return any(any(map(_names_boilerplate, found)) for found in words)


@dataclass
class _Open:
    """An open element: what it means for the text in it. node, path and depth are the innermost block element's."""

    name: str
    node: int = 0
    path: int = 0
    depth: int = 0
    marked: int = -1
    section: bool = False
    hidden: bool = False
    link: bool = False


def blocks(page: str) -> tuple[list[Block], list[Node]]:
    """Text blocks of a page in order, and its block elements; the first one is the page.

    Without the text of scripts, styles and the like, and of elements that are not shown.
    """
    found: list[Block] = []
    nodes = [Node("", -1, False)]
    paths: dict[tuple[int, str], int] = {}
    stack = [_Open("")]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
        if text:
            around = stack[-1]
            found.append(Block(around.path, text, around.section, min(linked, len(text)), around.node, around.marked))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if not stack[-1].hidden:
            pieces.append(text)
            linked += len(text) * stack[-1].link

    def close_down_to(depth: int) -> None:
        if any(e.name not in INLINE or e.marked != stack[depth - 1].marked for e in stack[depth:]):
            flush()
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        if token["text"] is not None:
            add(token["text"])
            continue
        if token["name"] is None:
            if token[0].startswith("<![CDATA["):
                add(html.escape(token[0][9:].removesuffix("]]>"), quote=False))
            continue
        name = token["name"].lower()
        if token["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close_down_to(depth)
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break
            continue
        if name in RAW:
            if not token["attributes"].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else end
            if name not in ("svg", "math"):
                flush()
            continue
        if name in VOID:
            if name in ("br", "hr", "wbr"):
                pieces.append("" if name == "wbr" else " ")
            continue
        for depth in range(len(stack) - 1, 0, -1):
            if name in ENDED_BY_SIBLING.get(stack[depth].name, ()):
                close_down_to(depth)
                break
            if stack[depth].name in SCOPES:
                break
        parent = stack[-1]
        opened = _Open(name, parent.node, parent.path, parent.depth, parent.marked, parent.section)
        attributes = _attributes(token["attributes"])
        opened.hidden = parent.hidden or name == "head" or _is_hidden(attributes)
        opened.link = parent.link or name == "a"
        if _is_boilerplate(name, attributes, parent.section):
            opened.marked = parent.depth + 1
        if name not in INLINE:
            flush()
            nodes[parent.node].is_leaf = False
            opened.node, opened.depth = len(nodes), parent.depth + 1
            opened.path = paths.setdefault((parent.path, name), len(paths) + 1)
            opened.section |= name in SECTIONS
            nodes.append(Node(name, parent.node))
        elif opened.marked != parent.marked:
            flush()  # what came before is not within this inline element
        stack.append(opened)
    flush()
    return found, nodes


def _smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian mean over neighbours, with weights that add up to one at the borders too."""
    reach = max(1, round(2 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    ones = np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]
    return np.convolve(values, weights)[reach : reach + len(values)] / ones


def path_ratios(found: list[Block], sigma: float = SMOOTHING) -> np.ndarray:
    """The fused ratio of each block's path.

    Per path: mean text length, punctuation marks per block, and the share of text outside
    links. Length and punctuation are smoothed over the sequence of blocks; a block's ratio is
    length * (1 + punctuation) * share, and a path takes the median of its blocks.
    """
    lengths, marks, links, counts = (defaultdict(int) for _ in range(4))  # by path
    for b in found:
        lengths[b.path] += len(b.text)
        marks[b.path] += len(_PUNCTUATION.findall(b.text))
        links[b.path] += b.linked
        counts[b.path] += 1
    length = np.array([lengths[b.path] / counts[b.path] for b in found])
    mark = np.array([marks[b.path] / counts[b.path] for b in found])
    plain = np.array([1 - links[b.path] / lengths[b.path] for b in found])
    fused = _smooth(length, sigma) * (1 + _smooth(mark, sigma)) * plain
    values: dict[int, list[float]] = defaultdict(list)
    for b, value in zip(found, fused):
        values[b.path].append(float(value))
    typical = {path: median(of_path) for path, of_path in values.items()}
    return np.array([typical[b.path] for b in found])


def _article(found: list[Block], nodes: list[Node], weights: np.ndarray) -> int:
    """The innermost element, no passage and not without elements, that holds ARTICLE_SHARE of the weight.

    It also holds PATH_SHARE of the weight on its paths, so that one of several sections alike is not taken for all.
    """
    if not weights.any():
        return 0
    held = np.zeros(len(nodes))
    for b, weight in zip(found, weights):
        held[b.node] += weight
    for node in range(len(nodes) - 1, 0, -1):
        held[nodes[node].parent] += held[node]
    # more than half of the weight is held by one element of a depth only, so these are nested in this order
    chain = [n for n, h in enumerate(held) if h >= ARTICLE_SHARE * held[0] and not nodes[n].is_leaf and nodes[n].name not in PASSAGES]
    inside = _innermost_of(chain, nodes)
    by_path: dict[int, float] = defaultdict(float)
    own: dict[int, set[int]] = defaultdict(set)
    for b, weight in zip(found, weights):
        if weight:
            by_path[b.path] += float(weight)
            own[inside[b.node]].add(b.path)
    seen: set[int] = set()
    on_paths = 0.0
    for node in reversed(chain):
        on_paths += sum(by_path[p] for p in own[node] - seen)
        seen |= own[node]
        if held[node] >= PATH_SHARE * on_paths:
            return node
    return 0


def _innermost_of(chain: list[int], nodes: list[Node]) -> list[int]:
    """Per element, the innermost element of `chain` that it is or lies in; chain starts with the page."""
    chosen, inside = set(chain), []
    for number, node in enumerate(nodes):
        inside.append(number if number in chosen or node.parent < 0 else inside[node.parent])
    return inside


def main_text(page: str | None, threshold: float = THRESHOLD, sigma: float = SMOOTHING) -> str:
    """The article of a page: its blocks joined by one space; empty if there is none.

    Paths whose ratio reaches `threshold` times the mean of the page's blocks, weighted by
    their text, are content. The article is the innermost element that holds nearly all
    content; all its blocks are taken, short ones and headings too, but those of paths that are
    mostly links and those below elements within it that are boilerplate by name. Where that
    is no element but the page, only blocks of content paths are taken, and headings before them.
    """
    found, nodes = blocks(page or "")
    believed = [b for b in found if b.marked < 0]
    if not believed:  # names would leave no text: only what lies below the fewest of them counts
        outermost = min((b.marked for b in found), default=0)
        believed = [b for b in found if b.marked == outermost]
    if not believed:
        return ""
    ratios = path_ratios(believed, sigma)
    sizes = np.array([len(b.text) for b in believed])
    content = ratios >= threshold * (ratios * sizes).sum() / sizes.sum()
    prior = np.array([2.0 if b.section else 1.0 for b in believed])
    article = _article(believed, nodes, np.where(content, ratios * prior, 0.0))
    if nodes[article].name in ("", "html", "body"):
        kept: list[Block] = []
        for b, is_content in reversed(list(zip(believed, content))):
            heads = nodes[b.node].name in HEADINGS and kept and nodes[b.node].parent == nodes[kept[-1].node].parent
            if is_content or heads:
                kept.append(b)
        return " ".join(b.text for b in reversed(kept))
    inside, menus = _innermost_of([0, article], nodes), _menus(believed)
    return " ".join(b.text for b in believed if inside[b.node] == article and b.path not in menus)


def _menus(found: list[Block]) -> set[int]:
    """Paths with more than LINK_SHARE of their text in links."""
    size, linked = defaultdict(int), defaultdict(int)
    for b in found:
        size[b.path] += len(b.text)
        linked[b.path] += b.linked
    return {path for path in size if linked[path] > LINK_SHARE * size[path]}


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """(row, text, n_chars) per page: the input's columns, its main text and its code points.

    Null and empty pages give an empty text. Pages of any length are read whole, each by
    itself, so nothing is shuffled; repeated rows and other columns stay as they are.
    """

    def texts_of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    make = F.pandas_udf(texts_of, T.StringType()).asNondeterministic()  # so that it runs once for its two uses
    packed = pages.select(F.struct("*").alias("row"), make(F.col(page)).alias("text"))
    return packed.select("row", "text", F.length("text").cast("bigint").alias("n_chars"))
