"""Main text of web pages by tag-path ratios.

A page is scanned into its texts, each with the path of tags from the root to it; tags without meaning of their own, such as
links and emphasis, don't count. Per path the texts, their characters, their punctuation and the characters in links are
summed. The ratios of a path, characters and punctuation per text, are smoothed along the page with a Gaussian window over
neighbouring blocks. Smoothed and own ratios are fused into one score by multiplication, with the share outside links and
the weight of the path's tags, and paths from the threshold on (a share of the spread of all scores) hold content. The article is the smallest element
around most of their text; its blocks are returned whole and in order, so that headings and one-word paragraphs, whose own
paths score low, stay. Elements that are no article by their tag, role or class (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, scripts, styles) are left out wherever they are.

Character references are decoded, any white space inside a block becomes one space, blocks are joined by line breaks. Line
breaks by ``br`` are white space. Tags need not be closed: a block ends an open paragraph, an item or cell ends the one
before, and a close tag ends what is open inside it.

Scale. Pages are worked on one by one where they lie: no shuffle, nothing kept between pages.

Results for odd input: a null or empty page, or one without an article, has an empty text; one that stops in the middle is
read as far as it goes, and text without any tag is one block. Repeated rows and null keys are returned as they come. An
empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.words import whole

PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
# A comment, a declaration, or a tag with its name and attributes, in which quoted values may hold ">".
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))")

# What HTML says of its elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style title textarea template noscript iframe noembed noframes object svg math canvas audio video select".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table article section main div body blockquote".split())
ARTICLES = frozenset(["article", "main"])
# Elements that hold a piece of an article, not a whole one.
LEAVES = frozenset("p pre li dt dd blockquote h1 h2 h3 h4 h5 h6".split())
# Parts of a page that are no article.
ASIDE_TAGS = frozenset("nav footer aside form dialog menu button fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
ASIDE_CLASS = re.compile(
    r"^(?:(?:[a-z0-9]+[-_])*(?:ad|ads|advert|adverts|advertisement|advertising|adsbygoogle|sponsor|sponsored|promo|banner|nav|"
    r"navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|footer|masthead|cookie|cookies|consent|gdpr|notice|popup|modal|"
    r"newsletter|subscribe|signup|comment|comments|disqus|replies|respond|share|sharing|social|related|recommended|"
    r"recommendations|widget|toolbar|login|search|pagination|pager|skip)(?:[-_][a-z0-9]+)*|header|(?:page|site|top)[-_]header)$"
)
NEVER_ASIDE = frozenset(["", "html", "body"])
BODY_CLASS = re.compile(r"^(?:(?:[a-z0-9]+[-_])*(?:article|content|post|entry|story|maintext|main|body)(?:[-_][a-z0-9]+)*)$")

# How much a tag on a path speaks for content.
WEIGHTS = {"article": 4.0, "main": 3.0, "p": 2.0, "pre": 2.0, "blockquote": 2.0, "li": 0.7, "td": 0.8}
HEAVIEST = 1e6
SPREAD, REACH, SIGMA = 0.5, 2, 1.0
KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-REACH, REACH + 1)]
MOST_TEXT = 0.8
# Links outside articles: these shares of a list's or a block's characters are linked, in short texts.
LINKED, MOST_LINKED, SHORT = 0.6, 0.9, 60


class Element:
    """An element: its tag, its parent, the number of its tag path, and what it says about being part of an article."""

    __slots__ = ("tag", "parent", "path", "weight", "depth", "aside", "in_article", "holds_article", "chars", "best", "within")

    def __init__(self, tag: str, parent: Element | None, attributes: str, numbers: dict[tuple[int, str], int]):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.in_article = parent is not None and (parent.in_article or parent.tag in ARTICLES)
        self.holds_article = False
        self.chars = self.best = 0
        named = {}
        if attributes and not attributes.isspace():
            named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        classes = f"{named.get('class', '')} {named.get('id', '')}".lower().split()
        label = f"{tag}.{classes[0]}" if classes else tag
        self.path = numbers.setdefault((parent.path if parent else -1, label), len(numbers))
        # The weight of a path is that of its tags together, within bounds.
        self.weight = WEIGHTS.get(tag, 2.0 if any(BODY_CLASS.match(c) for c in classes) else 1.0)
        if parent:
            self.weight = min(self.weight * parent.weight, HEAVIEST)
        if tag in ARTICLES:
            # Reader comments may come as articles of their own.
            self.aside = any(_aside_class(c) and ("comment" in c or "repl" in c) for c in classes)
        elif tag in NEVER_ASIDE:
            self.aside = False
        else:
            self.aside = tag in ASIDE_TAGS or named.get("role", "").lower() in ASIDE_ROLES or any(map(_aside_class, classes))
            self.aside = self.aside or (tag == "header" and not self.in_article)
        if tag in ARTICLES and not self.aside:
            up = parent
            while up is not None and not up.holds_article:
                up.holds_article = True
                up = up.parent


def _aside_class(name: str) -> bool:
    return not name.startswith(("with-", "has-", "no-", "without-")) and ASIDE_CLASS.match(name) is not None


class Block(NamedTuple):
    """Text between two block borders, with its element and how much of it is linked."""

    element: Element
    text: str
    linked: int

    @property
    def is_link(self) -> bool:
        """Little but links, and short."""
        return len(self.text) <= SHORT and self.linked >= MOST_LINKED * len(self.text.replace(" ", ""))


def blocks(html: str) -> tuple[list[Element], list[Block]]:
    """The elements of a page and its non-empty blocks, both in order."""
    numbers: dict[tuple[int, str], int] = {}
    current = Element("", None, "", numbers)
    elements, found = [current], []
    opened: Counter[str] = Counter()
    pieces, linked, links = [], 0, False

    def end_block() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append(Block(current, text, min(linked, len(text))))
            pieces, linked = [], 0

    def close(tags: frozenset[str] | tuple[str, ...]) -> None:
        """Close the innermost element of these tags and what is open in it."""
        nonlocal current
        while True:
            tag, current = current.tag, current.parent
            opened[tag] -= 1
            if tag in tags:
                return

    at = 0
    while at < len(html):
        m = MARKUP.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at:
            pieces.append(html[at:upto])
            linked += len(html[at:upto].strip()) if links else 0
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        ends, tag = m[1] == "/", m[2].lower()
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            links = not ends if tag == "a" else links
            continue
        end_block()
        links = False
        if ends:
            if opened[tag]:
                close((tag,))
            continue
        if tag in UNSEEN:
            # Nothing in there is markup or text of the page.
            over = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = at if m[0].endswith("/>") else over.end() if over else len(html)
            continue
        # An open paragraph ends where a block begins, an item or cell where the next one does, unless that lies deeper.
        if current.tag == "p":
            close(("p",))
        if tag in CLOSED_BY:
            up = current
            while up.parent is not None and up.tag not in SCOPES and up.tag not in CLOSED_BY[tag]:
                up = up.parent
            if up.tag in CLOSED_BY[tag]:
                close(CLOSED_BY[tag])
        if tag not in VOID and not m[0].endswith("/>"):
            current = Element(tag, current, m[3], numbers)
            elements.append(current)
            opened[tag] += 1
    end_block()
    return elements, found


class Path:
    """What the blocks of one tag path have together."""

    __slots__ = ("blocks", "chars", "marks", "linked", "weight", "score")

    def __init__(self, weight: float):
        self.blocks = self.chars = self.marks = self.linked = 0
        self.weight, self.score = weight, 0.0

    @property
    def is_menu(self) -> bool:
        """A list of links."""
        return self.blocks > 2 and self.linked >= LINKED * self.chars and self.chars <= SHORT * self.blocks


def score_paths(found: list[Block]) -> tuple[list[Path], float]:
    """The path of each block with its fused score, and the threshold."""
    by_number: dict[int, Path] = {}
    paths = []
    for block in found:
        e = block.element
        # Elements of one path may still differ in a second class, or in what they hold.
        path = by_number.setdefault(2 * e.path + e.aside, Path(0.0 if e.aside else e.weight))
        path.blocks += 1
        path.chars += len(block.text)
        path.marks += len(PUNCTUATION.findall(block.text))
        path.linked += block.linked
        paths.append(path)
    # What is no article lends nothing to its neighbours.
    ratios = [(p.chars / p.blocks, p.marks / p.blocks) if p.weight else (0.0, 0.0) for p in paths]
    for i, path in enumerate(paths):
        window = range(max(0, i - REACH), min(len(paths), i + REACH + 1))
        total = sum(KERNEL[j - i + REACH] for j in window)
        chars, marks = (sum(KERNEL[j - i + REACH] * ratios[j][k] for j in window) / total for k in (0, 1))
        fused = math.sqrt(chars * ratios[i][0]) * (1 + math.sqrt(marks * ratios[i][1]))
        path.score += fused * (1 - path.linked / path.chars) * path.weight / path.blocks
    scores = [p.score for p in by_number.values()]
    mean = sum(scores) / len(scores)
    spread = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    return paths, min(SPREAD * spread, max(scores))


def article_of(elements: list[Element], found: list[Block], paths: list[Path], threshold: float) -> Element | None:
    """The smallest element around all blocks of the best path and most of the text of all content paths."""
    best = max(paths, key=lambda p: p.score)
    if best.score <= 0:
        return None
    for block, path in zip(found, paths):
        if path.score > 0 and path.score >= threshold:
            block.element.chars += len(block.text)
            block.element.best += path is best
    for e in reversed(elements[1:]):
        e.parent.chars += e.chars
        e.parent.best += e.best
    enough = [e for e in elements if e.best == best.blocks and e.chars >= MOST_TEXT * elements[0].chars and e.tag not in LEAVES]
    smallest = up = max(enough, key=lambda e: e.depth)
    while up is not None:
        if up.tag in ARTICLES:
            return up
        up = up.parent
    return smallest


def main_text(html: str) -> str:
    """The blocks of the article, joined by line breaks."""
    elements, found = blocks(html)
    if not found:
        return ""
    for e in elements:
        held = e.holds_article and e.tag not in ARTICLES
        e.aside = (e.aside and not held) or (e.parent is not None and e.parent.aside)
    paths, threshold = score_paths(found)
    article = article_of(elements, found, paths, threshold)
    if article is None:
        return ""
    for e in elements:
        e.within = e is article or (e.parent is not None and e.parent.within)
    kept, title, titled = [], [], False
    for block, path in zip(found, paths):
        e = block.element
        if e.aside:
            continue
        if e.within and (article.tag in ARTICLES or not (path.is_menu or block.is_link)):
            titled = titled or e.tag == "h1"
            kept.append(block.text)
        elif not kept and e.tag == "h1":
            title = [block.text]
    # A heading above the article is its title, unless the article has one.
    return "\n".join(kept if titled else title + kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, url, ``text`` and ``n_chars``."""
    chosen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), whole(html).alias("html"))
    kinds = dict(chosen.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), texts], names=["key", "url", "text"])

    found = chosen.mapInArrow(run, f"key {kinds['key']}, url {kinds['url']}, text string")
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
