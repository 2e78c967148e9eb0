"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level tags. The first pass looks at each block alone: the share of stop
words, the length and the share of text in links make it good, bad or undecided; blocks in elements that
hold menus, headers, footers, sidebars, notices, adverts, forms or comments are bad. The second pass lets
undecided, mostly short blocks take the label of their nearest decided neighbours, so that a heading goes
with its article and a stray link with its menu. Where a page marks its article, blocks outside it are bad
and undecided ones inside it are good unless all their decided neighbours there are bad.

Null or empty html gives empty text. Every page is read by itself, in time linear in its length for
well-formed quotes; repeated rows, null ids and extra columns make no difference, and an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import extended, slices

GOOD, BAD, UNDECIDED = 1, -1, 0

#: Characters below which a block is short, and from which a dense one is good by itself.
SHORT, LONG = 70, 200
#: Share of stop words from which text reads as prose, and below which a long block does not.
STOP_HIGH, STOP_LOW = 0.30, 0.10
#: Share of characters in links from which a block is a list of links.
LINKS = 0.5

#: Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can could did do for from had has have he her his how if
    in into is it its more not of on one or our out she so some than that the their them then there these they this
    to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer es für
    haben hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so um und uns vom von vor
    war was wenn wie wir wird zu zum zur über
    au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais me même mes
    ne nos nous on ont ou par pas plus pour qu que qui sa sans se ses son sont sur un une vous être
    al algo como con cuando de del desde donde el ella en entre era es esta este está fue ha hay la las le lo los más
    me mi muy ni no nos o para pero por porque que se ser si sin sobre su sus también un una uno y ya
    """.split()
)

_BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead tr ul
    """.split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
_HIDDEN = frozenset(
    "audio button canvas head iframe math noscript object script select style svg template textarea title video".split()
)
_BAD_TAGS = frozenset("aside dialog fieldset footer form menu nav".split())
_ARTICLE_TAGS = frozenset("article main".split())
#: Words of class, id and role that mark what is not the article.
_BAD_NAMES = frozenset(
    """
    ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent contentinfo
    cookie cookies disqus dialog footer gdpr login menu modal nav navbar navigation newsletter notice notices pagination
    pager popup promo promoted promotion related search share sharing sidebar signup social sponsor sponsored subscribe
    toolbar widget
    """.split()
)
_HEAD_NAMES = frozenset("header masthead topbar".split())
#: Words that say where or what a box is, and leave the rest of a compound name to decide.
_BOX_NAMES = frozenset(
    """
    area article block body bottom box button buttons col column container content desktop div fixed form global group
    header inner item items left link links list main mobile module outer overlay page panel post posts reader right
    row section site slot sticky top unit user wrap wrapper
    """.split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>|<[A-Za-z/!?][^>]*+\Z",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN_ATTRIBUTE = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in _HIDDEN}
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    """Text of one block with what the rules look at."""

    article: int = 0  # number of the article it lies in, 0 outside
    excluded: bool = False
    parts: list[str] = field(default_factory=list)
    link_parts: list[str] = field(default_factory=list)
    text: str = ""

    def weight(self) -> float:
        """Length in characters, of which those of ideographs and syllables count for more."""
        return len(self.text) + 1.5 * sum("\u2e80" <= c for c in self.text)

    def link_density(self) -> float:
        return sum(len("".join(unescape(p).split())) for p in self.link_parts) / max(1, len(self.text.replace(" ", "")))

    def stop_density(self) -> float:
        words = _WORD.findall(self.text.lower())
        return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _excluded(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _BAD_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if _HIDDEN_ATTRIBUTE.search(attributes):
        return True
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            # Of a compound name every word counts: an article may have a paragraph named "share-price".
            words = {w for w in re.split(r"[^a-z]+", name) if w}
            told = words - _BOX_NAMES
            if told and told <= _BAD_NAMES:
                return True
            if words & _HEAD_NAMES and told <= _HEAD_NAMES and not in_article:
                return True
    return False


def blocks(html: str) -> list[Block]:
    """The page's non-empty blocks in order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # tag, excluded from here on, article number
    opened: Counter[str] = Counter()  # tags on the stack, so that a closing one without them is passed over at once
    current = Block()
    articles = links = breaks = 0
    at, end = 0, len(html)

    def close_block() -> None:
        nonlocal current
        current.text = " ".join(unescape("".join(current.parts)).split())
        if current.text:
            found.append(current)
        _, excluded, article = stack[-1] if stack else ("", False, 0)
        current = Block(article, excluded)

    def add(text: str) -> None:
        nonlocal breaks
        if text:
            current.parts.append(text)
            if links:
                current.link_parts.append(text)
            if breaks and not text.isspace():
                breaks = 0

    while at < end:
        m = _TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in _HIDDEN:
            if not closing and tag != "head" and not attributes.rstrip().endswith("/"):
                stop = _RAW_END[tag].search(html, at)
                at = stop.end() if stop else end
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            breaks += 1
            if breaks == 2:
                close_block()
            else:
                add(" ")
            continue
        block = tag in _BLOCK
        if closing:
            while opened[tag]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == tag:
                    break
        elif tag not in _VOID and not attributes.endswith("/"):
            if block and stack and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1
            if tag in ("li", "dt", "dd", "td", "th", "tr", "option") and stack and stack[-1][0] == tag:
                opened[stack.pop()[0]] -= 1
            _, excluded, article = stack[-1] if stack else ("", False, 0)
            drop = _excluded(tag, attributes, article > 0)
            if tag in _ARTICLE_TAGS and not article and not (excluded or drop):
                articles += 1
                article = articles
            if block or drop:
                stack.append((tag, excluded or drop, article))
                opened[tag] += 1
            block = block or (drop and not excluded)
        if block or (closing and bool(stack or not current.parts) and current.excluded != (stack[-1][1] if stack else False)):
            close_block()
            breaks = 0
            links = 0
    close_block()
    return found


def known_language(found: list[Block]) -> bool:
    """Whether the page's longer blocks have stop words; those of other languages say nothing by lacking them."""
    words = [w for b in found if not b.excluded and b.weight() >= SHORT for w in _WORD.findall(b.text.lower())]
    return not words or sum(w in STOP_WORDS for w in words) >= STOP_LOW * len(words)


def first_pass(block: Block, marked: bool, known: bool = True) -> int:
    """The label a block gets by itself; ``marked`` says that the page marks its article.

    Where the page's language is not ``known``, length and links decide alone.
    """
    if block.excluded or (marked and not block.article):
        return BAD
    if not known:
        dense = block.link_density() >= LINKS
        return (UNDECIDED if block.article else BAD) if dense else GOOD if block.weight() >= SHORT else UNDECIDED
    dense = block.link_density() >= LINKS
    if len(block.text) < SHORT:
        return BAD if dense and not block.article else UNDECIDED
    if dense:
        return UNDECIDED if block.article else BAD
    stop = block.stop_density()
    if stop >= STOP_HIGH or (stop >= STOP_LOW and len(block.text) >= LONG):
        return GOOD
    return BAD if stop < STOP_LOW and not block.article else UNDECIDED


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Undecided blocks take the label of the nearest decided neighbour in the same region.

    With neighbours of both kinds the nearer one counts, the good one at equal distance. Without any, a
    block is good in a marked article and bad elsewhere.
    """
    n = len(found)
    before: list[tuple[int, int] | None] = [None] * n
    after: list[tuple[int, int] | None] = [None] * n
    for order, nearest in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, int]] = {}
        for i in order:
            nearest[i] = last.get(found[i].article)
            if labels[i] != UNDECIDED and not (found[i].article and found[i].excluded):
                last[found[i].article] = (labels[i], i)
    out = list(labels)
    for i, label in enumerate(labels):
        if label == UNDECIDED:
            sides = [(abs(i - s[1]), -s[0]) for s in (before[i], after[i]) if s]
            out[i] = -min(sides)[1] if sides else GOOD if found[i].article else BAD
    return out


def main_text(html: str) -> str:
    """Text of the good blocks, one per line.

    A page that the rules of a known language would leave empty is judged by length and links alone.
    """
    found = blocks(html)
    marked = any(b.article for b in found)
    labels: list[int] = []
    for known in (True, False):
        if known and not known_language(found):
            continue
        labels = second_pass(found, [first_pass(b, marked, known) for b in found])
        if GOOD in labels:
            break
    return "\n".join(b.text for b, label in zip(found, labels) if label == GOOD)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``text`` and ``n_chars`` for every page; the other columns but the html stay."""
    kept, schema = extended(pages, "text string, n_chars long", drop=html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [main_text(h) if h else "" for h in batch.column(html).to_pylist()]
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return pages.select(*kept, html).mapInArrow(run, schema)
