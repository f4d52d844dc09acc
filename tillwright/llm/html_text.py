"""Main text of HTML pages by two-pass block rules (operator 10).

A page is cut into blocks at block-level tags. Pass one decides blocks by length, link density and
stop-word density; headings and short blocks stay open. Pass two lets open blocks inherit from the
nearest decided neighbours. Elements that are never article text (navigation, forms, scripts, adverts,
comments and so on) are left out beforehand by tag, role and class.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import SPACES, slices

# Tags, and words of class, id and role, in natural groups.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol option p pre search "
    "section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED_TAGS = frozenset(
    "aside audio button canvas datalist dialog embed footer head header iframe input label legend menu nav noembed "
    "noframes noscript object option script search select style svg template textarea title video xmp".split()
)
SKIPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
SKIPPED_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored sponsors promo promotion promoted "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager skip toc "
    "header masthead topbar footer colophon copyright "
    "sidebar aside rail widget widgets related recommended recommendations trending popular "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "comment comments commentlist disqus respond replies reply discussion "
    "share sharing social tags hidden".split()
)
# Words that say nothing about an element beside one of the above, and words after which no text is the article's.
LAYOUT_WORDS = frozenset("area bar block body bottom box center container content group inner item items layout left list main middle outer panel right row section top wrap wrapper".split())
NEVER_TEXT = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored sponsors comment comments commentlist disqus "
    "respond replies reply cookie cookies consent gdpr newsletter subscribe subscription signup login paywall hidden".split()
)
# Elements that hold the article even if a class of theirs has one of the words above.
KEPT_TAGS = frozenset("html body article main".split())
# Opening one of these ends an open element of the named ones, as their end tags may be left out.
CLOSES = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
STOP_WORDS = frozenset(
    # English, German, French, Spanish
    "a an and are as at be by for from has he in is it its of on or she that the their they this to was were will with you "
    "als am auch auf aus bei das dem den der des die ein eine einer es für im in ist mit nicht sich sie sind und von war wie zu zum "
    "au aux avec ce ces dans de des du elle en est et il la le les leur ne ou par pas plus pour qu que qui se son sur un une "
    "al con de del el en es esta este la las lo los más no para pero por que se sin su sus un una y".split()
)

# Blocks of an article that hold few stop words by their nature.
PLAIN_TAGS = frozenset("pre li dd dt td th table tr tbody caption figcaption ul ol dl".split())

SHORT_CHARS, LONG_CHARS = 70, 200
MAX_LINK_DENSITY = 0.33
LOW_STOP_WORDS, HIGH_STOP_WORDS = 0.05, 0.12
GOOD, BAD, OPEN = 1, 0, -1

_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|/[^A-Za-z>][^>]*>|/>)", re.DOTALL)
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]*+))?(?=[\s/>\"']|\Z)", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z]+")
_SPACE_RUN = re.compile(r"\s+")
_WORDS = re.compile(r"\w+")
_SHOUT = re.compile(r"!!|!\s*\Z|[0-9]\s?%|[$\u20ac\u00a3]\s?[0-9]|[0-9]\s?[$\u20ac\u00a3]|\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b", re.DOTALL)


@dataclass
class Block:
    """A run of text between block-level tags."""

    tag: str
    in_article: bool
    text: str
    linked: int
    label: int = field(default=OPEN)
    doubtful: tuple[int, ...] = ()  # the open elements that may be none of the article, by number


KEPT, DOUBTFUL, LEFT_OUT = 0, 1, 2


def _standing(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element is left out, or to be judged by how much of the page's text it holds.

    That is for forms, as some pages are one form, and for elements of an article whose names have other words too.
    """
    if tag in SKIPPED_TAGS:
        # An article's own header holds its headline.
        return KEPT if tag == "header" and in_article else LEFT_OUT
    standing = DOUBTFUL if tag == "form" else KEPT
    if not attributes or tag in KEPT_TAGS:
        return standing
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return LEFT_OUT
        if name == "role" and value in SKIPPED_ROLES and not (tag == "form" and value == "form"):
            return LEFT_OUT
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return LEFT_OUT
        if name in ("class", "id"):
            # Names such as comment-list or adBanner consist of words; all-inclusive wrappers are kept.
            for word in re.split(r"\s+", (match[2] or "").strip("\"'")):
                parts = [p.lower() for p in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", word)]
                if parts and not {"no", "has", "with", "without"} & set(parts) and SKIPPED_WORDS & set(parts):
                    others = set(parts) - SKIPPED_WORDS - LAYOUT_WORDS
                    if not in_article or not others or NEVER_TEXT & set(parts):
                        return LEFT_OUT
                    standing = DOUBTFUL
    return standing


def blocks(page: str) -> list[Block]:
    """The blocks of a page in page order, without elements that are left out."""
    found: list[Block] = []
    stack: list[str] = []
    skipped_at = 0  # height of the stack below the outermost skipped element, from 1; 0: none
    links = articles = linked = 0
    doubts: list[tuple[int, int]] = []  # (height of the stack, number) of open doubtful elements
    numbers = 0
    parts: list[str] = []
    block_tag = "body"

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE_RUN.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                found.append(Block(block_tag, articles > 0, text, linked, doubtful=tuple(n for _, n in doubts)))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skipped_at:
            parts.append(text)
            if links:
                linked += len(text)

    def close(height: int) -> None:
        nonlocal skipped_at, links, articles
        for tag in stack[height:]:
            links -= tag == "a"
            articles -= tag in ("article", "main")
        del stack[height:]
        while doubts and doubts[-1][0] > height:
            doubts.pop()
        if skipped_at > height:
            skipped_at = 0

    at, size = 0, len(page)
    while at < size:
        opened = page.find("<", at)
        if opened < 0:
            add(page[at:])
            break
        match = _TAG.match(page, opened)
        if not match and page[opened + 1 : opened + 2].isalpha() or not match and page[opened + 1 : opened + 2] == "/":
            match = _LOOSE_TAG.match(page, opened)  # an open quote
        if not match:
            add(page[at : opened + 1])
            at = opened + 1
            continue
        add(page[at:opened])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            add(" ")
        if tag in BLOCK_TAGS and not skipped_at:
            flush()
            block_tag = tag
        if match[1]:
            # An end tag closes its element and all in it, if it is open within the same article.
            for height in range(len(stack) - 1, -1, -1):
                if stack[height] == tag:
                    close(height)
                    break
                if stack[height] in ("article", "main", "body", "td", "th") and tag not in ("html", "body", "article", "main", "table", "tr", "div", "section"):
                    break
            if tag in BLOCK_TAGS:
                block_tag = next((t for t in reversed(stack) if t in BLOCK_TAGS), "body")
            continue
        if tag in VOID_TAGS:
            continue
        if tag in CLOSES:
            for height in range(len(stack) - 1, -1, -1):
                if stack[height] in CLOSES[tag]:
                    close(height)
                    break
                if stack[height] in ("ul", "ol", "dl", "table", "select", "article"):
                    break
        if tag == "body":  # ends a head that was left open
            close(next((h for h, t in enumerate(stack) if t == "head"), len(stack)))
        if tag in ("article", "main") and "head" in stack:
            close(stack.index("head"))
        stack.append(tag)
        links += tag == "a"
        if not skipped_at:
            standing = _standing(tag, match[3] or "", articles > 0)
            if standing == LEFT_OUT:
                skipped_at = len(stack)
            elif standing == DOUBTFUL:
                numbers += 1
                doubts.append((len(stack), numbers))
        articles += tag in ("article", "main")
        if tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            close(len(stack) - 1)
    flush()
    return found


def _density(block: Block) -> float:
    words = _WORDS.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _first_label(block: Block, telling: bool) -> int:
    """Pass one: decided by links, length and stop words; short blocks and headings stay open.

    In an article links speak for nothing, and a low density only against words in capitals. Where stop
    words are not ``telling``, as the page's language has others, length decides in an article.
    """
    size = len(block.text)
    if not block.in_article and block.linked > MAX_LINK_DENSITY * size:
        # A paragraph can be one long link, and is then like its neighbours.
        return OPEN if block.tag == "p" and size >= SHORT_CHARS and _density(block) >= HIGH_STOP_WORDS else BAD
    if size < SHORT_CHARS or block.tag in HEADINGS:
        return OPEN
    if block.in_article and (not telling or block.tag in PLAIN_TAGS):
        return GOOD
    density = _density(block)
    if density >= HIGH_STOP_WORDS or size >= LONG_CHARS and density >= LOW_STOP_WORDS:
        return GOOD
    if density >= LOW_STOP_WORDS or size >= LONG_CHARS:
        return OPEN
    # A paragraph of an article may have no stop word, as a list of names; an advert in it shouts too.
    return OPEN if block.in_article and not _shouts(block) else BAD


def _shouts(block: Block) -> bool:
    words = [w for w in _WORDS.findall(block.text) if w[0].isalpha()]
    capitals = 2 * sum(w[0].isupper() for w in words) >= len(words)
    return capitals and bool(_SHOUT.search(block.text))


def label(found: list[Block]) -> None:
    """Both passes, in place.

    In pass two an open block takes the label of its nearest decided neighbours: theirs if they agree
    or if there is one only. Where they differ, a heading goes with the block after it, a block of an
    article is kept, and another is not. Without any decided block, blocks of an article and paragraphs
    are kept.
    """
    telling = any(len(block.text) >= SHORT_CHARS and _density(block) >= HIGH_STOP_WORDS for block in found)
    for block in found:
        block.label = _first_label(block, telling)
    before: list[int] = []
    last = OPEN
    for block in found:
        before.append(last)
        last = block.label if block.label != OPEN else last
    following = OPEN
    for at in range(len(found) - 1, -1, -1):
        block = found[at]
        if block.label != OPEN:
            following = block.label
            continue
        sides = {before[at], following} - {OPEN}
        if block.in_article and (GOOD in sides or not sides):
            decided = GOOD
        elif len(sides) == 1:
            decided = sides.pop()
        elif not sides:
            decided = GOOD if block.in_article or block.tag == "p" else BAD
        else:
            decided = following if block.tag in HEADINGS else BAD
        block.label = decided


def _without_doubtful(found: list[Block]) -> list[Block]:
    """The blocks but for those in a doubtful element that holds no more than half of the accepted text."""
    if not any(block.doubtful for block in found):
        return found
    label(found)
    total, held = 0, {}
    for block in found:
        if block.label == GOOD:
            total += len(block.text)
            for number in block.doubtful:
                held[number] = held.get(number, 0) + len(block.text)
    kept = [block for block in found if all(2 * held.get(number, 0) > total for number in block.doubtful)]
    for block in kept:
        block.label = OPEN
    return kept


def main_text(page: str) -> str:
    """Blocks of the main text, white space made even, joined by an empty line.

    Blocks outside articles are left out only where articles hold most of what the rules accept.
    """
    found = _without_doubtful(blocks(page))
    label(found)
    accepted = [block for block in found if block.label == GOOD]
    inside = sum(len(block.text) for block in accepted if block.in_article)
    if 2 * inside > sum(len(block.text) for block in accepted):
        found = [block for block in found if block.in_article]
        label(found)
    return "\n\n".join(block.text for block in found if block.label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages``.

    A null or empty page has an empty text. Broken markup, unclosed tags and attributes never fail a
    page. Repeated rows and null ids get a row each; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
