"""Main text of web pages by the contiguous region with the greatest sum of scores.

Method. A page is read as a sequence of words and tags. Every word has a score, the chance that it
belongs to the article minus one half, every tag has one of zero or less, and one linear scan finds the region
with the greatest sum. Scores come from labelled pages: those that mark their article with an
``article`` or ``main`` element, which is the label and no feature. Features of a word are
where it stands (the outermost element around it that is furniture of the page, or else the nearest block), whether
it is in a link, the words and the linked share of its block, and the end of the block's text; a tag has its
place and name. Each feature value weighs the log of its odds inside and outside
articles over a bounded sample (``SAMPLE`` pages, those with the smallest hashes), beside fixed pseudo-counts for
values that the labelled pages do not have. Weights are clipped, so no single feature decides.

On a page that marks one article the mark moves scores: words inside gain, words outside lose, tags
inside cost nothing. Furniture inside the region (menus, adverts, notices, forms, comments) is left out. A page on which no
word scores above zero gives all blocks that are neither furniture nor links.

Text: character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by a line feed. Block elements and ``br`` end a block.

Defined results: a NULL or empty page, and one without words outside furniture, has the empty text and
0 characters; unclosed tags, comments and quotes are read as browsers do, a tag that never ends
hides the rest; repeated pages each get a row, with one text; without any labelled page the
pseudo-counts alone decide. Other columns are ignored; an empty table gives an empty result.

At scale: one narrow pass over a sample gives some hundred counts, one pass without a shuffle
scores all pages. Scanning, scoring and the search are linear in the length of a page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000
CLIP, SHAPE_CLIP = 2.0, 1.0
MARKED = 0.5

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title select option datalist map textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr input".split()
)
FURNITURE = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "fieldset": "form",
    "button": "form", "dialog": "notice",
}
ROLES = {
    "navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "sidebar",
    "search": "form", "form": "form", "dialog": "notice", "alertdialog": "notice", "alert": "notice",
}
# Words of class names and ids.
NAMES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar toc skip sitenav",
    "header": "header masthead topbar branding siteheader",
    "footer": "footer colophon copyright bottombar sitefooter",
    "sidebar": "sidebar aside widget widgets related recommended recommendations trending popular rail teaser teasers",
    "advert": "ad ads advert adverts advertisement adsense adslot sponsor sponsored promo promoted promotion banner dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay paywall newsletter subscribe subscription disclaimer",
    "form": "form login signin signup search searchbox",
    "comment": "comment comments commentlist disqus respond reply replies discussion",
    "share": "share sharing social",
}
CONTENT_NAMES = frozenset("article articlebody content post entry story main maincontent body text".split())
_KIND_OF_NAME = {name: kind for kind, names in NAMES.items() for name in names.split()}
# Elements that are furniture whatever they hold. Others with most words of a page and its heading wrap it.
_FIRM = frozenset(["nav", "footer", "aside"])
# Pseudo-counts (inside, outside) of feature values; others count PRIOR.
PRIOR = (1.0, 1.0)
PRIORS = {f"at:{kind}": (0.2, 20.0) for kind in NAMES} | {
    "at:p": (20.0, 2.0), "at:h1": (5.0, 1.0), "at:h2": (4.0, 1.0), "at:h3": (4.0, 1.0), "at:blockquote": (5.0, 1.0), "at:pre": (5.0, 1.0),
    "at:li": (4.0, 1.5), "at:td": (3.0, 1.5), "at:div": (1.0, 1.6), "link:yes": (2.0, 8.0), "link:no": (8.0, 4.0), "linked:most": (1.0, 8.0),
    "linked:none": (8.0, 3.0), "end:stop": (8.0, 2.0), "words:21+": (8.0, 1.0), "words:11-20": (4.0, 1.5), "words:1-2": (2.0, 4.0),
    "tag:p": (20.0, 2.0),
}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Element:
    tag: str
    parent: int
    kind: str = ""  # furniture by tag, role or name
    hidden: bool = False
    mark: str = ""  # article or main
    words: int = 0
    heads: int = 0  # article, main and h1 elements inside


@dataclass
class Block:
    element: int
    parts: list[str] = field(default_factory=list)
    n_words: int = 0
    linked: int = 0


@dataclass
class Page:
    """Elements, blocks of text, and the sequence: block numbers, or tags as (name, element)."""

    elements: list[Element]
    blocks: list[Block]
    sequence: list[int | tuple[str, int]]


def _kind(tag: str, attributes: dict[str, str]) -> str:
    if tag in FURNITURE:
        return FURNITURE[tag]
    if (role := attributes.get("role", "").lower()) in ROLES:
        return ROLES[role]
    if tag in ("html", "body", "main"):
        return ""
    names = [name.lower() for key in ("class", "id") for name in _NAME.findall(attributes.get(key, ""))]
    kinds = [_KIND_OF_NAME[name] for name in names if name in _KIND_OF_NAME]
    if "header" in kinds and not CONTENT_NAMES.isdisjoint(names):
        kinds = [kind for kind in kinds if kind != "header"]  # the heading of an entry
    return kinds[0] if kinds else ""


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """(text, '', ''), or (tag, 'open' | 'close', attributes); comments and declarations are left out."""
    place, size, lowered = 0, len(page), None
    while place < size:
        tag = page.find("<", place)
        if tag < 0:
            yield page[place:], "", ""
            return
        if tag > place:
            yield page[place:tag], "", ""
        following = page[tag + 1 : tag + 2]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 2)
            place = size if end < 0 else end + 3
        elif following in ("!", "?"):
            end = page.find(">", tag)
            place = size if end < 0 else end + 1
        elif following.isascii() and (following.isalpha() or following == "/"):
            found = _TAG.match(page, tag) or _LOOSE_TAG.match(page, tag)
            if not found:
                if following == "/" and not page[tag + 2 : tag + 3].isalpha():
                    place = tag + 2
                    continue
                return  # a tag without an end hides the rest
            close, name, rest = found.groups()
            name, place = name.lower(), found.end()
            yield name, "close" if close else "open", rest
            if name in RAW and not close:
                lowered = page.lower() if lowered is None else lowered
                if len(lowered) != size:  # a letter whose lower case is longer
                    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), page)
                end = lowered.find(f"</{name}", place)
                yield page[place : size if end < 0 else end], "", ""
                place = size if end < 0 else end
        else:
            yield "<", "", ""
            place = tag + 1


# Open elements that an opening tag closes, up to the nearest of the elements that hold them.
_CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
           "th": ("td th", "tr table"), "option": ("option", "select")}


def parse(page: str) -> Page:
    elements = [Element("", -1)]
    stack, open_tags = [0], Counter()
    links = 0
    blocks: list[Block] = []
    sequence: list[int | tuple[str, int]] = []
    block: Block | None = None

    def pop() -> None:
        nonlocal links
        tag = elements[stack.pop()].tag
        open_tags[tag] -= 1
        links -= tag == "a"

    for text, kind, rest in _pieces(page):
        if not kind:
            element = elements[stack[-1]]
            if element.hidden or not text:
                continue
            text = html.unescape(text)
            words = len(text.split())
            if block is None:
                if not words:
                    continue
                block = Block(stack[-1])
                sequence.append(len(blocks))
                blocks.append(block)
            block.parts.append(text)
            block.n_words += words
            element.words += words
            if links:
                block.linked += words
            continue
        tag = text
        if kind == "open":
            shown = not elements[stack[-1]].hidden
            if shown and open_tags["p"] and tag not in INLINE | VOID | HIDDEN:
                # A block ends an open paragraph with the inline elements in it.
                for place in range(len(stack) - 1, 0, -1):
                    above = elements[stack[place]].tag
                    if above == "p":
                        while len(stack) > place:
                            pop()
                    if above not in INLINE:
                        break
            if shown and tag in _CLOSES:
                closed, holders = (names.split() for names in _CLOSES[tag])
                if any(open_tags[name] for name in closed):
                    for place in range(len(stack) - 1, 0, -1):
                        above = elements[stack[place]].tag
                        if above in holders:
                            break
                        if above in closed:
                            while len(stack) > place:
                                pop()
            attributes = _attributes(rest) if rest.strip(" /") else {}
            parent = elements[stack[-1]]
            hidden = parent.hidden or tag in HIDDEN or "hidden" in attributes or bool(_HIDDEN_STYLE.search(attributes.get("style", "")))
            new = Element(tag, stack[-1], _kind(tag, attributes), hidden)
            if tag in ("article", "main") or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody":
                new.mark = "" if new.kind else "article" if tag == "article" else "main"
            elements.append(new)
            if tag not in INLINE:
                block = None
                if not parent.hidden:
                    sequence.append((tag, len(elements) - 1))
            if tag not in VOID:
                stack.append(len(elements) - 1)
                open_tags[tag] += 1
                links += tag == "a"
        elif open_tags[tag]:
            if tag not in INLINE:
                block = None
                sequence.append((tag, stack[-1]))
            elif elements[stack[-1]].tag != tag and any(elements[n].tag not in INLINE for n in stack[-8:] if elements[n].tag != tag):
                continue  # an inline end tag does not end blocks
            while elements[stack[-1]].tag != tag:
                pop()
            pop()
        elif tag == "p" or tag == "br":
            block = None
    for number in range(len(elements) - 1, 0, -1):
        element = elements[number]
        elements[element.parent].words += element.words
        elements[element.parent].heads += element.heads + (element.tag == "h1" or bool(element.mark))
    return Page(elements, blocks, sequence)


def _settled(page: Page) -> tuple[list[str], list[bool], bool]:
    """Per element the furniture around it, if any, and whether it lies in the marked article; whether there is one."""
    elements, total = page.elements, page.elements[0].words
    kinds, inside = [""] * len(elements), [False] * len(elements)
    in_main = [False] * len(elements)
    marks: list[int] = []
    for number, element in enumerate(elements[1:], 1):
        parent = element.parent
        in_main[number] = in_main[parent] or bool(element.mark)
        kind = element.kind
        wraps = element.tag not in _FIRM and kind != "comment" and element.heads and 2 * element.words > total
        if wraps or (kind == "header" and in_main[number]):
            kind = ""
        kinds[number] = kinds[parent] or kind
        if element.mark and not kinds[number] and not element.hidden:
            marks.append(number)
    # Articles count before main elements; nested ones belong to the outermost; several articles mark none.
    chosen = [n for n in marks if elements[n].mark == "article"] or marks
    for number in chosen:
        inside[number] = True
    outer = []
    for number, element in enumerate(elements[1:], 1):
        if inside[element.parent]:
            inside[number] = True
        elif inside[number]:
            outer.append(number)
    if len(outer) > 1:
        best = max(outer, key=lambda n: elements[n].words)
        if 2 * elements[best].words <= sum(elements[n].words for n in outer):
            outer = []
        else:
            outer = [best]
        inside = [False] * len(elements)
        for number in outer:
            inside[number] = True
        for number, element in enumerate(elements[1:], 1):
            inside[number] = inside[number] or inside[element.parent]
    return kinds, inside, bool(outer)


def _nearest_block(page: Page, number: int) -> str:
    while number and (page.elements[number].tag in INLINE or page.elements[number].mark):
        number = page.elements[number].parent
    return page.elements[number].tag if number else "body"


# Names that count as features; other elements share one.
_KNOWN = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd div section td th tr table tbody blockquote pre figure figcaption br hr center address"
    " details summary body nav header footer aside form html".split()
)


# Blocks that are short and without a stop wherever they stand.
_SHORT = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th figcaption".split())


def _word_features(page: Page, block: Block, kinds: list[str]) -> list[str]:
    at = kinds[block.element] or _nearest_block(page, block.element)
    share = block.linked / block.n_words
    linked = "none" if not block.linked else "some" if share < 0.34 else "much" if share < 0.67 else "most"
    n = block.n_words
    size = "1-2" if n < 3 else "3-5" if n < 6 else "6-10" if n < 11 else "11-20" if n < 21 else "21+"
    if at in _SHORT:
        return [f"at:{at}", f"link:{'yes' if share > 0.5 else 'no'}", f"linked:{linked}"]
    last = "".join(block.parts).rstrip()[-1:]
    end = "stop" if last in ".!?:;,\"'»”…" else "open"
    at = at if kinds[block.element] or at in _KNOWN else "other"
    return [f"at:{at}", f"link:{'yes' if share > 0.5 else 'no'}", f"linked:{linked}", f"words:{size}", f"end:{end}"]


def _tag_features(page: Page, name: str, number: int, kinds: list[str]) -> list[str]:
    return [f"at:{kinds[number]}"] if kinds[number] else [f"tag:{name if name in _KNOWN else 'other'}"]


def label_counts(text: str) -> Counter[tuple[str, bool]]:
    """Words and tags per feature value and side of a page that marks its article; nothing for other pages."""
    page = parse(text)
    kinds, inside, marked = _settled(page)
    counts: Counter[tuple[str, bool]] = Counter()
    if not marked:
        return counts
    for item in page.sequence:
        if isinstance(item, int):
            block = page.blocks[item]
            side = inside[block.element] and not kinds[block.element]
            for name in ["all", *_word_features(page, block, kinds)]:
                counts[name, side] += block.n_words
        elif not page.elements[item[1]].mark:
            side = inside[item[1]] and not kinds[item[1]]
            for name in _tag_features(page, *item, kinds):
                if name.startswith("tag:"):
                    counts[name, side] += 1
    return counts


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Clipped log odds of each feature value, from counts and pseudo-counts."""
    names = {name for name, _ in counts} | set(PRIORS)
    # Sides of different size are made alike; counts weigh as shares of a thousand words each.
    scale = {side: 1000 / max(1, counts.get(("all", side), 0)) for side in (True, False)}
    found = {}
    for name in names - {"all"}:
        a, b = PRIORS.get(name, PRIOR)
        a, b = a + scale[True] * counts.get((name, True), 0), b + scale[False] * counts.get((name, False), 0)
        clip = CLIP if name.startswith(("at:", "tag:", "link:")) else SHAPE_CLIP
        found[name] = max(-clip, min(clip, math.log(a / b)))
    return found


def _score(names: list[str], weights: dict[str, float]) -> float:
    """Chance of being content, less one half."""
    return 1 / (1 + math.exp(-sum(weights.get(name, 0.0) for name in names))) - 0.5


def region(scores: list[float]) -> tuple[int, int]:
    """First place and end of the contiguous part with the greatest positive sum; the first, longest one of equals."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for place, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, place
        total += score
        if total > best or (total == best and best and start == found[0]):
            best, found = total, (start, place + 1)
    return found


def extract(text: str, weights: dict[str, float]) -> str:
    """Main text of a page."""
    page = parse(text)
    if not page.blocks:
        return ""
    kinds, inside, marked = _settled(page)
    scores = []
    for item in page.sequence:
        number = page.blocks[item].element if isinstance(item, int) else item[1]
        if isinstance(item, int):
            block = page.blocks[item]
            score = 0.0 if kinds[number] else _score(_word_features(page, block, kinds), weights)
            if marked and not kinds[number]:
                score = max(score, 0.0) + MARKED if inside[number] else min(score, 0.0) - MARKED
            scores.append(score * block.n_words)
        else:
            score = min(0.0, _score(_tag_features(page, *item, kinds), weights))
            scores.append(0.0 if marked and inside[number] else score)
    first, end = region(scores)
    kept = [page.blocks[item] for item in page.sequence[first:end] if isinstance(item, int)]
    if first == end:  # too little text to tell: all that is neither furniture nor links
        kept = [block for block in page.blocks if 2 * block.linked < block.n_words]
    lines = (" ".join("".join(block.parts).split()) for block in kept if not kinds[block.element])
    return "\n".join(lines)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, bool]] = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(label_counts(text.as_py() or ""))
    names = [name for name, _ in counts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([side for _, side in counts], pa.bool_()), pa.array(list(counts.values()), pa.int64())],
        ["name", "side", "n"],
    )


def learned_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` labelled pages. Feature values are a fixed set, so few rows come to the driver."""
    marked = pages.filter(r"html rlike '(?i)<(article|main)[\\s>]'")
    # A cut of the hashes first, so that the sample's own size, not the table's, decides what is sorted.
    share = min(1.0, 2 * sample / max(1, marked.count()))
    placed = marked.selectExpr("html", "shiftrightunsigned(xxhash64(page_id, html), 11) as place").filter(f"place <= {int(share * (1 << 53))}L")
    chosen = placed.orderBy("place").limit(sample).select("html")
    counted = chosen.mapInArrow(_counting, "name string, side boolean, n bigint")
    rows = counted.groupBy("name", "side").agg(F.expr("sum(n) as n")).collect()
    return weights_from({(row["name"], row["side"]): row["n"] for row in rows})


def _extracting(weights: dict[str, float]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(text.as_py() or "", weights) for text in batch.column("html")]
            ids = [batch.column("page_id"), batch.column("url")]
            arrays = [*ids, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return work


def main_texts(pages: DataFrame, sample: int = SAMPLE, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: page_id, url, its main text and the characters of that."""
    known = learned_weights(pages, sample) if weights is None else weights
    narrow = pages.selectExpr("bigint(page_id) as page_id", "url", "html")
    return narrow.mapInArrow(_extracting(known), "page_id bigint, url string, text string, n_chars bigint")
