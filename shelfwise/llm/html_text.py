"""The main text of web pages by minimum cut.

A page is cut into text blocks. What a block looks like and where in the page it stands
give its gain as content; neighbouring blocks, and blocks with the same parent, are tied by
edges; the minimum cut parts content from boilerplate.

What an element is (nav, footer, hidden) settles all below it. What it is called, and being
a form, is weaker: layouts name wrappers after what stands beside the article. Such evidence
fades with the distance in the page and does not count for an element that holds the main
part, or most of the prose.
"""

from __future__ import annotations

import html as entities
import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.batches import bounded
from shelfwise.llm.mincut import min_cut

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({_ATTRS})>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Elements whose content is never text of the page.
RAW = frozenset("script style title noscript template textarea iframe object svg math select canvas audio video xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that ends when one of these begins beside it.
ENDS = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
BOILERPLATE = frozenset("nav footer aside menu button search dialog label legend".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog".split())
#: Words in a class or id.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion promoted nav navbar navigation menu menus "
    "sidebar side rail footer foot header masthead topbar toolbar breadcrumb breadcrumbs pagination pager comment comments commentlist reply replies respond "
    "disqus discussion cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login related recommended "
    "recommendations trending popular share sharing social widget widgets popup modal overlay banner copyright disclaimer legal search skip outbrain taboola "
    "paywall donate tagcloud feedback".split()
)
GOOD_WORDS = frozenset("article content main post entry story body text prose".split())


class Weights(NamedTuple):
    """Log odds that a block is content, and the weights of edges."""

    bias: float = -0.9
    words: float = 0.9
    sentence: float = 0.8
    links: float = -4.0
    paragraph: float = 0.9
    heading: float = 0.7
    item: float = -0.3
    article: float = 2.2
    main: float = 1.2
    good_name: float = 1.3
    boilerplate: float = -7.0
    fading: float = 0.9
    article_header: float = -2.0
    rights: float = -3.0
    adjacent: float = 0.8
    adjacent_apart: float = 0.25
    siblings: float = 0.5


class _Named:
    """An element with a bad name, or a form: what its subtree holds, and whether it counts."""

    __slots__ = ("number", "depth", "above", "main", "article", "prose", "texts", "anchored", "own", "counts")

    def __init__(self, number: int, depth: int, above: _Named | None):
        self.number, self.depth, self.above = number, depth, above
        self.main = self.article = False
        self.prose = self.texts = self.anchored = self.own = 0
        self.counts = True


class _Place(NamedTuple):
    tag: str
    number: int
    parent: int
    article: bool
    main: bool
    good: bool
    bad: bool
    header: bool
    link: bool
    depth: int
    named: _Named | None


class Block(NamedTuple):
    text: str
    link_share: float
    place: _Place


def _opened(tag: str, attrs: str, above: _Place, number: int) -> _Place:
    bad = above.bad or tag in BOILERPLATE
    good, link = above.good, above.link or tag == "a"
    header = above.header
    named = tag == "form"
    if tag == "header":
        if above.article:
            header = True
        else:
            bad = True
    if attrs:
        for name, a, b, c in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                words = {w.lower() for w in NAME.findall(value)}
                named = named or bool(words & BAD_WORDS)
                good = good or bool(words & GOOD_WORDS)
            elif name == "role":
                bad = bad or value.lower() in ROLES
                named = named or value.lower() == "form"
                good = good or value.lower() in ("main", "article")
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                bad = True
    main, article = above.main or tag == "main", above.article or tag == "article"
    depth, within = above.depth + (tag in BLOCK), above.named
    # An article inside boilerplate, or named like it, is a comment, a teaser or an advert.
    if not bad and (tag == "main" or (tag == "article" and not above.article and not named)):
        kind, holder = tag, within
        while holder is not None and not getattr(holder, kind):
            setattr(holder, kind, True)
            holder = holder.above
    if named and tag not in ("body", "html", "main", "article"):
        within = _Named(number, depth, within)
    return _Place(tag, number, above.number, article, main, good, bad, header, link, depth, within)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with decoded references and single spaces."""
    out: list[Block] = []
    stack = [_Place("", 0, -1, False, False, False, False, False, False, 0, None)]
    parts: list[str] = []
    linked = 0
    number = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                place = next((p for p in reversed(stack) if p.tag in BLOCK), stack[0])
                out.append(Block(text, min(1.0, linked / len(text)), place))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        if found is None:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if name is None:
            if page.startswith("<![CDATA[", found.start()):
                say(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag, attrs = name.lower(), found[3] or found[6] or ""
        if found[1] or found[4]:
            if tag in BLOCK:
                close()
            if any(p.tag == tag for p in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in RAW:
            if not attrs.endswith("/") or tag in ("script", "style", "title"):
                gone = re.compile(rf"</{tag}\s*[^>]*>|\Z", re.I).search(page, at)
                at = gone.end()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            close()
            for k in range(len(stack) - 1, 0, -1):
                if tag in ENDS.get(stack[k].tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag not in VOID and (tag in BLOCK or tag == "a" or attrs):
            number += 1
            stack.append(_opened(tag, attrs, stack[-1], number))
    close()
    return out


def judge_names(blocks: list[Block]) -> None:
    """Names that wrap the main part of the page do not count any more."""
    total = clean = 0
    known: dict[int, _Named] = {}
    for block in blocks:
        place = block.place
        if place.bad or block.link_share >= 0.5:
            continue
        size = len(block.text)
        total += size
        anchored = size * (place.article or place.main or place.good)
        if place.named is None:
            clean += anchored
            continue
        place.named.own += anchored
        place.named.prose += size
        place.named.texts += 1
        place.named.anchored += size * place.article
        holder = place.named
        while holder is not None and holder.number not in known:
            known[holder.number] = holder
            holder = holder.above
    order = [known[n] for n in sorted(known)]
    for held in reversed(order):
        if held.above is not None:
            held.above.prose += held.prose
            held.above.texts += held.texts
            held.above.anchored += held.anchored
    for held in order:  # from the outside in
        if held.above is not None and held.above.counts:
            continue
        # Nothing outside looks like the main part, and this does.
        alone = clean * 10 < total and (
            (held.article and held.anchored * 5 >= total) or (held.texts > 1 and held.prose * 2 > total)
        )
        if held.main or alone:
            held.counts = False
            clean += held.own


def gain_of(block: Block, w: Weights) -> float:
    """Log odds that a block is content."""
    place, text = block.place, block.text
    words = text.count(" ") + 1
    gain = w.bias + w.words * min(math.log1p(words) / math.log(21), 1.5) + w.links * block.link_share
    gain += w.sentence * (text[-1] in ".!?…:;\"'”»)")
    if place.tag in ("p", "pre", "blockquote"):
        gain += w.paragraph
    elif place.tag[:1] == "h" and place.tag[1:].isdigit():
        gain += w.heading
    elif place.tag in ("li", "td", "th", "dd", "dt", "option"):
        gain += w.item
    named = place.named is not None and place.named.counts
    gain += w.article * (place.article and not named) + w.main * place.main + w.good_name * place.good
    if place.bad:
        gain += w.boilerplate
    elif named:
        gain += w.boilerplate * w.fading ** (place.depth - place.named.depth)
    elif place.header and place.tag not in ("h1", "h2", "h3"):
        gain += w.article_header
    if text[0] == "©" or (words < 30 and ("©" in text or "all rights reserved" in text.lower())):
        gain += w.rights
    return gain


def main_text(page: str | None, w: Weights = Weights()) -> str:
    """The content blocks of a page, joined by empty lines."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    judge_names(blocks)
    edges, last = [], {}
    for i, block in enumerate(blocks):
        parent = block.place.parent
        if i:
            edges.append((i - 1, i, w.adjacent if blocks[i - 1].place.parent == parent else w.adjacent_apart))
        before = last.get(parent)
        if before is not None and before != i - 1:
            edges.append((before, i, w.siblings))
        last[parent] = i
    kept = min_cut([gain_of(b, w) for b in blocks], edges)
    return "\n\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def _extractor(at: int, names: list[str], weights: Weights):
    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(at)]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return run


def extract_text(pages: DataFrame, html: str = "html", weights: Weights = Weights()) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) in place of ``html`` and columns of these names.

    Character references are decoded, white space inside a block becomes one space, content
    blocks are joined by two line ends. A null or empty page, or one without content, has an
    empty text. Repeated rows are treated alike.
    """
    pages = bounded(pages).drop(*({"text", "n_chars"} - {html}))
    fields = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType(fields).add("text", "string").add("n_chars", "long")
    return pages.mapInArrow(_extractor(pages.columns.index(html), schema.names, weights), schema)
