"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page becomes a list of text blocks. A block's features are its word count and link
density, those of its two neighbours, and what encloses it. The tree is grown on the
labelled blocks of a few sample pages below.
"""
from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm import bytescan as B

#: Elements whose content is never page text.
RAW = frozenset("script style template noscript svg math iframe object canvas textarea select title audio video".split())
#: Those that may close themselves.
FOREIGN = frozenset(["svg", "math"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
BOILER_TAGS = frozenset("nav header footer aside form menu button dialog fieldset search label".split())
MAIN_TAGS = frozenset(["article", "main"])
#: Words of class, id and role that name what surrounds an article.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments complementary consent "
    "contentinfo cookie cookies copyright disclaimer disqus dropdown feedback footer form gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification pagination pager paywall popup privacy promo promoted promotion recommended "
    "related replies reply responses search share sharing sidebar signup social sponsor sponsored subscribe subscription tags teaser toc toolbar "
    "warning widget".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
#: Whose header is a headline, not that of the site.
OWN_HEADER = frozenset("article entry post story".split())
#: An element that starts ends these open ones, as far as the nearest of their containers.
CLOSES = {"li": (["li"], ["ul", "ol", "menu", "dir"]), "dt": (["dt", "dd"], ["dl"]), "dd": (["dt", "dd"], ["dl"]), "option": (["option"], ["select"]),
          "tr": (["tr", "td", "th"], ["table", "tbody", "thead", "tfoot"]), "td": (["td", "th"], ["tr", "table"]), "th": (["td", "th"], ["tr", "table"])}
ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*"
TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)({ATTRIBUTES})>|<[!?][^>]*>", re.S)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
ANCHOR = re.compile(r"(?:^|\s)(?:id|name)\s*=", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
PARTS = re.compile(r"[a-z]+")
#: Letters of scripts written without spaces (Thai to Tibetan, Burmese, Khmer, kana, Chinese), each a word of its own.
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
ONE_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD = re.compile(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")
FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after", "boiler", "main", "main_on_page", "heading", "boiler_before", "boiler_after"]


def count_words(words: list[str]) -> int:
    """Words of a text split at white space; where a script has no spaces, its letters."""
    if all(map(str.isascii, words)):
        return len(words)
    text = " ".join(words)
    return len(WORD.findall(text)) if ONE_UNSPACED.search(text) else len(words)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    boiler: bool
    main: bool
    heading: bool


class Open(NamedTuple):
    """An open element; the flags hold for it or what encloses it, at any depth."""

    name: str = ""
    boiler: bool = False
    main: bool = False
    heading: bool = False
    in_p: bool = False


OUTSIDE = Open()


@dataclass
class Reader:
    """Open elements and the block being read. Every step is as long as what it closes, so a page
    costs what it has tags, however deep or broken."""

    blocks: list[Block] = field(default_factory=list)
    open_: list[Open] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    link_at: int = -1
    parts: list[str] = field(default_factory=list)
    in_link: list[str] = field(default_factory=list)

    def inner(self) -> Open:
        return self.open_[-1] if self.open_ else OUTSIDE

    def flush(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                linked = count_words(html.unescape(" ".join(self.in_link)).split())
                at = self.inner()
                self.blocks.append(Block(" ".join(words), count_words(words), linked, at.boiler, at.main, at.heading))
        self.parts, self.in_link = [], []

    def text(self, raw: str) -> None:
        self.parts.append(raw)
        if self.link_at >= 0:
            self.in_link.append(raw)

    def unlink(self) -> None:
        """Ends the open <a> but none of the elements inside it."""
        self.open_[self.link_at] = self.open_[self.link_at]._replace(name="")
        if self.places["a"][-1] == self.link_at:
            self.places["a"].pop()
        else:
            self.places["a"].remove(self.link_at)
        self.places.setdefault("", []).append(self.link_at)  # nothing looks for a place without a name
        self.link_at = -1

    def last(self, names: list[str]) -> int:
        """Where the innermost open element of these names is, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def cut(self, at: int) -> None:
        """Closes the element at this place and all inside it."""
        for e in self.open_[at:]:
            self.places[e.name].pop()
        del self.open_[at:]
        if self.link_at >= at:
            self.link_at = -1

    def close(self, name: str) -> None:
        at = self.last([name])
        if at >= 0:
            self.cut(at)

    def start(self, name: str, attributes: str) -> None:
        if name in CLOSES:
            ends, within = CLOSES[name]
            at = self.last(ends)
            if at > self.last(within):
                self.cut(at)
        if name in VOID:
            return
        # Links do not nest, so a link that was never closed ends where the next one starts;
        # a named place in the page is no link.
        if name == "a" and self.link_at >= 0:
            self.unlink()
        link = name == "a" and not (ANCHOR.search(attributes) and not HREF.search(attributes))
        at = self.inner()
        own = name in BOILER_TAGS
        if attributes and not own and name not in ("html", "body"):
            own = is_boiler(name, attributes)
        title = len(name) == 2 and name[0] == "h" and name[1].isdigit()
        self.places.setdefault(name, []).append(len(self.open_))
        if link:
            self.link_at = len(self.open_)
        self.open_.append(Open(name, at.boiler or own, at.main or name in MAIN_TAGS, at.heading or title, at.in_p or name == "p"))


def is_boiler(name: str, attributes: str) -> bool:
    """Whether class, id or role name something that surrounds an article. `has-sidebar` and the like say what a
    wrapper holds beside the article; the header of a post is its headline."""
    given = [t for m in NAMED.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").lower().split()]
    named: set[str] = set()
    for t in given:
        if not t.startswith(("has-", "no-", "with-", "without-")):
            words = set(PARTS.findall(t))
            named |= words - {"header"} if words & OWN_HEADER else words
    return bool(named & BOILER_WORDS) and not (name in MAIN_TAGS and named & MAIN_WORDS) or bool(HIDDEN.search(attributes))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order. A tag of a block-level element ends a block;
    `br` is white space. What a script, a drawing and the like hold is no text; where the end tag of
    one is missing, only its tag is passed over. Broken pages read as far as their tags can be told."""
    r = Reader()
    at, endless = 0, set()
    while m := TOKEN.search(page, at):
        if m.start() > at:
            r.text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name in RAW:
            closed = m[1] or name in FOREIGN and m[3].endswith("/") or name in endless
            if not closed:
                if end := RAW_END[name].search(page, at):
                    at = end.end()
                else:
                    endless.add(name)
            continue
        if name == "br":
            r.parts.append(" ")
        elif name in BLOCK:
            r.flush()
            if not m[1] and r.inner().in_p:
                r.close("p")
        if m[1]:
            r.close(name)
        else:
            r.start(name, m[3])
    if at < len(page):
        r.text(page[at:])
    r.flush()
    return r.blocks


def features(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    links = np.array([min(1.0, b.linked / b.words) for b in blocks])
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = words, links
    out[1:, 2], out[1:, 3] = words[:-1], links[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], links[1:]
    out[:, 6] = [b.boiler for b in blocks]
    out[:, 7] = [b.main for b in blocks]
    out[:, 8] = any(b.main for b in blocks)
    out[:, 9] = [b.heading for b in blocks]
    out[1:, 10], out[:-1, 11] = out[:-1, 6], out[1:, 6]
    return out


# ---- decision tree -----------------------------------------------------------------

@dataclass
class Node:
    value: float
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """Splits by the lowest Gini impurity until leaves are pure."""
    node = Node(float(y.mean()) if len(y) else 0.0)
    if depth == 0 or node.value in (0.0, 1.0):
        return node
    best = (float(2 * node.value * (1 - node.value)) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            shares = [y[low].mean(), y[~low].mean()]
            impurity = sum(w * 2 * p * (1 - p) for w, p in zip((low.mean(), 1 - low.mean()), shares, strict=True))
            if impurity < best[0]:
                best = (impurity, f, float(limit))
    if best[1] >= 0:
        node.feature, node.limit = best[1], best[2]
        low = x[:, node.feature] <= node.limit
        node.low, node.high = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return node


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)
    if node.low is None or node.high is None:
        out[:] = node.value >= 0.5
        return out
    low = x[:, node.feature] <= node.limit
    out[low], out[~low] = predict(node.low, x[low]), predict(node.high, x[~low])
    return out


#: Sample pages, a block's label being its first word. Every kind of block comes in every
#: length, one word too, so that length alone tells nothing.
MARKED = (
    "<header><p>{drop}</p></header><nav><ul>{menu}</ul></nav><div class='ad'>{drop}</div><div class='cookie-notice'><p>{drop}</p></div>"
    "<article><h1>{keep}</h1><p>{keep}</p><div class='ad'>{drop}</div><p>{keep}</p><p>{keep} <a href='/a'>{linked}</a></p><p><a href='/b'>{keep}</a></p>"
    "<aside><p>{drop}</p></aside><form><p>{drop}</p></form><p>{keep}</p><div class='comments'><p>{drop}</p><p>{drop}</p></div></article>"
    "<section id='comments'><p>{drop}</p></section><div><p>{drop}</p></div><form><p>{drop}</p></form><div class='sidebar'><p>{drop}</p></div><footer>{drop}</footer>")
PLAIN = (
    "<header><p>{drop}</p></header><div><ul>{menu}</ul></div><div><a href='/'>{drop}</a></div><div><h1>keep title</h1><p>{keep}</p><p>{keep}</p><p>keep so.</p><p>keep</p><p>keep中文</p><p>{keep}</p>"
    "<p><a href='/b'>{keep}</a></p><p>{keep}</p><p>keep <a href='/c'>{linked}</a></p><p>{keep}</p>"
    "<div class='ad'>{drop}</div><p>{keep}</p><div class='promo'><p>{drop}</p></div><div>{keep}</div></div>"
    "<div><a href='/r'>{drop}</a></div>"
    "<div class='comments'><p>{drop}</p></div><div><a href='/p'>{drop}</a> <a href='/q'>{linked}</a></div><div class='promo'><p>{drop}</p></div><footer>{drop}</footer>")
MENU = "".join(f"<li><a href='/{w}'>drop {w}</a></li>" for w in ("home", "world", "sport", "arts"))
#: A page whose elements have no names: link lists and rows of teasers tell by their neighbours, which are links too.
NAMELESS = (
    "<div><div><a href='/'>{drop}</a></div><div>{links}</div></div><div><h1>{keep}</h1><div>{keep}</div><div>{keep}</div><div><a href='/b'>{keep}</a></div>"
    "<div>{keep}</div><div>keep.</div><div>{keep}</div></div><div>{teasers}</div><div>{links}</div>")
#: A link that begins or ends a page, alone.
BARE = "<div><a href='/'>{drop}</a></div><p>{keep}</p><p>{keep}</p><div><a href='/z'>{drop}</a></div>"
LINKS = "".join(f"<div><a href='/{w}'>drop {w}</a></div>" for w in ("home", "world", "sport"))
TEASERS = "<div><a href='/t'>{drop}</a></div>" * 4
LENGTHS = {MARKED: (0, 2, 10, 30, 100, 400), PLAIN: (0, 2, 15, 40, 120, 400), NAMELESS: (0, 2, 12, 35, 110, 400), BARE: (0, 2, 8, 40, 400)}


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features of all sample blocks, and whether they are main text."""
    x, y = [], []
    for page, lengths in LENGTHS.items():
        for n in lengths:
            more = " word" * n
            drop = "drop" + more
            blocks = blocks_of(page.format(keep="keep" + more, drop=drop, linked="linked" + more, menu=MENU, links=LINKS, teasers=TEASERS.format(drop=drop)))
            x.append(features(blocks))
            y += [float(b.text.startswith("keep")) for b in blocks]
    return np.concatenate(x), np.array(y)


@cache
def tree() -> Node:
    return grow(*labelled())


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, predict(tree(), features(blocks)), strict=True) if keep)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """The kept columns, `text` and `n_chars` (code points) per input row.

    Blocks are joined in page order by a newline; references are decoded, white space inside a
    block becomes one space. A page is read whole and on its own: nothing is shuffled, and
    the tree, grown from fixed samples, is the same in every task.

    Null and empty pages, and pages without main text, give an empty text. Repeated rows
    give repeated results; null ids stay null; columns not kept are not read.
    """
    names = [id_col, *keep]
    rows = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(html_col).alias("page_"))
    schema = ", ".join([*(f"c{i} {rows.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names))), "text_ string", "n_chars_ long"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "page_"):
                texts = [main_text(p) if p else "" for p in part.column("page_").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f"c{i}") for i in range(len(names))), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [*(f"c{i}" for i in range(len(names))), "text_", "n_chars_"])

    return rows.mapInArrow(scan, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("text_").alias("text"), F.col("n_chars_").alias("n_chars"))
