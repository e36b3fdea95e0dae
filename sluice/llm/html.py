"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree; inline elements belong to their
block. Each node has a content variable with a potential from its features (tag, names,
length, links, punctuation), and each parent-child pair has a potential of its own.
Sum-product message passing, once upward and once downward, gives every node's exact
content marginal. Weights are fitted by maximum likelihood, with the same message
passing, on labelled pages (``labelled_pages.py``): articles in named, semantic and
unnamed wrappers, directly in the body, with ``<br>``, of one paragraph and of many.

Blocks whose node has a marginal of at least one half are the text: character
references decoded, white space inside a block as one space, trimmed, joined in page
order by a blank line. Scripts, styles, forms' controls, the head and comments of the
markup are never text.

Defined cases: a null or empty page, or one without content, has the empty text;
unclosed and misplaced tags are closed where a browser would close blocks, an open
head at the first element or text that cannot stand in it, and an open element that is
never text with the block around it (without one it goes to the page's end); text
without any element is one block; a comment, tag or quoted value left open goes to the
page's end; pages are read in linear time, whatever their length, depth or faults; ties
(a marginal of exactly one half) are text; repeated rows and null ids are pages like others; an
empty table gives no rows. Extra columns are ignored.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shipped
from .labelled_pages import AROUND, INSIDE, labelled_pages

#: Element sets of the HTML standard (fixed values).
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label map mark math meter "
                   "nobr output picture progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head script style noscript template svg canvas iframe object button select option textarea title audio video "
                    "datalist math".split())
#: Elements that may stand in a head; any other start tag, or text, ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements that a new one of these closes if still open, up to the given parents.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
             "option": ({"option"}, {"select"})}
CONTENT_AT = 0.5


@dataclass
class Block:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    label: int = -1
    chars: int = 0
    linked: int = 0
    marks: int = 0
    children: list[int] = field(default_factory=list)


#: One attribute's name, and what may stand before it and before its value.
_NAME = re.compile(r"[^\s/>=][^\s/>=]*|=[^\s/>=]*")
_GAP, _SPACE, _BARE = re.compile(r"[\s/]*"), re.compile(r"\s*"), re.compile(r"[^\s>]*")
_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}


def _tag_end(html: str, at: int) -> tuple[int, bool, list[tuple[str, str]]]:
    """Reads attributes from ``at``: the place behind the tag's ``>`` (-1: the page ends
    inside the tag), whether it closes itself, and the attributes (the first of a name)."""
    found: dict[str, str] = {}
    while True:
        gap = _GAP.match(html, at).end()
        if gap >= len(html):
            return -1, False, []
        if html[gap] == ">":
            return gap + 1, gap > at and html[gap - 1] == "/", list(found.items())
        name = _NAME.match(html, gap)
        at, value = name.end(), ""
        sign = _SPACE.match(html, at).end()
        if html[sign:sign + 1] == "=":
            at = _SPACE.match(html, sign + 1).end()
            quote = html[at:at + 1]
            if quote in ('"', "'") and quote:
                end = html.find(quote, at + 1)
                if end < 0:
                    return -1, False, []
                value, at = html[at + 1:end], end + 1
            else:
                end = _BARE.match(html, at).end()
                value, at = html[at:end], end
        found.setdefault(name.group().lower(), value)


class Page:
    """Block tree and text segments (block number, text) in page order. Every character
    is read a bounded number of times, whatever is left open."""

    def __init__(self, html: str):
        self.blocks = [Block("#page", -1)]
        self.stack, self.links = [0], 0
        self.at: dict[str, list[int]] = {"#page": [0]}  # depths in the stack, by tag
        self.dropped: list[str] = []
        self.n_dropped: Counter[str] = Counter()
        self.segments: list[tuple[int, list[str]]] = []
        self.new = True
        self._read(html)

    def _read(self, html: str) -> None:
        """Tags, texts and comments in turn, as the HTML standard cuts them: a comment,
        tag or quoted value that is left open goes to the page's end."""
        at, n = 0, len(html)
        while at < n:
            i = html.find("<", at)
            if i < 0:
                i = n
            if i > at:
                self.handle_data(unescape(html[at:i]))
            if i == n:
                return
            two = html[i + 1:i + 2]
            closing = two == "/"
            tag = _TAG.match(html, i + 1 + closing)
            if html.startswith("<!--", i):
                end = html.find("-->", i + 2)
                at = end + 3
            elif tag:
                end, self_closing, attrs = _tag_end(html, tag.end())
                at = end
                name = tag.group().lower()
                if end < 0:
                    return
                if closing:
                    self.handle_endtag(name)
                elif self_closing:
                    self.handle_startendtag(name, attrs)
                else:
                    self.handle_starttag(name, attrs)
                if name in _RAW_END and not closing and not self_closing:
                    raw = _RAW_END[name].search(html, at)
                    if raw is None:
                        return
                    at = raw.start()
            elif two in ("!", "?") or closing and i + 2 < n:
                end = html.find(">", i + 2)
                at = end + 1
            else:
                self.handle_data("<")
                end = at = i + 1
            if end < 0:
                return

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.at[self.blocks[self.stack.pop()].tag].pop()
        self.links, self.new = 0, True

    def _innermost(self, tags) -> int:
        """Depth of the innermost open block with one of the tags; 0 if none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _drop(self, tag: str) -> None:
        self.dropped.append(tag)
        self.n_dropped[tag] += 1

    def _undrop(self, tag: str) -> None:
        """Ends the innermost open ``tag`` and all inside it."""
        while True:
            last = self.dropped.pop()
            self.n_dropped[last] -= 1
            if last == tag:
                return

    def _undrop_all(self) -> None:
        self.dropped.clear()
        self.n_dropped.clear()

    def _inside_dropped(self, tag: str) -> None:
        """Keeps the elements open inside a dropped one, so that the end tag of an
        enclosing block is known from theirs."""
        if tag == "select" and self.n_dropped[tag]:  # ends the open one
            while self.n_dropped[tag]:
                self._undrop(tag)
        elif tag == self.dropped[-1] and tag in ("button", "option"):  # ends it and opens another
            return
        elif tag in DROPPED or tag not in INLINE and tag not in VOID:
            self._drop(tag)

    def handle_starttag(self, tag, attrs):
        if self.dropped:
            if self.dropped[0] == "head" and (tag == "body" or len(self.dropped) == 1 and tag not in IN_HEAD):
                self._undrop_all()
            else:
                self._inside_dropped(tag)
                return
        if tag in DROPPED:
            self._drop(tag)
            return
        if tag in INLINE:
            if tag == "a":
                self.links = 1
            elif tag == "br":
                self.handle_data(" ")
            return
        if self.at.get("p"):  # a block ends an open paragraph
            self._pop_to(self.at["p"][0])
        if tag in CLOSED_BY:
            ends, within = CLOSED_BY[tag]
            if (depth := self._innermost(ends)) > self._innermost(within):
                self._pop_to(depth)
        self.new = True
        if tag in VOID:
            return
        at = dict(attrs)
        names = " ".join(unescape(at.get(k, "")) for k in ("class", "id", "role")).lower()
        label = at.get("data-y")
        self.blocks.append(Block(tag, self.stack[-1], tuple(re.findall(r"[a-z]+", names)), int(label) if label in ("0", "1") else -1))
        self.blocks[self.stack[-1]].children.append(len(self.blocks) - 1)
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append(len(self.blocks) - 1)

    def handle_startendtag(self, tag, attrs):
        if self.n_dropped["svg"] or self.n_dropped["math"]:  # closed in foreign elements only
            return
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in DROPPED:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.dropped:
            if self.n_dropped[tag]:
                self._undrop(tag)
                return
            if tag in INLINE or not self.at.get(tag):
                return
            self._undrop_all()  # an enclosing block closes
        if tag == "a":
            self.links = 0
        elif tag not in INLINE and (depth := self._innermost((tag,))):
            self._pop_to(depth)

    def handle_data(self, data):
        if self.dropped == ["head"] and data.strip():
            self._undrop_all()
        if self.dropped:
            return
        here = self.stack[-1]
        if self.new or self.segments[-1][0] != here:
            self.segments.append((here, []))
            self.new = False
        self.segments[-1][1].append(data)
        block = self.blocks[here]
        n = len(data.strip())
        block.chars += n
        block.linked += n * self.links
        block.marks += sum(map(data.count, ".,;!?"))


# -- model -----------------------------------------------------------------------

_NAMES = {w: kind for kind, names in AROUND.items() for name in names for w in name.split("-") if w not in ("site", "list", "bottom", "meta")}
_NAMES |= {w: "inside" for name in INSIDE for w in name.split("-") if w not in ("main",)} | {"comment": "comments", "reply": "comments"}


def _features(page: Page, k: int) -> list[str]:
    b = page.blocks[k]
    out = ["any", f"tag {b.tag}", f"{_pair(b)} {b.tag}"]
    known = {f"name {_NAMES[w]}" for w in b.names if w in _NAMES}
    out += known or [f"unnamed {_pair(b)} {b.tag}"]
    if b.chars:
        out.append(f"chars {min(int(math.log2(b.chars)) // 2, 5)}")
        out.append(f"links {4 * b.linked // b.chars}")
        out.append(f"marks {min(4, 100 * b.marks // b.chars)}")
    else:
        out.append("bare")
    return out


def _pair(child: Block) -> str:
    return "bare" if not child.chars else "text"


def _edge(blocks: list[Block], k: int) -> str:
    """Kind of the potential between a block and its parent; the page's outermost blocks
    hold everything, so they say little of what is in them."""
    return _pair(blocks[k]) + (" on top" if blocks[blocks[k].parent].tag in ("#page", "html", "body") else "")


def _lse(a: float, b: float) -> float:
    m = a if a > b else b
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def passed(page: Page, unary: dict[str, float], pair: dict[tuple[str, int, int], float],
           features: list[list[str]] | None = None) -> tuple[list[float], dict[int, list[list[float]]]]:
    """Content marginal of every block, and of every parent-child pair (by child)."""
    blocks, n = page.blocks, len(page.blocks)
    features = features or [_features(page, k) for k in range(n)]
    local = [[0.0, sum(unary.get(f, 0.0) for f in features[k])] for k in range(n)]
    up = [[0.0, 0.0] for _ in range(n)]  # message of a block to its parent
    inner = [x[:] for x in local]
    pots = [None] * n
    for k in range(n - 1, 0, -1):  # children stand behind their parents
        kind = _edge(blocks, k)
        t = pots[k] = [[pair.get((kind, a, b), 0.0) for b in (0, 1)] for a in (0, 1)]
        x = inner[k]
        up[k] = [_lse(t[a][0] + x[0], t[a][1] + x[1]) for a in (0, 1)]
        top = inner[blocks[k].parent]
        top[0] += up[k][0]
        top[1] += up[k][1]
    belief, both = [None] * n, {}
    belief[0] = inner[0]
    for k in range(1, n):
        above = belief[blocks[k].parent]
        rest = [above[a] - up[k][a] for a in (0, 1)]
        t, x = pots[k], inner[k]
        joint = [[rest[a] + t[a][b] + x[b] for b in (0, 1)] for a in (0, 1)]
        top = max(map(max, joint))
        z = sum(math.exp(v - top) for row in joint for v in row)
        both[k] = [[math.exp(v - top) / z for v in row] for row in joint]
        down = [_lse(rest[0] + t[0][b], rest[1] + t[1][b]) for b in (0, 1)]
        belief[k] = [down[b] + x[b] for b in (0, 1)]
    return [1 / (1 + math.exp(min(700.0, b[0] - b[1]))) for b in belief], both


def fit(htmls: list[str], steps: int = 60, rate: float = 0.5, pull: float = 1e-3) -> tuple[dict, dict]:
    """Maximum likelihood by gradient steps (scaled by past gradients). Blocks
    without a label (wrappers) are boilerplate or content by the majority of their
    labelled children."""
    pages = [Page(h) for h in htmls]
    features = [[_features(p, k) for k in range(len(p.blocks))] for p in pages]
    labels = []
    for p in pages:
        y = [b.label for b in p.blocks]
        for k in range(len(y) - 1, -1, -1):
            if y[k] < 0:
                below = [y[c] for c in p.blocks[k].children]
                y[k] = int(2 * sum(below) > len(below) or p.blocks[k].chars > 0)  # own text: a page without elements
        labels.append(y)
    unary: dict = {}
    pair: dict = {}
    seen: dict = {}
    n = sum(map(len, labels))
    for _ in range(steps):
        du: dict = {}
        dp: dict = {}
        for p, y, fs in zip(pages, labels, features, strict=True):
            marginal, both = passed(p, unary, pair, fs)
            for k, b in enumerate(p.blocks):
                off = y[k] - marginal[k]
                for f in fs[k]:
                    du[f] = du.get(f, 0.0) + off
                if k:
                    kind = _edge(p.blocks, k)
                    for a in (0, 1):
                        for c in (0, 1):
                            key = (kind, a, c)
                            dp[key] = dp.get(key, 0.0) + (y[b.parent] == a and y[k] == c) - both[k][a][c]
        for w, d in ((unary, du), (pair, dp)):
            for key, g in d.items():
                g = g / n - pull * w.get(key, 0.0)
                seen[key] = seen.get(key, 0.0) + g * g
                w[key] = w.get(key, 0.0) + rate * g / (math.sqrt(seen[key]) + 1e-8)
    return unary, pair


@lru_cache(maxsize=1)
def default_model() -> tuple[dict, dict]:
    return fit(labelled_pages())


def main_text(html: str, model: tuple[dict, dict]) -> str:
    if not html:
        return ""
    page = Page(html)
    marginal, _ = passed(page, *model)
    out = [" ".join("".join(parts).split()) for k, parts in page.segments if marginal[k] >= CONTENT_AT]
    return "\n\n".join(x for x in out if x)


def extracted(pages: DataFrame, model: tuple[dict, dict] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shipped(pages.sparkSession)
    model = model or default_model()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [main_text(h.as_py() or "", model) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                              pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(each, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))
