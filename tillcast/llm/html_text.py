"""Main text of web pages: flat text blocks classified by a small decision tree."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------
#: Elements whose content is never text of the page.
HIDDEN = "script style noscript template svg math iframe object head title select textarea button canvas audio video"
#: Elements that run inside a block; all others end it.
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr"
)
#: Elements whose nesting is followed.
CONTAINERS = "nav header footer aside form dialog menu article main section div ul ol dl table figure fieldset details body"
#: Containers that hold no article text, by element, and by words in class, id or role.
OUTSIDE = "nav footer aside form dialog menu"
HINTS = (
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside complementary header masthead topbar footer contentinfo copyright cookie cookies consent gdpr notice "
    "alert newsletter subscribe subscription signup popup modal overlay dialog share sharing social related recommended comment "
    "comments commentlist disqus reply replies respond login search form pagination pager toolbar widget"
)
#: Those hints that name no layout of a page's article, so that a compound of them is as good as the word alone.
PLAIN_HINTS = (
    "advert advertisement advertising sponsor sponsored breadcrumb breadcrumbs footer contentinfo copyright cookie cookies consent "
    "gdpr newsletter subscription signup comment comments commentlist disqus reply replies respond pagination pager"
)
#: First words of names that say what an element has or lacks, not what it is.
ABOUT = "has have no not with without hide show is js"
#: Hidden elements that may hold others of their name.
NESTS = "svg object template math"
#: Hidden elements whose content cannot hold markup: without an end tag they reach to the page's end.
RAW = "script style textarea title"
_HIDDEN, _INLINE, _CONTAINERS, _OUTSIDE, _HINTS, _PLAIN, _ABOUT, _RAW, _NESTS = (
    frozenset(x.split()) for x in (HIDDEN, INLINE, CONTAINERS, OUTSIDE, HINTS, PLAIN_HINTS, ABOUT, RAW, NESTS))
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_EDGES = {name: re.compile(rf"<(/?){name}\b[^>]*(?:>|\Z)", re.I) for name in _HIDDEN}
_HEAD_END = re.compile(r"</head\b[^>]*(?:>|\Z)", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    inside: bool  # in an article or main element
    outside: bool  # in an element that holds no article text, or one whose name says so
    hinted: bool  # in a container whose compound name has such a word in it
    heading: bool


def _hint(attributes: str, known: frozenset[str] = _HINTS) -> int:
    """How much class, id and role say that an element is no article: 2 a whole name does, 1 a word in a compound, 0 nothing."""
    level = 0
    for m in _NAMES.finditer(attributes):
        for name in m[1].strip("\"'").split():
            words = [w.lower() for w in _WORDS.findall(name)]
            if not words or words[0] in _ABOUT:
                continue
            found = [w for w in words if w in known]
            if len(found) == len(words) or not _PLAIN.isdisjoint(found):
                return 2
            if found:
                level = 1
    return level


def _level(name: str, attributes: str, inside: bool, above: int) -> int:
    """Level of an opened container inside one of level ``above``; an article in a merely hinted one starts anew."""
    if name in _OUTSIDE or name == "header" and not inside:
        return 2
    if name in ("body", "article", "main"):
        own = 2 if name == "article" and _hint(attributes, _PLAIN) == 2 else 0
        return max(own, above if above == 2 else 0)
    return max(above, _hint(attributes) if attributes else 0)


def _hidden_end(name: str, html: str, at: int) -> int:
    """Where the content of a hidden element that starts at ``at`` ends.

    Its end tag counts only if no element of the name opens before it; a raw
    one without an end tag reaches to the end, any other is taken as empty.
    """
    edge = _EDGES[name].search(html, at)
    if name in _RAW:
        while edge and not edge[1]:
            edge = _EDGES[name].search(html, edge.end())
        return edge.end() if edge else len(html)
    depth = 1
    while edge:
        if edge[1]:
            depth -= 1
            if not depth:
                return edge.end()
        elif name in _NESTS:
            depth += 1
        else:
            return at
        edge = _EDGES[name].search(html, edge.end())
    return at


def blocks(html: str) -> list[Block]:
    """Text blocks of a page in order, with the counts and marks that the classifier reads."""
    out: list[Block] = []
    text: list[str] = []
    state = {"linked": 0, "link": False, "heading": False}
    stack: list[tuple[str, bool, int]] = []  # name, inside, level

    def end_block() -> None:
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            _, inside, level = stack[-1] if stack else ("", False, 0)
            words = joined.count(" ") + 1
            out.append(Block(joined, words, min(words, state["linked"]), inside, level == 2, level == 1, state["heading"]))
        text.clear()
        state["linked"] = 0

    def add(piece: str) -> None:
        if piece:
            text.append(piece)
            if state["link"]:
                state["linked"] += len(unescape(piece).split())

    at = 0
    while m := _TAG.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if name in _HIDDEN and not closing:
            if not m[3].rstrip().endswith("/") or name in ("script", "style", "title", "head"):
                if name not in ("button", "select"):
                    end_block()
                if name != "head":
                    at = _hidden_end(name, html, at)
                elif ended := _HEAD_END.search(html, at):
                    at = ended.end()
            continue
        if name in _INLINE:
            if name == "a":
                state["link"] = not closing
            elif name == "br":
                text.append(" ")
            continue
        end_block()
        state["link"] = False
        state["heading"] = not closing and len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if name in _CONTAINERS:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            else:
                _, inside, level = stack[-1] if stack else ("", False, 0)
                stack.append((name, inside or name in ("article", "main"), _level(name, m[3], inside, level)))
    add(html[at:])
    end_block()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Per block: word count and link density of it and of its neighbours, and the four marks."""
    words = np.array([0, *(b.words for b in found), 0], dtype=float)
    density = np.array([1, *(b.linked / b.words for b in found), 1], dtype=float)
    marks = np.array([[b.inside, b.outside, b.hinted, b.heading] for b in found], dtype=float).reshape(-1, 4)
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], marks])


# ---------------------------------------------------------------------------
# decision tree
# ---------------------------------------------------------------------------
def grow(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """Binary tree by Gini impurity: a share of ones, or (feature, threshold, at most, above)."""
    share = float(y.mean())
    best = None
    if depth and 0 < share < 1:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= t
                a, b = y[left], y[~left]
                gini = (len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())) / len(y)
                if best is None or gini < best[0] - 1e-12:
                    best = (gini, f, float(t), left)
    if best is None or best[0] >= share * (1 - share) - 1e-12:
        return share
    _, f, t, left = best
    return f, t, grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)


def decide(tree, row) -> float:
    while isinstance(tree, tuple):
        f, t, low, high = tree
        tree = low if row[f] <= t else high
    return tree


#: The labelled table: pages whose blocks begin with + (article) or - (anything else); nW stands for n words.
LABELLED = (
    "<body><nav><ul><li><a>- 1W</a></li><li><a>- 1W</a></li><li><a>- 2W</a></li></ul></nav><div class='ad'>- 9W</div>"
    "<article><h1>+ 8W</h1><p>+ 60W</p><p>+ 1W</p><p>+ 25W</p><p>+ 3W</p></article><footer>- 8W</footer></body>",
    "<body><header><p>- 6W</p><a>- 2W</a></header><div class='cookie-notice'>- 30W</div><main><h1>+ 5W</h1><p>+ 2W</p>"
    "<p>+ 90W <a>6W</a></p><p>+ 12W</p><ul><li>+ 4W</li><li>+ 9W</li></ul></main><aside><p>- 25W</p><ul><li><a>- 3W</a></li>"
    "</ul></aside><section class='comments'><p>- 40W</p><p>- 7W</p></section><footer><p>- 12W</p><a>- 2W</a></footer></body>",
    "<body><div class='menu'><a>- 1W</a><a>1W</a><a>1W</a></div><div><h1>+ 6W</h1><p>+ 45W</p><p>+ 33W</p><p>+ 6W</p><p>+ 52W</p>"
    "</div><div class='sidebar'><p>- 20W</p><p>- 3W</p></div><form><p>- 5W</p></form><div class='footer'>- 9W</div></body>",
    "<body><p><a>- 1W</a> <a>1W</a> <a>1W</a> <a>1W</a></p><p>+ 40W</p><p>+ 28W</p><p>+ 70W <a>3W</a></p><p>+ 22W</p>"
    "<p><a>- 2W</a></p><p><a>- 3W</a></p></body>",
    "<body><ul><li><a>- 2W</a></li><li><a>- 1W</a></li></ul><p>+ 18W</p><p>+ 35W</p><p><a>- 4W</a></p></body>",
    "<body><article><h1>+ 4W</h1><p>+ 2W</p><p>+ 1W</p><p>+ 4W</p><div class='advert'>- 15W</div><p>+ 14W</p>"
    "<div id='comments'><p>- 22W</p><p>- 50W</p></div></article><div class='related'><a>- 6W</a><p>- 16W</p></div></body>",
    "<body><p>+ 30W</p></body>",
    "<body><nav><a>- 2W</a><a>1W</a></nav><article><p>+ 10W</p><p>+ 24W</p><p>+ 3W</p></article></body>",
    "<body><h1>+ 4W</h1><p>+ 30W</p><p>+ 8W</p></body>",
    "<body><article><p>+ 3W</p></article></body>",
    "<body><div class='main-nav'><a>- 1W</a><a>2W</a></div><div id='share-story'><h1>+ 6W</h1><p>+ 44W</p><p>+ 26W</p><p>+ 5W</p>"
    "<p>+ 31W</p></div><div class='sidebar-left'><p>- 12W</p><p>- 3W</p><p><a>- 5W</a></p></div><div class='related-posts'><p>- 7W "
    "<a>5W</a></p><p><a>- 6W</a></p></div></body>",
    "<body><div class='page layout-sidebar'><div class='widget-box'><p>- 4W</p><p>- 11W</p><p>- 6W</p></div><article><p>+ 4W</p>"
    "<p>+ 30W</p><p>+ 2W</p></article><div class='search-box'><p>- 3W</p></div></div></body>",
    "<body><article><p>+ 1W <a>4W</a></p><p>+ 20W <a>18W</a></p><p><a>+ 3W</a></p><p>+ 9W</p></article><nav><p>- 14W</p></nav></body>",
)


def labelled_blocks(pages: tuple[str, ...] = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [], []
    for page in pages:
        found = blocks(re.sub(r"(\d+)W", lambda m: " ".join(["w"] * int(m[1])), page))
        for b in found:
            b.words -= 1  # the label itself
            b.linked = min(b.linked, b.words)
        found = [b for b in found if b.words]
        xs.append(features(found))
        ys += [float(b.text.startswith("+")) for b in found]
    return np.vstack(xs), np.array(ys)


def train() -> object:
    return grow(*labelled_blocks())


def main_text(html: str | None, tree) -> str:
    """Article blocks of a page in order, joined by line ends; empty for null, empty and all-boilerplate pages."""
    found = blocks(html) if html else []
    if not found:
        return ""
    return "\n".join(b.text for b, x in zip(found, features(found)) if decide(tree, x) >= 0.5)


def extract(html: Column) -> Column:
    """Main text of every whole page.

    Null, empty and all-boilerplate pages give an empty text; equal pages give
    equal texts, and an empty table none.  Only the given column is read, so
    other columns may have any name.  Pages are never cut; one is held by one
    task at a time.
    """
    tree = train()

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, tree) for p in pages], dtype=object)

    return run(html)
