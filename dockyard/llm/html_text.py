"""Main-text extraction from HTML by a minimum cut over the blocks of a page.

A page becomes its text blocks in order. A classifier turns each block's tags,
names, links and length into two costs: of calling it content and of calling
it boilerplate. These are its capacities to the two terminals; blocks that are
next to each other, or are siblings in the DOM, are tied by smoothness edges.
The minimum cut separates content from boilerplate.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|</?[a-zA-Z][^>]*+\Z"
    r"|<[!?/][^>]*+>"
    r"|[^<]++|<", re.S)
_NAME = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
#: Elements whose text is never part of a page's text.
SKIP = frozenset("head title script style noscript template textarea select option button svg math object iframe canvas audio video datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: An opening tag of the key ends an open element of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

BOILER_TAGS = frozenset("nav footer menu search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo search alert alertdialog menu menubar toolbar".split())
#: Elements and roles that stand beside the article, but may also stand around all of it: an inner main starts
#: anew; an inner article does in those of rank 1 (in an aside it is a teaser).
WRAPPERS = {"form": 1, "fieldset": 1, "dialog": 1, "aside": 2, "complementary": 2}
#: Words in a class or id that name something beside the article.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "menubar sidebar rail footer foot header masthead topbar cookie cookies consent gdpr notice notices notification alert "
    "disclaimer warning popup modal overlay newsletter subscribe subscription signup login comment comments commentlist "
    "reply replies respond disqus discussion share sharing social related recommended recirculation breadcrumb breadcrumbs "
    "pagination pager widget toolbar search form copyright legal skip tags".split())
#: Of these, words that also name the layout of a page on the element around all of it.
LAYOUT_WORDS = frozenset("nav navbar navigation menu menubar sidebar rail".split())
CONTENT_WORDS = frozenset("article content post entry story main body text prose page".split())
#: What follows one of these in a name ("has-sidebar", "no-ads") tells how a page is laid out, not what an element is.
STATE_WORDS = frozenset("has no with without".split())
#: Costs of a name with a word of BOILER_WORDS: as part of an article's name, of layout words alone, and of others.
#: They are inherited; blocks with the most content evidence there is (7.4) can outweigh the first two.
PART_COST, LAYOUT_COST, NAME_COST = 1.0, 5.0, 8.0


class _Element:
    __slots__ = ("tag", "number", "boiler", "wrap", "named", "inside", "link", "skip")

    def __init__(self, tag, number, boiler, wrap, named, inside, link, skip):
        self.tag, self.number, self.boiler, self.wrap, self.named = tag, number, boiler, wrap, named
        self.inside, self.link, self.skip = inside, link, skip


def _words(names: str) -> list[str]:
    """The words of a class or id, without what follows a word of STATE_WORDS in a name."""
    out = []
    for name in names.split():
        for w in _WORD.findall(_CAMEL.sub(" ", name).lower()):
            if w in STATE_WORDS:
                break
            out.append(w)
    return out


def blocks(page: str) -> list[tuple]:
    """(text, parent element, boilerplate evidence, content evidence, characters in links, tag) per block."""
    out: list[tuple] = []
    stack = [_Element("", 0, 0.0, 0, 0.0, 0.0, False, False)]
    number, parts, linked = 0, [], 0
    skip_to = None

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                home = next((e for e in reversed(stack) if e.tag in BLOCK or not e.tag))
                at = stack.index(home)
                above = next((e.number for e in reversed(stack[:at]) if e.tag in BLOCK or not e.tag), 0)
                out.append((text, above, max(home.boiler, home.named, 40.0 if home.wrap else 0.0), home.inside, linked, home.tag))
        linked = 0

    for m in _TOKEN.finditer(page):
        token = m[0]
        tag = m[2] or m[5]
        if skip_to is not None:
            if tag and (m[1] or m[4]) and tag.lower() == skip_to:
                skip_to = None
                stack.pop()
            continue
        if tag is None:
            if token[0] == "<" and len(token) > 1:
                continue  # a comment or a declaration
            top = stack[-1]
            if not top.skip:
                parts.append(token)
                if top.link:
                    linked += len(token.strip())
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag in BLOCK:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK and tag not in BLOCK:
                    break  # a stray inline end tag doesn't close the blocks around it
            continue
        if tag in BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                open_ = stack[i].tag
                if open_ == "p" or open_ in ENDS.get(tag, ()):
                    del stack[i:]
                    if open_ == "p":
                        break
                elif open_ in BLOCK:
                    break
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            continue
        top = stack[-1]
        boiler, wrap, named, inside = top.boiler, top.wrap, top.named, top.inside
        own_name, own_inside, own_wrap, is_main = 0.0, 0.0, WRAPPERS.get(tag, 0), tag == "main"
        attributes = m[3] if m[2] else m[6]
        if tag in BOILER_TAGS or tag == "header" and not inside >= 3:
            boiler = max(boiler, 40.0)
        elif tag in ("article", "main"):
            own_inside = 3.0
        if attributes and not attributes.isspace() and tag not in ("html", "a"):
            for a in _NAME.finditer(attributes):
                name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    boiler = max(boiler, 40.0)
                elif name == "style":
                    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                        boiler = max(boiler, 40.0)
                elif name == "role":
                    own_wrap = max(own_wrap, WRAPPERS.get(value.lower(), 0))
                    if value.lower() in BOILER_ROLES:
                        boiler = max(boiler, 40.0)
                    elif value.lower() in ("main", "article"):
                        own_inside, is_main = 3.0, is_main or value.lower() == "main"
                elif tag not in ("body", "main"):
                    words = _words(value)
                    beside = [w for w in words if w in BOILER_WORDS]
                    if beside:
                        # "entry-header" and the like name a part of the article
                        own = any(w in CONTENT_WORDS for w in words) and not any(
                            w in ("comment", "comments", "ad", "ads", "menu", "nav", "sidebar", "share", "related") for w in words)
                        own_name = max(own_name, PART_COST if own or tag == "article" else
                                       LAYOUT_COST if LAYOUT_WORDS.issuperset(beside) else NAME_COST)
                    if any(w in CONTENT_WORDS for w in words) and (not beside or LAYOUT_WORDS.issuperset(beside)):
                        own_inside = max(own_inside, 2.0)
        if own_name > PART_COST and own_inside < 3:
            inside = 0.0  # what is beside the article isn't part of the one around it
        elif own_inside == 3 and not own_name:
            named = 0.0  # an article or main with no such name of its own starts anew
            wrap = 0 if is_main or wrap < 2 else wrap
        named, inside = max(named, own_name), max(inside, own_inside)
        number += 1
        stack.append(_Element(tag, number, boiler, max(wrap, own_wrap), named, inside, top.link or tag == "a", top.skip or tag in SKIP))
        if tag in RAW and not token.endswith("/>"):
            skip_to = tag
    flush()
    return out


def costs(block: tuple) -> tuple[float, float]:
    """The classifier: (cost of calling the block boilerplate, cost of calling it content)."""
    text, _, boiler, inside, linked, tag = block
    words = text.count(" ") + 1
    content = 0.6 + inside + min(3.0, words / 12)
    if tag in ("p", "pre", "blockquote") or tag[:1] == "h" and tag[1:].isdigit():
        content += 0.8
    share = min(1.0, linked / max(1, len(text)))
    return content, 0.7 + boiler + 4.0 * share * (1.0 if words < 30 else 0.5)


def min_cut(terminal: Sequence[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for each node on the source's side of a minimum cut.

    ``terminal`` is a node's capacity from the source less that to the sink;
    ``edges`` has undirected capacities. Capacities are counted in millionths,
    so sums are exact. A node whose terminal outweighs all its edges stays on
    that side in some minimum cut, so it is settled first and its edges become
    terminals of its neighbours. What is left falls into connected parts; a
    maximum flow is found in each.
    """
    n = len(terminal)
    net = [round(1e6 * t) for t in terminal]
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[j][i] = near[i].get(j, 0) + round(1e6 * c)
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is not None or abs(net[i]) < sum(near[i].values()):
            continue
        side[i] = net[i] > 0
        for j, c in near[i].items():
            del near[j][i]
            net[j] += c if side[i] else -c
            todo.append(j)
        near[i] = {}
    for i in range(n):
        if side[i] is None:
            part, seen = [i], {i}
            for j in part:
                for k in near[j]:
                    if k not in seen:
                        seen.add(k)
                        part.append(k)
            from_source = _saturate(part, near, net)
            for j in part:
                side[j] = j in from_source
    return [bool(s) for s in side]


def _saturate(part: list[int], near: list[dict[int, int]], net: list[int]) -> set[int]:
    """Send a maximum flow through ``part``; the nodes the source still reaches.

    Blocking flows: each phase ranks nodes by their distance from the source
    and fills every path of rising rank, so shortest paths get longer from
    phase to phase. ``near`` holds residual capacities, ``net`` what is left
    of the terminals (above 0: from the source).
    """
    while True:
        queue = [i for i in part if net[i] > 0]
        sources = list(queue)
        rank = dict.fromkeys(queue, 0)
        meets = False
        for i in queue:
            meets = meets or net[i] < 0
            for j, c in near[i].items():
                if c > 0 and j not in rank:
                    rank[j] = rank[i] + 1
                    queue.append(j)
        if not meets:
            return set(rank)
        nexts = {i: [j for j, c in near[i].items() if c > 0 and rank[j] == rank[i] + 1] for i in queue}
        for source in sources:
            path = [source]
            while path and net[source] > 0:
                i = path[-1]
                if net[i] < 0:
                    steps = list(zip(path, path[1:]))
                    amount = min(net[source], -net[i], *(near[a][b] for a, b in steps))
                    net[source] -= amount
                    net[i] += amount
                    full = None
                    for at, (a, b) in enumerate(steps):
                        near[a][b] -= amount
                        near[b][a] += amount
                        if full is None and not near[a][b]:
                            full = at
                    if full is not None:
                        del path[full + 1:]
                    continue
                while nexts[i] and not near[i][nexts[i][-1]]:
                    nexts[i].pop()
                if nexts[i]:
                    path.append(nexts[i][-1])
                else:
                    path.pop()
                    if path:
                        nexts[path[-1]].pop()


def main_text(page: str) -> str:
    """The page's content blocks in order, joined by newlines."""
    found = blocks(page)
    if not found:
        return ""
    terminal = []
    edges: dict[tuple[int, int], float] = {}
    last_of: dict[int, int] = {}
    for i, b in enumerate(found):
        content, boiler = costs(b)
        terminal.append(content - boiler)
        if i:
            edges[i - 1, i] = 0.5
        sibling = last_of.get(b[1])
        if sibling is not None:
            edges[sibling, i] = edges.get((sibling, i), 0.0) + 0.5
        last_of[b[1]] = i
    kept = min_cut(terminal, edges)
    return "\n".join(b[0] for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``id, url, text`` for every row of ``pages``.

    Null html counts as empty, and a page without content has an empty text.
    Each page is handled by itself and in whole; nothing is shuffled, ids may
    repeat or be null, other columns aren't read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"_id": part["_id"], "_url": part["_url"], "text": [main_text(h or "") for h in part["_html"]]})

    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    return (rows.mapInPandas(run, "_id long, _url string, text string")
            .withColumnsRenamed({"_id": id_col, "_url": url_col}))
