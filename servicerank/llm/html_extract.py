"""Main text of web pages, by a graphical model on the DOM tree.

Every node is content or not. Potentials of nodes (tags, class words, lengths,
links) and of parent-child pairs are learned from labelled pages; messages
passed up and down the tree give each node's marginal; blocks whose text is
content with probability one half or more make the text.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weights of node features, shared by hashing.
FEATURES = 1 << 13
#: Pages that give the words of the labelled pages: those with the smallest hash of their id.
SAMPLE = 200
#: Labelled pages the model is fitted on.
LABELLED = 500

#: Tags up to this length are looked at as they stand, if they hold pairs of double quotes at most.
SHORT_TAG = 256
OPENING = re.compile(r"<(?:(!--)|([!?])|/?[a-zA-Z])")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LABEL = re.compile(r"\bdata-label=\"([01])\"")
VOID = set("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = set("head script style noscript template svg iframe object canvas math select textarea title".split())
RAW = set("script style textarea title noscript iframe".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: What a new element of a kind closes, up to the enclosing elements behind it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Parts of a page whose descendants are told so.
REGIONS = set("article main nav footer header aside form section table ul ol blockquote figure button label".split())
#: What a node is told at most of the elements around it, the outer ones first; pages have some dozens.
TOLD = 512
KIND = {"text": 0, "inline": 1, "block": 2, "region": 3, "page": 4}
KINDS = len(KIND)


@dataclass
class Page:
    """A DOM as arrays in document order; parents come before children."""

    parent: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    sentences: list[int] = field(default_factory=list)
    block: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    region: list[frozenset] = field(default_factory=list)
    label: list[int] = field(default_factory=list)


_number: dict[str, int] = {}


def _feature(name: str) -> int:
    found = _number.get(name)
    if found is None:
        if len(_number) > 100_000:
            _number.clear()
        found = _number[name] = zlib.crc32(name.encode()) % FEATURES
    return found


def _described(tag: str, name: str) -> tuple[list[int], frozenset]:
    """Features of an element, and what its descendants are told: its tag, the words of its class, id, role and itemprop."""
    out, told = [_feature(f"tag {name}")], {name} & REGIONS
    for found in ATTRIBUTE.finditer(tag):
        value = found[2] or found[3] or found[4] or ""
        for word in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value):
            out.append(_feature(f"word {word.lower()}"))
            told.add(f".{word.lower()}")
        out.append(_feature(f"value {value.lower()}"))
    return out, frozenset(told)


class Tokens:
    """Cuts a page into text and tags, in time that grows with its length whatever the markup.

    A tag ends at the first `>` outside of quotes; without one, or with a quote
    that is never closed, its `<` is text.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.marks: list[int] = []
        self.of: dict[str, list[int]] = {}
        #: Where tags end whose scan has come to a mark outside of quotes, by the mark's number; -1 if nowhere.
        self.ends: dict[int, int] = {}

    def _look(self) -> None:
        """Find the marks, once for a page that needs them."""
        if not self.of:
            self.marks = [m.start() for m in re.finditer("[>\"']", self.source)]
            self.of = {c: [i for i in self.marks if self.source[i] == c] for c in ">\"'"}

    def _after(self, char: str, at: int) -> int:
        """The first place from `at` on that holds a mark, or -1."""
        places = self.of[char]
        i = bisect_left(places, at)
        return places[i] if i < len(places) else -1

    def _tag_end(self, at: int) -> int:
        mark, passed, end = bisect_left(self.marks, at), [], -1
        while mark < len(self.marks):
            if mark in self.ends:
                end = self.ends[mark]
                break
            passed.append(mark)
            place = self.marks[mark]
            char = self.source[place]
            if char == ">":
                end = place + 1
                break
            close = self._after(char, place + 1)
            if close < 0:
                break
            mark = bisect_left(self.marks, close + 1)
        for mark in passed:
            self.ends[mark] = end
        return end

    def next(self, at: int) -> int:
        """Where the token at `at` ends."""
        source = self.source
        if source[at] != "<":
            end = source.find("<", at)
            return end if end >= 0 else len(source)
        found = OPENING.match(source, at)
        if found is None:
            return at + 1
        if found[1]:
            end = source.find("-->", at + 4)
            return end + 3 if end >= 0 else len(source)
        end = source.find(">", at, at + SHORT_TAG)
        if end > 0 and (found[2] or (source.find("'", at, end) < 0 and source.count('"', at, end) % 2 == 0)):
            return end + 1
        self._look()
        end = self._after(">", found.end()) + 1 if found[2] else self._tag_end(found.end())
        return end if end > 0 else at + 1


def parse(source: str) -> Page:
    """The tree of a page; tolerates unclosed, misnested and unknown markup."""
    page = Page()
    known: dict[str, tuple[list[int], frozenset]] = {}
    raw_ends: dict[str, list[int]] = {}
    stack: list[tuple[str, int]] = []
    regions: list[frozenset] = [frozenset()]
    labels = [0]
    block, unseen = 0, 0
    # Where the open elements of a name stand in the stack, and those that are blocks.
    opened: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = []

    def add(kind: str, features: list[int], text: str = "") -> None:
        page.parent.append(stack[-1][1] if stack else -1)
        page.kind.append(KIND[kind])
        page.features.append(features)
        page.text.append(text)
        page.block.append(block)
        page.region.append(regions[-1])
        page.label.append(labels[-1])
        for values in (page.length, page.linked, page.sentences):
            values.append(0)

    def pop() -> None:
        nonlocal block, unseen
        name, _ = stack.pop()
        opened[name].pop()
        if name in BLOCKS:
            blocks.pop()
        regions.pop()
        labels.pop()
        block += name in BLOCKS
        unseen -= name in UNSEEN

    def pop_to(size: int) -> None:
        while len(stack) > size:
            pop()

    def last(names: set[str]) -> int:
        """The innermost open element of any of these names."""
        return max((opened[n][-1] for n in names if opened[n]), default=-1)

    add("page", [_feature("root")])
    stack.append(("", 0))
    regions.append(frozenset())
    labels.append(0)
    at, size, tokens = 0, len(source), Tokens(source)
    while at < size:
        end = tokens.next(at)
        token = source[at:end]
        at = end
        if token[0] != "<" or token == "<":
            if unseen:
                continue
            text = html.unescape(token)
            seen = len(text.strip())
            add("text", [], text)
            if seen:
                page.length[-1] = seen
                page.sentences[-1] = text.count(".") + text.count("!") + text.count("?")
                if opened["a"]:
                    page.linked[-1] = seen
            continue
        tag = TAG.match(token)
        if tag is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            if opened[name]:
                pop_to(opened[name][-1])
            elif name in BLOCKS:
                block += 1
            continue
        if name in BLOCKS:
            block += 1
            if blocks and stack[blocks[-1]][0] == "p":
                pop_to(blocks[-1])
        if name in CLOSES:
            closed, within = CLOSES[name]
            if (nearest := last(closed)) > last(within):
                pop_to(nearest)
        if name in VOID:
            if name == "br" and not unseen:
                add("text", [], " ")
            continue
        if token not in known:
            known[token] = _described(token, name)
        kind = "page" if name in ("html", "body") else "region" if name in REGIONS else "block" if name in BLOCKS else "inline"
        mark = LABEL.search(token)
        add(kind, known[token][0])
        opened[name].append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        stack.append((name, len(page.parent) - 1))
        told = known[token][1]
        regions.append(regions[-1] if len(regions[-1]) > TOLD or told <= regions[-1] else regions[-1] | told)
        labels.append(int(mark[1]) if mark else labels[-1])
        unseen += name in UNSEEN
        if token.endswith("/>") and name not in BLOCKS:
            pop()
        elif name in RAW:
            if name not in raw_ends:
                raw_ends[name] = [m.start() for m in re.finditer(rf"</{re.escape(name)}\s*>", source, re.I)]
            close = bisect_left(raw_ends[name], at)
            at = raw_ends[name][close] if close < len(raw_ends[name]) else size
    return page


def _bin(value: float, base: float = 2.0) -> int:
    return int(math.log(value + 1, base))


class Forest:
    """Pages as one set of arrays, ready for message passing."""

    def __init__(self, pages: list[Page]) -> None:
        sizes = [len(p.parent) for p in pages]
        base = np.cumsum([0, *sizes])
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.parent = np.concatenate([np.array(p.parent) + b for p, b in zip(pages, base[:-1], strict=True)])
        self.parent[base[:-1]] = -1
        self.kind = np.concatenate([p.kind for p in pages]).astype(np.int64)
        self.length = np.concatenate([p.length for p in pages]).astype(np.int64)
        depth = np.zeros(len(self.parent), np.int64)
        parents = self.parent.tolist()
        depths = depth.tolist()
        for i, p in enumerate(parents):
            depths[i] = depths[p] + 1 if p >= 0 else 0
        self.depth = np.array(depths)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(self.depth.max() + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        nodes, features = [], []
        for p, b in zip(pages, base[:-1].tolist(), strict=True):
            for i, names in enumerate(self._features(p)):
                features += names
                nodes += [b + i] * len(names)
        self.node_of, self.feature = np.array(nodes, np.int64), np.array(features, np.int64)
        child = np.flatnonzero(self.parent >= 0)
        self.edge = np.full(len(self.parent), -1)
        self.edge[child] = self.kind[self.parent[child]] * KINDS + self.kind[child]

    @staticmethod
    def _features(page: Page) -> Iterator[list[int]]:
        length, linked, sentences = page.length[:], page.linked[:], page.sentences[:]
        for i in range(len(length) - 1, 0, -1):
            parent = page.parent[i]
            length[parent] += length[i]
            linked[parent] += linked[i]
            sentences[parent] += sentences[i]
        total = max(1, length[0])
        present = frozenset().union(*page.region)
        before = 0
        for i, own in enumerate(page.features):
            kind, size = page.kind[i], length[i]
            share = 4 * linked[i] // size if size else -1
            out = [
                *own,
                _feature(f"{kind} length {_bin(size)}"),
                _feature(f"{kind} links {share}"),
                _feature(f"{kind} sentences {min(3, sentences[i])} links {share}"),
                _feature(f"{kind} place {4 * before // total}"),
                *(_feature(f"in {r}") for r in page.region[i]),
                *(_feature(f"out of {r}") for r in ("article", "main") if r in present and r not in page.region[i]),
            ]
            if kind == 0:
                before += page.length[i]
            yield out


@dataclass
class TreeModel:
    """Weights of node features, and log potentials of (parent, child) labels for each pair of kinds."""

    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Each node's probability of being content, and each edge's joint probabilities (parent, child)."""
        n = len(forest.parent)
        unary = np.zeros((n, 2))
        unary[:, 1] = np.bincount(forest.node_of, self.weights[forest.feature], n)
        potentials = self.pairs[np.maximum(forest.edge, 0)]
        inside, up = unary.copy(), np.zeros((n, 2))
        for level in reversed(forest.levels[1:]):
            # A child's message to its parent, for each of the parent's labels.
            up[level] = np.logaddexp(*np.moveaxis(potentials[level] + inside[level][:, None, :], 2, 0))
            np.add.at(inside, forest.parent[level], up[level])
        outside = np.zeros((n, 2))
        for level in forest.levels[1:]:
            parent = forest.parent[level]
            rest = outside[parent] + inside[parent] - up[level]
            outside[level] = np.logaddexp(*np.moveaxis(potentials[level] + rest[:, :, None], 1, 0))
        belief = inside + outside
        content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        child = np.flatnonzero(forest.parent >= 0)
        parent = forest.parent[child]
        joint = potentials[child] + (outside[parent] + inside[parent] - up[child])[:, :, None] + inside[child][:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        return content, joint / joint.sum((1, 2), keepdims=True)


def labelled_pages(sentences: list[str], count: int, seed: int = 7) -> list[str]:
    """Pages in many layouts, made of given sentences, with `data-label` on their parts."""
    rng = random.Random(seed)
    pick, chance = rng.choice, lambda p: rng.random() < p
    said = lambda low, high: " ".join(pick(sentences) for _ in range(rng.randint(low, high)))
    words = lambda low, high: " ".join(said(1, 2).split()[: rng.randint(low, high)])
    linked = lambda: f'<a href="/{rng.randint(0, 999)}">{words(1, 4)}</a>'

    def paragraph() -> str:
        text = said(1, 6)
        if chance(0.2):
            cut = text.split()
            i = rng.randrange(len(cut))
            cut[i] = pick(["<b>{}</b>", '<a href="/x">{}</a>', "<em>{}</em>", "<span>{}</span>", "<code>{}</code>"]).format(cut[i])
            text = " ".join(cut)
        if chance(0.1):
            text = f"<b>{text}<br>"
            return f"<p>{text}"
        return f"<p>{text}</p>"

    def body() -> str:
        parts = [f"<h1>{words(3, 12)}</h1>"] if chance(0.9) else []
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.76:
                parts.append(paragraph())
            elif kind < 0.82:
                parts.append(f"<h{(n := rng.randint(2, 4))}>{words(2, 8)}</h{n}>")
            elif kind < 0.88:
                parts.append((tag := pick(["ul", "ol"])) and f"<{tag}>" + "".join(f"<li>{said(1, 2)}</li>" for _ in range(rng.randint(2, 5))) + f"</{tag}>")
            elif kind < 0.92:
                parts.append(f"<blockquote>{paragraph()}</blockquote>")
            elif kind < 0.95:
                parts.append("<table>" + "".join(f"<tr><td>{words(1, 5)}</td><td>{words(1, 5)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.97:
                parts.append(f"<figure><img src=x><figcaption>{said(1, 1)}</figcaption></figure>")
            else:
                parts.append(f"<pre>{said(1, 2)}</pre>")
        return "".join(parts)

    menu = lambda: "<ul>" + "".join(f"<li>{linked()}</li>" for _ in range(rng.randint(3, 9))) + "</ul>"
    comment = lambda: f'<{(t := pick(["div", "li", "article", "p"]))} class="{pick(["comment", "reply", "comment-body", "user-comment"])}">{pick(["", f"<b>{words(1, 2)}</b>"])}{pick([said(1, 4), paragraph()])}</{t}>'

    def around(place: str) -> str:
        """Something that is not the article."""
        choices = {
            "top": [
                lambda: f"<nav>{menu()}</nav>",
                lambda: f'<div class="{pick(["menu", "navbar", "nav", "navigation", "topbar", "breadcrumb", "breadcrumbs"])}">{pick([menu(), " ".join(linked() for _ in range(4))])}</div>',
                lambda: f'<header{pick(["", " id=masthead", " class=site-header"])}>{pick(["", f"<h1>{words(1, 4)}</h1>", f"<p>{said(1, 1)}</p>"])}{pick(["", menu(), f"<nav>{menu()}</nav>"])}{words(1, 6)}</header>',
                lambda: f'<div id="{pick(["header", "top", "logo", "site-header", "banner"])}">{words(1, 6)}</div>',
                lambda: f'<form{pick(["", " class=search", " id=login"])}><label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>{pick(["", said(1, 1)])}</form>',
            ],
            "any": [
                lambda: f'<div class="{pick(["ad", "ads", "advert", "advertisement", "ad-banner", "sponsored", "promo", "banner"])}">{pick([said(1, 2), paragraph(), linked()])}</div>',
                lambda: f'<div class="{pick(["cookie", "cookie-notice", "notice", "consent", "gdpr", "popup", "modal", "alert", "newsletter", "subscribe", "signup"])}">{pick([said(1, 2), paragraph()])}{pick(["", f"<button>{words(1, 2)}</button>"])}</div>',
                lambda: f'<{(t := pick(["aside", "div"]))} {"" if t == "aside" and chance(0.5) else pick(["class=sidebar", "id=sidebar", "class=widget", "class=related", "class=recommended", "class=trending", "class=share", "class=social"])}>{pick([menu(), paragraph(), f"<h3>{words(1, 4)}</h3>{menu()}", said(1, 3)])}</{t}>',
                lambda: f'<form action="/s"{pick(["", " class=contact", " class=newsletter"])}><p>{said(1, 2)}</p><input type=email><button type=submit>{words(1, 2)}</button></form>',
            ],
            "bottom": [
                lambda: f"<footer>{pick(['&copy; ', ''])}{said(1, 2)}{pick(['', menu(), ' &middot; ' + said(1, 1)])}</footer>",
                lambda: f'<div class="{pick(["footer", "copyright", "legal", "bottom", "site-info", "colophon"])}">{pick(["&copy; ", ""])}{said(1, 2)}</div>',
                lambda: f'<{(t := pick(["section", "div", "ul", "ol"]))} {pick(["id", "class"])}="{pick(["comments", "comment-list", "responses", "discussion", "disqus", "replies"])}">{pick(["", f"<h2>{words(1, 3)}</h2>"])}{"".join(comment() for _ in range(rng.randint(1, 6)))}</{t}>',
                lambda: comment(),
            ],
        }
        return marked(pick(choices[place])(), 0)

    def marked(part: str, label: int) -> str:
        return re.sub(r"^<(\w+)", rf'<\1 data-label="{label}"', part, count=1)

    names = "content post entry article article-body story post-content main-content text entry-content main body".split()
    openings = [("<article>", "</article>")] * 4 + [
        ("<main>", "</main>"),
        ("<main><article>", "</article></main>"),
        ("<section>", "</section>"),
        *((f'<div {a}="{n}">', "</div>") for n in names for a in ("class", "id")[: 1 + (n in ("content", "main"))]),
    ]
    pages = []
    for _ in range(count):
        opening, closing = pick(openings)
        top = [around("top") for _ in range(rng.randint(0, 3))] + [around("any") for _ in range(rng.randint(0, 2))]
        bottom = [around("any") for _ in range(rng.randint(0, 2))] + [around("bottom") for _ in range(rng.randint(0, 3))]
        inner = body() + (around("any") if chance(0.3) else "") + (around("bottom") if chance(0.2) else "")
        shell = ("<div class=wrapper>", "</div>") if chance(0.3) else ("", "")
        pages.append(
            f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title><style>p{{margin:0}}</style></head><body>{shell[0]}"
            f"{''.join(top)}{marked(opening, 1)}{inner}{closing}{''.join(bottom)}{shell[1]}<script>track(1);</script></body></html>"
        )
    return pages


def fit(sources: list[str], epochs: int = 150) -> TreeModel:
    """Maximum likelihood on pages with `data-label`, by Adam; features seen on fewer pages keep smaller weights."""
    forest = Forest([parse(s) for s in sources])
    labels = np.concatenate([parse(s).label for s in sources])
    model = TreeModel(np.zeros(FEATURES), np.zeros((KINDS**2, 2, 2)))
    child = np.flatnonzero(forest.parent >= 0)
    wanted = np.zeros((KINDS**2, 2, 2))
    np.add.at(wanted, (forest.edge[child], labels[forest.parent[child]], labels[child]), 1)
    moments = [np.zeros((2, *v.shape)) for v in (model.weights, model.pairs)]
    for step in range(1, epochs + 1):
        content, joint = model.marginals(forest)
        expected = np.zeros((KINDS**2, 2, 2))
        np.add.at(expected, forest.edge[child], joint)
        unary = np.bincount(forest.feature, (labels - content)[forest.node_of], FEATURES)
        for values, gradient, m in zip(
            (model.weights, model.pairs), (unary - 0.5 * model.weights, wanted - expected - 0.5 * model.pairs), moments, strict=True
        ):
            m[0] += 0.1 * (gradient - m[0])
            m[1] += 0.01 * (gradient**2 - m[1])
            values += 0.1 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-6)
    return model


def main_text(page: Page, content: np.ndarray) -> str:
    """The blocks that are content, white space made one space, joined by one space."""
    out: list[str] = []
    parts: list[str] = []
    weight = size = 0.0
    current = -1

    def close() -> None:
        if size and weight >= 0.5 * size:
            out.append(" ".join("".join(parts).split()))

    for i, kind in enumerate(page.kind):
        if kind:
            continue
        if page.block[i] != current:
            close()
            parts, weight, size, current = [], 0.0, 0.0, page.block[i]
        parts.append(page.text[i])
        weight += content[i] * page.length[i]
        size += page.length[i]
    close()
    return " ".join(o for o in out if o)


def train(
    pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample: int = SAMPLE, labelled: int = LABELLED
) -> TreeModel:
    """Fit on `labelled` pages in many layouts, filled with the sentences of at most `sample` given pages, whole."""
    chosen = pages.select(F.col(id_column).alias("_id"), F.col(html_column).alias("_html")).filter("_html IS NOT NULL")
    # The ids first, so that only the sample's pages are sorted and sent.
    ids = chosen.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = chosen.join(F.broadcast(ids), "_id").select("_id", "_html")
    found = sorted(rows.dropDuplicates(["_id"]).collect(), key=lambda r: zlib.crc32(str(r._id).encode()))
    sentences = []
    for row in found:
        page = parse(row._html)
        for text, size in zip(page.text, page.length, strict=True):
            if size > 20:
                sentences += [html.escape(s.strip() + ".") for s in text.split(".") if s.strip()]
    return fit(labelled_pages(sentences or ["No words are given."], labelled))


def extract(pages: DataFrame, model: TreeModel, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of `pages`: the id, the url, `text` and `n_chars` (its code points).

    `text` holds the blocks that the model takes for content, character
    references decoded. Null and empty html gives an empty text, as do pages
    without content; unclosed or unknown markup is tolerated; a page may be as
    long as a string may be. No shuffle. Repeated rows give repeated results,
    other columns are not looked at, an empty table gives an empty result.
    """
    schema = T.StructType(
        [
            T.StructField(id_column, pages.schema[id_column].dataType),
            T.StructField(url_column, pages.schema[url_column].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                parsed = [parse(s or "") for s in part.column(2).to_pylist()]
                forest = Forest(parsed)
                content, _ = model.marginals(forest)
                cuts = np.cumsum([0, *(len(p.parent) for p in parsed)])
                texts = [main_text(p, content[a:b]) for p, a, b in zip(parsed, cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    schema.names,
                )

    return pages.select(id_column, url_column, html_column).mapInArrow(run, schema)
