"""Main text of web pages by a tree-structured graphical model.

A page's block elements are the nodes of a tree; each is content or not. Unary potentials weigh
features of an element (its tag, words in its class, id and role, amount of text, share of link
text, sentences), parent-child potentials couple an element with its parent, by the kind of
child. Sum-product messages go from the leaves to the root and back and give every element's
exact content marginal; weights are trained with the exact gradient that the same messages give,
on labelled pages. The text blocks of elements whose marginal reaches one half are the result.

Labelled pages come from two places: generated layouts with known labels, and a bounded sample of
the table's own pages that mark their article. In half of the latter the mark is hidden, so that
pages without one are learned too.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.tables import hash_share

SAMPLE = 300  # pages of the table that training reads: the bound of the sample
BATCH = 64  # pages whose messages are passed together

# An svg is empty if it closes itself; one that is not closed ends where an element of the page begins or ends.
_QUOTED = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""
_OUTSIDE = (r"/?(?:p|div|span|h[1-6]|ul|ol|li|dl|dt|dd|table|tr|td|th|pre|blockquote|br|hr|img|b|i|em|strong|small|article|section"
            r"|main|aside|nav|header|footer|form|body|html)\b")
_TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(svg)\b{_QUOTED}(?<=/)>"
    rf"|<(svg)\b{_QUOTED}>(?:[^<]++|<!--.*?-->|<(foreignObject|desc|title|style|script)\b[^>]*(?<!/)>.*?</\3\s*>"
    rf"|<(?!/svg\b|{_OUTSIDE}))*+(?:</svg\s*>)?"
    r"|<(script|style|noscript|template|svg|textarea|select)\b[^>]*>.*?(?:</\4\s*>|\Z)"
    r"|<[/!?]?[a-zA-Z][^<>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*)")
_ATTRIBUTES = re.compile(r"""\b(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SENTENCE = re.compile(r"[.!?…](?:\s|$)")

# Names of HTML elements and words of common class names.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s "
             "samp small span strike strong sub sup time tt u var wbr picture source".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 "
             "h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
TAGS = [{"article", "main"}, {"div", "section", "center"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"},
        {"ul", "ol", "dl", "menu"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th"},
        {"blockquote", "pre", "figure", "figcaption", "details"}, {"header"}, {"footer"}, {"nav"}, {"aside"},
        {"form", "fieldset", "button", "dialog", "iframe", "object"}, {"body", "html"}, {"head", "title"}]
CLASSES = [r"\b(nav|menu|navbar|navigation|breadcrumbs?|toc|pager|pagination|tabs?)\b", r"\b(header|masthead|topbar|site-title|logo)\b",
           r"\b(footer|copyright|colophon|legal|bottom)\b", r"\b(sidebar|aside|widget|related|recommend\w*|more|teaser|complementary)\b",
           r"\b(cookies?|consent|gdpr|notices?|banner|popup|modal|alert|overlay|disclaimer|warning)\b",
           r"\b(ads?|advert\w*|sponsor\w*|promo\w*|adsense|banner-ad|commercial)\b",
           r"\b(form|subscribe|subscription|newsletter|login|signup|search|contact)\b",
           r"\b(comments?|replies|reply|respond|discussion|disqus|reviews?|responses)\b",
           r"\b(share|social|follow|tags?|meta|byline|author-box|rating)\b",
           r"\b(article|content|post|entry|story|main|body|text|page-content|prose|markdown)\b"]
_CLASSES = [re.compile(x) for x in CLASSES]
N_STATS = 22
N_FEATURES = 1 + len(TAGS) + 1 + len(CLASSES) + N_STATS
EDGES = 4  # plain child, paragraph-like child, child with a telling tag or class, child of such a parent
BARRIER = {8, 9, 10, 11, 12, 14}  # tags that hold no article text
BARRIER_CLASS = set(range(9))


class Page:
    """Block elements in document order with their text blocks."""

    def __init__(self, source: str, generated: bool = True):
        """``data-y`` is a label in generated layouts only; other pages use the name for their own."""
        self.generated = generated
        self.parent, self.depth, self.tag, self.names, self.label = [-1], [0], ["html"], [""], [None]
        self.blocks: list[tuple[int, str, int]] = []  # owner, text, characters inside links
        self._parse(source)

    def _open(self, tag: str, names: str, label) -> None:
        self.parent.append(self._stack[-1])
        self.depth.append(self.depth[self._stack[-1]] + 1)
        self.tag.append(tag)
        self.names.append(names)
        self.label.append(label)
        self._stack.append(len(self.tag) - 1)
        self._last.setdefault(tag, []).append(len(self._stack) - 1)

    def _close_to(self, height: int) -> None:
        while len(self._stack) > height:
            self._last[self.tag[self._stack.pop()]].pop()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._stack[-1], text, self._linked))
        self._text, self._linked = [], 0

    def _parse(self, source: str) -> None:
        self._stack, self._text, self._linked, links = [0], [], 0, 0
        self._last: dict[str, list[int]] = {"html": [0]}
        for match in _TOKENS.finditer(source):
            token = match.group()
            if token[0] != "<" or token == "<":
                self._text.append(token)
                if links:
                    self._linked += len(token)
                continue
            if match.lastindex or token[1:2] in "!?" or token[-1] != ">":
                continue
            name = _NAME.match(token)
            if not name:
                continue
            tag = name.group(1).lower()
            closing = token[1] == "/"
            if tag == "a":
                links = 0 if closing else 1
            if tag in INLINE:
                continue
            self._flush()
            if closing:
                if self._last.get(tag) and self._last[tag][-1] > 0:
                    self._close_to(self._last[tag][-1])
                continue
            if tag in ENDS_P and self._last.get("p"):
                self._close_to(self._last["p"][-1])
            if tag in SAME and self.tag[self._stack[-1]] in SAME[tag]:
                self._close_to(len(self._stack) - 1)
            if tag in VOID or token.endswith("/>"):
                continue
            names, label = "", None
            if len(token) > len(tag) + 2:
                for key, *values in _ATTRIBUTES.findall(token):
                    value = max(values, key=len)
                    if key.lower() == "data-y":
                        if self.generated:
                            label = int(value)
                    else:
                        names += " " + re.sub(r"[_-]+|(?<=[a-z])(?=[A-Z])", " ", value).lower() + " " + value.lower()
            if tag not in ("html",):
                self._open(tag, names, label)
        self._flush()

    def features(self) -> tuple[list[list[int]], list[int]]:
        """Feature numbers of every element, and the kind of its edge to its parent."""
        n = len(self.tag)
        own, linked, ends, blocks = [0] * n, [0] * n, [0] * n, [0] * n
        for owner, text, inside in self.blocks:
            own[owner] += len(text)
            linked[owner] += min(inside, len(text))
            ends[owner] += len(_SENTENCE.findall(text))
            blocks[owner] += 1
        whole, whole_linked, whole_ends = own[:], linked[:], ends[:]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            whole[p] += whole[i]
            whole_linked[p] += whole_linked[i]
            whole_ends[p] += whole_ends[i]
        total = max(whole[0], 1)
        rows, kinds, told = [], [], []
        for i in range(n):
            fixed, telling = _named(self.tag[i], self.names[i])
            at = N_FEATURES - N_STATS
            share = whole_linked[i] / max(whole[i], 1)
            row = [0, *fixed, at + min(len(bin(whole[i])) - 2, 13) // 2, at + 7 + min(int(share * 4), 3),
                   at + 11 + min(int(whole[i] / total * 4), 3), at + 15 + min(whole_ends[i], 2),
                   at + 18 + (own[i] > 0) + 2 * (own[i] > 80)]
            rows.append(row)
            told.append(telling)
            p = self.parent[i]
            kinds.append(2 if telling else 3 if p >= 0 and told[p] else 1 if self.tag[i] in TAGS[2] | TAGS[3] else 0)
        return rows, kinds


_NAMED: dict[tuple[str, str], tuple[list[int], bool]] = {}


def _named(tag: str, names: str) -> tuple[list[int], bool]:
    """Features of a tag and its class names; does either speak against content?"""
    key = (tag, names)
    got = _NAMED.get(key)
    if got is None:
        if len(_NAMED) > 50_000:
            _NAMED.clear()
        groups = [i for i, group in enumerate(TAGS) if tag in group]
        words = [i for i, x in enumerate(_CLASSES) if x.search(names)] if names else []
        telling = bool(BARRIER & set(groups)) or bool(BARRIER_CLASS & set(words)) and 9 not in words
        got = _NAMED[key] = ([1 + g for g in groups] or [1 + len(TAGS)], telling)
        got[0].extend(2 + len(TAGS) + w for w in words)
    return got


class Forest:
    """Several pages as flat arrays, grouped by depth, for message passing."""

    def __init__(self, pages: list[tuple[Page, list[list[int]], list[int]]]):
        parent, depth, kind, rows, sizes = [], [], [], [], []
        for page, features, kinds in pages:
            start = len(parent)
            parent += [p + start if p >= 0 else -1 for p in page.parent]
            depth += page.depth
            kind += kinds
            rows += features
            sizes.append(len(features))
        self.parent, self.kind = np.array(parent), np.array(kind)
        self.sizes = sizes
        self.count = np.array([len(r) for r in rows])
        self.flat = np.fromiter((f for r in rows for f in r), np.int64, int(self.count.sum()))
        self.owner = np.repeat(np.arange(len(rows)), self.count)
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
        self.levels = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def propagate(forest: Forest, unary: np.ndarray, edge: np.ndarray):
    """Sum-product on all trees: content marginals, and the joint marginals of child and parent."""
    n = len(forest.parent)
    belief = np.zeros((n, 2))
    belief[:, 1] = np.bincount(forest.owner, unary[forest.flat], n)
    up = np.zeros((n, 2))
    for level in forest.levels[:0:-1]:  # leaves to root
        t = edge[forest.kind[level]] + belief[level][:, None, :]  # [node, parent state, own state]
        up[level] = np.logaddexp(t[:, :, 0], t[:, :, 1])
        np.add.at(belief, forest.parent[level], up[level])
    joint = np.zeros((n, 2, 2))
    for level in forest.levels[1:]:  # root to leaves
        p = forest.parent[level]
        t = edge[forest.kind[level]] + (belief[p] - up[level])[:, :, None]
        both = t + belief[level][:, None, :]
        both -= both.max(axis=(1, 2), keepdims=True)
        both = np.exp(both)
        joint[level] = both / both.sum(axis=(1, 2), keepdims=True)
        belief[level] += np.logaddexp(t[:, 0], t[:, 1])
    top = belief - belief.max(1, keepdims=True)
    top = np.exp(top)
    return top[:, 1] / top.sum(1), joint


class TreeModel:
    def __init__(self, unary: np.ndarray, edge: np.ndarray):
        self.unary, self.edge = unary, edge

    def texts(self, sources: list[str]) -> list[str]:
        """Main text of each page: blocks of content elements, joined by newlines."""
        out = []
        for start in range(0, len(sources), BATCH):
            pages = [Page(s, generated=False) for s in sources[start:start + BATCH]]
            forest = Forest([(p, *p.features()) for p in pages])
            content, _ = propagate(forest, self.unary, self.edge)
            at = 0
            for page, size in zip(pages, forest.sizes, strict=True):
                keep = content[at:at + size] >= 0.5
                out.append("\n".join(text for owner, text, _ in page.blocks if keep[owner]))
                at += size
        return out


def fit(pages: list[tuple[Page, list[int]]], steps: int = 200, rate: float = 0.08, penalty: float = 2e-3) -> TreeModel:
    """Maximum likelihood with exact gradients; ``pages`` come with a label per element."""
    forest = Forest([(p, *p.features()) for p, _ in pages])
    y = np.array([v for _, labels in pages for v in labels])
    unary, edge = np.zeros(N_FEATURES), np.zeros((EDGES, 2, 2))
    edge[:, 0, 0] = edge[:, 1, 1] = 0.5
    inner = forest.parent >= 0
    seen = np.zeros((len(y), 2, 2))
    seen[np.flatnonzero(inner), y[forest.parent[inner]], y[inner]] = 1
    m = [np.zeros_like(unary), np.zeros_like(edge)]
    v = [np.zeros_like(unary), np.zeros_like(edge)]
    for step in range(1, steps + 1):
        content, joint = propagate(forest, unary, edge)
        grads = [np.bincount(forest.flat, (y - content)[forest.owner], N_FEATURES) / len(y) - penalty * unary,
                 np.stack([(seen - joint)[inner & (forest.kind == k)].sum(0) for k in range(EDGES)]) / len(y)
                 - penalty * edge]
        for i, (value, grad) in enumerate(zip((unary, edge), grads, strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.99 * v[i] + 0.01 * grad * grad
            value += rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return TreeModel(unary, edge)


def marked(page: Page) -> list[int] | None:
    """Labels of a page that marks its article: elements inside it and in nothing that speaks
    against content. None if the page has no such mark."""
    if "article" not in page.tag and "main" not in page.tag:
        return None
    root = "article" if "article" in page.tag else "main"
    inside, out = [], []
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        here = (p >= 0 and inside[p]) or tag == root
        inside.append(here and not _named(tag, page.names[i])[1])
        out.append(int(inside[i]))
    return out


def labelled(page: Page) -> list[int]:
    """Labels of a generated layout: ``data-y`` holds for an element and all below it."""
    out = []
    for i, label in enumerate(page.label):
        out.append(label if label is not None else out[page.parent[i]] if page.parent[i] >= 0 else 0)
    return out


def layouts(count: int = 160, seed: int = 11) -> list[str]:
    """Generated pages with labels: an article in one of several wrappers, among the usual parts
    around and inside it."""
    draw = random.Random(seed)
    words = "alo bera cinu dorem esta fali gona hutre iven jolas kime lun mora neth opil pran quos rilo sen tur".split()

    def text(n: int) -> str:
        out = []
        while n > 0:
            size = min(n, draw.randint(4, 14))
            out.append(" ".join(draw.choice(words) for _ in range(size)).capitalize() + ".")
            n -= size
        return " ".join(out)

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{draw.choice(words)}">{text(2)}</a></li>' for _ in range(n))

    def part(kind: str) -> str:
        name = {"nav": ["nav", "menu", "main-menu", "breadcrumb"], "side": ["sidebar", "widget", "related-posts"],
                "ad": ["ad", "ads", "advert", "sponsored", "promo"], "note": ["cookie-notice", "notice", "consent-banner"],
                "form": ["newsletter", "subscribe", "search-form", "login"], "talk": ["comments", "comment-list", "replies"],
                "head": ["header", "site-header"], "foot": ["footer", "site-footer"], "share": ["share", "social", "tags"]}[kind]
        name = f'{draw.choice(["class", "id"])}="{draw.choice(name)}"'
        body = {"nav": f"<ul>{links(draw.randint(3, 9))}</ul>", "side": f"<h3>{text(3)}</h3><ul>{links(4)}</ul><p>{text(20)}</p>",
                "ad": draw.choice([text(draw.randint(3, 15)), f"<p>{text(draw.randint(8, 40))}</p>"]),
                "note": f"<p>{text(draw.randint(10, 40))}</p>",
                "form": f"<label>{text(3)}</label><input><button>{text(1)}</button><p>{text(8)}</p>",
                "talk": "".join(f'<div class="comment"><b>{text(2)}</b><p>{text(draw.randint(6, 60))}</p></div>' for _ in range(draw.randint(1, 5))),
                "head": f"<h2>{text(3)}</h2><p>{text(6)}</p>", "foot": f"<p>{text(8)}</p><ul>{links(3)}</ul>",
                "share": f"<ul>{links(3)}</ul>"}[kind]
        tag = draw.choice({"nav": ["nav", "div", "ul"], "side": ["aside", "div", "aside"], "form": ["form", "div", "form"],
                           "talk": ["section", "div"], "head": ["header", "div"], "foot": ["footer", "div"],
                           "note": ["div", "section", "aside"]}.get(kind, ["div"]))
        bare = tag not in ("div", "section", "ul") and draw.random() < 0.5
        return f'<{tag} data-y="0"{"" if bare else " " + name}>{body}</{tag}>'

    out = []
    for _ in range(count):
        blocks = [f"<h1>{text(draw.randint(3, 9))}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.75:
                blocks.append(f"<p>{text(draw.choice([1, 3, 8, 30, 80, 200]))}</p>")
            elif kind < 0.83:
                blocks.append(f"<h2>{text(4)}</h2>")
            elif kind < 0.9:
                blocks.append("<ul>" + "".join(f"<li>{text(8)}</li>" for _ in range(4)) + "</ul>")
            elif kind < 0.95:
                blocks.append(f"<blockquote><p>{text(20)}</p></blockquote>")
            else:
                blocks.append(f"<table><tr><td>{text(3)}</td><td>{text(3)}</td></tr></table>")
        for kind in draw.sample(["ad", "share", "talk", "form", "side", "note"], draw.randint(0, 2)):
            blocks.insert(draw.randint(1, len(blocks)), part(kind))
        wrapper = draw.choice(['article', 'article', 'main', 'div class="content"', 'div id="post-body"', 'div class="entry-content"',
                               'section class="story"', 'div', 'article class="post"', 'div role="main"'])
        body = f'<{wrapper} data-y="1">{"".join(blocks)}</{wrapper.split()[0]}>'
        before = [part(k) for k in draw.sample(["head", "nav", "ad", "note", "side", "form"], draw.randint(1, 4))]
        after = [part(k) for k in draw.sample(["foot", "talk", "side", "ad", "share", "form", "note"], draw.randint(1, 4))]
        page = "".join([*before, body, *after])
        if draw.random() < 0.4:
            page = f'<div class="{draw.choice(["wrapper", "page", "container", "site"])}">{page}</div>'
        out.append(f"<html><head><title>{text(4)}</title></head><body>{page}</body></html>")
    return out


_HIDDEN = re.compile(r"<(/?)(?:article|main)\b[^>]*>", re.I)


def train(pages: DataFrame, sample: int = SAMPLE) -> TreeModel:
    """Fit on generated layouts and on at most ``sample`` pages of the table that mark their
    article, drawn by hash from all distinct ones."""
    texts = pages.select(F.col("html").cast("string").alias("html"))
    texts = texts.where(F.col("html").rlike("(?i)<(article|main)\\b"))
    different = texts.select(F.xxhash64("html")).distinct().count()
    rows = (texts.where(hash_share(["html"], sample, different))
            .distinct().orderBy(F.xxhash64("html"), "html").limit(sample).collect())
    known = []
    for source in layouts():
        page = Page(source)
        known.append((page, labelled(page)))
    for i, row in enumerate(rows):
        page = Page(row.html, generated=False)
        labels = marked(page)
        if i % 2:  # the same labels, learned without the mark
            page.tag = ["div" if t in ("article", "main") else t for t in page.tag]
        known.append((page, labels))
    return fit(known)


def _extract(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                rows = batch.slice(part, 500)
                texts = held.value.texts([x or "" for x in rows.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])
    return run


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    A null or empty page, or one without content, has an empty text; so has a page that is only text
    outside of any element. ``<br>`` ends a block. Repeated rows are treated alike; other columns are ignored. Fits the model on ``pages`` unless one is given.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or train(pages))
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"),
                       F.col("html").cast("string")).mapInArrow(_extract(held), "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
