"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at block-level tags.  Each block gets a logit:
what its ancestors say (article and main against nav, footer, aside, forms and
class names of menus, notices, adverts, comments), plus a text classifier over
link density, length, punctuation and the like.  A class name whose head
(its last word but words of place) is of menus, notices and so on says so strongly
(``weather-widget``, ``comment-body``); one that has such a word elsewhere
(``social-science``) says it weakly, and the classifier can outweigh it.  A form
is boilerplate if it has fields, no article or main, and not the page's prose.
The classifier is trained on
the blocks of up to ``sample_pages`` pages (the bound is a parameter) whose
ancestors tell their label; a sure classifier outweighs an article's or, with
edges to content, boilerplate's ancestors.  The two costs of a block are the capacities of its
edges to source and sink; edges between adjacent blocks, and between blocks
close in the DOM, have the capacity of a smoothness cost.  The minimum cut
separates content from boilerplate: blocks whose own cost exceeds all their
edges are labelled at once (they keep that label in every minimum cut), the
rest by max-flow.

Text: character references decoded, white space in a block turned into one
space, blocks joined by one space in page order; nothing else is dropped.

Edge cases: a null or empty page, or one without content, gives an empty text;
a page without content by the cut has what its ancestors call so; a block whose
costs tie is boilerplate; parsing and edges are linear in the page, however
long, deep or broken it is;
unclosed tags, comments and scripts run to the end of the page; repeated rows
give repeated results; without any labelled block the classifier is
neutral; other columns pass through, one named like a result is replaced.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import add_columns, logistic

# HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg annotation object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q ruby rp rt s samp "
                   "small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub msubsup "
                   "mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace mpadded mfenced semantics"
                   .split())
BOILER_TAGS = frozenset("nav footer aside menu dialog button fieldset".split())
CONTENT_TAGS = frozenset(("article", "main"))
FIELDS = frozenset("input select textarea button".split())
# Words of class, id and role that name what a part of a page is for.
BOILER_WORDS = frozenset("""ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment
    comments consent contentinfo cookie cookies copyright dialog discussion disqus disclaimer footer gdpr header login
    masthead menu modal nav navbar navigation navi newsletter notice notices notification overlay pager pagination popup
    privacy promo promotion recommended related replies reply respond search share sharing sidebar sidenav signup skip
    social sponsor sponsored subscribe tags teaser toolbar topbar tracking widget widgets""".split())
BOILER_STARTS = ("comment", "advert", "adsby", "sidebar", "cookie", "navig", "newsletter")
CONTENT_WORDS = frozenset("article articlebody content entry main post postbody story body text".split())
PLACE_WORDS = frozenset("""area bar block bottom box button buttons center content desktop fixed footer form global group
    head holder icon icons inner item items large left link links list local media medium mobile module outer panel part
    policy posts articles primary right secondary section site slot small sticky title top unit user users reader readers
    up use view""".split())
LAYOUT_WORDS = frozenset("has with no wrapper wrap container layout page site col row".split())
CUE = re.compile(r"©|copyright|cookie|all rights|subscribe|sign up|log ?in|privacy|terms of|newsletter|share", re.I)

TAG = re.compile(r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z)
    | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S | re.X)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
N_FEATURES = 12
# Costs: a sure classifier outweighs what an article says, and edges tip the scales; with
# edges it also outweighs what boilerplate says (more, for comments and adverts are prose too).
ADJACENT, CLOSE, STRONG, INSIDE, CLIP = 0.5, 0.3, -5.0, 4.0, 4.4
HINT = -2.0  # what a class name says that has a word of boilerplate, but not as its head
PROSE, FORM_PROSE = 15, 50  # words of a block of prose, words of prose of a form around an article
TOPICS = ("category-", "tag-")  # classes that name what an article is about
KINDS_OF_ARTICLE = frozenset("article entry main post story".split())


def boiler_word(word: str) -> bool:
    return word in BOILER_WORDS or word.startswith(BOILER_STARTS)


def head(words: list[str]) -> str:
    """What a name of several words is: its last word that is not one of place."""
    return next((w for w in reversed(words) if boiler_word(w) or not (
        w in PLACE_WORDS or w in CONTENT_WORDS or w.isdigit())), "")


def says(name: str, attrs: str, above: float) -> float:
    """What an element tells of the text in it: a logit, ``above`` is its parent's."""
    if name == "main":
        return INSIDE
    if above <= STRONG or name in BOILER_TAGS or (name == "header" and above < INSIDE):
        return STRONG
    names = [[w.lower() for w in WORD.findall(c)] for m in NAMED.finditer(attrs)
             for c in (m[1] or m[2] or m[3] or "").split() if not c.lower().startswith(TOPICS)] if attrs else []
    if above >= INSIDE:  # the header of an article is part of it
        names = [[w for w in x if w != "header"] for x in names]
    words = set().union(*names)
    if name == "article" and words & KINDS_OF_ARTICLE:
        return INSIDE
    content = name == "article" or words & CONTENT_WORDS and name not in ("html", "body")
    boiler = [x for x in names if any(map(boiler_word, x))]
    if boiler and not words & LAYOUT_WORDS and name not in ("html", "body"):
        if any(boiler_word(head(x)) for x in boiler):
            return STRONG
        return 0.0 if content else min(above, HINT)
    return INSIDE if content else above


class Node:
    """An element of the page's tree."""
    __slots__ = ("parent", "depth")

    def __init__(self, parent: Node | None):
        self.parent, self.depth = parent, parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("text", "logit", "node", "tag", "linked", "form")

    def __init__(self, text: str, logit: float, node: Node, tag: str, linked: int, form: Form | None):
        self.text, self.logit, self.node, self.tag, self.linked, self.form = text, logit, node, tag, linked, form

    @property
    def prose(self) -> int:
        """Words of a block that reads like prose, else 0."""
        words = self.text.count(" ") + 1
        return words if words >= PROSE and 2 * self.linked < len(self.text) and self.logit > STRONG else 0


class Form:
    """What is seen inside a form element."""
    __slots__ = ("fields", "content", "prose")

    def __init__(self):
        self.fields, self.content, self.prose = 0, False, 0


class Open:
    """The open elements of a page, with the innermost one of each name."""

    def __init__(self):
        # name, logit, node, place of the innermost element that is not inline, form
        self.stack: list[tuple[str, float, Node, int, Form | None]] = [("", 0.0, Node(None), 0, None)]
        self.places: dict[str, list[int]] = {}
        self.links = 0

    def push(self, name: str, attrs: str) -> None:
        _, logit, node, base, form = self.stack[-1]
        here = len(self.stack)
        if name == "form":
            form = Form()
        elif form and name in CONTENT_TAGS:
            form.content = True
        self.stack.append((name, says(name, attrs, logit), Node(node), base if name in INLINE else here, form))
        self.places.setdefault(name, []).append(here)
        self.links += name == "a"

    def cut(self, k: int) -> None:
        """Closes the elements from place ``k`` on."""
        for name, *_ in self.stack[k:]:
            self.places[name].pop()
            self.links -= name == "a"
        del self.stack[k:]

    def end(self, name: str) -> int | None:
        """The place of the element that an end tag closes, if any; an inline one only in its block."""
        at = self.places.get(name)
        return at[-1] if at and (name not in INLINE or at[-1] > self.stack[-1][3]) else None

    def shut(self, name: str) -> None:
        """A block begins a new one: what the open paragraph or item holds is closed."""
        names = ("li",) if name == "li" else ("dt", "dd") if name in ("dt", "dd") else \
            ("td", "th") if name in ("td", "th") else ("tr", "td", "th") if name == "tr" else ("p",)
        k = self.stack[-1][3]
        while k and self.stack[k][0] not in names and self.stack[k][0] == "p":
            k = self.stack[k - 1][3]
        if k and self.stack[k][0] in names:
            self.cut(k)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, without head, scripts, styles and comments."""
    out: list[Block] = []
    tree = Open()
    pieces, linked = [], 0
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            _, logit, _, base, form = tree.stack[-1]
            out.append(Block(text, logit, tree.stack[base][2], tree.stack[base][0], linked, form))
        pieces.clear()
        linked = 0

    while at < size:
        lt = page.find("<", at)
        m = TAG.match(page, lt) if lt >= 0 else None
        if lt >= 0 and m is None:  # a bare < is text
            piece = unescape(page[at:lt]) + "<"
            pieces.append(piece)
            linked += len(piece) if tree.links else 0
            at = lt + 1
            continue
        if lt < 0:
            lt = size
        if lt > at:
            piece = unescape(page[at:lt])
            pieces.append(piece)
            linked += len(piece) if tree.links else 0
        if m is None:
            break
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            k = tree.end(name)
            if k is not None:
                if name not in INLINE:
                    flush()
                tree.cut(k)
            continue
        form = tree.stack[-1][4]
        if form and name in FIELDS:
            form.fields += 1
        if name in RAW:
            if m[0].endswith("/>"):
                continue
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if name not in INLINE:
            flush()
            tree.shut(name)
        if name not in VOID:
            tree.push(name, m["attrs"])
    flush()
    _judge_forms(out)
    return out


def _judge_forms(found: list[Block]) -> None:
    """Blocks of a form with fields are boilerplate, unless it is the frame of the page's content."""
    for b in found:
        if b.form:
            b.form.prose += b.prose
    total = sum(b.prose for b in found)
    for b in found:
        f = b.form
        if f and f.fields and not f.content and (f.prose < FORM_PROSE or 2 * f.prose < total):
            b.logit = STRONG


def features(found: list[Block]) -> list[int]:
    """Feature bits of every block."""
    out, n = [], len(found)
    for i, b in enumerate(found):
        t, words = b.text, b.text.count(" ") + 1
        density = b.linked / len(t)
        bits = (density > 0.3, density > 0.7, words >= 5, words >= 15, words >= 40, t[-1] in ".!?:;\"”»",
                "," in t or ". " in t, b.tag[:1] == "h" and b.tag[1:].isdigit(), b.tag in ("li", "td", "th", "dd", "dt"),
                CUE.search(t) is not None, i * 10 < n, (n - 1 - i) * 10 < n)
        out.append(sum(x << k for k, x in enumerate(bits)))
    return out


def distance(a: Node, b: Node) -> int:
    """Steps between two elements in the tree.  Over the neighbours of a page
    in order these are steps of one walk around its tree, so linear in all."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness costs: neighbours in page order by their distance in the DOM,
    and each block with the last one before it under the same parent."""
    out, last = [], {}
    for j, b in enumerate(found):
        if j:
            out.append((j - 1, j, 2 * ADJACENT / max(2, distance(found[j - 1].node, b.node))))
        i = last.get(b.node.parent)
        if i is not None and i < j - 1:
            out.append((i, j, CLOSE))
        last[b.node.parent] = j
    return out


def min_cut(logit: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Content labels of least cost: |logit| for a block labelled against its
    sign, the weight of every link between different labels."""
    n, z = len(logit), list(logit)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in links:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # a node whose own cost is over all its links keeps its side
        i = todo.popleft()
        if label[i] is None and abs(z[i]) >= sum(near[i].values()):
            label[i] = z[i] > 0
            for j, w in near[i].items():
                z[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        content = _max_flow(rest, z, near)
        for i in rest:
            label[i] = i in content
    return [bool(x) for x in label]


def _max_flow(nodes: list[int], z: list[float], near: list[dict[int, float]]) -> set[int]:
    """The source side of the minimum cut, by shortest augmenting paths."""
    source, sink = -1, -2
    left: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    left[source], left[sink] = {}, {}
    for i in nodes:
        a, b = (source, i) if z[i] > 0 else (i, sink)
        left[a][b], left[b][a] = abs(z[i]), 0.0
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, w in left[i].items():
                if w > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came) - {source}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= flow
            left[b][a] = left[b].get(a, 0.0) + flow


def main_text(page: str | None, weights: np.ndarray) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    logit = [b.logit + float(np.clip(weights[f], -CLIP, CLIP)) for b, f in zip(found, features(found), strict=True)]
    content = min_cut(logit, edges(found))
    if not any(content):  # a page has content: what ancestors call so, then
        content = [b.logit > 0 for b in found]
    return " ".join(b.text for b, c in zip(found, content, strict=True) if c)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(f, x.logit > 0) for page in b.column("html").to_pylist() for found in [blocks(page or "")]
                for f, x in zip(features(found), found, strict=True) if abs(x.logit) >= INSIDE]
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in rows], pa.int32()),
                                          pa.array([y for _, y in rows], pa.bool_())], ["features", "content"])


def learn(pages: DataFrame, sample_pages: int = 2000) -> np.ndarray:
    """The classifier's logit for every combination of features; the driver
    gets counts of (features, label), at most 2 x 4096 rows."""
    sample = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("html").alias("h")) \
        .where("html is not null")
    bound = sample.select("h").orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    bits = np.array([[f >> k & 1 for k in range(N_FEATURES)] + [1] for f in range(1 << N_FEATURES)], float)
    if bound is None:
        return np.zeros(1 << N_FEATURES)
    rows = sample.where(F.col("h") <= bound).dropDuplicates(["h"]).select("html") \
        .mapInArrow(_labelled, "features int, content boolean") \
        .groupBy("features", "content").count().collect()
    if len({r.content for r in rows}) < 2:
        return np.zeros(1 << N_FEATURES)
    x = bits[[r.features for r in rows]]
    return bits @ logistic(x, np.array([float(r.content) for r in rows]), np.array([float(r["count"]) for r in rows]))


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """``pages`` with the main text of html and its length in code points."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(html: pa.Array) -> list[pa.Array]:
        texts = [main_text(t, shared.value) for t in html.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_columns(pages, "text string, n_chars long", run, text="html")
