"""HTML extraction by minimum cut.

A page becomes a sequence of text blocks, split at block tags.  Scripts,
styles, templates, fields and comments in markup hold no text, and forms neither,
unless they frame the page (``in_forms``).  A classifier gives every
block the log odds of being main text, which become capacities to the source
(content) or the sink (boilerplate).  Blocks next to each other are tied by
smoothness edges, tighter the nearer they are in the tree, and so are the blocks of
one parent.  The cut of least capacity labels the blocks; blocks on the source's
side, in page order, joined by one blank, are the main text.

The classifier is logistic, on what a block and its ancestors look like (tags,
words of ``class``, ``id`` and ``role``, links, length, punctuation).  It is trained
on at most ``FIT_PAGES`` pages of the table at hand (those with the smallest hashes),
whose semantic tags serve as labels, and shrunk towards fixed starting weights
(``START``), which stand where no page has such tags.

Nodes whose own capacity is at least that of all their edges are settled before the
flow is computed, which changes no cut and leaves little on most pages; maximum flow
runs on the rest, without recursion, so long pages do no harm.

Defined cases: null html is empty and gives empty text; a page of unmarked text is
one block; unclosed and unknown tags are allowed (a head without its end tag ends at the first
element or text that can't be in it); repeated rows give equal texts; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.llm.tables import for_python, read
from roomtrace.llm.words import texts

FIT_PAGES = 1_000

#: HTML's elements by their role.
DROPPED = frozenset(
    "script style template svg canvas iframe embed audio video head button select"
    " option textarea input datalist output progress meter dialog title annotation annotation-xml".split()
)
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul br title".split()
)
#: Elements that close an open paragraph; it lies right in one of them.
ENDS_P = BLOCKS - {"br", "td", "th", "tr", "caption", "title"}
#: An element closed by the start of another one.
ENDED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
#: Elements beyond which no element is closed by the start of another one.
LISTS = ("ul", "ol", "dl", "table", "menu")
#: What may stand in a head; any other element or text ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
MAIN_TAGS = frozenset(["article", "main"])
OUTER_TAGS = frozenset(["nav", "header", "footer", "aside", "menu"])
MAIN_WORDS = frozenset("article main content post entry story text body".split())
OUTER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menus"
    " header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices alert popup modal overlay"
    " comment comments disqus reply replies respond social share sharing related recommended breadcrumb breadcrumbs"
    " pagination pager newsletter subscribe subscription signup login search copyright legal toolbar skip".split()
)
#: Those of them that also hold for an article inside: readers' comments are often marked up as articles.
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
#: Words behind the one that says what an element is, and in front of one that says only how it looks.
PLACE_WORDS = frozenset(
    "box block list wrapper wrap container inner outer area section bar links link posts articles items item buttons button slot"
    " unit top bottom left right col column panel text content message icons zone region row grid form group head title body"
    " first last small large main site page global primary secondary".split()
)
MODIFIERS = frozenset("with without no not non has is hide".split())
#: Elements of running text; a class on one of them inside an article is about that text.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption span em strong b i".split())
OUTER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog toolbar".split()
)

#: What the classifier looks at, and its starting weights.
START = {
    "constant": 0.2,
    "main tag around": 2.0,
    "main tag elsewhere": -3.0,
    "outer tag around": -8.0,
    "main word around": 1.0,
    "outer word around": -8.0,
    "share of links": -2.5,
    "log words": 0.3,
    "sentence marks": 0.5,
    "heading": 0.3,
    "paragraph": 0.5,
}
#: Words from which text in a form is running text, also outside of paragraphs.
RUNNING = 10
PARAGRAPHS = ("p", "blockquote", "pre")
#: Smoothness: capacity between neighbours at distance 1 in the tree, and between blocks of one parent.
NEAR, SIBLINGS = 0.8, 0.4

#: A name and its value, if any.  Quotes hold a value together only at its start; elsewhere they are characters like others.
_ATTRIBUTE = r"=?+[^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|(?=[^\s/>]){_ATTRIBUTE})*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    """An open element: what lies around a text in it."""

    tag: str
    depth: int
    parent: Node | None
    main: bool = False
    outer: bool = False
    main_word: bool = False
    outer_word: bool = False
    comment: bool = False
    link: bool = False
    #: The nearest element that splits blocks, maybe itself.
    holder: Node | None = None
    #: The innermost form, and whether an article or main element lies between.
    form: Node | None = None
    framed: bool = False
    #: Its text is left out, whatever else it is.
    dropped: bool = False


@dataclass(slots=True)
class Block:
    node: Node
    #: Depth of the deepest element that has been open ever since the block before.
    shared: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    chars: int = 0
    text: str = ""


def _outer_token(token: str, in_main: bool) -> str | None:
    """The word by which a class or id names boilerplate, if it does.

    ``site-footer`` and ``related-posts`` do; ``with-sidebar``, ``ad-free`` and ``header-fixed`` say how something else looks,
    ``related-work`` names its own matter, and the header of an article belongs to it.
    """
    words = _WORDS.findall(token)
    if not words or words[0] in MODIFIERS:
        return None
    named = list(words)
    while len(named) > 1 and named[-1] in PLACE_WORDS:
        named.pop()
    last = named[-1]
    if last not in OUTER_WORDS:
        return None
    if last in ("header", "banner", "masthead") and (in_main or "hero" in words or any(w in MAIN_WORDS - PLACE_WORDS for w in words)):
        return None
    return last


def _open(tag: str, attributes: str, parent: Node) -> Node:
    node = Node(tag, parent.depth + 1, parent, parent.main, parent.outer, parent.main_word, parent.outer_word, parent.comment, parent.link, parent.holder, parent.form, parent.framed)
    if tag in BLOCKS:
        node.holder = node
    if tag in MAIN_TAGS:
        node.main = node.framed = True
        # What the layout around an article is called says nothing about it.
        node.outer_word = node.comment
    # A header inside an article is its heading, not the page's.
    elif tag in OUTER_TAGS and not (tag == "header" and parent.main):
        node.outer = True
    # In an article it stands for what scripts would show, elsewhere it asks for scripts.
    elif tag == "noscript" and not parent.main:
        node.outer = True
    node.dropped = tag in DROPPED or (tag == "label" and parent.form is not None and not parent.framed)
    if tag == "a":
        node.link = True
    if attributes:
        for name, *values in _NAMES.findall(attributes):
            value = "".join(values).lower()
            words = _WORDS.findall(value)
            if name.lower() == "role":
                node.outer |= any(w in OUTER_ROLES for w in words)
                if "main" in words or "article" in words:
                    node.main = node.framed = True
            elif tag not in ("body", "html"):
                node.main_word |= any(w in MAIN_WORDS for w in words)
                if parent.main and tag in TEXT_TAGS:
                    continue
                named = {_outer_token(token, parent.main) for token in value.split()} - {None}
                node.comment |= any(w in COMMENT_WORDS for w in named)
                # An article's own classes are about the page it is on, unless they call it a comment.
                node.outer_word |= node.comment if tag in MAIN_TAGS else bool(named)
    if tag == "form":
        node.form, node.framed = node, False
    return node


def in_forms(blocks: list[Block]) -> list[bool]:
    """Whether each block belongs to a form that doesn't frame the page.

    A form frames it that holds an article or main element, or at least as much
    running text as there is text outside of it; its text is judged like any other.
    """
    # Each form with its text, how much of that is running, and whether it has an article or main element.
    forms: dict[int, list] = {}
    total = 0
    for b in blocks:
        node, form = b.node, b.node.form
        while form is not None and id(form) not in forms:
            forms[id(form)] = [form, 0, 0, False]
            form = form.parent.form
        if node.outer or node.outer_word or 2 * b.linked >= b.chars:
            continue
        total += len(b.text)
        if node.form is not None:
            found = forms[id(node.form)]
            found[1] += len(b.text)
            found[2] += len(b.text) if node.tag in PARAGRAPHS or b.text.count(" ") + 1 >= RUNNING else 0
            found[3] |= node.framed and b.text != ""
    outer_first = sorted(forms.values(), key=lambda f: f[0].depth)
    for found in reversed(outer_first):
        if (around := found[0].parent.form) is not None:
            for k in (1, 2, 3):
                forms[id(around)][k] += found[k]
    frames: dict[int, bool] = {}
    for form, size, running, framed in outer_first:
        around = form.parent.form
        frames[id(form)] = bool(framed or 0 < running >= total - size) and (around is None or frames[id(around)])
    return [b.node.form is not None and not frames[id(b.node.form)] for b in blocks]


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, white space inside made single blanks."""
    root = Node("", 0, None)
    root.holder = root
    stack, out = [root], []
    # Places in the stack by tag, and of those that a paragraph can lie right in, so that no search goes through the stack.
    places: dict[str, list[int]] = defaultdict(list)
    scopes: list[int] = []
    block: Block | None = None
    at, dropped, shared = 0, 0, 0

    def last(tag: str) -> int:
        """The place of the innermost open element of a tag, or 0."""
        return places[tag][-1] if places.get(tag) else 0

    def say(raw: str) -> None:
        nonlocal block, shared
        if stack[-1].tag == "head" and raw.strip(" \t\n\f\r"):
            close(len(stack) - 1)
        if dropped or not raw:
            return
        node = stack[-1]
        if block is None:
            block = Block(node.holder, shared)
            out.append(block)
            shared = len(stack) - 1
        text = entities.unescape(raw) if "&" in raw else raw
        block.parts.append(text)
        block.chars += len(text)
        if node.link:
            block.linked += len(text)

    def close(to: int) -> None:
        nonlocal dropped, block, shared
        for node in reversed(stack[to:]):
            places[node.tag].pop()
            if node.tag in ENDS_P:
                scopes.pop()
            dropped -= node.dropped
            if node.tag in BLOCKS:
                block = None
        del stack[to:]
        shared = min(shared, to - 1)

    while True:
        found = _TAG.search(page, at)
        if found is None:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                say(found[0][9:].removesuffix("]]>"))
            continue
        tag = found[2].lower()
        if found[1]:
            if k := last(tag):
                close(k)
            if tag in BLOCKS:
                block = None
            continue
        if tag == "body":
            # Whatever is open in the head.
            if k := last("head"):
                close(k)
        elif stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in ENDS_P and scopes and stack[scopes[-1]].tag == "p":
            close(scopes[-1])
        if tag in ENDED_BY:
            k = max(last(t) for t, by in ENDED_BY.items() if tag in by)
            if k > max(map(last, LISTS)):
                close(k)
        if tag in BLOCKS:
            block = None
        if tag in VOID:
            continue
        places[tag].append(len(stack))
        if tag in ENDS_P:
            scopes.append(len(stack))
        stack.append(_open(tag, found[3], stack[-1]))
        dropped += stack[-1].dropped
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            if tag not in DROPPED:
                say(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            close(len(stack) - 1)
    for b in out:
        b.text = _SPACE.sub(" ", "".join(b.parts)).strip()
    kept, shared = [], 0
    for b, left_out in zip(out, in_forms(out)):
        shared = min(shared, b.shared)
        if b.text and not left_out:
            b.shared = shared
            kept.append(b)
            shared = b.node.depth
    return kept


def block_features(b: Block, page_has_main: bool) -> list[float]:
    node, words = b.node, b.text.count(" ") + 1
    return [
        1.0,
        float(node.main),
        float(page_has_main and not node.main),
        float(node.outer),
        float(node.main_word),
        float(node.outer_word),
        b.linked / max(1, b.chars),
        np.log1p(words),
        float(any(c in b.text for c in ".!?;:")),
        float(node.tag in ("h1", "h2", "h3", "h4", "h5", "h6")),
        float(node.tag in PARAGRAPHS),
    ]


# --- the cut -----------------------------------------------------------------------


def tree_distance(a: Block, b: Block) -> int:
    """Steps between the elements of a block and the next one over their last common ancestor."""
    return a.node.depth + b.node.depth - 2 * min(a.node.depth, b.node.depth, b.shared)


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours, and each block with the one before it under the same parent."""
    found: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            found[i - 1, i] = NEAR / (1 + tree_distance(blocks[i - 1], b))
        parent = id(b.node.parent)
        if parent in last:
            key = last[parent], i
            found[key] = found.get(key, 0.0) + SIBLINGS
        last[parent] = i
    return [(a, b, c) for (a, b), c in found.items()]


def minimum_cut(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Whether each node is on the source's side of a least cut; positive odds tie a node to the source, negative ones to the sink."""
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    own = odds.astype(float).tolist()
    side: list[bool | None] = [None] * n
    # A node that outweighs its edges is settled, and pulls its neighbours by what ties them.
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is not None or abs(own[i]) < sum(near[i].values()) or (own[i] == 0 and near[i]):
            continue
        side[i] = own[i] > 0
        for j, c in near[i].items():
            own[j] += c if side[i] else -c
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = _source_side(rest, own, near)
        for i in rest:
            side[i] = i in reached
    return np.array(side, bool)


def _source_side(rest: list[int], own: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes reached from the source when the flow is greatest (shortest augmenting paths in layers)."""
    source, sink = -1, -2
    left: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    left[source], left[sink] = {}, {}
    for i in rest:
        if own[i] > 0:
            left[source][i] = own[i]
            left[i].setdefault(source, 0.0)
        elif own[i] < 0:
            left[i][sink] = -own[i]
            left[sink].setdefault(i, 0.0)
    while True:
        layer, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in left[u].items():
                if c > 1e-12 and v not in layer:
                    layer[v] = layer[u] + 1
                    queue.append(v)
        if sink not in layer:
            return set(layer)
        path, tries = [source], {u: iter(list(left[u])) for u in layer}
        while path:
            u = path[-1]
            if u == sink:
                flow = min(left[a][b] for a, b in zip(path, path[1:]))
                full = len(path)
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    left[a][b] -= flow
                    left[b][a] = left[b].get(a, 0.0) + flow
                    if left[a][b] <= 1e-12:
                        full = min(full, k + 1)
                del path[full:]
                tries[path[-1]] = iter(list(left[path[-1]]))
                continue
            for v in tries[u]:
                if layer.get(v) == layer[u] + 1 and left[u][v] > 1e-12:
                    path.append(v)
                    break
            else:
                path.pop()
                layer[u] = -1
        # Every shortest path is full now.


def features_of(blocks: list[Block]) -> np.ndarray:
    # An article among the comments, or in a sidebar, isn't the page's main part.
    has_main = any(b.node.main and not b.node.outer and not b.node.outer_word for b in blocks)
    return np.array([block_features(b, has_main) for b in blocks])


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    x = features_of(blocks)
    inside = minimum_cut(x @ weights, edges_of(blocks))
    return " ".join(b.text for b, keep in zip(blocks, inside) if keep)


# --- training -------------------------------------------------------------------------


def fit(x: np.ndarray, y: np.ndarray, pull: float = 25.0) -> np.ndarray:
    """Logistic weights by Newton steps, pulled towards the starting weights."""
    start = np.array(list(START.values()))
    weights = start.copy()
    for _ in range(20 if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - pull * (weights - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(start))
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the pages that a semantic tag labels, with equal ones counted."""
    for batch in batches:
        rows = []
        for page in texts(batch, "html"):
            found = blocks_of(page)
            # A page without main tags says nothing.
            if any(b.node.main and not b.node.outer and not b.node.outer_word for b in found):
                rows += [
                    (x, float(b.node.main and not b.node.outer and not b.node.outer_word))
                    for x, b in zip(features_of(found).tolist(), found)
                ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rows], pa.list_(pa.float64())), pa.array([y for _, y in rows], pa.float64())], ["x", "y"]
        )


def train(pages: DataFrame, most: int = FIT_PAGES) -> np.ndarray:
    """Weights from at most ``most`` pages; their blocks' numbers come to the driver."""
    picked = pages.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(most).distinct()
    sample = pages.join(F.broadcast(picked), "page_id").select("page_id", "html")
    one_each = sample.groupBy("page_id").agg(F.min("html").alias("html")).select("html")
    found = for_python(one_each).mapInArrow(_sums, "x array<double>, y double").groupBy("x", "y").count().toArrow()
    if not found.num_rows:
        return fit(np.empty((0, len(START))), np.empty(0))
    x, y = np.array(found["x"].to_pylist()), np.asarray(found["y"])
    # Equal blocks count by the root of their number, so that menus don't outweigh the rest.
    weight = np.sqrt(np.asarray(found["count"], float))
    order = np.lexsort((*x.T, y))
    copies = np.maximum(1, np.round(weight[order])).astype(int)
    return fit(np.repeat(x[order], copies, 0), np.repeat(y[order], copies))


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``page_id, url, text`` for each row of ``page_id, url, html``."""
    weights = train(pages) if weights is None else weights
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page, weights) for page in texts(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return for_python(pages.select("page_id", "url", "html")).mapInArrow(run, schema)


def op5_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
