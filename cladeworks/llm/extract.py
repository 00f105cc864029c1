"""Main text of web pages by a tree-structured graphical model.

A page is parsed into a tree of block elements. Each has a binary state, content or not; a log-linear potential reads
its tag, the names in its and its next ancestors' class and id and the words in these names, the forms, asides, footers and
navigation that hold it at any depth, its text and links, and a potential on each edge couples parent and child.
Sum-product messages, once up and once down the tree, give exact marginals; training climbs the exact gradient of the
labels' log-likelihood (expected against observed features) on labelled pages, by default a bounded number of generated
ones (html_pages). Blocks whose element is content with a marginal of at least 0.5 are the text.

Text is read whole: character references are decoded, white space inside a block becomes one space, blocks are joined
by a line feed. Scripts, styles, comments, templates and other raw elements have no text. A page is handled in one
task, in time and memory in proportion to its length, without recursion.

Defined cases: null html is the empty page and gives the empty text; broken markup closes as browsers do in the common
cases; an element that is never closed ends with its parent; repeated rows extract alike; an empty table gives an empty
result. A form around an article, main or h1 wraps the page and counts as a plain container. Extra columns pass through; text and n_chars are replaced.
"""

from __future__ import annotations

import functools
import html
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .html_pages import labelled_page

# Fixed values of HTML: elements by how they parse.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title noscript iframe template svg object canvas audio video head textarea".split())
BLOCK = frozenset(
    "html body address article aside blockquote button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup label legend li main menu nav ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
SCOPED = frozenset("p li td th tr dd dt option".split())  # their end tags don't reach beyond the next SCOPE
KEEPS_P = frozenset("button label option select".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",),
    "tbody": ("td", "th", "tr", "tbody", "thead", "tfoot"), "tfoot": ("td", "th", "tr", "tbody", "thead", "tfoot"),
}
SCOPE = frozenset("table ul ol dl select body html div article section form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|data-y)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
GROUPS = {**dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 1), **dict.fromkeys("p pre blockquote".split(), 2), **dict.fromkeys("li ul ol dl dt dd table tbody tr td th".split(), 3), **dict.fromkeys("figure figcaption".split(), 4)}
N_GROUPS = 5
ASIDE = frozenset("nav aside form footer".split())  # elements that tell of all they hold, however deep
WRAPPED = frozenset("article main h1".split())  # no form of an article holds these
PAGES, EPOCHS = 800, 12


class Page:
    """Block elements in page order: parents, tags, attributes, text and link lengths, labels; and the blocks of text."""

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.attributes: list[str] = [""]
        self.label: list[int] = [0]
        self.size: list[int] = [0]
        self.linked: list[int] = [0]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, pieces = [0], []
        depths: dict[str, list[int]] = defaultdict(list)  # where on the stack each tag is open, so that no tag searches it
        scopes = [0]
        link = -1
        lower = None

        def flush() -> None:
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    self.blocks.append((stack[-1], text))
                    self.size[stack[-1]] += len(text)

        def pop_to(depth: int) -> None:
            flush()
            while len(stack) > depth:
                if self.tag[stack.pop()] in SCOPE:
                    scopes.pop()
            for opened in depths.values():
                while opened and opened[-1] >= depth:
                    opened.pop()

        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            end = m.start() if m else n
            if end > at:
                said = source[at:end]
                pieces.append(said)
                if link >= 0:
                    self.linked[stack[-1]] += len(said)
            if not m:
                break
            at = m.end()
            if m[1]:
                tag = m[1].lower()
                if tag == "a":
                    link = -1
                elif tag in BLOCK:
                    depth = depths[tag][-1] if depths[tag] else 0
                    if depth and (tag not in SCOPED or depth > scopes[-1]):
                        if link >= depth:
                            link = -1
                        pop_to(depth)
                    else:
                        flush()
            elif m[2]:
                tag = m[2].lower()
                if tag in RAW:
                    if not m[3].endswith("/>"):
                        if tag == "head":
                            continue
                        lower = source.lower() if lower is None else lower
                        if len(lower) != n:  # lower-casing changed lengths
                            lower = "".join(c.lower() if c < "\x80" else c for c in source)
                        close = lower.find(f"</{tag}", at)
                        stop = source.find(">", close) if close >= 0 else -1
                        at = stop + 1 if stop >= 0 else n
                elif tag == "a":
                    link = len(stack) - 1
                elif tag == "br" or tag == "wbr":
                    pieces.append(" " if tag == "br" else "")
                elif tag == "hr":
                    flush()
                elif tag in BLOCK:
                    flush()
                    if tag not in KEEPS_P and len(stack) > 1 and self.tag[stack[-1]] == "p":
                        link = -1
                        pop_to(len(stack) - 1)
                    elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.tag[stack[-1]] in ("h1", "h2", "h3", "h4", "h5", "h6"):
                        pop_to(len(stack) - 1)
                    if tag in CLOSES:
                        above = [opened[i] for t in CLOSES[tag] if (i := bisect_right(opened := depths[t], scopes[-1])) < len(opened)]
                        if above:
                            pop_to(min(above))
                    found = dict((k.lower(), v.strip("\"'")) for k, v in _ATTRIBUTE.findall(m[3]))
                    self.parent.append(stack[-1])
                    self.tag.append(tag)
                    self.attributes.append(" ".join(found.get(k, "") for k in ("class", "id", "role")).strip())
                    self.label.append(int(found.get("data-y") == "1"))
                    self.size.append(0)
                    self.linked.append(0)
                    stack.append(len(self.tag) - 1)
                    depths[tag].append(len(stack) - 1)
                    if tag in SCOPE:
                        scopes.append(len(stack) - 1)
        flush()


def features(page: Page) -> list[list[str]]:
    out = []
    n_links = page.linked
    words = [["w:" + w.lower() for w in _WORD.findall(a)] + ["name:" + w for w in a.lower().split()] if a else [] for a in page.attributes]
    inside: list[frozenset[str]] = []
    tags = ["body", *page.tag[1:]]  # text outside of all elements is the body's own
    wraps = [tag in WRAPPED for tag in tags]
    for i in range(len(tags) - 1, 0, -1):
        if wraps[i]:
            wraps[page.parent[i]] = True
            if tags[i] == "form":  # it holds the page's article: a wrapper, no form
                tags[i] = "div"
    for i, tag in enumerate(tags):
        size = page.size[i]
        mine = ["bias", "tag:" + tag]
        mine += words[i]
        held = inside[page.parent[i]] if i else frozenset()
        inside.append(held | {tag} if tag in ASIDE else held)
        mine += ["in:" + t for t in sorted(held)]
        up = page.parent[i]
        for _ in range(2):  # the words of parent and grandparent
            if up > 0:
                mine += ["above:" + w for w in words[up]]
                mine.append("under:" + tags[up])
                up = page.parent[up]
        if size:
            mine.append(f"size:{min(8, int(math.log2(size)))}")
            mine.append("linked" if n_links[i] * 2 > size else "plain")
            mine.append(f"{tag}:{'linked' if n_links[i] * 2 > size else 'plain'}")
        out.append(mine)
    return out


class Model:
    """Weights of the features (known by name) and an edge's log-potentials by the child's group, [parent][child] flattened."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.edges = [[0.0] * 4 for _ in range(N_GROUPS)]

    def marginals(self, page: Page, found: list[list[str]]) -> tuple[list[float], list[float], list[float]]:
        """Each element's probability to be content, and for training its upward log-odds and its parent's without it."""
        n, w, parent = len(page.tag), self.weights, page.parent
        up = [sum(w.get(f, 0.0) for f in mine) for mine in found]
        message = [0.0] * n
        for i in range(n - 1, 0, -1):
            e = self.edges[GROUPS.get(page.tag[i], 0)]
            message[i] = _soft(e[2], e[3] + up[i]) - _soft(e[0], e[1] + up[i])
            up[parent[i]] += message[i]
        total, without = up[:], [0.0] * n
        for i in range(1, n):
            e = self.edges[GROUPS.get(page.tag[i], 0)]
            without[i] = total[parent[i]] - message[i]
            total[i] = up[i] + _soft(e[1], e[3] + without[i]) - _soft(e[0], e[2] + without[i])
        return [_sigmoid(x) for x in total], up, without

    def text(self, source: str) -> str:
        page = Page(source)
        p, _, _ = self.marginals(page, features(page))
        return "\n".join(text for i, text in page.blocks if p[i] >= 0.5)


def _soft(a: float, b: float) -> float:
    top = a if a > b else b
    return top + math.log1p(math.exp(-abs(a - b)))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def train(sources: Iterable[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> Model:
    """Stochastic gradient ascent (AdaGrad) on the log-likelihood of the labels in data-y."""
    model = Model()
    pages = [(p, features(p)) for p in map(Page, sources)]
    seen_w: dict[str, float] = {}
    seen_e = [[1e-6] * 4 for _ in range(N_GROUPS)]
    order = list(range(len(pages)))
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            page, found = pages[k]
            p, up, without = model.marginals(page, found)
            grad: dict[str, float] = {}
            edge = [[0.0] * 4 for _ in range(N_GROUPS)]
            for i, mine in enumerate(found):
                d = page.label[i] - p[i]
                for f in mine:
                    grad[f] = grad.get(f, 0.0) + d
                if i:
                    g = GROUPS.get(page.tag[i], 0)
                    e = model.edges[g]
                    joint = [e[0], e[1] + up[i], e[2] + without[i], e[3] + without[i] + up[i]]
                    top = max(joint)
                    joint = [math.exp(x - top) for x in joint]
                    z = sum(joint)
                    for s in range(4):
                        edge[g][s] -= joint[s] / z
                    edge[g][2 * page.label[page.parent[i]] + page.label[i]] += 1
            for f, d in grad.items():
                d -= decay * model.weights.get(f, 0.0)
                seen_w[f] = seen_w.get(f, 1e-6) + d * d
                model.weights[f] = model.weights.get(f, 0.0) + rate * d / math.sqrt(seen_w[f])
            for g in range(N_GROUPS):
                for s in range(4):
                    d = edge[g][s] - decay * model.edges[g][s]
                    seen_e[g][s] += d * d
                    model.edges[g][s] += rate * d / math.sqrt(seen_e[g][s])
    return model


@functools.cache
def default_model(pages: int = PAGES) -> Model:
    """Trained on so many generated pages, the same each time and kept for later calls."""
    return train(labelled_page(i) for i in range(pages))


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """pages with text, the main text of html, and n_chars."""
    model = model or default_model()
    pages = pages.drop("text", "n_chars")
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("html"))
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [model.text(s or "") for s in column.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*part.schema.names, "text", "n_chars"])

    return pages.mapInArrow(run, schema)
