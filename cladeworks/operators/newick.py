"""Newick strings: parsing with an explicit stack, leaf sets, rooting, neighbour joining. Pure Python, one tree at a time."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np

from . import joining as J

_TOKEN = re.compile(r"\s*('(?:[^']|'')*'|[(),:;]|[^(),:;\s']+)")


class NewickError(ValueError):
    """The string is no tree."""


class Tree:
    def __init__(self):
        self.parent: list[int] = []
        self.children: list[list[int]] = []
        self.label: list[str | None] = []
        self.length: list[float | None] = []

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.children.append([])
        self.label.append(None)
        self.length.append(None)
        if parent >= 0:
            self.children[parent].append(len(self.parent) - 1)
        return len(self.parent) - 1


def parse(text: str | None) -> Tree:
    """The first tree of a string. Quoted labels are kept, bracketed notes are dropped."""
    if not text or not text.strip():
        raise NewickError("empty")
    text = re.sub(r"\[[^\]]*\]", "", text)
    tree = Tree()
    at, node, state, done = 0, tree.add(-1), "start", False
    while at < len(text) and not done:
        m = _TOKEN.match(text, at)
        if not m:
            if text[at:].strip():
                raise NewickError(f"unreadable at {at}")
            break
        t, at = m[1], m.end()
        if t == "(":
            if state not in ("start",):
                raise NewickError("'(' after a node")
            node = tree.add(node)
        elif t == ",":
            if tree.parent[node] < 0:
                raise NewickError("',' outside brackets")
            node, state = tree.add(tree.parent[node]), "start"
        elif t == ")":
            if tree.parent[node] < 0:
                raise NewickError("too many ')'")
            node, state = tree.parent[node], "closed"
        elif t == ":":
            m = _TOKEN.match(text, at)
            try:
                tree.length[node] = float(m[1])
            except (TypeError, ValueError, AttributeError):
                raise NewickError("bad length") from None
            at, state = m.end(), "measured"
        elif t == ";":
            done = True
        else:
            if state in ("named", "measured"):
                raise NewickError("two labels")
            tree.label[node] = t[1:-1].replace("''", "'") if t[0] == "'" else t
            state = "named"
    if tree.parent[node] >= 0:
        raise NewickError("unbalanced")
    if any(not c and not tree.label[i] for i, c in enumerate(tree.children)):
        raise NewickError("a tip without a name")
    return tree


def rows(tree: Tree) -> list[tuple]:
    """NODES of a tree in preorder: a subtree is the run of nodes from its root to `last`."""
    depth: list[int] = []
    out = []
    last = list(range(len(tree.parent)))
    for i in range(len(tree.parent) - 1, 0, -1):  # children come after their parents
        last[tree.parent[i]] = max(last[tree.parent[i]], last[i])
    for i, p in enumerate(tree.parent):
        depth.append(0 if p < 0 else depth[p] + 1)
        out.append((i, None if p < 0 else p, tree.label[i], tree.length[i], not tree.children[i], depth[i], last[i]))
    return out


def leaf_sets(tree: Tree) -> dict[int, set[str]]:
    out: dict[int, set[str]] = {i: set() if c else {tree.label[i]} for i, c in enumerate(tree.children)}
    for i in range(len(tree.parent) - 1, 0, -1):  # children come after their parents
        out[tree.parent[i]] |= out[i]
    return out


def split_many(text: str) -> list[str]:
    """The trees of a text, cut at semicolons outside quotes and brackets; a missing last semicolon is added."""
    out, piece, quoted, depth = [], [], False, 0
    for c in text:
        piece.append(c)
        if c == "'":
            quoted = not quoted
        elif not quoted:
            depth += (c in "([") - (c in ")]")
            if c == ";" and depth <= 0:
                out.append("".join(piece).strip())
                piece, depth = [], 0
    rest = "".join(piece).strip()
    if rest:
        out.append(rest + ";")
    return out


def _name(label: str) -> str:
    return "'" + label.replace("'", "''") + "'" if re.search(r"[\s(),:;'\[\]]", label) else label


def _graph(tree: Tree) -> list[dict[int, float]]:
    near: list[dict[int, float]] = [{} for _ in tree.parent]
    for i, p in enumerate(tree.parent):
        if p >= 0:
            near[i][p] = near[p][i] = max(tree.length[i] or 0.0, 0.0)
    if len(near[0]) == 2:  # a root of two edges is no node of the unrooted tree
        a, b = near[0]
        near[a][b] = near[b][a] = near[a].pop(0) + near[b].pop(0)
        near[0] = {}
    return near


def _write(tree: Tree, near: list[dict[int, float]], u: int, v: int, at: float) -> str:
    """Newick of the tree rooted on edge u-v, `at` from u."""

    out: list[str] = []
    stack: list = [");", (v, u, near[u][v] - at), ",", (u, v, at), "("]  # what is still to be written, the next last
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        node, up, length = x
        below = [y for y in near[node] if y != up]
        if below:
            out.append("(")
            stack.append(f"):{length:g}")
            for k in range(len(below) - 1, -1, -1):
                stack += [(below[k], node, near[node][below[k]]), *[","][: k > 0]]
        else:
            out.append(f"{_name(tree.label[node]) if tree.label[node] else ''}:{length:g}")
    return "".join(out)


def _reach(near: list[dict[int, float]], start: int) -> np.ndarray:
    """The distance of each node from one, nan where no path leads."""
    out = [math.nan] * len(near)
    stack = [(start, -1, 0.0)]
    while stack:
        x, up, d = stack.pop()
        out[x] = d
        stack += [(y, x, d + w) for y, w in near[x].items() if y != up]
    return np.array(out)


def _ends(near: list[dict[int, float]], tips: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Distances of all nodes from the two tips that are farthest apart, the first such two in order, and how far that is.

    Five walks and no matrix: the tip farthest from any is an end of a longest path, and no tip is farther from another
    than that one is from one of the path's two ends. Ends that differ by rounding alone count as equal.
    """
    at = np.array(tips)
    one = _reach(near, tips[int(np.argmax(_reach(near, tips[0])[at]))])
    far = np.maximum(one, _reach(near, tips[int(np.argmax(one[at]))]))[at]
    i = int(np.argmax(far >= far.max() * (1 - 1e-12)))
    first = _reach(near, tips[i])
    j = int(np.argmax(first[at]))
    second = _reach(near, tips[j])
    there, back = float(second[at[i]]), float(first[at[j]])  # sums in two orders
    return (second, first, back) if back > there else (first, second, there)


def _distances(near: list[dict[int, float]], tips: list[int]) -> np.ndarray:
    """The distance from each node to each tip."""
    return np.stack([_reach(near, t) for t in tips], axis=1)


def mad_root(text: str, max_tips: int = 600) -> tuple[str | None, str, float | None]:
    """(newick, method, score): the root on the edge where ancestors' relative deviations are least in the squares."""
    try:
        tree = parse(text)
    except NewickError:
        return None, "malformed", None
    near = _graph(tree)
    tips = [i for i, c in enumerate(tree.children) if not c]
    n = len(tips)
    if n < 3:
        return text, "unchanged", None
    edges = [(u, v) for u in range(len(near)) for v in near[u] if u < v]
    if n > max_tips or not any(w > 0 for x in near for w in x.values()):
        di, dj, far = _ends(near, tips)
        half = far / 2
        for u, v in edges:
            for a, b in ((u, v), (v, u)):
                if abs(di[a] + near[a][b] + dj[b] - far) < 1e-9 and di[a] <= half <= di[a] + near[a][b] + 1e-12:
                    return _write(tree, near, a, b, half - di[a]), "midpoint", None
        u, v = edges[0]
        return _write(tree, near, u, v, near[u][v] / 2), "midpoint", None
    d = _distances(near, tips)  # of max_tips tips at most
    pair = d[tips]
    with np.errstate(divide="ignore", invalid="ignore"):
        inverse = np.where(pair > 0, 1 / pair**2, 0.0)
    best = (np.inf, None)
    upper = np.triu(np.ones((n, n), bool), 1)
    for u, v in edges:
        w = near[u][v]
        here = d[u] < d[v]  # tips on u's side
        if not here.any() or here.all():
            here = np.array([_side(near, u, v, t) for t in tips])
        across = np.outer(here, ~here)
        weight = across * inverse
        total = weight.sum()
        # on the edge at x from u: deviation of (b, c) is (2 (d_ub + x) / d_bc - 1) squared
        x = ((pair - 2 * d[u][:, None]) * weight).sum() / (2 * total) if total > 0 else w / 2
        x = min(max(x, 0.0), w)
        cross = (across * np.where(pair > 0, (2 * (d[u][:, None] + x) / np.where(pair > 0, pair, 1) - 1) ** 2, 0.0)).sum()
        same = 0.0
        for side, node in ((here, u), (~here, v)):
            k = np.flatnonzero(side)
            if len(k) > 1:
                sub = pair[np.ix_(k, k)]
                # their ancestor under this root lies where the paths to the node part
                rise = (d[node][k][:, None] + sub - d[node][k][None, :]) / 2
                dev = np.where(sub > 0, (2 * rise / np.where(sub > 0, sub, 1) - 1) ** 2, 0.0)
                same += (dev * upper[: len(k), : len(k)]).sum()
        score = float(np.sqrt((cross + same) / upper.sum()))
        if score < best[0] - 1e-12:
            best = (score, (u, v, x))
    u, v, x = best[1]
    return _write(tree, near, u, v, x), "mad", best[0]


def _side(near, u: int, v: int, tip: int) -> bool:
    """Is the tip on u's side of edge u-v."""
    stack = [(u, v)]
    while stack:
        x, up = stack.pop()
        if x == tip:
            return True
        stack += [(y, x) for y in near[x] if y != up]
    return False


def neighbour_joining(names: list[str], seqs: list[str]) -> str:
    """Newick by neighbour joining on the share of differing, ungapped columns. Shorter sequences end in gaps."""
    return joined(names, *J.joins(J.distances(seqs), J.kinds(seqs)))


def joined(names: list[str], joins: Iterable[tuple[int, int, float, float]], left: list[int], d: np.ndarray) -> str:
    """Newick of joins in order: pieces are linked and written once, so a ladder costs no more than its length."""
    label: list = [_name(x) for x in names]
    for a, b, la, lb in joins:
        label[a] = ("(", label[a], f":{la:.6g},", label[b], f":{lb:.6g})")
    lengths = (d[0, 1] + d[0, 2] - d[1, 2]) / 2, (d[0, 1] + d[1, 2] - d[0, 2]) / 2, (d[0, 2] + d[1, 2] - d[0, 1]) / 2
    out: list[str] = []
    stack: list = [f":{max(lengths[2], 0):.6g});", label[left[2]], f":{max(lengths[1], 0):.6g},", label[left[1]], f":{max(lengths[0], 0):.6g},", label[left[0]], "("]
    while stack:
        piece = stack.pop()
        if isinstance(piece, str):
            out.append(piece)
        else:
            stack += piece[::-1]
    return "".join(out)
