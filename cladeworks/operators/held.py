"""Neighbour joining where only some rows of the distances are at hand: the joins that these rows decide, and the rows that decide the next ones.

What is known of every node fits arrays of one entry a node: its place (the sequence's number; a joined node takes the first
one's), kind (equal: copies), stored (the round that its row was stored in; 0: a sequence), born (the join that made it), sums,
and of its row the NEAR columns of least d - u (cols, near) when it was last looked at (when), a bound of its other columns
(rest) and of those born since (fresh). A column's d - u falls by no more than u has risen anywhere, so from these follows, for
every row, what its least Q is not below.
"""

from __future__ import annotations

import io

import numpy as np

from .joining import _FAR, _STRIP, _TIE, _first, _sums, _two_a_kind

NEAR = 16
_GONE = np.iinfo(np.int32).max


def nearest(rows: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the columns of least d - u, their distances, and the least d - u of the others."""
    k = min(NEAR, rows.shape[1])
    cols, near, rest = np.full((len(rows), NEAR), -1, np.int32), np.full((len(rows), NEAR), _FAR), np.full(len(rows), _FAR)
    for at in range(0, len(rows), _STRIP):
        some = slice(at, at + _STRIP)
        q = rows[some] - u
        if k < rows.shape[1]:
            by = np.argpartition(q, k, axis=1)
            rest[some] = np.take_along_axis(q, by[:, k : k + 1], axis=1)[:, 0]
        else:
            by = np.broadcast_to(np.arange(k), (len(q), k))
        cols[some, :k] = by[:, :k]
        near[some, :k] = np.take_along_axis(rows[some], by[:, :k], axis=1)
    return cols, near, rest


def begin(sums: np.ndarray, kind: np.ndarray, cols: np.ndarray, near: np.ndarray, rest: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of sequences, by place."""
    n = len(sums)
    zero = np.zeros(n, np.int32)
    return {"place": np.arange(n, dtype=np.int32), "kind": kind.astype(np.int64), "stored": zero, "born": zero, "when": zero, "sums": sums, "cols": cols, "near": near, "rest": rest, "fresh": np.full(n, _FAR), "needed": np.zeros(0, np.int32)}


def packed(nodes: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **nodes)
    return out.getvalue()


def unpacked(body: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(body)))


def _least(nodes: dict[str, np.ndarray], u: np.ndarray, some: slice | np.ndarray = slice(None), rise: float = 0.0) -> np.ndarray:
    """What d - u is not below in some rows."""
    cols = nodes["cols"][some]
    valid = (cols >= 0) & (nodes["born"][cols] <= nodes["when"][some][:, None])
    q = np.where(valid, nodes["near"][some] - u[cols], _FAR).min(axis=1)
    return np.minimum(q, np.minimum(nodes["rest"][some], nodes["fresh"][some]) - rise)


def wanted(nodes: dict[str, np.ndarray], cells: int) -> np.ndarray:
    """Positions of the nodes whose rows the next joins are decided by: all where they have no more than so many cells, else those whose Q may be least, two of a kind."""
    m = len(nodes["place"])
    if m * m <= cells or m <= 4:
        return np.arange(m)
    u = nodes["sums"] / (m - 2)
    bound = _least(nodes, u) - u
    bound[nodes["needed"]] = -_FAR
    order = np.argsort(bound, kind="stable")
    kind = nodes["kind"][order]
    first = np.unique(kind, return_index=True)[1]
    rest = np.delete(np.arange(m), first)
    both = np.sort(np.concatenate([first, rest[np.unique(kind[rest], return_index=True)[1]]]))
    return np.sort(order[both[: max(cells // m, len(nodes["needed"]), 4)]])


def some_joins(nodes: dict[str, np.ndarray], held: np.ndarray, d: np.ndarray, stored: int) -> tuple[list[tuple[int, int, float, float]], dict[str, np.ndarray], list[tuple[int, np.ndarray]]]:
    """The next joins (as `joining.joins` has them), by rows held of all nodes: up to the first that another row may decide. Then the nodes left, and the new ones' places and rows.

    d is overwritten; a joined node's row takes the first one's slot. A call that makes no join, as too many rows are equal or little
    was known of them, tells more of the rows it held and names those `needed`, which `wanted` puts first.
    """
    total = m = len(nodes["place"])
    nodes = {k: v.copy() for k, v in nodes.items()}
    kind, sums, born = nodes["kind"], nodes["sums"], nodes["born"]
    now, unused = int(born.max()), int(kind.max()) + 1
    slot = np.full(total, -1)
    slot[held] = np.arange(len(held))
    of, free = held.copy(), []  # whose row a slot holds
    sums[held] = _sums(d, slot, held, None)
    d[np.arange(len(held)), held] = _FAR
    u = sums / (m - 2)
    nodes["cols"][held], nodes["near"][held], nodes["rest"][held] = nearest(d, u)
    nodes["when"][held], nodes["fresh"][held] = now, _FAR
    alive, out, needed, rise = np.ones(total, bool), [], np.zeros(0, np.int64), 0.0
    least = _least(nodes, u)

    def look(i: int) -> None:
        same = np.flatnonzero((kind == kind[i]) & alive)
        here = slot[same][slot[same] >= 0]  # of copies one row tells for all
        least[same] = (float((d[here[0]] - u).min()) if len(here) else _least(nodes, u, np.array([i]), rise)[0]) + rise
        bound[same] = least[i] - rise - u[i]
        seen[same] = True

    def copied(i: int) -> bool:
        """Copies have equal rows, so that of a held one serves."""
        like = np.flatnonzero((kind == kind[i]) & alive & (slot >= 0))
        if not len(like) or not free:
            return False
        slot[i], p = free.pop(), like[0]
        d[slot[i]] = d[slot[p]]
        d[slot[i], p], d[slot[i], i] = d[slot[p], i], _FAR
        of[slot[i]] = i
        return True

    while m > 3:
        bound = np.where(alive, least - rise - u, _FAR)
        seen = np.zeros(total, bool)
        while not seen[i := int(np.argmin(bound))]:
            look(i)
        limit = bound[i] + _TIE / (m - 2)
        for i in np.flatnonzero((bound <= limit) & (slot < 0)):
            if not seen[i]:
                look(i)
        rows = _two_a_kind(np.flatnonzero(bound <= limit), kind)
        needed = np.array([i for i in rows if slot[i] < 0 and not copied(i)], np.int64)
        if len(needed):
            needed = rows
            break
        left = None if m == total else np.flatnonzero(alive)
        a, b, fresh = _first(d, slot, u, rows, limit, left, m)
        ab = d[slot[a], b]
        la = max(ab / 2 + (fresh[a] - fresh[b]) / (2 * (m - 2)), 0.0)
        out.append((int(nodes["place"][a]), int(nodes["place"][b]), la, max(ab - la, 0.0)))
        one, two = d[slot[a]], d[slot[b]]
        new = (one + two - ab) / 2
        new[~alive] = new[a] = new[b] = _FAR
        alive[b] = False
        if kind[a] != kind[b]:
            kind[a], unused = unused, unused + 1
        sums += new - one - two
        sums[~alive] = 0.0
        now += 1
        born[a], born[b], nodes["stored"][a] = now, _GONE, stored
        d[:, a] = new[of]
        d[slot[a]] = new
        d[:, b] = _FAR
        free.append(slot[b])
        slot[b] = -1
        m -= 1
        if m == 3:
            break
        sums[a] = _sums(d, slot, np.array([a]), np.flatnonzero(alive))[0]
        before, u = u, sums / (m - 2)
        risen = u - before
        risen[a] = -_FAR  # the new column is compared below
        rise += risen[alive].max()
        by = new - u[a] + rise
        np.minimum(nodes["fresh"], by, out=nodes["fresh"])
        np.minimum(least, by, out=least)
        cols, near, rest = nearest(new[None], u)
        nodes["cols"][a], nodes["near"][a], nodes["rest"][a] = cols[0], near[0], rest[0] + rise
        nodes["when"][a], nodes["fresh"][a] = now, _FAR
        least[a] = (new - u).min() + rise
    keep = np.flatnonzero(alive)
    at = np.full(total + 1, -1, np.int32)  # of column -1 too
    at[keep] = np.arange(len(keep))
    nodes["rest"] -= rise
    made = np.flatnonzero(alive & (nodes["stored"] == stored))
    if out and m > 3:
        _remember(nodes, u, keep, made, d[slot[made]], now)
    new = [(int(nodes["place"][i]), d[slot[i]][keep]) for i in made]
    rest = {k: v[keep] for k, v in nodes.items() if k != "needed"}
    rest["cols"] = at[rest["cols"]]
    return out, rest | {"needed": at[needed]}, new


def _remember(nodes: dict[str, np.ndarray], u: np.ndarray, rows: np.ndarray, made: np.ndarray, d: np.ndarray, now: int) -> None:
    """The nearest columns of all rows among those they have and the new ones, which then are no more among the rest."""
    for at in range(0, len(rows), 4096):
        some = rows[at : at + 4096]
        cols = nodes["cols"][some]
        valid = (cols >= 0) & (nodes["born"][cols] <= nodes["when"][some][:, None])
        cols = np.concatenate([np.where(valid, cols, -1), np.broadcast_to(made.astype(np.int32), (len(some), len(made)))], axis=1)
        near = np.concatenate([np.where(valid, nodes["near"][some], _FAR), d[:, some].T], axis=1)
        near[:, : valid.shape[1]][np.isin(cols[:, : valid.shape[1]], made)] = _FAR
        q = near - u[cols]
        by = np.argpartition(q, NEAR, axis=1)
        nodes["rest"][some] = np.minimum(nodes["rest"][some], np.take_along_axis(q, by[:, NEAR : NEAR + 1], axis=1)[:, 0])
        cols, near = np.take_along_axis(cols, by[:, :NEAR], axis=1), np.take_along_axis(near, by[:, :NEAR], axis=1)
        nodes["cols"][some], nodes["near"][some] = np.where(near < _FAR / 2, cols, -1), near
    nodes["when"][rows], nodes["fresh"][rows] = now, _FAR
