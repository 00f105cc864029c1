"""Neighbour joining on arrays: distances of sequences in blocks, and joins that look only at rows which may hold the least Q."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_GAPS = np.frombuffer(b"-.~", np.uint8)
_STRIP = 64  # rows that are handled at once
_TOGETHER = 256  # sequences that are compared with another at once
_FAR = 1e9  # of a joined column, and of a row with itself
_TIE = 1e-6  # values of Q that are nearer than this are summed anew, as rounding may part them


def _wide(seqs: list[str]) -> bool:
    """Is there anything but capital letters, which five bits tell apart from each other and from nothing."""
    return not all(s.isascii() and s.isalpha() and s.isupper() or not s for s in seqs)


def _code(seq: str, wide: bool) -> np.ndarray:
    """A sequence as bits, 64 columns a word: five planes of letters, or eight of bytes and one that is set where there is no gap."""
    raw = np.frombuffer(seq.encode(), np.uint8)
    bits = np.zeros((9 if wide else 5, -(-len(raw) // 64) * 64), np.uint8)
    for k in range(8 if wide else 5):
        bits[k, : len(raw)] = raw >> k & 1
    if wide:
        bits[8, : len(raw)] = ~np.isin(raw, _GAPS)
    return np.packbits(bits, axis=1).view(np.uint64)


def _together(codes: list[np.ndarray], size: np.ndarray, wide: bool) -> Callable[[np.ndarray, int], np.ndarray]:
    """The distances of some sequences to another, all at once."""
    left = np.zeros((len(codes[0]), max(c.shape[1] for c in codes), len(codes)), np.uint64)
    for k, code in enumerate(codes):
        left[:, : code.shape[1], k] = code
    buffers = np.empty((2, *left.shape[1:]), np.uint64)

    def to(code: np.ndarray, length: int) -> np.ndarray:
        w = min(left.shape[1], code.shape[1])
        differ, other = buffers[:, :w]
        np.bitwise_xor(left[0, :w], code[0, :w, None], out=differ)
        for k in range(1, 8 if wide else 5):
            np.bitwise_xor(left[k, :w], code[k, :w, None], out=other)
            np.bitwise_or(differ, other, out=differ)
        if wide:
            np.bitwise_and(left[8, :w], code[8, :w, None], out=other)
            np.bitwise_and(differ, other, out=differ)
            both = np.bitwise_count(other).sum(axis=0, dtype=np.int64)
            beyond = 0
        else:  # where one has ended it differs from the other
            both = np.minimum(size, length)
            beyond = np.minimum(np.maximum(size, length), 64 * w) - both
        return (np.bitwise_count(differ).sum(axis=0, dtype=np.int64) - beyond) / np.maximum(both, 1)

    return to


def distances(seqs: list[str]) -> np.ndarray:
    """The share of differing columns among those without a gap in either, for all pairs. Shorter sequences end in gaps."""
    n, wide = len(seqs), _wide(seqs)
    size = np.array([len(s.encode()) for s in seqs])
    order = np.argsort(size, kind="stable")  # those compared at once are about as long
    codes = [_code(s, wide) for s in seqs]
    d = np.zeros((n, n))
    for at in range(0, n, _TOGETHER):
        some = order[at : at + _TOGETHER]
        to = _together([codes[i] for i in some], size[some], wide)
        for j in order[at:]:
            d[j, some] = d[some, j] = to(codes[j], size[j])
    np.fill_diagonal(d, 0)
    return d


def across(right: list[str]) -> Callable[[list[str]], np.ndarray]:
    """The same distances, of each sequence given later to each of these."""
    other, codes = [len(s.encode()) for s in right], {}

    def of(left: list[str]) -> np.ndarray:
        if True not in codes and (wide := _wide(left) or _wide(right)) not in codes:
            codes.clear()
            codes[wide] = [_code(s, wide) for s in right]
        [(wide, of_right)] = codes.items()
        size = np.array([len(s.encode()) for s in left])
        order = np.argsort(size, kind="stable")
        d = np.zeros((len(left), len(right)))
        for at in range(0, len(left), _TOGETHER):
            some = order[at : at + _TOGETHER]
            to = _together([_code(left[i], wide) for i in some], size[some], wide)
            for j, code in enumerate(of_right):
                d[some, j] = to(code, other[j])
        return d

    return of


def kinds(seqs: list[str]) -> np.ndarray:
    """Equal numbers for equal sequences."""
    first: dict[str, int] = {}
    return np.array([first.setdefault(s, len(first)) for s in seqs])


def joins(d: np.ndarray, kind: np.ndarray) -> tuple[list[tuple[int, int, float, float]], list[int], np.ndarray]:
    """The joins (a, b, length of a, length of b) in order, the new node takes a's place; the three places left and their distances. d is overwritten.

    A row's least d - u (u: its sum over the others by their number less two) is kept from when the row was last looked at. It
    can have fallen since by no more than u has risen anywhere, summed over the joins, so rows are looked at by these bounds
    until none is below the least value found: the same joins as by all pairs, in steps of some rows each. Copies (of one kind)
    have equal rows and keep them when joined, so one is looked at for all, and of equal pairs only the first can be next.
    """
    n = m = len(d)
    slot = np.arange(n)
    kind, unused = kind.copy(), int(kind.max()) + 1
    place = np.arange(n)  # of columns in what was given: joined ones are taken out now and then
    out: list[tuple[int, int, float, float]] = []
    alive = np.ones(n, bool)
    sums = d.sum(axis=1)
    np.fill_diagonal(d, _FAR)
    least = None  # no row has been looked at
    while m > 3:
        if least is None or m < 0.8 * len(d):
            if not alive.all():
                keep = np.flatnonzero(alive)
                for to, i in enumerate(keep):  # in place: a row moves up, never down
                    d[to, : len(keep)] = d[i][keep]
                d, place, kind, alive = d[: len(keep), : len(keep)], place[keep], kind[keep], np.ones(len(keep), bool)
                sums = _sums(d, slot, np.arange(m), None)
            u = sums / (m - 2)
            least = np.array([(row - u).min() for row in d])
            rise = 0.0
        bound = np.where(alive, least - rise - u, _FAR)
        seen = np.zeros(len(d), bool)
        while not seen[i := int(np.argmin(bound))]:
            same = np.flatnonzero((kind == kind[i]) & alive)
            least[same] = (d[i] - u).min() + rise
            bound[same] = least[i] - rise - u[i]
            seen[same] = True
        limit = bound[i] + _TIE / (m - 2)
        left = None if m == len(d) else np.flatnonzero(alive)
        a, b, fresh = _first(d, slot, u, _two_a_kind(np.flatnonzero(bound <= limit), kind), limit, left, m)
        ab = d[a, b]
        la = max(ab / 2 + (fresh[a] - fresh[b]) / (2 * (m - 2)), 0.0)
        out.append((int(place[a]), int(place[b]), la, max(ab - la, 0.0)))
        new = (d[a] + d[b] - ab) / 2
        new[~alive] = new[a] = new[b] = _FAR
        alive[b] = False
        if kind[a] != kind[b]:
            kind[a], unused = unused, unused + 1
        sums += new - d[a] - d[b]
        sums[~alive] = 0.0
        d[a] = d[:, a] = new
        d[:, b] = _FAR
        m -= 1
        if m == 3:
            break
        sums[a] = _sums(d, slot, np.array([a]), np.flatnonzero(alive))[0]
        before, u = u, sums / (m - 2)
        risen = u - before
        risen[a] = -_FAR  # the new column is compared below
        rise += risen[alive].max()
        least = np.minimum(least, new - u[a] + rise)
        least[a] = (new - u).min() + rise
    left = np.flatnonzero(alive)
    return out, [int(i) for i in place[left]], d[np.ix_(left, left)]


def _two_a_kind(rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The first two rows of each kind."""
    if len(rows) <= 2:
        return rows
    first = np.unique(kind[rows], return_index=True)[1]
    rest = np.delete(rows, first)
    return np.sort(np.concatenate([rows[first], rest[np.unique(kind[rest], return_index=True)[1]]]))


def _first(d: np.ndarray, slot: np.ndarray, u: np.ndarray, rows: np.ndarray, limit: float, left: np.ndarray | None, m: int) -> tuple[int, int, dict[int, float]]:
    """The pair of least Q among these rows (slot: where in d a node's row is), of equal ones the first in order, and the sums of the rows it was told by."""
    xs, ys = [], []
    for at in range(0, len(rows), _STRIP):
        some = rows[at : at + _STRIP]
        i, j = np.nonzero(d[np.ix_(slot[some], rows)] - u[rows] <= limit + u[some][:, None])
        xs += [some[i], rows[j]]
        ys += [rows[j], some[i]]  # rounding may part the two orders of a pair
    x, y = np.concatenate(xs), np.concatenate(ys)
    ends, back = np.unique(x, return_inverse=True)
    fresh = dict(zip(ends.tolist(), _sums(d, slot, ends, left)))
    by = np.array([fresh[i] for i in ends.tolist()])
    q = (m - 2) * d[slot[x], y] - by[back] - by[np.searchsorted(ends, y)]
    least = np.flatnonzero(q == q.min())
    k = least[np.lexsort((y[least], x[least]))[0]]
    return min(int(x[k]), int(y[k])), max(int(x[k]), int(y[k])), fresh


def _sums(d: np.ndarray, slot: np.ndarray, rows: np.ndarray, left: np.ndarray | None) -> np.ndarray:
    """Rows' sums over the columns left, in their order."""
    out = []
    for at in range(0, len(rows), _STRIP):
        some = rows[at : at + _STRIP]
        part = d[slot[some]] if left is None else d[np.ix_(slot[some], left)]
        part[np.arange(len(some)), some if left is None else np.searchsorted(left, some)] = 0
        out.append(part.sum(axis=1))
    return np.concatenate(out)
