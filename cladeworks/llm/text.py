"""Words, word hashes and n-gram hashes of whole texts, vectorised over Arrow buffers.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. All hashes are 64-bit, the same on every executor, and mix
what they read nonlinearly after every step, so that no constructed texts share them as they would a polynomial's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
CHUNK = 1 << 20  # bytes of text handled at a time; a longer document is a chunk of its own

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE.encode())] = True
SEPARATES = np.ones(256, bool)  # bytes outside letters, digits and what isn't ASCII
SEPARATES[[*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]] = False
_FIRST = [(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1]
_FIRST = np.array(_FIRST, np.uint64)  # masks of a lane's first k bytes
_SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0xA0761D6478BD642F))
_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LONG = 64  # bytes; longer words are hashed by BLAKE2b, one by one


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    if at is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about size bytes, at least a row each."""
    _, at = buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, end
        row = end


def words(raw: np.ndarray, at: np.ndarray, space: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each document (n + 1 entries)."""
    if len(raw) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~(_IS_SPACE[raw] if space is None else space)
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at, "left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, mixed after every eight bytes; `second`: another, independent one."""
    k = int(second)
    size = ends - starts
    out = np.full(len(starts), _SEEDS[k], np.uint64) + size.astype(np.uint64) * _STEP[k]
    if not len(starts):
        return out
    a = int(starts[0])
    padded = np.concatenate([raw[a : int(ends[-1])], np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place
    short = size <= LONG
    left, at = (np.arange(len(starts)) if short.all() else np.flatnonzero(short)), 0
    while len(left):
        rest = size[left] - at
        lane = lanes[starts[left] - a + at] & _FIRST[np.minimum(rest, 8)]
        out[left] = mixed((out[left] ^ lane) * _STEP[k])
        left, at = left[rest > 8], at + 8
    for i in np.flatnonzero(~short):
        both = hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
        out[i] = int.from_bytes(both[8 * k : 8 * k + 8], "little")
    return out


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive entries, runs across documents included; len(h) - n + 1 entries.

    Neighbouring runs are joined in twos, fours and so on, and mixed at every join, so that no algebra of the entries survives.
    """
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out, done, run, size = None, 0, h, 1
    while True:
        if n & size:
            part = run[done : done + m]
            out = part if out is None else mixed(out * _STEP[1] + part)
            done += size
        size *= 2
        if size > n:
            return mixed(out + np.uint64(n))
        run = mixed(run[: -(size // 2)] * _STEP[0] + run[size // 2 :])


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the runs of n words, by first word, lie inside one document."""
    m = max(total - n + 1, 0)
    ok = np.ones(m, bool)
    for k in range(1, n):  # a document that begins at word f breaks the runs from f - n + 1 to f - 1
        spot = first - k
        ok[spot[(spot >= 0) & (spot < m) & (first < total) & (first > 0)]] = False
    return ok


def digest(text: Column | str) -> Column:
    """SHA-256 of a text's bytes in hex; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def halves(hexes: Column) -> list[Column]:
    """The first 128 bits of a hex digest as two bigints."""
    return [F.conv(F.substring(hexes, at, 16), 16, -10).cast("long") for at in (1, 17)]


def two_hashes(text: Column | str) -> list[Column]:
    """A text's content as two bigints: 128 bits of SHA-256, for which nobody can make two texts that agree."""
    return halves(digest(text))


def n_words(text: Column | str) -> Column:
    """Number of words, inside the JVM."""
    inner = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE_CLASS + "+"))).cast("long")


def fresh(columns: list[str]) -> str:
    """A prefix that no column has, for columns that an operator adds and drops again."""
    prefix = "_x"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "x"
    return prefix
