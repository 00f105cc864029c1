"""Word and gram hashes against constructed texts, and substring dedup over them."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from cladeworks.llm import substring
from cladeworks.llm import text as X


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


def hashes(*texts, second=False):
    raw, at = X.buffers(pa.array(texts))
    starts, ends, _ = X.words(raw, at)
    return X.word_hashes(raw, starts, ends, second)


@pytest.mark.parametrize("second", [False, True])
def test_words_differ(second):
    """Every polynomial modulo 2**64 with an odd base gives a Thue-Morse word of 2048 letters or more and its complement one value."""
    said = [thue_morse(n, x) for n in (8, 63, 64, 65, 1024, 2048, 4096) for x in ("ab", "ba")] + ["x" * n for n in range(1, 140)] + ["é" * n for n in range(1, 40)]
    assert len(set(hashes(" ".join(said), second=second).tolist())) == len(said)


def test_words_hash_alike_wherever_they_stand():
    r = random.Random(1)
    said = ["".join(r.choices("abcé漢", k=r.choice([1, 3, 7, 8, 9, 16, 40, 64, 65, 200]))) for _ in range(300)]
    one = hashes(" ".join(said))
    assert one.tolist() == [int(hashes("\n" + w + " tail")[0]) for w in said]
    assert not set(one.tolist()) & set(hashes(" ".join(said), second=True).tolist())


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13, 35])
def test_grams_are_of_their_words_in_order(n):
    r = random.Random(n)
    words = [r.choice("ab") for _ in range(4000)] + list(thue_morse(4096)) + list(thue_morse(4096, "ba"))
    g = X.gram_hashes(hashes(" ".join(words)), n)
    seen: dict = {}
    assert all(seen.setdefault(tuple(words[i : i + n]), x) == x for i, x in enumerate(g.tolist())) and len(set(seen.values())) == len(seen) and len(g) == len(words) - n + 1


def test_substring_keeps_what_only_a_polynomial_would_repeat(spark):
    lead = [f"u{i}" for i in range(34)]
    texts = [" ".join([*lead, thue_morse(4096, x)]) for x in ("ab", "ba")]  # the 35th words differ
    texts += [" ".join(thue_morse(2048, x)) for x in ("cd", "dc")]  # as many words of one letter, whose windows do repeat
    got = {r.doc_id: (r.n_removed, r.text) for r in substring.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == (0, texts[0]) and got[1] == (0, texts[1]) and got[2][0] == got[3][0] == 2048


def test_super_edges_are_exact_windows():
    """The anchor of a window is its leftmost least gram, whatever the place."""
    r = random.Random(3)
    h = np.array([r.randrange(5) for _ in range(600)], np.uint64)
    first = np.array([0, 200, 230, 600])
    grams = X.gram_hashes(h, 4)
    s0, s1, place, k = substring.super_edges(h, first, 12, 4)
    want = {}
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b - 11):
            want[i] = min(range(i, i + 9), key=lambda j: (grams[j], j))
    got = {i: (p, key) for x, y, p, key in zip(s0, s1, place, k) for i in range(x, y + 1)}
    assert {i: p for i, (p, _) in got.items()} == want and all(grams[p] == key for p, key in got.values())
