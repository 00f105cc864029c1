"""Toxicity counts, probabilities and joined counts against plain Kneser-Ney over dictionaries."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cladeworks.llm import toxicity
from cladeworks.llm.store import Workspace


def tox_docs():
    r = random.Random(9)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789éж漢", k=r.randint(1, 9))) for _ in range(3000)]
    rude = ["zwerkop", "vexxil", "qorbat", "жжук"]
    rows = [(i, " ".join(r.choices(words, k=40) + (r.choices(rude, k=4) if i % 5 == 0 else []))) for i in range(600)]
    return [*rows, (1000, None), (1001, ""), (1002, "Ünï 漢字")], [(i, int(i % 5 == 0)) for i in range(600)]


def symbols(word):
    return ["<"] * 4 + list(word.encode()) + [">"]


class Plain:
    """Counts by the definition: raw at the top and after a start mark, contexts before the gram elsewhere."""

    def __init__(self, docs, labels):
        raw = [defaultdict(int), defaultdict(int)]
        for (_, text), (_, label) in zip(docs, labels):
            for w in text.split():
                s = symbols(w)
                for end in range(4, len(s)):
                    raw[label][tuple(s[end - 4 : end + 1])] += 1
        self.five = raw
        self.four = [self.below(r, {g for g in r}) for r in raw]
        both = {g: self.four[0].get(g, 0) + self.four[1].get(g, 0) for g in {*self.four[0], *self.four[1]}}
        three = self.below(both, set(both))
        two = self.below(three, set(three))
        one = defaultdict(int)
        for g in two:
            one[g[1:]] += 1
        self.shared = [one, two, three]

    @staticmethod
    def below(counts, seen):
        out = defaultdict(int)
        for g in seen:
            out[g[1:]] += counts[g] if g[1] == "<" else 1
        return out

    def probability(self, c, g):
        p = 1 / toxicity.SYMBOLS
        for n, counts in enumerate([*self.shared, self.four[c], self.five[c]], 1):
            own = g[5 - n :]
            after = [v for k, v in counts.items() if k[:-1] == own[:-1]]
            if after:
                p = (max(counts.get(own, 0) - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(after) * p) / sum(after)
        return p

    def ratio(self, word):
        s = symbols(word)
        grams = [tuple(s[e - 4 : e + 1]) for e in range(4, len(s))]
        return sum(math.log(self.probability(1, g)) - math.log(self.probability(0, g)) for g in grams)


@pytest.fixture(scope="module")
def counted(spark):
    docs, labels = tox_docs()
    rows = [(t, label) for (_, t), (_, label) in zip(docs, labels)]
    table = toxicity.gram_counts(spark.createDataFrame(rows, "text string, label long").repartition(3), Workspace(spark, "test"))
    return table.cache(), Plain(docs, labels)


def code(s):
    return {"<": toxicity.START, ">": toxicity.END}[s] if isinstance(s, str) else int(toxicity._CODE[s])


def test_counts_are_exact(counted):
    table, plain = counted
    number = lambda g: sum(code(c) << 8 * (len(g) - 1 - i) for i, c in enumerate(g))
    want: dict = {}
    for n, both in ((5, plain.five), (4, plain.four)):
        for g in {*both[0], *both[1]}:
            want[n << 40 | number(g)] = (both[0].get(g, 0), both[1].get(g, 0), 0, 0)
        contexts = defaultdict(lambda: [0, 0, 0, 0])
        for c in (0, 1):
            for g, k in both[c].items():
                contexts[n + 8 << 40 | number(g[:-1])][c] += k
                contexts[n + 8 << 40 | number(g[:-1])][2 + c] += k > 0
        want |= {k: tuple(v) for k, v in contexts.items()}
    assert len(want) > 30_000 and {r.key: (r.a, r.b, r.ta, r.tb) for r in table.collect()} == want


def test_log_likelihoods_are_plain_kneser_ney(counted):
    table, plain = counted
    t = table.toArrow()
    model = toxicity.Model(np.asarray(t["key"]), [np.asarray(t[c]) for c in ("a", "b", "ta", "tb")], toxicity.continuation(table))
    said = ["zwerkop", "zwerkops", "жжук", "xvexxilx", "abc", "é漢", "9", "neverseenword", "漢ж"]
    words = toxicity.Words(pa.array([" ".join(said)]))
    got = model.ratio(words, np.arange(len(words.example)))[words.which]
    assert got == pytest.approx([plain.ratio(w) for w in said], abs=1e-4) and got[0] > 3 > got[4]


def test_shared_model_sums_to_one(counted):
    p = toxicity.continuation(counted[0]).reshape(-1, toxicity.SYMBOLS)
    assert np.allclose(p.sum(1), 1, atol=1e-3) and p.min() > 0


def test_joined_counts_score_like_broadcast_ones(spark):
    docs, labels = tox_docs()
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = [{r.doc_id: r.score for r in toxicity.score(docs, labels, most=most).collect()} for most in (10**9, 0)]
    assert len(got[0]) == 603 and got[1] == pytest.approx(got[0], abs=1e-9) and max(got[0].values()) > 0.9
