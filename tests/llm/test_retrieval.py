"""Latent retrieval against a dense SVD, exact cosines and all windows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cladeworks.llm import decontaminate

BLOCK, SPAN = decontaminate.BLOCK, decontaminate.BLOCK * decontaminate.WINDOW


def planted(seed, n_bench=300, n_docs=300, keep_share=0.5, extra=200):
    """Passages, and documents: plain ones, and half-rewritten passages that keep the answer, among text of the same common words."""
    r = random.Random(seed)
    words, odds = [f"w{i}" for i in range(4000)], [1 / (i + 1) for i in range(4000)]
    draw = lambda n: r.choices(words, odds, k=n)
    bench = [draw(40) for _ in range(n_bench)]
    docs = [draw(r.randint(50, 400)) for _ in range(n_docs)]
    for p in bench[:extra]:
        keep = set(r.sample(range(34), round(34 * keep_share))) | set(range(34, 40))
        docs.append([*draw(r.randint(0, 100)), *(w if k in keep else f"s{r.randrange(99)}" for k, w in enumerate(p)), *draw(r.randint(0, 100))])
    return bench, docs


def lcs(a, b):
    number = {w: i for i, w in enumerate({*a, *b})}
    return decontaminate.lcs(decontaminate.masks_of(np.array([number[w] for w in a])), len(a), [number[w] for w in b]) / len(a)


def brute(bench, docs):
    """(doc, item): best exact cosine of whole TF-IDF vectors among the windows that the checks accept."""
    blocks = [d[a : a + BLOCK] for d in docs for a in range(0, len(d), BLOCK)]
    df = Counter(w for b in blocks for w in set(b))
    idf = {w: math.log((len(blocks) + 1) / (df[w] + 1)) + 0.1 for p in bench for w in p}
    vector = lambda ws: {w: n * idf[w] for w, n in Counter(ws).items() if w in idf}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    known = [(vector(p), sum(idf[w] for w in p)) for p in bench]
    out: dict = {}
    for i, d in enumerate(docs):
        for a in range(0, len(d), BLOCK):
            span = d[a : a + SPAN]
            has, mine = set(span), vector(span)
            for j, p in enumerate(bench):
                held = [w for w in p if w in has]
                if len(held) < 0.5 * len(p) or sum(idf[w] for w in held) < 0.5 * known[j][1]:
                    continue
                s = lcs(p, span)
                if s >= 0.5 and (s >= 0.75 or lcs(p[-6:], span) >= 0.8):
                    cosine = sum(x * known[j][0].get(w, 0) for w, x in mine.items()) / norm(mine) / norm(known[j][0])
                    out[i, j] = max(out.get((i, j), 0.0), cosine)
    return out


def found(spark, bench, docs, **options):
    flagged = decontaminate.flag(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"), spark.createDataFrame([(j, " ".join(p)) for j, p in enumerate(bench)], "item_id long, text string"), **options)
    return {(x.doc_id, m.item_id) for x in flagged.collect() for m in x.matches}


@pytest.mark.parametrize(("seed", "keep_share"), [(3, 0.5), (8, 0.65)])
def test_recall_of_paraphrases_and_of_exact_cosine(spark, seed, keep_share):
    bench, docs = planted(seed, keep_share=keep_share)
    want = brute(bench, docs)
    near = {k for k, c in want.items() if c >= 0.45}  # what the same search over exact cosines would find
    got = found(spark, bench, docs)
    print(f"found {len(got & set(want))} of {len(want)}; of {len(near)} by exact cosine {len(got & near)}; {len(got - set(want))} others")
    assert len(want) > 180 and not got - set(want) and len(got & set(want)) >= 0.95 * len(want) and len(got & near) >= 0.95 * len(near)


def test_latent_space_against_a_dense_svd(spark):
    """The randomised basis holds nearly as much of the matrix as the best basis of its rank."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = [r.choices(words, [1 / (i + 1) for i in range(300)], k=r.randint(10, 200)) for _ in range(200)]
    bench = [r.choices(words, k=30) for _ in range(40)]
    h = lambda ws: decontaminate.normal_words(decontaminate.pa.array([" ".join(ws)]))[0]
    voc = decontaminate.Vocabulary(np.concatenate([h(p) for p in bench]))
    df = spark.createDataFrame([(" ".join(d),) for d in docs], "text string").repartition(3)
    table = decontaminate.hits(df, spark.sparkContext.broadcast(voc)).cache()
    terms = {w: int(np.searchsorted(voc.hashes, h([w])[0])) for p in bench for w in p}
    blocks = [d[a : a + BLOCK] for d in docs for a in range(0, len(d), BLOCK)]
    dense = np.zeros((len(blocks), len(voc.hashes)))
    for i, b in enumerate(blocks):
        for w in b:
            if w in terms:
                dense[i, terms[w]] += 1
    counts, total = decontaminate.frequencies(table, len(voc.hashes))
    assert total == len(blocks) and (counts == (dense > 0).sum(0)).all()
    idf = np.log((total + 1) / (counts + 1)) + 0.1
    dense *= idf
    x = np.random.default_rng(0).standard_normal((len(idf), 7))
    assert np.allclose(decontaminate.gram_product(table, idf, x), dense.T @ (dense @ x), rtol=1e-3, atol=1e-2)
    rows = [np.array([terms[w] for w in p]) for p in bench]
    items = decontaminate.Passages(rows, idf)
    mine = np.zeros((len(bench), len(idf)))
    for i, t in enumerate(rows):
        np.add.at(mine[i], t, idf[t])
    assert np.allclose(items.times(x), mine @ x) and np.allclose(items.back(items.times(x)), mine.T @ (mine @ x))
    for rank in (20, 60):
        basis = decontaminate.latent_space(table, items, idf, rank).astype(float)
        scale = max(1.0, np.linalg.norm(dense.T @ dense) / np.linalg.norm(mine.T @ mine))
        stacked = np.vstack([dense, math.sqrt(scale) * mine])
        best = np.sqrt((np.linalg.svd(stacked, compute_uv=False)[:rank] ** 2).sum())
        assert np.allclose(basis.T @ basis, np.eye(rank), atol=1e-3) and np.linalg.norm(stacked @ basis) >= 0.95 * best


def test_windows_begin_before_the_first_rare_word(spark):
    common = [f"c{i}" for i in range(22)]
    passage = [*common, *(f"r{i}" for i in range(18))]
    rows = [(i, " ".join(common)) for i in range(200)] + [(900, " ".join([*(f"x{i}" for i in range(10)), *passage, *(f"y{i}" for i in range(60))]))]
    got = decontaminate.flag(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string"))
    assert [(m.item_id, m.lcs) for r in got.where("doc_id = 900").collect() for m in r.matches] == [(1, 1.0)]


def test_rounds_give_what_one_round_gives(spark, monkeypatch):
    bench, docs = planted(4, n_bench=60, n_docs=40, keep_share=0.8, extra=40)
    whole = found(spark, bench, docs)
    monkeypatch.setattr(decontaminate, "PASSAGES", 25)
    assert len(whole) >= 38 and len(whole & found(spark, bench, docs)) >= 0.97 * len(whole)
    monkeypatch.setattr(decontaminate, "TERMS", 60)
    sizes = [len(x) for x in decontaminate.rounds(spark.createDataFrame([(j, " ".join(p)) for j, p in enumerate(bench)], "item_id long, text string"))]
    assert sum(sizes) == 60 and max(sizes) <= 4


def test_short_items_match_whole_lines(spark):
    docs = [(1, "before\nOpen  sesame!\nafter"), (2, "they said open sesame twice"), (3, "open sesame"), (4, "open\nsesame"), (5, None), (6, "yes"), (7, "Yes, yes.\nyes")]
    items = [(10, "open sesame"), (11, "Yes"), (12, ""), (13, "..."), (14, None)]
    got = decontaminate.flag(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: [m.item_id for m in r.matches] for r in got} == {1: [10], 2: [], 3: [10], 4: [], 5: [], 6: [11], 7: [11]}
