"""Splits by sums of tip hashes and quartets by intervals, against sets in plain Python, and on trees of any depth."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from cladeworks.operators import newick as N
from cladeworks.operators import quartets as Q
from cladeworks.operators import splits as B
from cladeworks.operators import trees as R


def trees_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "tree_id int, newick string")


def random_tree(r, tips):
    """A tree with polytomies and unary nodes."""
    nodes = [f"'{t}'" if " " in t else t for t in r.sample(tips, len(tips))]
    while len(nodes) > 1:
        k = min(len(nodes), r.choice([1, 2, 2, 2, 3, 4]))
        taken = [nodes.pop(r.randrange(len(nodes))) for _ in range(k)]
        nodes.append(f"({','.join(taken)})")
    return nodes[0] + ";"


def sets(text):
    return N.leaf_sets(N.parse(text))


def plain_splits(text, keep=None):
    found = sets(text)
    every = found[0] & keep if keep is not None else found[0]
    return {frozenset([frozenset(s & every), frozenset(every - s)]) for i, s in found.items() if i and len(s & every) >= 2 and len(every - s) >= 2 and N.parse(text).children[i]}


def sample(seed, n):
    r = random.Random(seed)
    names = ["a b", "it's", "x"] + [f"t{i}" for i in range(20)]
    return [random_tree(r, r.sample(names, r.randrange(1, 14)) if i % 5 else names) for i in range(n)]


def test_splits_and_distances(spark):
    texts = [t.replace("it's", "'it''s'") for t in sample(1, 24)] + ["((a,b;", "(a,b);", "a;"]
    nodes = R.nodes(trees_of(spark, *texts)).persist()
    counts = {r.tree_id: r["count"] for r in B.splits(nodes, ["tree_id"]).groupBy("tree_id").count().collect()}
    assert counts == {i: n for i, t in enumerate(texts[:24]) if (n := len(plain_splits(t)))}
    pairs = [(i, j) for i, j in itertools.combinations(range(24), 2) if (i + j) % 3 == 0] + [(0, 24), (0, 25), (25, 25), (26, 1)]
    got = {(r.a, r.b): (r.n_shared, r.rf) for r in B.rf_distance(spark.createDataFrame(pairs, "a int, b int"), nodes).collect()}
    want = {}
    for a, b in pairs:
        if 24 not in (a, b):
            both = sets(texts[a])[0] & sets(texts[b])[0]
            want[a, b] = (len(both), len(plain_splits(texts[a], both) ^ plain_splits(texts[b], both)))
    assert got == want


def plain_shape(text, q):
    for side in plain_splits(text, set(q)):
        return next(next(t for t in s if t != q[0]) for s in side if q[0] in s)
    return None


@pytest.mark.parametrize("options", [(None, None, None, None), (30, None, None, None), (None, 17, None, None), (None, None, 40, None), (None, None, None, 33)])
def test_quartets(spark, options):
    texts = [t.replace("it's", "'it''s'") for t in sample(2, 12)]
    pairs = list(itertools.combinations(range(0, 12), 2))
    got = {(r.a, r.b): (r.n_quartets, r.agreement) for r in Q.quartet_agreement(spark.createDataFrame(pairs, "a int, b int"), R.nodes(trees_of(spark, *texts)).persist(), *options).collect()}
    for a, b in pairs:
        tips = sorted(sets(texts[a])[0] & sets(texts[b])[0])
        every = list(itertools.combinations(tips, 4))
        first, stride, drawn, spread = options
        if spread:
            every = [every[int(i * (len(every) / spread))] for i in range(spread)] if len(every) > spread else every
        elif drawn:
            every = [every[i] for i in sorted(random.Random(0).sample(range(len(every)), min(drawn, len(every))))]
        elif stride:
            step = max(1, len(every) // stride)
            every = every[: step * stride : step]
        elif first:
            every = every[:first]
        elif len(every) > 500:
            continue  # all 8855 are compared in the other ways
        same = [plain_shape(texts[a], q) == plain_shape(texts[b], q) for q in every]
        n, agreement = got[a, b]
        assert n == len(same) and (agreement is None if not same else abs(agreement - sum(same) / len(same)) < 1e-12)


def test_monophyly(spark):
    r = random.Random(4)
    texts = [t.replace("it's", "'it''s'") for t in sample(3, 20)]
    taxa = [(t, rank, k, r.choice("PQR" if k else "XY")) for t in ["a b", "it's", "x"] + [f"t{i}" for i in range(18)] for k, rank in enumerate(("domain", "phylum"))]
    nodes = R.nodes(trees_of(spark, *texts)).persist()
    got = {(x.tree_id, x["rank"]): (x.n_total, x.n_mono) for x in B.monophyly(nodes, spark.createDataFrame(taxa, "tip string, rank string, rank_idx int, taxon string")).collect()}
    want = {}
    for i, text in enumerate(texts):
        tree, found = N.parse(text), sets(text)
        clades = [s for k, s in found.items() if tree.children[k]]
        for rank in ("domain", "phylum"):
            groups = [{t for t, k, _, x in taxa if k == rank and x == name and t in found[0]} for name in "XYPQR"]
            groups = [g for g in groups if len(g) >= 2 and len(found[0] - g) >= 2]
            if groups:
                want[i, rank] = (len(groups), sum(g in clades or found[0] - g in clades for g in groups))
    assert got == want
    single = {(x.tree_id, x.taxon): x.monophyletic for x in B.is_monophyletic(nodes, spark.createDataFrame([("t0", "one"), ("t1", "two"), ("t2", "two")], "tip string, taxon string")).collect()}
    for (i, taxon), mono in single.items():
        group = {"t0"} if taxon == "one" else {"t1", "t2"} & sets(texts[i])[0]
        assert mono == (len(group) == 1 or group in [s for k, s in sets(texts[i]).items() if N.parse(texts[i]).children[k]])


def ladder(tips):
    return "(" * (len(tips) - 1) + tips[0] + "".join(f",{t})" for t in tips[1:]) + ";"


def test_a_ladder_of_twenty_thousand_tips(spark, capsys):
    """Every prefix of a ladder is a clade: 200 million places as lists of tips. Two tips changed places, so the prefixes between them differ."""
    tips = [f"t{i:05}" for i in range(20_000)]
    other = tips.copy()
    other[7_000], other[7_100] = other[7_100], other[7_000]
    trees = trees_of(spark, ladder(tips), ladder(other))
    pairs = spark.createDataFrame([(0, 1)], "a int, b int")
    nodes = R.nodes(trees).persist()
    nodes.count()
    began = time.time()
    got = B.rf_distance(pairs, nodes)
    row = got.first()
    assert (row.n_shared, row.rf) == (20_000, 200) and time.time() - began < 30
    began = time.time()
    row = Q.quartet_agreement(pairs, nodes, None, None, 1000).first()
    picks = [Q.unrank(20_000, i) for i in sorted(random.Random(0).sample(range(20_000 * 19_999 * 19_998 * 19_997 // 24), 1000))]

    def shape(order, q):  # in a ladder the first two of four are joined
        at = sorted((order.index(tips[k]), k) for k in q)
        return frozenset([frozenset([at[0][1], at[1][1]]), frozenset([at[2][1], at[3][1]])])

    near = [q for q in picks if {7000, 7100} & set(q)]  # the others can't differ
    same = 1000 - sum(shape(tips, q) != shape(other, q) for q in near)
    assert row.n_quartets == 1000 and abs(row.agreement - same / 1000) < 1e-12 and time.time() - began < 30
    got.explain()
    said = capsys.readouterr().out
    assert "collect_list" not in said and "collect_set" not in said and "array" not in said.lower().replace("mapinarrow", "")


def test_unrank_is_lexicographic_order():
    for n in range(4, 12):
        assert [tuple(Q.unrank(n, i)) for i in range(len(list(itertools.combinations(range(n), 4))))] == list(itertools.combinations(range(n), 4))


def test_quartet_picks_in_sql(spark):
    R.register(spark)
    got = spark.sql("SELECT n, i, r1, r2, r3, r4 FROM VALUES (5), (3) s(n), LATERAL quartet_picks(n, NULL, NULL, NULL, NULL)").orderBy("i").collect()
    assert [tuple(r)[2:] for r in got] == list(itertools.combinations(range(5), 4))
    assert spark.sql("SELECT node_id, last FROM newick_nodes('((A,B),C);')").where(F.col("last") == 3).count() == 2


def plain_induced(tree, kept):
    """Nested (label or None, length, children) of a tree on its kept tips; None for no tip."""

    def walk(i):
        if not tree.children[i]:
            return (tree.label[i], tree.length[i] or 0.0, []) if tree.label[i] in kept else None
        below = [x for c in tree.children[i] if (x := walk(c))]
        if len(below) == 1:
            return (below[0][0], below[0][1] + (tree.length[i] or 0.0), below[0][2])
        return (tree.label[i], tree.length[i] or 0.0, below) if below else None

    return walk(0)


def nested(rows):
    """The same from NODES rows in preorder."""
    made = {}
    for r in sorted(rows, key=lambda r: r.node_id):
        made[r.node_id] = (r.label, r.length, [])
        if r.parent_id is not None:
            made[r.parent_id][2].append(made[r.node_id])
    return made[0]


def same(a, b, top=True):
    return a[0] == b[0] and (top or abs(a[1] - b[1]) < 1e-9) and len(a[2]) == len(b[2]) and all(same(x, y, False) for x, y in zip(a[2], b[2]))


def test_induced_trees(spark):
    from cladeworks.operators import induced as I

    r = random.Random(12)
    texts = []
    for text in sample(5, 30):
        said = text.replace("it's", "'it''s'")
        texts.append("".join(c + (f"n{i}:{r.random() * 3:.3f}" if c == ")" else "") for i, c in enumerate(said)))
    kept = [(i, t) for i, text in enumerate(texts) for t in sets(text)[0] if r.random() < (0.5 if i % 4 else 0.1)] + [(0, "no such tip")]
    nodes = R.nodes(trees_of(spark, *texts)).persist()
    got: dict = {}
    for row in I.induced_trees(nodes, spark.createDataFrame(kept, "tree_id int, tip string")).collect():
        got.setdefault(row.tree_id, []).append(row)
    for i, text in enumerate(texts):
        want = plain_induced(N.parse(text), {t for k, t in kept if k == i})
        assert (i in got) == (want is not None)
        if want:
            assert same(nested(got[i]), want) and got[i] and all(r.length is None for r in got[i] if r.parent_id is None)
            by_id = {row.node_id: row for row in got[i]}
            assert all(row.depth == (0 if row.parent_id is None else by_id[row.parent_id].depth + 1) for row in got[i])
            assert all(row.last == max([k for k, x in by_id.items() if k >= row.node_id and all(y.depth > row.depth for z, y in by_id.items() if row.node_id < z <= k)], default=row.node_id) for row in got[i])
    branches = {(b.tree_id, b.clade.n): b.support for b in I.internal_branches(R.nodes(trees_of(spark, "(((a,b)0.9,c)x,(d,e)12);"))).collect()}
    assert branches == {(0, 2): 12.0, (0, 3): None} or branches == {(0, 2): 0.9, (0, 3): None}
