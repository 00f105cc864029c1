"""Trees as tables: one parse of each Newick string gives nodes and clades; splits, distances, quartets and gates are joins (splits.py, quartets.py)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..scratch import saved
from . import joining_rounds as R
from . import newick as N
from . import quartets as Q
from . import splits as B
from .quartets import quartet_agreement, unrank  # noqa: F401
from .splits import is_monophyletic, monophyly, rf_distance  # noqa: F401

NJ_TASKS = 200  # over which markers are dealt, so that two seldom share one
NODES = "node_id int, parent_id int, label string, length double, is_leaf boolean, depth int, last int"


@udtf(returnType=NODES)
class NewickNodes:
    """Table function: the nodes of a Newick string, parents first."""

    def eval(self, newick: str):
        for row in N.rows(N.parse(newick)):
            yield row


def register(spark) -> None:
    """Makes newick_nodes(text) and quartet_picks(n, first, stride_to, drawn, spread) available to SQL."""
    spark.udtf.register("newick_nodes", NewickNodes)
    Q.register(spark)


def nodes(trees: DataFrame) -> DataFrame:
    """tree_id and NODES; a malformed tree has none."""
    kind = trees.schema["tree_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in NODES.split(", ")]
        for batch in batches:
            for tree_id, text in zip(batch.tree_id, batch.newick):
                try:
                    yield pd.DataFrame(N.rows(N.parse(text)), columns=names).assign(tree_id=tree_id)[["tree_id", *names]]
                except N.NewickError:
                    continue

    return trees.select("tree_id", "newick").mapInPandas(run, f"tree_id {kind}, {NODES}")


def clades(trees: DataFrame) -> DataFrame:
    """tree_id, tips (sorted), is_root: the leaf set of each inner node."""
    kind = trees.schema["tree_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tree_id, text in zip(batch.tree_id, batch.newick):
                try:
                    tree = N.parse(text)
                except N.NewickError:
                    continue
                rows += [(tree_id, sorted(tips), i == 0) for i, tips in N.leaf_sets(tree).items() if tree.children[i] or i == 0]
            yield pd.DataFrame(rows, columns=["tree_id", "tips", "is_root"])

    return trees.select("tree_id", "newick").mapInPandas(run, f"tree_id {kind}, tips array<string>, is_root boolean")


def tips(clade_table: DataFrame) -> DataFrame:
    return clade_table.where("is_root").select("tree_id", F.explode(F.array_distinct("tips")).alias("tip"))


def splits(clade_table: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """tree_id, side, n: canonical side of each distinct split with two tips or more on both sides. keep (tree_id, tips): tips to restrict to first."""
    root = (keep if keep is not None else clade_table.where("is_root")).select("tree_id", F.array_sort(F.array_distinct("tips")).alias("every"))
    inner = clade_table.where("not is_root").join(root, "tree_id").withColumn("a", F.array_sort(F.array_intersect("tips", "every")))
    inner = inner.withColumn("b", F.array_sort(F.array_except("every", "a"))).where("size(a) >= 2 and size(b) >= 2")
    return inner.select("tree_id", F.when(F.col("a") <= F.col("b"), F.col("a")).otherwise(F.col("b")).alias("side"), F.size("every").alias("n")).distinct()


def collapsed(node_table: DataFrame, focal: DataFrame) -> DataFrame:
    """tree_id, x, y (x < y): focal groups (grp, tip; a short configured list) that one branch of the tree parts from all else, so that it can't tell them apart."""
    one = focal.select("grp", "tip").distinct()
    names = one.select("grp").distinct()
    two = names.select(F.col("grp").alias("x")).crossJoin(names.select(F.col("grp").alias("y"))).where("x < y")
    tips_of = lambda side: two.join(one.withColumnRenamed("grp", side), side).select("x", "y", "tip")
    union = B.group_sums(tips_of("x").union(tips_of("y")).distinct(), ["x", "y"])
    inner = B.clade_sums(node_table, ["tree_id"]).where("parent_id is not null and clade.n >= 2 and whole.n - clade.n >= 2")
    sides = inner.select("tree_id", F.explode(F.array(F.col("clade"), B.rest(F.col("whole"), F.col("clade")))).alias("grp")).distinct()
    return sides.join(union, "grp").select("tree_id", "x", "y")


def legality(reference: DataFrame, gene: DataFrame, tip_cap: int | None = None, focal: DataFrame | None = None) -> DataFrame:
    """a (reference), b (gene), verdict of each pair (a, b) in gene: the first fault of MALFORMED, TIPSET_MISMATCH, TOO_FEW_TIPS, POLYTOMY, TIP_CAP_EXCEEDED, CLADE_COLLAPSED, else LEGAL.

    reference: tree_id, newick (or the nodes) of all trees; gene: pairs (a, b); focal: groups (grp, tip) of which no two may be merged on one branch.
    """
    table = reference if "node_id" in reference.columns else nodes(reference)
    leaves = table.where("is_leaf").select("tree_id", F.col("label").alias("tip")).distinct()
    ref = table.where("is_leaf").groupBy("tree_id").agg(F.count(F.lit(1)).alias("n_tips"))
    degree = table.where("parent_id is not null").groupBy("tree_id", "parent_id").agg(F.count(F.lit(1)).alias("k"))
    root = table.where("parent_id is null").select("tree_id", F.col("node_id").alias("root"))
    degree = degree.join(root, "tree_id").groupBy("tree_id").agg(F.max(F.col("k") + (F.col("parent_id") != F.col("root")).cast("int")).alias("degree"))
    lost = gene.join(leaves.withColumnRenamed("tree_id", "b"), "b").join(leaves.withColumnRenamed("tree_id", "a"), ["a", "tip"], "left_anti").groupBy("a", "b").agg(F.count(F.lit(1)).alias("lost"))
    out = gene.join(ref.join(degree, "tree_id", "left").withColumnRenamed("tree_id", "a"), "a", "left").join(lost, ["a", "b"], "left")
    if focal is not None:
        out = out.join(collapsed(table, focal).select(F.col("tree_id").alias("a"), F.lit(True).alias("merged")).distinct(), "a", "left")
    verdict = (
        F.when(F.col("n_tips").isNull(), "MALFORMED").when(F.col("lost") > 0, "TIPSET_MISMATCH").when(F.col("n_tips") < 4, "TOO_FEW_TIPS").when(F.col("degree") > 3, "POLYTOMY")
        .when(F.lit(tip_cap is not None) & (F.col("n_tips") > (tip_cap or 0)), "TIP_CAP_EXCEEDED").when(F.col("merged") if focal is not None else F.lit(False), "CLADE_COLLAPSED").otherwise("LEGAL")
    )
    return out.select("a", "b", verdict.alias("verdict"))


def has_bipartition(clade_table: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (tree_id, left, right: arrays of tips) with present: does the tree, on these tips, part them so. No row: the tree can't be read."""
    wanted = asked.withColumns({"l": F.array_sort(F.array_distinct("left")), "every": F.array_sort(F.array_union("left", "right"))})
    joined = wanted.join(clade_table.select("tree_id", "tips"), "tree_id").withColumn("on", F.array_sort(F.array_intersect("tips", "every")))
    hit = (F.col("on") == F.col("l")) | (F.array_sort(F.array_except("every", "on")) == F.col("l"))
    lone = (F.size("l") == 1) | (F.size("every") - F.size("l") == 1)
    return joined.groupBy("tree_id", "left", "right").agg(F.bool_or(hit | lone).alias("present"))


def sisters(clade_table: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (tree_id, x, y: arrays of tips) with sister: the smallest clade that holds both groups holds nothing else, and each is a clade or one tip."""
    known = clade_table.select("tree_id", F.array_sort("tips").alias("c"))
    both = F.array_sort(F.array_union("x", "y"))
    joined = asked.join(known, "tree_id")
    whole = lambda c: F.bool_or(F.col("c") == F.array_sort(F.array_distinct(c))) | F.bool_or(F.size(F.array_distinct(c)) == 1)
    return joined.groupBy("tree_id", "x", "y").agg((F.bool_or(F.col("c") == both) & whole("x") & whole("y")).alias("sister"))


def mrca_depth(tree_table: DataFrame, clade_table: DataFrame, wanted: DataFrame) -> DataFrame:
    """tree_id, name, depth: edges from the root to the last common ancestor of the wanted (tree_id, name, tip) tips. tree_table: nodes()."""
    path = tree_table.select("tree_id", "node_id", "parent_id", "depth", "label", "is_leaf")
    asked = wanted.groupBy("tree_id", "name").agg(F.collect_set("tip").alias("w"))
    over = asked.join(clade_table, "tree_id").where(F.size(F.array_except("w", "tips")) == 0)  # nested: each ancestor once
    lone = asked.where("size(w) = 1").select("tree_id", "name", F.col("w")[0].alias("label")).join(path.where("is_leaf"), ["tree_id", "label"]).select("tree_id", "name", "depth")
    several = over.where("size(w) > 1").groupBy("tree_id", "name").agg((F.count(F.lit(1)) - 1).cast("int").alias("depth"))
    return lone.unionByName(several)


def special_node(clade_table: DataFrame, wanted: DataFrame) -> DataFrame:
    """tree_id, name, tips: the smallest clade that holds all wanted (tree_id, name, tip) tips."""
    asked = wanted.groupBy("tree_id", "name").agg(F.collect_set("tip").alias("w"))
    over = asked.join(clade_table, "tree_id").where(F.size(F.array_except("w", "tips")) == 0)
    return over.groupBy("tree_id", "name").agg(F.min_by("tips", F.size("tips")).alias("tips"))


def consensus(clade_table: DataFrame, share: float = 0.5) -> DataFrame:
    """side, support of the splits that more than `share` of the trees have: the majority-rule consensus as splits."""
    n = clade_table.select("tree_id").distinct().agg(F.count(F.lit(1)).alias("trees"))
    counts = splits(clade_table).groupBy("side").agg(F.count_distinct("tree_id").alias("k"))
    return counts.crossJoin(F.broadcast(n)).where(F.col("k") / F.col("trees") > share).select("side", (F.col("k") / F.col("trees")).alias("support"))


def conflicts(left: DataFrame, right: DataFrame, quartets_of: int = 200) -> DataFrame:
    """tree_id, verdict, n_shared, nrf, agreement of two trees (tree_id, newick each) that are each other's reference.

    Both must be legal for the other: verdict is the first fault, left as the reference first, and nothing is measured then.
    Agreement is over all quartets of shared tips, or quartets_of at even distances.
    """
    text = F.col("tree_id").cast("string")
    every = left.select(F.concat(F.lit("L"), text).alias("tree_id"), "newick").unionByName(right.select(F.concat(F.lit("R"), text).alias("tree_id"), "newick"))
    ids = left.select(text.alias("id")).join(right.select(text.alias("id")), "id")
    there = ids.select(F.concat(F.lit("L"), "id").alias("a"), F.concat(F.lit("R"), "id").alias("b"))
    table = saved(nodes(every), "nodes")
    plain = F.substr("a", F.lit(2)).alias("tree_id")
    fault = F.min(F.when(F.col("verdict") != "LEGAL", F.struct("a", "verdict")))  # L before R
    told = saved(legality(table, there.union(there.select("b", "a"))).groupBy(plain).agg(F.coalesce(fault["verdict"], F.lit("LEGAL")).alias("verdict")), "verdicts")  # read many times below
    legal = there.join(told.where("verdict = 'LEGAL'"), F.substr("a", F.lit(2)) == F.col("tree_id")).select("a", "b")
    measured = rf_distance(legal, table).join(quartet_agreement(legal, table, None, spread=quartets_of).select("a", "b", "agreement"), ["a", "b"])
    return told.join(measured.select(plain, "n_shared", F.col("normalized_rf").alias("nrf"), "agreement"), "tree_id", "left")


def filter_gene_trees(trees: DataFrame, min_tips: int = 4, min_support: float | None = None) -> DataFrame:
    """trees with `dropped`: null if usable, else why. An unmeasured support fails a support floor."""
    from ..functions.scalars import mean_support, newick_tips

    few = F.size(newick_tips(F.col("newick"))) < min_tips
    weak = F.lit(False) if min_support is None else ~F.coalesce(mean_support(F.col("newick")) >= min_support, F.lit(False))
    return trees.withColumn("dropped", F.when(few, "too_few_tips").when(weak, "low_support"))


def mad_rooted(trees: DataFrame, max_tips: int = 600) -> DataFrame:
    """tree_id, newick rooted by minimal ancestor deviation (midpoint beyond max_tips or without lengths), score."""
    kind = trees.schema["tree_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *N.mad_root(text, max_tips)) for i, text in zip(batch.tree_id, batch.newick)]
            yield pd.DataFrame(rows, columns=["tree_id", "newick", "method", "score"])

    return trees.select("tree_id", "newick").mapInPandas(run, f"tree_id {kind}, newick string, method string, score double")


def neighbour_joining(aln: DataFrame, cells: int = R.CELLS, strip_bytes: int = R.STRIP_BYTES) -> DataFrame:
    """marker_id, newick, method ('nj-builtin'), reason: a tree of each marker's sequences by p-distance. Fewer than four: none, and why.

    A marker is joined in one task while its distances and letters fit there, else in rounds over all tasks (joining_rounds.py).
    """
    kind = aln.schema["marker_id"].dataType.simpleString()
    schema = f"marker_id {kind}, newick string, method string, reason string"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 4:
            return pd.DataFrame([(key[0], None, None, "fewer than 4 sequences")], columns=["marker_id", "newick", "method", "reason"])
        pdf = pdf.sort_values("taxon")
        return pd.DataFrame([(key[0], N.neighbour_joining([str(t) for t in pdf.taxon], list(pdf.seq)), "nj-builtin", None)], columns=["marker_id", "newick", "method", "reason"])

    aln = aln.select("marker_id", "taxon", "seq")
    sizes = aln.groupBy("marker_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("seq")).alias("letters"))
    large = saved(sizes.where(f"n >= 4 and (n * n > {cells} or letters > {2 * strip_bytes})").select(F.col("marker_id").alias("of"), (F.row_number().over(Window.orderBy("marker_id")) - 1).alias("tree")), "nj-large")  # few rows: each stands for thousands of sequences
    rounds = not large.isEmpty()
    if rounds:
        tagged = aln.join(F.broadcast(large), F.col("marker_id").eqNullSafe(F.col("of")), "left").drop("of")
        aln = tagged.where("tree is null")
    dealt = aln.select("marker_id", "taxon", "seq").repartition(NJ_TASKS, "marker_id")  # a number given is kept: small markers are much work, and are not put together into one task
    small = dealt.groupBy("marker_id").applyInPandas(run, schema)
    if not rounds:
        return small
    made = R.trees(tagged.where("tree is not null").select("tree", "taxon", "seq"), cells, strip_bytes).join(F.broadcast(large), "tree")
    return small.unionAll(made.select(F.col("of").alias("marker_id"), "newick", F.lit("nj-builtin").alias("method"), F.lit(None).cast("string").alias("reason")))
