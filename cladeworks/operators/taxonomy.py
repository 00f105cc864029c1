"""Taxonomy tables: parsing, merging, checks, scopes and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import RANKS, parse_lineage, read_lineage


def parse_table(lines: DataFrame, codes: str = "dpcofgs") -> DataFrame:
    """tip and a column a rank; a tip that repeats keeps its last row (by ordinal, if there is one)."""
    parsed = lines.select("*", *parse_lineage(F.col("lineage"), codes))
    ranks = [c for c in parsed.columns if c in RANKS]
    if "ordinal" not in lines.columns:
        return parsed.select("tip", *ranks)
    return parsed.groupBy("tip").agg(F.max_by(F.struct(*ranks), "ordinal").alias("r")).select("tip", "r.*")


def long(taxa: DataFrame) -> DataFrame:
    """tip, rank, rank_idx, taxon; measured ranks only."""
    ranks = [r for r in RANKS if r in taxa.columns]
    out = taxa.unpivot("tip", ranks, "rank", "taxon").where("taxon is not null")
    return out.withColumn("rank_idx", F.array_position(F.array(*map(F.lit, RANKS)), F.col("rank")).cast("int") - 1)


def merge(first: DataFrame, second: DataFrame) -> DataFrame:
    """Ranks of both tables, the first's where they differ, and n_conflicts."""
    ranks = [r for r in RANKS if r in first.columns and r in second.columns]
    a, b = first.alias("a"), second.alias("b")
    joined = a.join(b, F.col("a.tip") == F.col("b.tip"), "full_outer")
    differ = sum((F.coalesce(F.col(f"a.{r}") != F.col(f"b.{r}"), F.lit(False)).cast("int") for r in ranks), F.lit(0))
    return joined.select(F.coalesce("a.tip", "b.tip").alias("tip"), *[F.coalesce(f"a.{r}", f"b.{r}").alias(r) for r in ranks], differ.alias("n_conflicts"))


def unmatched(table_tips: DataFrame, tree_tips: DataFrame) -> DataFrame:
    """tip, side: tips that only the table or only the tree has."""
    a, b = table_tips.select("tip").distinct(), tree_tips.select("tip").distinct()
    return a.join(b, "tip", "left_anti").withColumn("side", F.lit("table_only")).unionByName(b.join(a, "tip", "left_anti").withColumn("side", F.lit("tree_only")))


def cycles(taxa: DataFrame) -> DataFrame:
    """tip, other: tips whose taxon names another tip whose taxon names the first."""
    pairs = long(taxa).select("tip", F.col("taxon").alias("other")).where("tip <> other").distinct()
    return pairs.alias("a").join(pairs.alias("b"), (F.col("a.tip") == F.col("b.other")) & (F.col("a.other") == F.col("b.tip"))).where("a.tip < b.tip").select("a.tip", "a.other")


def scope_rank(members: DataFrame, taxa: DataFrame) -> DataFrame:
    """tree_id, scope, taxon: the deepest rank at which all of a tree's known tips share one taxon."""
    known = members.join(taxa.select("tip"), "tip", "left_semi").groupBy("tree_id").agg(F.count(F.lit(1)).alias("n"))
    counts = members.join(long(taxa), "tip").groupBy("tree_id", "rank", "rank_idx").agg(F.count(F.lit(1)).alias("m"), F.min("taxon").alias("taxon"), F.max("taxon").alias("other"))
    whole = counts.join(known, "tree_id").where("m = n and taxon = other")
    return whole.groupBy("tree_id").agg(F.max_by(F.struct(F.col("rank").alias("scope"), "taxon"), "rank_idx").alias("s")).select("tree_id", "s.*")


def far_distance(taxa: DataFrame, fine: str = "genus", coarse: str = "order", share: float = 0.70, orders: int = 2) -> DataFrame:
    """One row: is the set so diverse that level thresholds widen. Exact distinct counts."""
    n = F.count(F.lit(1))
    row = taxa.agg(n.alias("n_tips"), F.count_distinct(fine).alias("n_fine"), F.count_distinct(coarse).alias("n_coarse"))
    return row.withColumn("far", (F.col("n_fine") / F.nullif(F.col("n_tips"), F.lit(0)) >= share) | (F.col("n_coarse") >= orders))


def domain_majority(labels: DataFrame) -> DataFrame:
    """The domain that half of the labels or more name, at least one."""
    d = F.when(F.lower("label").contains("d_archaea") | F.lower("label").contains("d__archaea"), "archaea").when(F.lower("label").contains("d_bacteria") | F.lower("label").contains("d__bacteria"), "bacteria")
    n = labels.agg(F.count(F.lit(1)).alias("n"))
    counts = labels.select(d.alias("domain")).where("domain is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("m"))
    return counts.crossJoin(F.broadcast(n)).where(F.col("m") >= F.greatest(F.lit(1), F.col("n") / 2)).orderBy(F.col("m").desc(), "domain").limit(1).select("domain", "m")


def embedded(labels: DataFrame, codes: str = "dpcofgs", forced: bool = False) -> DataFrame:
    """Taxonomy read from the labels themselves; nothing unless half of those with any rank have a domain, or forced."""
    parsed = labels.select(F.col("label").alias("tip"), *read_lineage(F.col("label"), codes))
    some = parsed.where(F.coalesce(*[F.col(c) for c in parsed.columns[1:]]).isNotNull())
    gate = some.agg((F.count("domain") * 2 >= F.count(F.lit(1))).alias("ok"))
    return some.crossJoin(F.broadcast(gate)).where(F.col("ok") | F.lit(forced)).drop("ok")


def must_pass(clades: DataFrame, members: DataFrame, taxa: DataFrame, rules: DataFrame, limit: int = 20) -> DataFrame:
    """tree_id, rule, relation, rank, taxon, members, result for each rule and taxon group on each tree.

    rules: rule, relation, level, min_taxa. A group is supported if its tips are exactly a clade (rooted). Other
    relations than monophyletic are not_checked. limit caps how many violations a tree and rule list, as a report does.
    """
    groups = members.join(long(taxa), "tip").groupBy("tree_id", "rank", "taxon").agg(F.array_sort(F.collect_set("tip")).alias("tips"))
    checks = groups.join(F.broadcast(rules), groups["rank"] == rules["level"])  # rules are a short configured list
    checks = checks.where(F.size("tips") >= F.greatest(F.col("min_taxa"), F.lit(2)))
    found = checks.join(clades.select("tree_id", F.col("tips").alias("clade"), F.lit(True).alias("hit")), (checks["tree_id"] == clades["tree_id"]) & (checks["tips"] == F.col("clade")), "left").drop(clades["tree_id"])
    result = F.when(F.col("relation") != "monophyletic", "not_checked").when(F.col("hit"), "pass").otherwise("violation")
    listed = found.dropDuplicates(["tree_id", "rule", "taxon"]).withColumn("result", result)
    turn = F.row_number().over(Window.partitionBy("tree_id", "rule", "result").orderBy("taxon"))
    return listed.withColumn("turn", turn).where((F.col("result") != "violation") | (F.col("turn") <= limit)).select("tree_id", "rule", "relation", "rank", "taxon", F.size("tips").alias("members"), "result")
