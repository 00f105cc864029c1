"""Merkle manifest of a dataset: a hash tree a group, one over the groups' roots, and each row's path to the root.

A row's leaf is the SHA-256 of its fields, each `-` or its UTF-8 byte count, `:` and itself. Leaves of a group ascend by
key; every ARITY consecutive nodes (the last run: fewer, even one) become one, until one is left, the group's subroot.
Subroots in order of their group (null first, by bytes) become the root in the same way. H is SHA-256 in lowercase hex
over the concatenated hex of its inputs.

How: rows are range-partitioned by (group, key, leaf), so a group of any size is numbered by counts of partitions, not in
one task. Nodes are then dealt in aligned blocks of ARITY ** LEVELS, a task reads whole blocks:

* upward, a treehash stack folds each block to one node, which is a leaf of the next round, until a group has one node;
* downward, each block's paths are advanced leaf by leaf (`traversal`): a stack a level builds the coming run while the
  present one is used, so that beside the block's input only (ARITY - 1) digests a level and stack are held; the
  upper path, which a block's leaves share, comes once a block by a cogroup and is appended.

Rounds are a logarithm of the rows; every round is written, so a lost executor costs a reread.

Defined cases: null fields are `-` in the leaf; a null group is a group of its own, before the empty one; null keys come
first; rows of equal group and key are ordered by leaf, and wholly equal rows are neighbours with equal leaves, each with
its own path; a lone leaf is its subroot and a lone subroot the root, with an empty path; empty and very long texts are
hashed like others; an empty table gives an empty result; extra columns are no part of leaves and are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Workspace

ARITY, LEVELS = 16, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:string,after:string>"


def leaf_hash(*fields: Column | str) -> Column:
    """The leaf of a row with these fields."""

    def told(field):
        said = (F.col(field) if isinstance(field, str) else field).cast("string")
        return F.when(said.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))

    return F.sha2(F.concat(*map(told, fields)), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def siblings_hash(path: Column) -> Column:
    """H of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class Treehash:
    """Folds leaves, as they come, to nodes `levels` higher: a stack of unfinished runs, fewer than ARITY digests a level."""

    def __init__(self, levels: int):
        self.open: list[list[str]] = [[] for _ in range(levels)]
        self.done: list[str] = []

    def feed(self, node: str) -> None:
        for run in self.open:
            run.append(node)
            if len(run) < ARITY:
                return
            node = digest(run)
            run.clear()
        self.done.append(node)

    def close(self) -> list[str]:
        """All nodes, once unfinished runs are folded as they are."""
        for level, run in enumerate(self.open):
            if run:
                (self.open[level + 1] if level + 1 < len(self.open) else self.done).append(digest(run))
                run.clear()
        return self.done


def folded_block(leaves: Sequence[str], levels: int) -> str:
    stack = Treehash(levels)
    for leaf in leaves:
        stack.feed(leaf)
    return stack.close()[0]


def traversal(leaves: Sequence[str], levels: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf of a block its path inside the block: (siblings before, siblings after) a level.

    A level's present run is used while its coming run is built by a treehash stack, which takes one leaf for each leaf passed.
    """
    spans = [ARITY ** (level + 1) for level in range(levels)]
    runs, coming = [], [Treehash(level) for level in range(levels)]
    for level, span in enumerate(spans):
        first = Treehash(level)
        for leaf in leaves[:span]:
            first.feed(leaf)
        runs.append(first.close())
    parts: list[tuple[str, str]] = [("", "")] * levels
    for i in range(len(leaves)):
        for level, span in enumerate(spans):
            if i and i % span == 0:
                runs[level], coming[level] = coming[level].close(), Treehash(level)
            if i + span < len(leaves):
                coming[level].feed(leaves[i + span])
            if i % (span // ARITY) == 0:  # the node of this level has changed
                at = i // (span // ARITY) % ARITY
                parts[level] = "".join(runs[level][:at]), "".join(runs[level][at + 1 :])
        yield list(parts)


def numbered(rows: DataFrame, work: Workspace, name: str) -> DataFrame:
    """rows (tree, key, h, more) with idx, the place in the tree by (key, h), and height, its levels. No tree is brought to one task."""
    ordered = rows.repartitionByRange("tree", F.col("key").asc_nulls_first(), "h").sortWithinPartitions("tree", F.col("key").asc_nulls_first(), "h")
    ordered = work.save(ordered.withColumn("at", F.monotonically_increasing_id()), f"{name}-ordered")  # the partition in its upper bits
    part = F.shiftright("at", 33).alias("part")
    runs = ordered.groupBy("tree", part).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")  # a row a partition of the tree
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("tree", "part", "low", before.alias("before"), F.sum("n").over(tree).alias("total"))
    height = F.when(F.col("total") == 1, 0).otherwise(F.length(F.hex(F.col("total") - 1)))  # hex digits: ARITY is 16
    out = ordered.withColumn("part", part).join(runs, ["tree", "part"])
    out = work.save(out.select(*rows.columns, (F.col("before") + F.col("at") - F.col("low")).alias("idx"), height.alias("height")), f"{name}0")
    work.drop(f"{name}-ordered")
    return out


def _blocks(nodes: DataFrame, taken: int) -> DataFrame:
    """nodes with block and the levels that this round folds."""
    levels = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.col("height") - taken))
    return nodes.withColumns({"block": F.floor(F.col("idx") / ARITY**LEVELS).cast("long"), "levels": levels})


def _fold(table: pa.Table) -> pa.Table:
    table = table.sort_by("idx")
    h = folded_block(table["h"].to_pylist(), table["levels"][0].as_py())
    return pa.table({"tree": table["tree"][:1], "idx": table["block"][:1], "h": pa.array([h]), "height": table["height"][:1]})


def ascend(nodes: DataFrame, work: Workspace, name: str) -> list[DataFrame]:
    """nodes (tree, idx, h, height) and the nodes of every further round; the last has one node a tree."""
    highest = nodes.agg(F.max("height")).first()[0] or 0  # one number
    rounds = [nodes]
    for taken in range(0, highest, LEVELS):
        made = _blocks(rounds[-1].select("tree", "idx", "h", "height"), taken).groupBy("tree", "block").applyInArrow(_fold, "tree string, idx long, h string, height int")
        rounds.append(work.save(made, f"{name}{len(rounds)}"))
    return rounds


PATH = f"path array<{STEP}>, subroot string, root string"


def descend(rounds: list[DataFrame], above: DataFrame, work: Workspace, name: str, keep: str) -> DataFrame:
    """rounds[0] (idx, tree, h and the columns of `keep`) with PATH; keep: their names and types; above: tree and PATH of each tree's one node."""
    paths = above.select("tree", F.lit(0).cast("long").alias("idx"), "path", "subroot", "root")
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def runner(names: list[str]):
        def run(block: pa.Table, upper: pa.Table) -> pa.Table:
            block, top = block.sort_by("idx"), upper["path"][0].as_py()
            own = traversal(block["h"].to_pylist(), block["levels"][0].as_py())
            found = [[*({"before": a, "after": b} for a, b in steps), *top] for steps in own]
            same = {x: pa.array([upper[x][0].as_py()] * len(block), pa.string()) for x in ("subroot", "root")}
            return pa.table({**{x: block[x] for x in names}, "path": pa.array(found, kind), **same})

        return run

    for k in range(len(rounds) - 2, -1, -1):
        fields = "tree string, idx long" + (f", h string, {keep}" if k == 0 else "")
        names = [x.split()[0] for x in fields.split(", ")]
        nodes = _blocks(rounds[k].select(*dict.fromkeys([*names, "h", "height"])), k * LEVELS)
        grouped = nodes.groupBy("tree", "block").cogroup(paths.groupBy("tree", "idx"))
        paths = grouped.applyInArrow(runner(names), f"{fields}, {PATH}")
        if k:
            paths = work.save(paths, f"{name}-paths{k}")
    if len(rounds) == 1:  # every tree is one node
        paths = rounds[0].select("tree", "idx", "h", *[x.split()[0] for x in keep.split(", ")]).join(paths.drop("idx"), "tree")
    return paths


def proofs(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS, more: dict[str, Column] | None = None) -> DataFrame:
    """A row a document: key, group, idx (its place in the group), leaf, path (steps from leaf to root: siblings before and after), subroot, root.

    more: further string columns of the rows to pass through.
    """
    more = more or {}
    work = Workspace(docs.sparkSession, "merkle")
    kind = docs.schema[key].dataType.simpleString()
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))  # null before the empty group, then by bytes
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf_hash(*fields).alias("h"), *[c.alias(f"more_{n}") for n, c in more.items()])
    rounds = ascend(numbered(rows, work, "nodes"), work, "nodes")
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("key"), "h")
    tops = ascend(numbered(subroots, work, "subroots"), work, "subroots")
    empty = F.array().cast(f"array<{STEP}>").alias("path")
    top = tops[-1].select("tree", empty, F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    above = descend(tops, top, work, "subroots", "key string").select(F.col("key").alias("tree"), "path", F.col("h").alias("subroot"), "root")
    above = work.save(above, "above")
    keep = ", ".join([f"key {kind}", *[f"more_{n} string" for n in more]])
    out = descend(rounds, above, work, "nodes", keep)
    said = F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))
    return out.select(F.col("key").alias(key), said.alias(group), "idx", F.col("h").alias("leaf"), "path", "subroot", "root", *[F.col(f"more_{n}").alias(n) for n in more])


def roots(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS) -> DataFrame:
    """The manifest's head: group, n_leaves, subroot, root."""
    found = proofs(docs, key, group, fields)
    return found.groupBy(group, "subroot", "root").agg(F.count(F.lit(1)).alias("n_leaves")).select(group, "n_leaves", "subroot", "root")
