"""Mixing sources to target weights by hash-threshold histograms (native: DataFrame functions only).

A document's place is a 60-bit hash of its id and text. A source takes every document below its threshold once more
than the others, so a smaller budget always takes a subset of a larger one. Thresholds come from histograms of
words by (source, 10 hash bits): a running sum over at most 1024 buckets a source finds the bucket in which the budget
falls, and only that bucket is refined by the next 10 bits, until it holds a single hash. Documents are never sorted
and never leave their partition; a histogram is summed before it is shuffled, so a hot source costs no more than any.

Rows that agree in id and text share a hash. Where the budget falls among such rows, as many of them are taken as come
nearest: only these rows are written, numbered where they lie, and counted by partition.

Defined cases: null or empty text has size 0; a null source is a source of its own, the last; of rows that agree in id
and text some may be taken once more than others; no documents or no words give targets of 0 and nothing taken. Targets
are computed over one row a source in one task.
Extra columns pass through; columns named like the ones that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Workspace
from .text import fresh, n_words

HASH_BITS, LEVEL_BITS = 60, 10
ADDED = ("size", "source_size", "target", "copies", "taken")


def place(doc_id: str = "doc_id", text: str = "text"):
    """The 60-bit hash that orders a source's documents."""
    said = F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def source_key(source: str = "source"):
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))


def targets(sizes: DataFrame, weights=(5, 2, 1), budget: float = 1.5, most: int = 2) -> DataFrame:
    """_key, source_size -> also target. One row a source: the water level of budget * words over weights, each source capped at most * its size."""
    order = Window.orderBy(F.col("_key").startswith("n"), "_key")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_key")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        weighed.withColumn("_cap", F.col("source_size") * most)
        .withColumn("_left", F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.sum("_w").over(after))
        .withColumn("_level", F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(everything))
    )
    target = F.coalesce(F.least(F.col("_level") * F.col("_w"), F.col("_cap").cast("double")), F.col("_cap").cast("double"))
    return level.select("_key", "source_size", F.round(target, 6).alias("target"))


def mix_sources(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, most: int = 2) -> DataFrame:
    """docs with size, source_size, target, copies (0 to most) and taken = size * copies.

    weights repeat over the sources in code point order. most must be whole: a document is taken whole or not at all.
    """
    spark, work = docs.sparkSession, Workspace(docs.sparkSession, "mixing")
    docs = docs.drop(*ADDED)
    x = fresh(docs.columns)
    marked = docs.withColumns({x + "key": source_key(), "size": n_words("text"), x + "h": place()})
    slim = work.save(marked.select(F.col(x + "key").alias("_key"), "size", F.col(x + "h").alias("_h")), "slim")
    sizes = slim.groupBy("_key").agg(F.sum("size").alias("source_size"))
    state = targets(sizes, weights, budget, most).withColumns(
        {"_whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")}
    )
    state = state.withColumns(
        {"_rest": F.col("target") - F.col("_whole") * F.col("source_size"), "_prefix": F.lit(0).cast("long"), "_low": F.lit(0).cast("long"), "_cut": F.lit(None).cast("long"), "_some": F.lit(0).cast("long"), "_of": F.lit(0).cast("long")}
    )
    state = work.save(state.withColumn("_cut", F.when(F.col("_rest") <= 0, F.lit(0).cast("long"))), "level0")
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        state = work.save(refine(slim, state, HASH_BITS - level * LEVEL_BITS), f"level{level}")
        work.drop(f"level{level - 1}")
        if not state.where("_cut is null").limit(1).count():
            break
    found = state.select(F.col("_key").alias(x + "key"), "source_size", "target", *[F.col("_" + c).alias(x + c) for c in ("whole", "cut", "some", "of")])
    out = marked.join(found, x + "key", "left")
    tied = (F.col(x + "of") > 1) & (F.col(x + "h") == F.col(x + "cut"))
    more = (F.col(x + "h") < F.col(x + "cut")) | ((F.col(x + "h") == F.col(x + "cut")) & (F.col(x + "some") > 0))
    if state.where("_of > 1").limit(1).count():
        rows = numbered(work.save(out.where(tied).withColumn(x + "row", F.monotonically_increasing_id()), "tied"), x)
        more_tied = F.col(x + "turn") <= F.col(x + "some")
        out = out.where(~F.coalesce(tied, F.lit(False))).withColumn(x + "more", more).unionByName(rows.withColumn(x + "more", more_tied).select(*out.columns, x + "more"))
    else:
        out = out.withColumn(x + "more", more)
    copies = (F.col(x + "whole") + F.coalesce(F.col(x + "more"), F.lit(False)).cast("long")).cast("long")
    return out.withColumns({"copies": copies, "taken": F.col("size") * copies}).select(*docs.columns, *ADDED)


def numbered(rows: DataFrame, x: str) -> DataFrame:
    """rows with x + turn, from 1 in each source: their turn in the partition that wrote them, after all of the partitions before."""
    key, part = x + "key", x + "part"
    rows = rows.withColumn(part, F.shiftright(x + "row", 33))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(key, part).agg(F.count(F.lit(1)).alias(x + "n"))
    counts = counts.select(key, part, F.coalesce(F.sum(x + "n").over(before), F.lit(0)).alias(x + "before"))
    here = F.row_number().over(Window.partitionBy(key, part).orderBy(x + "row"))
    return rows.withColumn(x + "here", here).join(counts, [key, part]).withColumn(x + "turn", F.col(x + "here") + F.col(x + "before"))


def refine(slim: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """One level: the bucket in which a source's rest falls; its threshold once that bucket holds one hash only."""
    open_ = state.where("_cut is null").select("_key", "_prefix", "_low", "_rest")
    histogram = (
        slim.join(open_, "_key")
        .where(F.shiftright("_h", shift + LEVEL_BITS) == F.col("_prefix"))
        .groupBy("_key", F.shiftright("_h", shift).alias("_bucket"))
        .agg(F.sum("size").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min("_h").alias("_least"), F.max("_h").alias("_most"), F.first("_low").alias("_low0"), F.first("_rest").alias("_r"))
    )
    upto = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        histogram.withColumn("_sum", F.col("_low0") + F.sum("_n").over(upto))
        .where(F.col("_sum") >= F.col("_r"))
        .groupBy("_key")
        .agg(F.min_by(F.struct("_bucket", "_n", "_rows", "_least", "_most", "_sum"), "_bucket").alias("_b"))
        .select("_key", "_b.*")
    )
    low = F.col("_sum") - F.col("_n")
    one = F.col("_least") == F.col("_most")
    cut = (
        F.when(F.col("_cut").isNotNull(), F.col("_cut"))
        .when(F.col("_bucket").isNull(), F.lit(1 << HASH_BITS).cast("long"))  # the rest is beyond all documents, by rounding
        .when(one, F.col("_least"))
    )
    decided = F.col("_cut").isNull() & one
    some = F.ceil((F.col("_rest") - low) * F.col("_rows") / F.col("_n") - 0.5).cast("long")  # of equal rows, as many as come nearest
    kept = ["_key", "source_size", "target", "_whole", "_rest"]
    return state.join(found, "_key", "left").select(
        *kept, F.coalesce("_bucket", "_prefix").alias("_prefix"), F.when(F.col("_bucket").isNull(), F.col("_low")).otherwise(low).cast("long").alias("_low"), cut.alias("_cut"),
        F.when(decided, some).otherwise(F.col("_some")).alias("_some"), F.when(decided, F.col("_rows")).otherwise(F.col("_of")).alias("_of"),
    )
