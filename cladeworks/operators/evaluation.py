"""Ranking ablation and detection metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranks(scores: DataFrame) -> DataFrame:
    """marker_id, rank by falling score, ties share the first place (competition ranks); unmeasured scores have none."""
    return scores.where("score is not null").withColumn("rank", F.rank().over(Window.orderBy(F.col("score").desc()))).select("marker_id", "rank")


def displacement(baseline: DataFrame, ablated: DataFrame) -> DataFrame:
    """marker_id, rank_baseline, rank_ablated, displacement, presence (both, baseline_only, ablated_only)."""
    a, b = ranks(baseline).alias("a"), ranks(ablated).alias("b")
    joined = a.join(b, F.col("a.marker_id") == F.col("b.marker_id"), "full_outer")
    x, y = F.col("a.rank"), F.col("b.rank")
    return joined.select(F.coalesce("a.marker_id", "b.marker_id").alias("marker_id"), x.alias("rank_baseline"), y.alias("rank_ablated"), (y - x).alias("displacement"), F.when(x.isNull(), "ablated_only").when(y.isNull(), "baseline_only").otherwise("both").alias("presence"))


BUCKETS = 200  # ranges of values; what one task counts is about a 200th of the distinct pairs


def balance(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> int:
    """Concordant less discordant weight, w_i w_j sign(x_i - x_j) sign(y_i - y_j) over all pairs, by merging: pairs (x, y) are distinct.

    Sorted by x, then y, each level of the merge asks for every right half how much of its left half is smaller and how much larger.
    """
    order = np.lexsort((y, x))
    x, w = x[order], w[order].astype(np.int64)
    _, rank = np.unique(y[order], return_inverse=True)
    n, span, total = len(x), int(rank.max(initial=0)) + 1, 0
    place = np.arange(n, dtype=np.int64)
    size = 1
    while size < n:
        block = place // (2 * size)
        left = (place // size) % 2 == 0
        keys = block[left] * span + rank[left]
        by = np.argsort(keys, kind="stable")
        keys, upto = keys[by], np.concatenate([[0], np.cumsum(w[left][by])])
        b, r = block[~left], rank[~left]
        low, at, past, end = (np.searchsorted(keys, b * span + k) for k in (0, r, r + 1, span))
        less, more = upto[at] - upto[low], upto[end] - upto[past]
        total += sum(((less - more) * w[~left]).tolist())  # Python integers don't overflow
        size *= 2
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if n else np.zeros(0, int)
    tied = zip(np.add.reduceat(w, starts).tolist(), np.add.reduceat(w * w, starts).tolist()) if n else ()
    return total - sum((a * a - b) // 2 for a, b in tied)  # of one x, in order of y


def _balances(rows: DataFrame, key: str | None, x: str, y: str) -> DataFrame:
    """s of each group (all rows for None): the balance of its distinct (x, y) with weights m."""

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"s": pa.array([str(balance(*(np.asarray(table[c]) for c in (x, y, "m"))))])})

    grouped = rows.groupBy(key) if key else rows.groupBy()
    return grouped.applyInArrow(run, "s string").select(F.col("s").cast("decimal(38,0)").alias("s"))


def _bucket(value: str, bounds: list[float]) -> Column:
    """2 k + 1 for the k-th bound itself, 2 k for what lies below it and above the one before: a value that is very frequent is a bucket of its own."""
    known = F.lit(np.array(bounds, dtype=float)) if bounds else F.array().cast("array<double>")
    below = F.size(F.filter(known, lambda b: b < F.col(value)))
    return (2 * below + F.array_contains(known, F.col(value)).cast("int")).cast("int")


def kendall_tau(scores: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row of tau-b over (a, b): concordant less discordant pairs over the untied, in n log n.

    Values are cut into ranges at quantiles (at most `buckets` numbers a column reach the driver). Pairs in one range of a are
    counted there by merging; pairs across ranges of a are counted from the matrix of weights if their ranges of b
    differ, and inside the range of b, summed by range of a, if not. No two rows are joined. Null or NaN: not measured.
    """
    whole = scores.select(F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b")).where("a is not null and b is not null and not isnan(a) and not isnan(b)")
    cells = whole.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"))
    cuts = cells.approxQuantile(["a", "b"], [(k + 1) / buckets for k in range(buckets - 1)], 0.2 / buckets)
    cuts = [sorted(set(c)) for c in cuts] or [[], []]
    cells = cells.select("a", "b", "m", _bucket("a", cuts[0]).alias("p"), _bucket("b", cuts[1]).alias("q"))
    inside = _balances(cells.where("p % 2 = 0"), "p", "a", "b")  # one value of a has no pairs
    across = _balances(cells.groupBy("p", "q").agg(F.sum("m").alias("m")), None, "p", "q")  # at most (2 * buckets) ** 2 rows
    level = _balances(cells.where("q % 2 = 0").groupBy("q", "p", "b").agg(F.sum("m").alias("m")), "q", "p", "b")
    balanced = inside.unionByName(across).unionByName(level).agg(F.coalesce(F.sum("s"), F.lit(0)).cast("double").alias("s"))
    pairs = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(19,0)") * (F.col(c) - 1) / 2), F.lit(0)).cast("double")
    ties_a = cells.groupBy("a").agg(F.sum("m").alias("n")).agg(pairs("n").alias("ta"))
    ties_b = cells.groupBy("b").agg(F.sum("m").alias("n")).agg(pairs("n").alias("tb"))
    total = cells.agg(F.sum("m").alias("n")).agg(pairs("n").alias("total"))
    row = balanced.crossJoin(ties_a).crossJoin(ties_b).crossJoin(total)  # one row each
    root = F.sqrt((F.col("total") - F.col("ta")) * (F.col("total") - F.col("tb")))
    return row.select(F.when(root > 0, F.col("s") / root).alias("tau"))


def one_factor(baseline: dict, ablated: dict) -> str:
    """The one key in which two configurations differ; any other number is refused."""
    keys = [k for k in sorted({*baseline, *ablated}) if baseline.get(k) != ablated.get(k)]
    if len(keys) != 1:
        raise ValueError(f"an ablation changes one factor, not {len(keys)}: {keys}")
    return keys[0]


def detection(truth: DataFrame, called: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1; 0 where a denominator is 0."""
    t, c = truth.select("marker_id").distinct().withColumn("t", F.lit(1)), called.select("marker_id").distinct().withColumn("c", F.lit(1))
    n = t.join(c, "marker_id", "full_outer").agg(F.count_if(F.col("t").isNotNull() & F.col("c").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("c").isNull()).alias("fn"))
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / (F.col("tp") + F.col("fn"))
    n = n.withColumns({"precision": F.when(F.col("tp") + F.col("fp") > 0, p).otherwise(0.0), "recall": F.when(F.col("tp") + F.col("fn") > 0, r).otherwise(0.0)})
    both = F.col("precision") + F.col("recall")
    return n.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0))


def resampled(rows: DataFrame, place: str, n: int, resamples: int, seed: int = 0) -> DataFrame:
    """rows, each with k (the resample, from 1) and times, how often it was drawn: n draws with replacement from n rows in every resample, and no row for none.

    place numbers the rows from 0. Draw j of resample k falls on a place that a hash of (seed, k, j) gives, so draws are rows of
    Spark's, summed where they are made, and each resample has exactly n of them.
    """
    draws = rows.sparkSession.range(n * resamples).select((F.floor(F.col("id") / n) + 1).cast("int").alias("k"), "id")
    sha = F.sha2(F.concat_ws(":", F.lit(seed), "id"), 256)
    at = F.pmod(F.conv(F.substring(sha, 1, 15), 16, 10).cast("long"), F.lit(n))
    times = draws.select("k", at.alias(place)).groupBy("k", place).agg(F.count(F.lit(1)).alias("times"))
    return times.join(rows, place)


def bootstrap_f1(truth: DataFrame, called: DataFrame, names: DataFrame, resamples: int = 1000, seed: int = 0) -> DataFrame:
    """f1, low, high: F1 over the names (marker_id), and the 95 % interval over resamples of as many names, drawn with replacement."""
    t, c = truth.select("marker_id").distinct().withColumn("t", F.lit(True)), called.select("marker_id").distinct().withColumn("c", F.lit(True))
    rows = names.select("marker_id").distinct().join(t, "marker_id", "left").join(c, "marker_id", "left").fillna(False, ["t", "c"])
    rows = rows.withColumn("place", F.row_number().over(Window.orderBy("marker_id")) - 1)  # a row a marker
    n = rows.count()
    hit, miss = F.col("t") & F.col("c"), F.col("t") != F.col("c")

    def f1(df: DataFrame, weight: Column, by: list[str]) -> DataFrame:
        sums = df.groupBy(*by).agg(F.sum(F.when(hit, weight).otherwise(0)).alias("tp"), F.sum(F.when(miss, weight).otherwise(0)).alias("miss"))
        return sums.select(*by, F.when(F.col("tp") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("miss"))).otherwise(0.0).alias("f1"))

    if not n:
        return names.sparkSession.createDataFrame([(None, None, None)], "f1 double, low double, high double")
    drawn = f1(resampled(rows, "place", n, resamples, seed), F.col("times"), ["k"])
    return f1(rows, F.lit(1), []).crossJoin(drawn.agg(F.percentile("f1", 0.025).alias("low"), F.percentile("f1", 0.975).alias("high")))  # one row each
