"""Line dedup over levelled sorted runs of line hashes.

A run is a table (k1, k2, n) sorted by 128 bits of SHA-256 of a line's key, n the documents that hold it. Each batch of
documents is counted, anti-joined against the lines that the runs already hold often enough (their count is settled)
and written as a run of level 0; when a level has `fanout` runs they merge into one of the next level. So a line is
rewritten once a level, log(batches) times in all, and a later batch is judged against all earlier ones.

Documents are counted with sums before every shuffle: a line of a third of all documents is one row a task. No line
list, count or document is gathered in one task or on the driver. A document's own lines are handled in one row, in time
that grows with them (and their sorting).

Defined cases: null or empty text is one empty line, whose key is shorter than min_chars and stays (for min_chars >= 1);
repeated rows and documents with one doc_id count as documents each; an empty table gives an empty result. A line that
repeats inside a document counts once. Extra columns pass through; text, n_lines and n_dropped are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import hot_keys, skewed_join
from .store import Workspace
from .text import SPACE, digest, fresh, halves, two_hashes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def once(value: Column, use) -> Column:
    """use(value), with value computed once however often `use` reads it."""
    return F.transform(F.array(value), use)[0]


def key_hashes(text: str, min_chars: int) -> Column:
    """For each line the hashes of its key, null where the key is too short to count."""

    said = F.transform(F.transform(lines(text), line_key), lambda key: F.when(F.length(key) >= min_chars, digest(key)))
    return F.transform(said, lambda d: F.when(d.isNotNull(), F.struct(*[h.alias(n) for h, n in zip(halves(d), ("k1", "k2"))])))


def distinct_keys(keys: Column) -> Column:
    """The different hashes of a document, by sorting."""
    return once(F.array_sort(F.filter(keys, lambda k: k.isNotNull())), lambda s: F.filter(s, lambda k, i: (i == 0) | (k != F.get(s, i - 1))))


class LineRuns:
    """Runs by level. add() takes a batch of line counts, settled() gives the lines found in min_docs documents or more."""

    def __init__(self, work: Workspace, min_docs: int, fanout: int = 4):
        self.work, self.min_docs, self.fanout = work, min_docs, fanout
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.made = 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for _, run in level]

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy("k1", "k2").agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame) -> None:
        """counts: (k1, k2, n), one row a line."""
        for run in self.runs():
            counts = counts.join(run.where(F.col("n") >= self.min_docs).select("k1", "k2"), ["k1", "k2"], "left_anti")
        self._put(0, counts)

    def _put(self, level: int, run: DataFrame) -> None:
        self.made += 1
        name = f"run{self.made}"
        saved = self.work.save(run.select("k1", "k2", "n").sortWithinPartitions("k1", "k2"), name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, saved))
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(level + 1, self.merged([run for _, run in old]))
            self.work.drop(*[name for name, _ in old])

    def names(self) -> list[str]:
        return [name for level in self.levels for name, _ in level]

    def settled(self) -> DataFrame:
        runs = self.runs()
        return self.merged(runs).where(F.col("n") >= self.min_docs).select("k1", "k2")


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 4) -> DataFrame:
    """docs with text without the lines whose key occurs in min_docs documents or more, n_lines before, n_dropped.

    batches: documents arrive in so many parts by content hash, each an add() to the runs.
    """
    work = Workspace(docs.sparkSession, "lines")
    docs = docs.drop("n_lines", "n_dropped")
    h1, h2 = two_hashes("text")
    texts = docs.select(h1.alias("t1"), h2.alias("t2"), key_hashes("text", min_chars).alias("keys"))
    texts = work.save(texts.withColumn("batch", F.pmod("t2", F.lit(batches))), "texts", partition="batch")
    runs = LineRuns(work, min_docs, fanout)
    for batch in range(batches):
        found = texts.where(F.col("batch") == batch).select(F.explode(distinct_keys(F.col("keys"))).alias("k"))
        runs.add(found.groupBy(F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")).agg(F.count(F.lit(1)).alias("n")))
    common = work.save(runs.settled(), "common")
    at = texts.select("t1", "t2", F.posexplode("keys").alias("pos", "k")).where("k is not null").select("t1", "t2", "pos", "k.k1", "k.k2")
    gone = at.join(common, ["k1", "k2"], "left_semi").groupBy("t1", "t2").agg(F.collect_set("pos").alias("gone"))
    gone = work.save(gone, "gone")
    often = work.save(hot_keys(texts.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")), "n", ["t1", "t2"]), "often")
    work.drop("texts", "common", *runs.names())
    x = fresh(docs.columns)
    renamed = {"t1": x + "t1", "t2": x + "t2"}
    drops = gone.select("t1", "t2", F.col("gone").alias(x + "gone")).withColumnsRenamed(renamed)
    listed = F.col(x + "gone")

    def kept(said):
        left = F.array_except(F.sequence(F.lit(0), F.size(said) - 1), listed)  # by a hash set
        return F.array_join(F.transform(left, lambda i: F.get(said, i)), "\n")

    dealt = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != "text" and isinstance(f.dataType, T.AtomicType)])
    out = skewed_join(docs.withColumns({x + "t1": h1, x + "t2": h2}), drops, [x + "t1", x + "t2"], often.withColumnsRenamed(renamed), dealt, "left")
    text = F.when(listed.isNotNull(), once(lines(), kept)).otherwise(F.coalesce("text", F.lit("")))
    out = out.withColumns({"n_lines": F.size(lines()).cast("long"), "n_dropped": F.coalesce(F.size(listed), F.lit(0)).cast("long"), "text": text})
    return out.select(*docs.columns, "n_lines", "n_dropped")
