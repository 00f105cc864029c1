"""Substring dedup: repeated windows of words, found in a compacted De Bruijn graph.

Edges are the windows of WINDOW consecutive words. Windows that share their minimizer (the least hash among their
ANCHOR-grams, leftmost on ties) follow each other, so a text is a chain of super-edges, some 15 windows each,
and only their anchors are shuffled at first. Equal windows have equal anchors at equal offsets:

1. anchors seen once are dropped (summed counts, then a semi join);
2. the super-edges left are read again from the texts; equal ones, by a digest of their words, collapse to one row with
   its multiplicity and one source coordinate; where an anchor has one super-edge only, its windows repeat as often as it;
3. super-edges that share an anchor with others are read once more at their source coordinates, and their windows are
   counted one by one, by a digest of the window's own words;
4. repeated super-edges are joined with their neighbours in the texts; links without a branch on either side compact
   into paths, whose source coordinates (text, first and last window) give the spans of words to remove.

Hashes of words only choose anchors, where a collision costs time. What is called equal has equal words by 128 bits of
BLAKE2b over the words themselves, joined by a space, read at the source coordinates.

Everything is counted by sums before a shuffle. Joins in which one key may hold a third of the rows deal it over many
tasks (skew.py); a text's spans are together in one row, groups of texts never are. Work follows the words and the
repeats, not their squares.

Defined cases: null text has no words; texts shorter than WINDOW keep all words; repeated rows repeat each other's
windows, so copies of WINDOW words or more lose all of them; a window that overlaps its own repeat counts too. Extra
columns pass through; text, n_words and n_removed are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .skew import hot_keys, skewed_join
from .store import Workspace

WINDOW, ANCHOR = 35, 8


def super_edges(h: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window, anchor's place and anchor's hash of each super-edge of a chunk; h: word hashes."""
    none = np.zeros(0, np.int64)
    m = len(h) - window + 1
    if m <= 0:
        return none, none, none, none.astype(np.uint64)
    grams = X.gram_hashes(h, anchor)
    span, size = window - anchor + 1, 1
    low, place = grams, np.arange(len(grams))

    def least(u, p, v, q):  # the left one on ties
        left = u <= v
        return np.where(left, u, v), np.where(left, p, q)

    while size * 2 <= span:
        low, place = least(low[:-size], place[:-size], low[size:], place[size:])
        size *= 2
    far = span - size
    low, place = least(low[:m], place[:m], low[far : far + m], place[far : far + m])
    at = np.flatnonzero(X.within(first, window, len(h)))
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    place = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    return at[begin], at[end], place[begin], grams[place[begin]]


class Chunk:
    """Words of a chunk of texts: bounds, hashes, first word of each text, and runs of words as they are compared."""

    def __init__(self, column: pa.Array):
        self.raw, at = X.buffers(column)
        self.starts, self.ends, self.first = X.words(self.raw, at)

    def hashes(self) -> np.ndarray:
        return X.word_hashes(self.raw, self.starts, self.ends)

    def joined(self) -> tuple[memoryview, np.ndarray]:
        """All words with a space after each, and where each begins."""
        size = self.ends - self.starts
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(int(begin[-1]), 32, np.uint8)
        at = np.repeat(begin[:-1] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        out[at] = self.raw[np.repeat(self.starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
        return memoryview(out), begin

    def digests(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """128 bits of each run of words from low to high (not included), as two int64."""
        said, begin = self.joined()
        both = b"".join([hashlib.blake2b(said[a:b], digest_size=16).digest() for a, b in zip(begin[low].tolist(), begin[high].tolist())])
        return np.frombuffer(both, np.int64).reshape(-1, 2)


def anchors(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """k, t1, t2, s0 (first window in the text) of each super-edge; texts: t1, t2, text."""

    def run(batches):
        for batch in batches:
            t1, t2 = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for a, b in X.slices(batch.column(2)):
                chunk = Chunk(batch.column(2).slice(a, b - a))
                s0, _, _, k = super_edges(chunk.hashes(), chunk.first, window, anchor)
                doc = np.searchsorted(chunk.first, s0, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(t1[a:b][doc]), pa.array(t2[a:b][doc]), pa.array((s0 - chunk.first[doc]).astype(np.int32))], ["k", "t1", "t2", "s0"])

    return texts.select("t1", "t2", "text").mapInArrow(run, "k long, t1 long, t2 long, s0 int")


KEY = ("k", "shift", "d1", "d2")
EDGE = "t1 long, t2 long, copies long, s0 int, n int, k long, shift int, d1 long, d2 long"


def edges(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """EDGE of the super-edges of texts (t1, t2, copies, starts, text) that begin at starts: n windows, whose first lies `shift` before the anchor."""

    def run(batches):
        for batch in batches:
            t1, t2, copies = (np.asarray(batch.column(i)) for i in range(3))
            for a, b in X.slices(batch.column(4)):
                chunk = Chunk(batch.column(4).slice(a, b - a))
                s0, s1, place, k = super_edges(chunk.hashes(), chunk.first, window, anchor)
                wanted = np.concatenate([np.asarray(x, np.int64) + f for x, f in zip(batch.column(3).slice(a, b - a).to_pylist(), chunk.first)] or [np.zeros(0, np.int64)])
                ok = np.isin(s0, wanted)
                s0, s1, place, k = s0[ok], s1[ok], place[ok], k[ok]
                doc = np.searchsorted(chunk.first, s0, "right") - 1
                d = chunk.digests(s0, s1 + window)
                made = [
                    t1[a:b][doc], t2[a:b][doc], copies[a:b][doc], (s0 - chunk.first[doc]).astype(np.int32), (s1 - s0 + 1).astype(np.int32), k.view(np.int64), (place - s0).astype(np.int32), d[:, 0], d[:, 1]
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], [x.split()[0] for x in EDGE.split(", ")])

    return texts.select("t1", "t2", "copies", "starts", "text").mapInArrow(run, EDGE)


WINDOWS = "k long, shift int, d1 long, d2 long, copies long, w1 array<long>, w2 array<long>"


def window_digests(texts: DataFrame, window: int) -> DataFrame:
    """WINDOWS: digests of all windows of the super-edges asked for; texts: text, asked (array of s0, n, k, shift, d1, d2, copies)."""

    def run(batches):
        for batch in batches:
            for a, b in X.slices(batch.column(0)):
                chunk = Chunk(batch.column(0).slice(a, b - a))
                asked = batch.column(1).slice(a, b - a)
                rows = asked.flatten()
                s0, n = (np.asarray(rows.field(x)).astype(np.int64) for x in ("s0", "n"))
                s0 = s0 + np.repeat(chunk.first[:-1], np.asarray(asked.value_lengths()))
                low = np.repeat(s0 - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                d = chunk.digests(low, low + window)
                cut = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(np.ascontiguousarray(d[:, i]))) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*(rows.field(x) for x in (*KEY, "copies")), *lists], [x.split()[0] for x in WINDOWS.split(", ")])

    return texts.select("text", "asked").mapInArrow(run, WINDOWS)


def repeated_windows(distinct: DataFrame, one: DataFrame, window: int, work: Workspace) -> DataFrame:
    """KEY, lo, hi: runs of repeated windows inside each distinct super-edge, as offsets."""
    key = list(KEY)
    lone = distinct.groupBy("k").agg(F.count(F.lit(1)).alias("edges")).where("edges = 1").select("k", F.lit(True).alias("alone"))
    told = work.save(distinct.join(work.save(lone, "lone"), "k", "left"), "told")
    whole = told.where("alone and copies > 1").select(*key, F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))
    asked = told.where("alone is null").groupBy("t1", "t2").agg(F.collect_list(F.struct("s0", "n", *key, "copies")).alias("asked"))  # places in one text
    mixed = work.save(window_digests(one.join(asked, ["t1", "t2"]), window), "windows")
    mixed = mixed.select(*key, "copies", F.posexplode(F.arrays_zip("w1", "w2")).alias("at", "w")).select(*key, "copies", "at", "w.w1", "w.w2")
    twice = work.save(mixed.groupBy("w1", "w2").agg(F.sum("copies").alias("c")).where("c > 1").select("w1", "w2"), "twice")
    bits = mixed.join(twice, ["w1", "w2"], "left_semi").groupBy(*key).agg(F.collect_list("at").alias("at"))  # at most WINDOW - ANCHOR + 1
    run = Window.partitionBy(*key).orderBy("at")
    single = bits.select(*key, F.explode("at").alias("at")).withColumn("run", F.col("at") - F.row_number().over(run))
    partial = single.groupBy(*key, "run").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).drop("run")
    out = work.save(whole.unionByName(partial.select(whole.columns)), "runs")
    work.drop("lone", "told", "windows", "twice")
    return out


def paths(found: DataFrame, runs: DataFrame, work: Workspace) -> DataFrame:
    """t1, t2, first, last: windows of the compacted repeated paths at each of their source coordinates."""
    key = list(KEY)
    dealt = F.xxhash64("t1", "t2", "s0")
    hot = work.save(hot_keys(found.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "n", key), "hot")
    # a key's runs as one row; an edge's name is its key and where in it the run begins
    listed = runs.groupBy(*key).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))  # at most half of WINDOW - ANCHOR + 1
    here = skewed_join(found.select("t1", "t2", "s0", *key), listed, key, hot, dealt).select("t1", "t2", "s0", *key, F.explode("runs").alias("r"))
    here = here.select("t1", "t2", F.xxhash64(*key, "r.lo").alias("edge"), (F.col("s0") + F.col("r.lo")).alias("first"), (F.col("s0") + F.col("r.hi")).alias("last"))
    text = Window.partitionBy("t1", "t2").orderBy("first")
    linked = work.save(here.withColumn("before", F.when(F.lag("last").over(text) + 1 == F.col("first"), F.lag("edge").over(text))), "linked")
    links = work.save(linked.where("before is not null").groupBy("before", "edge").agg(F.count(F.lit(1)).alias("n")), "links")
    ahead = links.groupBy("before").agg(F.count(F.lit(1)).alias("out"))
    behind = links.groupBy("edge").agg(F.count(F.lit(1)).alias("into"))
    plain = links.join(ahead.where("out = 1"), "before", "left_semi").join(behind.where("into = 1"), "edge", "left_semi").select("before", "edge", F.lit(True).alias("joined"))
    often = hot_keys(links, "n", ["before", "edge"])
    parts = skewed_join(linked, plain, ["before", "edge"], work.save(often, "often"), F.xxhash64("t1", "t2", "first"), "left")
    parts = parts.withColumn("path", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(text))
    return parts.groupBy("t1", "t2", "path").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("path")


def remove(docs: DataFrame, window: int, prefix: str) -> DataFrame:
    """docs (with prefix + first, prefix + last: arrays of window spans, or null) without the words covered; words joined by one space."""
    spans = (prefix + "first", prefix + "last")
    plain = [f for f in docs.schema.fields if f.name not in spans]
    names = [f.name for f in plain]
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "text" else f for f in plain] + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            lows, highs = (batch.column(batch.schema.get_field_index(x)) for x in spans)
            for a, b in X.slices(column):
                raw, at = X.buffers(column.slice(a, b - a))
                starts, ends, first = X.words(raw, at)
                gone = np.zeros(len(starts) + 1, np.int64)
                for d, (lo, hi) in enumerate(zip(lows.slice(a, b - a).to_pylist(), highs.slice(a, b - a).to_pylist())):
                    if lo:
                        np.add.at(gone, first[d] + np.asarray(lo), 1)
                        np.add.at(gone, first[d] + np.asarray(hi) + window, -1)
                kept = np.cumsum(gone[:-1]) == 0
                n_kept = np.diff(np.concatenate([[0], np.cumsum(kept)])[first])
                doc = np.searchsorted(first, np.flatnonzero(kept), "right") - 1
                step = np.zeros(len(raw) + 1, np.int64)
                step[starts[kept]] += 1
                step[ends[kept]] -= 1
                hold = np.cumsum(step[:-1]) > 0
                if len(doc):
                    more = np.append(doc[1:] == doc[:-1], False)  # a space after each word but the last of its document
                    gap = ends[kept][more]
                    raw = raw.copy()
                    raw[gap] = 32
                    hold[gap] = True
                size = np.concatenate([[0], np.cumsum(hold)])[at]
                text = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(raw[hold].tobytes())).cast(pa.string())
                part = batch.slice(a, b - a)
                words = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [*[text if x == "text" else part.column(part.schema.get_field_index(x)) for x in names], pa.array(words), pa.array(words - n_kept)], [*names, "n_words", "n_removed"]
                )

    return docs.mapInArrow(run, schema)


def drop_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """docs with text without the words that a repeated window covers (the rest joined by one space), n_words before, n_removed."""
    spark, work = docs.sparkSession, Workspace(docs.sparkSession, "substring")
    docs = docs.drop("n_words", "n_removed")
    h1, h2 = X.two_hashes("text")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(h1.alias("t1"), h2.alias("t2"), "text")
    every = work.save(anchors(texts, window, anchor), "anchors")
    # written, so that the join reads two plain shuffles, of which Spark can split a hot anchor's
    twice = work.save(every.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k"), "twice")
    starts = every.join(twice, "k", "left_semi").groupBy("t1", "t2").agg(F.collect_set("s0").alias("starts"))  # places in one text
    starts = work.save(starts, "starts")
    work.drop("anchors", "twice")
    one = texts.groupBy("t1", "t2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    one = work.save(one.join(starts, ["t1", "t2"]), "one")
    work.drop("starts")
    found = work.save(edges(one, window, anchor), "edges")
    copied = work.save(hot_keys(one, "copies", ["t1", "t2"]), "copied")
    distinct = found.groupBy(*KEY).agg(F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in ("n", "t1", "t2", "s0")])
    distinct = work.save(distinct, "distinct")
    runs = repeated_windows(distinct, one, window, work)
    work.drop("distinct", "one")
    spans = paths(found, runs, work).groupBy("t1", "t2").agg(F.collect_list("first").alias("_first"), F.collect_list("last").alias("_last"))
    spans = work.save(spans, "spans")
    work.drop("edges", "runs", "linked", "links", "hot", "often")
    g1, g2 = X.two_hashes(F.coalesce("text", F.lit("")))
    x = X.fresh(docs.columns)
    key = [x + "t1", x + "t2"]
    renamed = {"t1": x + "t1", "t2": x + "t2", "_first": x + "first", "_last": x + "last"}
    rows = docs.withColumns({x + "t1": g1, x + "t2": g2})
    dealt = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != "text" and isinstance(f.dataType, T.AtomicType)])
    marked = skewed_join(rows, spans.withColumnsRenamed(renamed), key, copied.withColumnsRenamed(renamed), dealt, "left")
    return remove(marked.select(*docs.columns, x + "first", x + "last"), window, x)
