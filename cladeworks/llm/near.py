"""N-gram Jaccard self join of documents by MinHash banding.

Texts are sets of five-word shingles (a shorter text is one shingle). Copies collapse to one row first. choose_bands()
finds rows and bands for the target recall at the threshold, and texts are shuffled on their band hashes. Mates are texts
of one bucket, and every two mates are verified on their full shingle sets, once, however many buckets they share:

* a text's home is its largest bucket; homes are cut into units of at most BLOCK texts or BLOCK_BYTES;
* all pairs inside a unit are verified together, by products of incidence matrices;
* two units are verified against each other if a bucket has members of both, and only the members of such buckets go there.

So buckets that chain through common text don't grow into one group: work follows the pairs of mates. A task returns a row
a text with its number of links and a spanning forest of the links, never the pairs themselves, so results stay in
proportion to the texts although no link between mates is lost. A popular bucket's rows are dealt over tasks (skew.py).

Result: a row a document with class_id (the smallest doc_id of its component of links and copies), n_copies (documents
with the same text, itself included) and n_links (different texts of similarity `threshold` or more).

Defined cases: null text counts as empty; texts without a word have no shingles and no links, but are copies of equal
texts; a null doc_id is never a class's id unless the class has no other; repeated rows are copies; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as X
from .components import components
from .skew import hot_keys, skewed_join
from .store import Workspace

SHINGLE, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 150
BLOCK, BLOCK_BYTES = 400, 16 << 20


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach the recall at the threshold within max_hashes."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        if threshold**rows < 1e-12:
            break
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def shingles(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk, in order, and the first of each document (n_docs + 1 entries)."""
    starts, ends, first = X.words(raw, at)
    h = X.word_hashes(raw, starts, ends)
    counts = np.diff(first)
    grams = X.gram_hashes(h, n)
    ok = X.within(first, n, len(h))
    out, sizes = grams[ok], np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.array([X.gram_hashes(h[first[d] : first[d + 1]], int(counts[d]))[0] for d in short], np.uint64)
        out = np.insert(out, np.concatenate([[0], np.cumsum(sizes)])[short], extra)
        sizes[short] = 1
    return out, np.concatenate([[0], np.cumsum(sizes)])


def band_hashes(raw: np.ndarray, at: np.ndarray, n: int, bands: int, rows: int) -> list[np.ndarray | None]:
    """Band hashes of each document; None without shingles."""
    grams, first = shingles(raw, at, n)
    full = np.flatnonzero(np.diff(first) > 0)
    out: list = [None] * (len(at) - 1)
    if not len(full):
        return out
    seeds = np.random.default_rng(7).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.zeros((len(full), bands), np.uint64)
    for i in range(bands * rows):
        low = np.minimum.reduceat(grams * seeds[i], first[full])
        keys[:, i // rows] = X.mixed(keys[:, i // rows] + low + np.uint64(i))
    for row, d in enumerate(full):
        out[d] = keys[row].view(np.int64)
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, t1, t2 (content hash), size (bytes), bands."""
    h1, h2 = X.two_hashes("text")
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    slim = slim.select("doc_id", h1.alias("t1"), h2.alias("t2"), F.octet_length("text").cast("long").alias("size"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(4)
            for a, b in X.slices(column):
                found = band_hashes(*X.buffers(column.slice(a, b - a)), n, bands, rows)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(found, pa.list_(pa.int64()))], ["doc_id", "t1", "t2", "size", "bands"])

    return slim.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, size long, bands array<long>")


def dealt_mates(texts: DataFrame, work: Workspace) -> DataFrame:
    """t1, t2, asked: the tasks (unit, other; equal for a unit's own pairs) that read each text which has a mate."""
    keys = texts.where("bands is not null").select("t1", "t2", "size", F.explode("bands").alias("key"))
    buckets = work.save(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    hot = hot_keys(buckets, "n", ["key"])
    by = F.xxhash64("t1", "t2")
    mates = work.save(skewed_join(keys, buckets, ["key"], hot, by), "mates")
    homes = mates.groupBy("t1", "t2").agg(F.max(F.struct("n", "key")).alias("home"), F.first("size").alias("size")).select("t1", "t2", F.col("home.key").alias("home"), "size")
    homes = work.save(homes, "homes")
    cuts = homes.groupBy("home").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_BYTES)).cast("long").alias("units"), F.count(F.lit(1)).alias("n"))
    unit = F.xxhash64("home", F.pmod("t2", F.col("units")))  # two units of one name would only be verified together
    units = skewed_join(homes, cuts.select("home", "units"), ["home"], hot_keys(cuts, "n", ["home"]), by).select("t1", "t2", unit.alias("unit"))
    units = work.save(units, "units")
    placed = work.save(mates.select("t1", "t2", "key").join(units, ["t1", "t2"]).select("t1", "t2", "key", "unit"), "placed")
    across = placed.groupBy("key").agg(F.sort_array(F.collect_set("unit")).alias("others")).where("size(others) > 1")  # a bucket's units
    across = work.save(across, "across")
    sets = work.save(across.groupBy("others").agg(F.min("key").alias("name")), "sets")  # many buckets have the same units: a text asks once a set
    shared = skewed_join(placed, across.join(sets, "others").select("key", "name"), ["key"], hot, by).select("t1", "t2", "unit", "name").distinct()
    shared = work.save(shared, "shared")
    often = hot_keys(shared.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "n", ["name"])
    others = skewed_join(shared, sets, ["name"], often, by).select("t1", "t2", "unit", "others")
    every = units.select("t1", "t2", "unit", F.array("unit").alias("others")).unionByName(others)
    task = F.transform(F.array_distinct(F.flatten("others")), lambda o: F.struct(F.least("unit", o).alias("a"), F.greatest("unit", o).alias("b")))
    asked = every.groupBy("t1", "t2", "unit").agg(F.collect_list("others").alias("others")).select("t1", "t2", "unit", task.alias("asked"))  # at most one list a band
    asked = work.save(asked, "asked")
    work.drop("buckets", "mates", "homes", "units", "placed", "across", "sets", "shared")
    return asked


VERIFIED = "t1 long, t2 long, links long, r1 long, r2 long"


def verify(table: pa.Table, n: int, threshold: float) -> pa.Table:
    """Links of one task: all pairs of a unit, or those across two units. A row a text: its links, the root of its tree."""
    across = table["a"][0].as_py() != table["b"][0].as_py()
    column = table["text"].combine_chunks() if table["text"].num_chunks != 1 else table["text"].chunk(0)
    side = np.asarray(table["unit"]) == table["a"][0].as_py()
    grams, first = shingles(*X.buffers(column), n)
    m = len(side)
    owner = np.repeat(np.arange(m), np.diff(first))
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    g, o = g[new], o[new]
    sizes = np.bincount(o, minlength=m).astype(np.float64)
    _, which, often = np.unique(g, return_inverse=True, return_counts=True)
    shared = often[which] > 1
    which, o = which[shared], o[shared]
    _, which = np.unique(which, return_inverse=True)
    order = np.argsort(which, kind="stable")
    which, o = which[order], o[order]
    both = np.zeros((m, m), np.float32)
    width, total = 4096, int(which[-1]) + 1 if len(which) else 0
    for at in range(0, total, width):
        a, b = np.searchsorted(which, [at, at + width])
        part = np.zeros((m, min(width, total - at)), np.float32)
        part[o[a:b], which[a:b] - at] = 1
        both += part @ part.T
    link = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    link &= (sizes[:, None] > 0) & (sizes[None, :] > 0)
    np.fill_diagonal(link, False)
    if across:
        link &= side[:, None] != side[None, :]
    root = np.arange(m)
    while True:  # the smallest neighbour's root, until nothing changes
        low = np.where(link, root[None, :], m).min(axis=1) if m else root
        new_root = np.minimum(root, low)
        new_root = new_root[new_root]
        if (new_root == root).all():
            break
        root = new_root
    t1, t2 = np.asarray(table["t1"]), np.asarray(table["t2"])
    return pa.table({"t1": t1, "t2": t2, "links": link.sum(axis=1).astype(np.int64), "r1": t1[root], "r2": t2[root]})


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """doc_id, t1, t2, class_id, n_copies, n_links, keeper: a row a document; keeper marks a class's one text and id."""
    work = Workspace(docs.sparkSession, "near")
    bands, rows = choose_bands(threshold, recall, max_hashes)
    every = work.save(signatures(docs, n, bands, rows), "signatures")
    texts = every.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    texts = work.save(texts.withColumn("t", F.struct("t1", "t2")), "texts")
    asked = dealt_mates(texts, work)
    h1, h2 = X.two_hashes("text")
    full_texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(h1.alias("t1"), h2.alias("t2"), "text").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    members = full_texts.join(asked, ["t1", "t2"]).select("t1", "t2", "text", "unit", F.explode("asked").alias("task")).select("t1", "t2", "text", "unit", "task.*")
    checked = work.save(members.groupBy("a", "b").applyInArrow(lambda table: verify(table, n, threshold), VERIFIED), "verified")
    work.drop("asked")
    links = checked.groupBy("t1", "t2").agg(F.sum("links").alias("n_links"))
    forest = checked.where("t1 <> r1 or t2 <> r2").select(F.struct(F.col("r1").alias("t1"), F.col("r2").alias("t2")).alias("u"), F.struct("t1", "t2").alias("v"))
    roots = components(forest, work, "classes").select("v.t1", "v.t2", "root")
    named = texts.select("t1", "t2", "t", "rep", "n_copies").join(links, ["t1", "t2"], "left").join(roots, ["t1", "t2"], "left")
    named = work.save(named.withColumns({"root": F.coalesce("root", "t"), "n_links": F.coalesce("n_links", F.lit(0).cast("long"))}), "named")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep"), F.col("t"))).alias("first"))
    classes = named.join(first, "root").select("t1", "t2", "n_copies", "n_links", F.col("first.rep").alias("class_id"), (F.col("t") == F.col("first.t")).alias("_keeps"))
    classes = work.save(classes, "named_classes")
    copied = hot_keys(classes, "n_copies", ["t1", "t2"])
    work.drop("texts", "verified", "named")
    dealt = F.xxhash64(F.spark_partition_id(), "doc_id")
    out = skewed_join(every.select("doc_id", "t1", "t2"), classes, ["t1", "t2"], copied, dealt)
    return out.select("doc_id", "t1", "t2", "class_id", "n_copies", "n_links", (F.col("_keeps") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("keeper"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class: that of the smallest doc_id."""
    keepers = near_duplicates(docs, **options).where("keeper").select("doc_id", "t1", "t2").distinct()
    h1, h2 = X.two_hashes(F.coalesce("text", F.lit("")))
    x = X.fresh(docs.columns)
    keepers = keepers.select(*[F.col(c).alias(f"{x}k{c}") for c in ("doc_id", "t1", "t2")])
    marked = docs.withColumns({x + "t1": h1, x + "t2": h2})
    same = (F.col(x + "t1") == F.col(x + "kt1")) & (F.col(x + "t2") == F.col(x + "kt2")) & F.col("doc_id").eqNullSafe(F.col(x + "kdoc_id"))
    return marked.join(keepers, same, "left_semi").dropDuplicates([x + "t1", x + "t2"]).select(*docs.columns)
