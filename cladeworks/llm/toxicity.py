"""Toxicity by class-conditional Kneser-Ney models.

Words are lower-cased letter and digit runs, spelled in UTF-8 bytes, so that no two letters share a symbol, with start and
end marks. Each class has its own highest order, counts of 5-grams, and below it its own continuation counts: in how many
contexts a 4-gram occurs in the class. Both classes back off to one shared trigram model of continuation counts (contexts
in toxic and ordinary texts together), so a rare expression is judged by what both know of it. Grams that begin with a
start mark have no earlier context and keep their counts, as is usual.

A word's log-likelihoods are compared, and a document is described by the length-normalised difference over the whole
text, over its strongest window of words and its strongest word, the numbers of strongly toxic words and its length; a
logistic regression turns these into a score.

Counts cover all labelled documents of the training folds, under the exact gram (up to 5 symbols of 8 bits), in a table
that grows with them. Up to BROADCAST_GRAMS rows, counted, it is broadcast; beyond, the grams of each chunk of texts are
joined with it and only these reach the chunk. The shared trigrams are at most SYMBOLS**3, by the alphabet. Folds are crc32(doc_id as text) mod 5: fold 0 is held out and never
learned from, 1 to 3 train the models, 4 the regression, on a sample of at most SAMPLE documents, chosen by hash.
Labels, language, source and id are no inputs of a score.

Defined cases: null text counts as empty and gets the score of a text without evidence; a null doc_id is held out; a
document labelled both ways has no label; without labels of both classes every score is 0. Repeated rows score alike.
Extra columns pass through; held_out, score and predicted are replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .labels import labelled
from .store import Workspace

ORDERS, SHARED, DISCOUNT, SPAN, SAMPLE = (4, 5), 3, 0.75, 5, 50_000
BROADCAST_GRAMS = 2_000_000  # about 50 MB
SYMBOLS, START, END = 160, 1, 2
_CODE = np.zeros(256, np.uint64)
_CODE[48:58] = np.arange(3, 13)
_CODE[97:123] = np.arange(13, 39)
_CODE[128:245] = np.arange(39, 156)  # UTF-8 has no bytes beyond


def fold(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def gram_key(n: int, key: np.ndarray) -> np.ndarray:
    """Where the table has a gram of n symbols."""
    return (key | np.uint64(n << 40)).astype(np.int64)


def context_key(n: int, key: np.ndarray) -> np.ndarray:
    """Where the table has the context of a gram of n symbols."""
    return ((key >> np.uint64(8)) | np.uint64(n + 8 << 40)).astype(np.int64)


class Words:
    """The distinct words of a chunk, and which of them each word is."""

    def __init__(self, column: pa.Array):
        self.raw, at = X.buffers(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
        self.starts, self.ends, self.first = X.words(self.raw, at, X.SEPARATES[self.raw])
        h = X.word_hashes(self.raw, self.starts, self.ends)
        _, self.example, self.which = np.unique(h, return_index=True, return_inverse=True)

    def grams(self, chosen: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """For the chosen distinct words: the word of each symbol, and the key of the last n symbols up to it."""
        s, e = self.starts[self.example[chosen]], self.ends[self.example[chosen]]
        pad = max(ORDERS) - 1
        size = e - s + pad + 1
        begin = np.cumsum(size) - size
        total = int(size.sum())
        word = np.repeat(np.arange(len(s)), size)
        turn = np.arange(total) - begin[word]
        codes = np.full(total, START, np.uint64)
        inner = (turn >= pad) & (turn < size[word] - 1)
        codes[inner] = _CODE[self.raw[(s[word] + turn - pad)[inner]]]
        last = turn == size[word] - 1
        codes[last] = END
        keys, key = {}, np.zeros(total, np.uint64)
        for n in range(1, max(ORDERS) + 1):
            back = np.zeros(total, np.uint64)
            back[n - 1 :] = codes[: total - n + 1]
            key = key | (back << np.uint64(8 * (n - 1)))
            keys[n] = key
        real = turn >= pad
        return word[real], {n: k[real] for n, k in keys.items()}


def gram_counts(docs: DataFrame, work: Workspace) -> DataFrame:
    """key, a, b, ta, tb of each gram and context of (text, label): counts in ordinary and in toxic texts, and a context's distinct next symbols."""
    longest, order = ORDERS[-1], ORDERS[0]

    def run(batches):
        for batch in batches:
            label = np.asarray(batch.column(1))
            for a, b in X.slices(batch.column(0)):
                words = Words(batch.column(0).slice(a, b - a))
                toxic = np.repeat(label[a:b], np.diff(words.first)) > 0
                often = [np.bincount(words.which[toxic == c], minlength=len(words.example)) for c in (False, True)]
                word, keys = words.grams(np.arange(len(words.example)))
                key, which = np.unique(gram_key(longest, keys[longest]), return_inverse=True)
                x, y = (np.bincount(which, k[word], len(key)).astype(np.int64) for k in often)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(x), pa.array(y)], ["key", "a", "b"])

    rows = docs.select("text", "label").mapInArrow(run, "key long, a long, b long")
    grams = work.save(rows.groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "grams")
    inner = F.col("key").bitwiseAND((1 << 8 * order) - 1)
    opens = F.shiftright("inner", 8 * (order - 1)) == START
    lower = grams.withColumn("inner", inner).groupBy((F.col("inner") + F.lit(order << 40)).alias("key")).agg(
        *[F.sum(F.when(opens, F.col(c)).otherwise((F.col(c) > 0).cast("long"))).alias(c) for c in ("a", "b")]
    )
    grams = work.save(grams.unionByName(lower), "both")
    above = (F.shiftright("key", 40) + 8) * (1 << 40) + F.shiftright(F.col("key").bitwiseAND((1 << 40) - 1), 8)
    contexts = grams.groupBy(above.alias("key")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb"))
    out = work.save(grams.withColumns({"ta": F.lit(0).cast("long"), "tb": F.lit(0).cast("long")}).unionByName(contexts), "table")
    work.drop("grams", "both")
    return out


def smoothed(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Discounted shares of each context's last symbols, the rest by `lower` (contexts x SYMBOLS each)."""
    total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    return np.where(total > 0, (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * kinds * lower) / np.maximum(total, 1), lower)


def continuation(table: DataFrame) -> np.ndarray:
    """Probability of each trigram's last symbol by continuation counts of both classes together; SYMBOLS**3 entries."""
    four = F.shiftright("key", 40) == SHARED + 1
    key = F.col("key").bitwiseAND((1 << 8 * SHARED) - 1)
    opens = F.shiftright(key, 8 * (SHARED - 1)) == START
    rows = table.where(four).groupBy(key.alias("k")).agg(F.sum(F.when(opens, F.col("a") + F.col("b")).otherwise(1)).alias("n")).toArrow()
    k = np.asarray(rows["k"]).astype(np.int64)
    three = np.zeros((SYMBOLS,) * 3, np.float32)
    three[k >> 16, k >> 8 & 255, k & 255] = np.asarray(rows["n"])
    two = (three > 0).sum(0).astype(np.float32)
    two[START] = three[START, START]
    below = smoothed((two > 0).sum(0, keepdims=True), np.full((1, SYMBOLS), np.float32(1 / SYMBOLS)))
    below = smoothed(two, np.repeat(below, SYMBOLS, 0))
    return smoothed(three.reshape(-1, SYMBOLS), np.tile(below, (SYMBOLS, 1))).astype(np.float32).reshape(-1)


class Model:
    """Both classes' probabilities of a symbol after its context, from rows (key, a, b, ta, tb) that hold all grams asked for."""

    def __init__(self, key: np.ndarray, values: list[np.ndarray], shared: np.ndarray):
        order = np.argsort(key)
        self.key, self.values, self.shared = key[order], np.array([v[order] for v in values], np.float64).reshape(4, -1), shared

    def find(self, key: np.ndarray) -> np.ndarray:
        """(a, b, ta, tb) of each key; 0 for those that the table doesn't have."""
        if not len(self.key):
            return np.zeros((4, len(key)))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return self.values[:, at] * (self.key[at] == key)

    def ratio(self, words: Words, chosen: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of the chosen words."""
        if not len(chosen):
            return np.zeros(len(chosen))
        word, keys = words.grams(chosen)
        longest, which = np.unique(keys[ORDERS[-1]], return_inverse=True)
        last = longest.astype(np.int64)
        base = self.shared[((last >> 16 & 255) * SYMBOLS + (last >> 8 & 255)) * SYMBOLS + (last & 255)]
        p = [base, base]
        for n in ORDERS:
            key = longest & np.uint64(256**n - 1)
            own, up = self.find(gram_key(n, key)), self.find(context_key(n, key))
            for c in range(2):
                seen = up[c]
                p[c] = np.where(seen > 0, (np.maximum(own[c] - DISCOUNT, 0) + DISCOUNT * up[2 + c] * p[c]) / np.maximum(seen, 1), p[c])
        each = np.log(np.maximum(p[1], 1e-12)) - np.log(np.maximum(p[0], 1e-12))
        return np.bincount(word, each[which], len(chosen))


class Knowledge:
    """The table, and how a chunk of texts gets the rows it asks for: all of them by broadcast, or its own by a join."""

    def __init__(self, docs: DataFrame, most: int):
        spark = docs.sparkSession
        self.work = Workspace(spark, "toxicity")
        self.table = gram_counts(docs, self.work)
        r = self.table.agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
        self.ready, shared, self.model = bool(r.a and r.b), continuation(self.table), None
        self.shared = spark.sparkContext.broadcast(shared)
        if r.n <= most:
            t = self.table.toArrow()
            self.model = spark.sparkContext.broadcast(Model(np.asarray(t["key"]), [np.asarray(t[c]) for c in ("a", "b", "ta", "tb")], shared))

    def scored(self, docs: DataFrame, work, columns: list[tuple[str, pa.DataType, T.DataType]]) -> DataFrame:
        """docs with columns that work(model, text column) gives for each chunk."""
        schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, _, t in columns]])
        return self._by_broadcast(docs, work, columns, schema) if self.model is not None else self._by_join(docs, work, columns, schema)

    def _by_broadcast(self, docs, work, columns, schema):
        model = self.model

        def run(batches):
            for batch in batches:
                for part in parts(batch):
                    yield with_columns(part, work(model.value, text_of(part)), columns)

        return docs.mapInArrow(run, schema)

    def _by_join(self, docs, work, columns, schema):
        shared = self.shared

        def pack(batches):
            for batch in batches:
                for part in parts(batch):
                    words = Words(text_of(part))
                    _, keys = words.grams(np.arange(len(words.example)))
                    asked = np.unique(np.concatenate([k for n in ORDERS for k in (gram_key(n, keys[n]), context_key(n, keys[n]))]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_batch(part)
                    yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([asked], pa.list_(pa.int64()))], ["chunk", "body", "asked"])

        def run(batches):
            for batch in batches:
                for body, rows in zip(batch.column(0), batch.column(1)):
                    t = rows.values if rows.is_valid else pa.array([], rows.type.value_type)
                    part = pa.ipc.open_stream(body.as_buffer()).read_all().combine_chunks().to_batches()[0]
                    model = Model(np.asarray(t.field("key")), [np.asarray(t.field(c)) for c in ("a", "b", "ta", "tb")], shared.value)
                    yield with_columns(part, work(model, text_of(part)), columns)

        chunks = self.work.save(docs.mapInArrow(pack, "chunk string, body binary, asked array<long>"), f"chunks-{uuid.uuid4().hex}")
        known = chunks.select("chunk", F.explode("asked").alias("key")).join(self.table, "key").groupBy("chunk").agg(F.collect_list(F.struct("key", "a", "b", "ta", "tb")).alias("rows"))
        return chunks.join(known, "chunk", "left").select("body", "rows").mapInArrow(run, schema)


def text_of(part: pa.RecordBatch) -> pa.Array:
    return part.column(part.schema.get_field_index("text"))


def parts(batch: pa.RecordBatch):
    for a, b in X.slices(text_of(batch)):
        yield batch.slice(a, b - a)


def with_columns(part: pa.RecordBatch, made: list, columns: list) -> pa.RecordBatch:
    more = [pa.array(list(x) if isinstance(k, pa.ListType) else x, k) for x, (_, k, _) in zip(made, columns)]
    return pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *[n for n, _, _ in columns]])


STRONG = (1.5, 2.5, 4.0)  # log-likelihood ratios of a word
FEATURES = 4 + len(STRONG)


def describe(model: Model, column: pa.Array) -> np.ndarray:
    """FEATURES of each document of a chunk."""
    words = Words(column)
    n = np.diff(words.first)
    out = np.zeros((len(n), FEATURES))
    if not len(words.which):
        return out
    ratio = model.ratio(words, np.arange(len(words.example)))[words.which]
    size = (words.ends - words.starts + 1).astype(np.float64)
    sums, sizes = np.concatenate([[0], np.cumsum(ratio)]), np.concatenate([[0], np.cumsum(size)])
    full = np.flatnonzero(n > 0)
    doc = np.repeat(np.arange(len(n)), n)
    end = np.minimum(np.arange(len(doc)) + SPAN, words.first[1:][doc])
    window = (sums[end] - sums[:-1]) / np.maximum(sizes[end] - sizes[:-1], 12.0)
    f, g = words.first[:-1][full], words.first[1:][full]
    out[full, 0] = (sums[g] - sums[f]) / np.maximum(sizes[g] - sizes[f], 1)
    out[full, 1] = np.maximum.reduceat(window, f)
    out[full, 2] = np.maximum.reduceat(ratio, f)
    out[full, 3] = np.log1p(n[full])
    for k, bound in enumerate(STRONG):
        strong = np.concatenate([[0], np.cumsum(ratio > bound)])
        out[full, 4 + k] = np.log1p(strong[g] - strong[f])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias first) by Newton's method; the rarer class counts more, by the root of the classes' ratio."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ratio = np.zeros(x.shape[1]), (y == 0).sum() / (y == 1).sum()
    each = np.where(y == 1, max(ratio, 1.0) ** 0.5, max(1 / ratio, 1.0) ** 0.5)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.full(len(w), ridge)
        penalty[0] = 0
        step = np.linalg.solve((x * (each * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (each * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = BROADCAST_GRAMS) -> tuple[Knowledge, np.ndarray, np.ndarray]:
    """The counts, and the weights and (mean, scale) of the regression. More than `most` rows of counts are joined."""
    known = labelled(docs.select("doc_id", "text"), labels, "toxic").withColumn("fold", fold())
    model = Knowledge(known.where("fold between 1 and 3").withColumn("label", F.col("label").cast("long")), most)
    tuning = known.where("fold = 4")
    n = labels.where(fold() == 4).count()
    if n > sample:  # the bound of the regression's sample; the models above know every document
        tuning = tuning.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    got = model.scored(tuning.select("text", "label"), lambda m, c: [describe(m, c)], [("x", pa.list_(pa.float64()), T.ArrayType(T.DoubleType()))]).select("x", "label").collect()
    x = np.array([r.x for r in got]).reshape(-1, FEATURES)
    y = np.array([float(r.label) for r in got])
    scale = np.vstack([x.mean(0), x.std(0) + 1e-6]) if len(x) else np.vstack([np.zeros(FEATURES), np.ones(FEATURES)])
    if not model.ready or len(set(y)) < 2:
        return model, np.array([-40.0] + [0.0] * FEATURES), scale
    return model, logistic((x - scale[0]) / scale[1], y), scale


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 if score >= 0.5)."""
    docs = docs.drop("held_out", "score", "predicted")
    known, w, scale = train(docs, labels, **options)

    def work(model, column):
        z = (describe(model, column) - scale[0]) / scale[1]
        return [1 / (1 + np.exp(-np.clip(z @ w[1:] + w[0], -40, 40)))]

    out = known.scored(docs, work, [("score", pa.float64(), T.DoubleType())])
    return out.withColumns({"held_out": fold() == 0, "predicted": (F.col("score") >= 0.5).cast("int")})
