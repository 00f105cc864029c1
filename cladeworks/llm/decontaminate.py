"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased letter and digit runs. The benchmark's words are the vocabulary. Documents are cut into blocks of
BLOCK words; their counts of vocabulary words, one pass over all texts, are the matrix of TF-IDF passages, with document
frequencies over all blocks. A randomised SVD of that matrix (benchmark passages stacked on it, with as much weight as
all the corpus) needs only products A'(A X) with a thin X, which a bounded number of tasks sum over their blocks and Spark
adds up by slices of terms. In a last pass each document's blocks are projected, windows of three neighbours (a projection
is linear) are compared with all benchmark passages by cosine, and a pair above `cosine` is verified on the words: the
longest common subsequence must hold `same` of the passage, or `similar` of it and the passage's answer (its last words) too.

Words found in more than `common` of the blocks carry little weight and are left out of the vectors, but for the FEWEST
rarest of each passage. The LCS and answer checks see all words. RANK is set by recall: tests/llm/test_retrieval.py
measures it against the exact cosine of whole TF-IDF vectors and against planted paraphrases.

The benchmark is a stated query set. The driver reads it in blocks of at most PASSAGES passages and TERMS different words,
each searched in a round of its own, so what driver and tasks hold is bounded whatever its size; the corpus is never collected.

Defined cases: null text counts as empty; items of fewer than LEAST words can't be told from chance inside a sentence and
match where a whole line says just their words; items without a word match nothing; equal items each match; documents
that repeat are flagged alike; an empty benchmark or table flags nothing. Extra columns pass through; a column named
`matches` is replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .store import Workspace

BLOCK, WINDOW, PASSAGE, LEAST, ANSWER, FEWEST = 32, 3, 48, 5, 6, 8
RANK, PASSAGES, TERMS, SLICE, GROUP, STRIP, TASKS_A_CORE = 256, 2000, 20_000, 64, 48, 2048, 4
MATCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("lcs", T.DoubleType())])


def normal_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word of a chunk, the first word of each document, and the line (numbered over the chunk) of each word."""
    raw, at = X.buffers(pc.utf8_lower(column.cast(pa.large_string())))
    space = X.SEPARATES[raw]
    if len(raw) > 2:  # punctuation of two and three bytes
        two = np.flatnonzero(raw[:-1] == 0xC2)
        two = two[~np.isin(raw[two + 1], (0xAA, 0xB5, 0xBA))]
        three = np.flatnonzero(raw[:-2] == 0xE2)
        three = three[(raw[three + 1] == 0x80) | (raw[three + 1] == 0x81)]
        for spots, n in ((two, 2), (three, 3)):
            for k in range(n):
                space[spots + k] = True
    starts, ends, first = X.words(raw, at, space)
    line = np.searchsorted(np.sort(np.concatenate([np.flatnonzero(raw == 10), at[1:]])), starts, "right")
    return X.word_hashes(raw, starts, ends), first, line


class Vocabulary:
    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes & np.uint64(0xFFFFF)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in h that hold a term, and the terms."""
        at = np.flatnonzero(self.seen[h & np.uint64(0xFFFFF)])
        if not len(self.hashes) or not len(at):
            return at[:0], at[:0]
        term = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        ok = self.hashes[term] == h[at]
        return at[ok], term[ok]


def blocks_of(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each word position, numbered over a chunk, and the first block of each document."""
    n = -(-np.diff(first) // BLOCK)
    start = np.concatenate([[0], np.cumsum(n)])
    doc = np.searchsorted(first, at, "right") - 1
    return start[doc] + (at - first[doc]) // BLOCK, start


Passage = tuple[int, np.ndarray]  # item_id, word hashes


def split_item(item: int, words: np.ndarray) -> list[Passage]:
    """Passages of at most PASSAGE words; an item of fewer than LEAST words is one."""
    return [(item, part) for part in np.array_split(words, -(-len(words) // PASSAGE))] if len(words) else []


def rounds(benchmark: DataFrame) -> Iterator[list[Passage]]:
    """Blocks of passages, of at most PASSAGES passages and TERMS different words (or one passage)."""
    out: list[Passage] = []
    terms: set[int] = set()
    rows = benchmark.where("text is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    while some := list(itertools.islice(rows, 500)):
        h, first, _ = normal_words(pa.array([r.text for r in some], pa.string()))
        for k, r in enumerate(some):
            for passage in split_item(r.item_id, h[first[k] : first[k + 1]]):
                own = set(passage[1].tolist())
                if out and (len(out) >= PASSAGES or len(terms | own) > TERMS):
                    yield out
                    out, terms = [], set()
                out.append(passage)
                terms |= own
    if out:
        yield out


def read_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each chunk of text: its terms, the block of each, and how many blocks there are."""
    for batch in batches:
        for terms, counts in zip(batch.column(0), batch.column(1)):
            n = np.frombuffer(counts.as_buffer(), np.uint8)
            yield np.frombuffer(terms.as_buffer(), np.uint32).astype(np.int64), np.repeat(np.arange(len(n)), n), len(n)


def hits(docs: DataFrame, vocabulary) -> DataFrame:
    """terms (uint32 of each word of the vocabulary), counts (uint8: so many in each block)."""

    def run(batches):
        voc = vocabulary.value
        for batch in batches:
            column = batch.column(0)
            for a, b in X.slices(column):
                h, first, _ = normal_words(column.slice(a, b - a).fill_null(""))
                at, term = voc.find(h)
                block, start = blocks_of(first, at)
                counts = np.bincount(block, minlength=start[-1]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([term.astype(np.uint32).tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["terms", "counts"])

    return docs.select("text").mapInArrow(run, "terms binary, counts binary")


def frequencies(table: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Blocks that hold each term, and all blocks."""

    def run(batches):
        df, total = np.zeros(n_terms, np.int64), 0
        for term, block, n_blocks in read_hits(batches):
            total += n_blocks
            key = block * n_terms + term
            key.sort()
            df += np.bincount(key[np.append(True, key[1:] != key[:-1])[: len(key)]] % n_terms, minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], total))], ["term", "n"])

    found = table.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term
    out = np.zeros(n_terms, np.int64)
    for r in found:
        if r.term >= 0:
            out[r.term] = r.n
    return out, next((r.n for r in found if r.term < 0), 0)


def gram_product(table: DataFrame, idf: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A'(A x) over all blocks of the corpus; idf is 0 for terms left out. Each task has one sum, however many blocks it reads."""
    context = table.sparkSession.sparkContext
    shared, width = context.broadcast((idf.astype(np.float32), x.astype(np.float32))), x.shape[1]
    tasks = TASKS_A_CORE * context.defaultParallelism

    def products(batches):
        weight, thin = shared.value
        out = np.zeros((len(weight), width), np.float64)
        for term, block, _ in read_hits(batches):
            ok = weight[term] > 0
            term, block = term[ok], block[ok]
            cut = np.flatnonzero(np.append(True, block[1:] != block[:-1])[: len(block)])
            cut = np.append(cut, len(block))
            for a in range(0, len(cut) - 1, GROUP):  # a few blocks as a small dense matrix over their own terms
                ends = cut[a : a + GROUP + 1]
                n = len(ends) - 1
                tf_idf, own = small_tf_idf(term[ends[0] : ends[-1]], np.repeat(np.arange(n), np.diff(ends)), n, weight)
                out[own] += tf_idf.T @ (tf_idf @ thin[own])
        for k in range(0, len(weight), SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([out[k : k + SLICE].astype(np.float32).tobytes()], pa.binary())], ["slice", "z"])

    def sums(batches):
        got: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, z in zip(batch.column(0).to_pylist(), batch.column(1)):
                z = np.frombuffer(z.as_buffer(), np.float32)
                got[k] = got[k] + z if k in got else z.astype(np.float64)
        for k, z in got.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([z.tobytes()], pa.binary())], ["slice", "z"])

    schema = "slice long, z binary"
    parts = table.coalesce(tasks).mapInArrow(products, schema).repartition("slice").mapInArrow(sums, schema)
    total = np.zeros((len(idf), width))
    for r in parts.collect():  # the vocabulary's terms x width, whatever the corpus
        total[r.slice : r.slice + SLICE] = np.frombuffer(r.z, np.float64).reshape(-1, width)
    shared.unpersist()
    return total


class Passages:
    """TF-IDF rows of the passages, sparse."""

    def __init__(self, terms: list[np.ndarray], idf: np.ndarray):
        self.term, self.row, self.shape = np.concatenate(terms), np.repeat(np.arange(len(terms)), [len(t) for t in terms]), (len(terms), len(idf))
        self.weight = idf[self.term][:, None]

    def times(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[0], x.shape[1]))
        np.add.at(out, self.row, x[self.term] * self.weight)
        return out

    def back(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros((self.shape[1], y.shape[1]))
        np.add.at(out, self.term, y[self.row] * self.weight)
        return out


def latent_space(table: DataFrame, items: Passages, idf: np.ndarray, rank: int, power: int = 1) -> np.ndarray:
    """Right singular vectors (terms x rank) of the corpus' and the benchmark's passages, by a randomised SVD."""
    n_terms = len(idf)
    rank = min(rank, n_terms)
    x = np.linalg.qr(np.random.default_rng(11).standard_normal((n_terms, rank)))[0]
    corpus, mine = gram_product(table, idf, x), items.back(items.times(x))
    scale = max(1.0, np.linalg.norm(corpus) / max(np.linalg.norm(mine), 1e-12))  # the benchmark weighs as much as the corpus
    x = np.linalg.qr(corpus + scale * mine)[0]
    for _ in range(power):
        z = gram_product(table, idf, x) + scale * items.back(items.times(x))
        values, vectors = np.linalg.eigh((x.T @ z + z.T @ x) / 2)
        x = np.linalg.qr(z @ vectors[:, ::-1])[0]
    return x.astype(np.float32)


def lcs(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; masks has each word's places in the passage of n words."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - bin(v).count("1")


def masks_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


def flag(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.45, same: float = 0.75, similar: float = 0.5, common: float = 0.02, rank: int = RANK) -> DataFrame:
    """docs with matches: for each benchmark item found in the document its best cosine and LCS share. Empty: clean."""
    work = Workspace(docs.sparkSession, "flagged")
    docs = docs.drop("matches")
    texts = docs
    out = docs.withColumn("matches", F.array().cast(T.ArrayType(MATCH, False)))
    for k, passages in enumerate(rounds(benchmark)):
        if k:  # one round's model at a time
            out = work.save(out, f"round{k}")
        out = searched(out, model(texts, passages, common, rank), cosine, same, similar)
    return out


def searched(docs: DataFrame, known: dict, cosine: float, same: float, similar: float) -> DataFrame:
    """docs with the matches of one round added to matches."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    names = docs.columns
    schema = T.StructType([T.StructField(f.name, T.ArrayType(MATCH, False), False) if f.name == "matches" else f for f in docs.schema.fields])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64())]))

    def run(batches):
        for batch in batches:
            column, before = (batch.column(batch.schema.get_field_index(x)) for x in ("text", "matches"))
            for a, b in X.slices(column):
                h, first, line = normal_words(column.slice(a, b - a).fill_null(""))
                found: list[dict] = [{m["item_id"]: (m["lcs"], m["cosine"]) for m in ms} for ms in before.slice(a, b - a).to_pylist()]
                short_search(shared.value, h, first, line, found)
                search(shared.value, h, first, found, cosine, same, similar)
                part = batch.slice(a, b - a)
                rows = pa.array([[{"item_id": i, "cosine": c, "lcs": s} for i, (s, c) in sorted(f.items())] for f in found], kind)
                yield pa.RecordBatch.from_arrays([rows if n == "matches" else part.column(i) for i, n in enumerate(names)], names)

    return docs.mapInArrow(run, schema)


def model(docs: DataFrame, passages: list[Passage], common: float, rank: int) -> dict:
    """Vocabulary, idf, latent space and projected passages of a block of the benchmark."""
    spark, work = docs.sparkSession, Workspace(docs.sparkSession, "latent")
    short = [(i, p) for i, p in passages if len(p) < LEAST]
    passages = [(i, p) for i, p in passages if len(p) >= LEAST]
    if not passages:
        return {"short": short, "passages": []}
    voc = Vocabulary(np.concatenate([p for _, p in passages]))
    table = work.save(hits(docs, spark.sparkContext.broadcast(voc)), "hits")
    df, total = frequencies(table, len(voc.hashes))
    idf = np.log((total + 1.0) / (df + 1.0)) + 0.1
    weights = idf.copy()
    used = df <= common * max(total, 1)
    rows = [np.searchsorted(voc.hashes, p) for _, p in passages]
    for terms in rows:
        own = np.unique(terms)
        used[own[np.argsort(df[own], kind="stable")[:FEWEST]]] = True
    idf[~used] = 0
    items = Passages(rows, idf)
    basis = latent_space(table, items, idf, rank)
    low = items.times(basis)
    norms = np.linalg.norm(low, axis=1, keepdims=True)
    work.drop("hits")
    return {
        "voc": voc, "basis": basis, "idf": idf.astype(np.float32), "items": (low / np.maximum(norms, 1e-9)).astype(np.float32).T,
        "weights": [weights[t] / weights[t].sum() for t in rows], "passages": passages, "short": short, "masks": [masks_of(p) for _, p in passages], "ends": [masks_of(p[-ANSWER:]) for _, p in passages],
    }


def short_search(m: dict, h: np.ndarray, first: np.ndarray, line: np.ndarray, found: list[dict]) -> None:
    """Adds items of fewer than LEAST words where a line of a document says just these."""
    edge = np.append(True, line[1:] != line[:-1])[: len(line)]
    begin = np.flatnonzero(edge)
    size = np.diff(np.append(begin, len(h)))
    for item, words in m["short"]:
        at = begin[size == len(words)]
        for k, w in enumerate(words):
            at = at[h[at + k] == w]
        for d in np.unique(np.searchsorted(first, at, "right") - 1):
            found[d][item] = (1.0, 1.0)


def small_tf_idf(term: np.ndarray, block: np.ndarray, n: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of n blocks (block: 0 to n - 1) as a dense matrix over their own terms, and these terms."""
    own, which = np.unique(term, return_inverse=True)
    return np.bincount(block * len(own) + which, minlength=n * len(own)).reshape(n, len(own)).astype(np.float32) * weight[own], own


def projected(m: dict, term: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Latent vectors of n blocks; block rises from 0."""
    z = np.zeros((n, m["basis"].shape[1]), np.float32)
    cut = np.searchsorted(block, np.arange(0, n + GROUP, GROUP))
    for k, (lo, hi) in enumerate(zip(cut, cut[1:])):
        if hi > lo:
            tf_idf, own = small_tf_idf(term[lo:hi], block[lo:hi] - k * GROUP, min(GROUP, n - k * GROUP), m["idf"])
            z[k * GROUP : (k + 1) * GROUP] = tf_idf @ m["basis"][own]
    return z


def search(m: dict, h: np.ndarray, first: np.ndarray, found: list[dict], cosine: float, same: float, similar: float) -> None:
    """Adds (LCS share, cosine) by item to found, for the documents of a chunk: every window of every document, STRIP at a time.

    The passage's words that the window has must also hold `similar` of its idf, so that common words alone never match.
    """
    if not m["passages"]:
        return
    at, term = m["voc"].find(h)
    block, start = blocks_of(first, at)
    ok = m["idf"][term] > 0
    term, block = term[ok], block[ok]
    for a in range(0, int(start[-1]), STRIP):
        n = min(STRIP, int(start[-1]) - a)
        lo, hi = np.searchsorted(block, [a, a + n + WINDOW - 1])
        if lo == hi:
            continue
        z = projected(m, term[lo:hi], block[lo:hi] - a, n + WINDOW - 1)
        doc = np.searchsorted(start, np.arange(a, a + n), "right") - 1
        left = start[doc + 1] - np.arange(a, a + n)  # blocks of the document from here on
        w = z[:n].copy()
        for k in range(1, WINDOW):
            w += z[k : k + n]
        for k in range(1, WINDOW):  # windows that would pass the document's end
            rows = np.flatnonzero(left == k)
            w[rows] = sum(z[rows + j] for j in range(k))
        norm = np.sqrt(np.einsum("ij,ij->i", w, w))
        close = w @ m["items"]
        for i, p in zip(*np.nonzero((close >= cosine * norm[:, None]) & (norm > 0)[:, None])):
            d = doc[i]
            begin = first[d] + (a + i - start[d]) * BLOCK
            share = verified(m, p, h[begin : min(begin + BLOCK * WINDOW, first[d + 1])], same, similar)
            item, c = m["passages"][p][0], float(close[i, p] / norm[i])
            if share is not None and (share, c) > found[d].get(item, (0.0, 0.0)):
                found[d][item] = (share, c)


def verified(m: dict, p: int, span: np.ndarray, same: float, similar: float) -> float | None:
    """The passage's LCS share in the window, if the window holds it."""
    words = m["passages"][p][1]
    held = np.isin(words, span)
    if held.sum() < similar * len(words) or m["weights"][p][held].sum() < similar:
        return None
    seen = span.tolist()
    share = lcs(m["masks"][p], len(words), seen) / len(words)
    tail = min(ANSWER, len(words))
    if share < similar or (share < same and lcs(m["ends"][p], tail, seen) < 0.8 * tail):
        return None
    return share


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without those that hold a benchmark item."""
    return flag(docs, benchmark, **options).where(F.size("matches") == 0).drop("matches")
