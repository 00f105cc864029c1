"""Quality rules with risk-controlled thresholds.

Rules score a document; higher is worse. For each stratum (language) a path of joint cutoffs is laid on one half of the
labelled documents: each step tightens the rule that gains most rejected bad documents there, a good one counting as
`price` bad ones, so that every step rejects what the one before did. The other half, the holdout, tests the steps in
order: one passes if the exact binomial tail P(X <= rejected good | n, risk) is at most delta over the number of strata
(Bonferroni), so that the whole stratum loses less than `risk` of its good documents to all rules together, in all strata
at once with confidence 1 - delta. The first step that fails ends the path (a fixed sequence needs no correction inside).
Of those that passed, the one is taken that gains most on the holdout. A stratum with too few labels certifies nothing
and loses nothing but the base failures: with delta 0.05 over s strata and risk 0.05 it needs ln(s / 0.05) / 0.051 good ones.

Every labelled document counts, on both halves: documents are counted by kind (stratum, label, and how many cutoffs of
each rule they exceed), the path is laid on all kinds of one half, and the steps of the other half's are summed. Up to
DRIVER_KINDS kinds the driver sees the kinds of the first half; beyond, it sees for each step of the path the sums by
stratum, rule and number of cutoffs, which give the same path.

Defined cases: null or empty text has no words and fails the base rule; a null language is a stratum of its own; a
document labelled both ways, or without label, calibrates nothing; repeated rows are judged alike; no labels or no
documents leave the base rule alone. Equality inside a document is by 64-bit hash. Extra columns pass through; columns
named like the ones that are added are replaced.
"""

from __future__ import annotations

import functools
import math
import operator
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X
from .labels import labelled
from .store import Workspace

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
GRAM = 8
_SYMBOL, _MARK, _UPPER = (np.zeros(256, bool) for _ in range(3))
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK[list(b"!")] = True
_UPPER[65:91] = True


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


SHARES = [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01]
#: Score and cutoffs of each rule, lenient first; above the cutoff a document is rejected.
RULES: dict[str, tuple[Column, list[float]]] = {}


def rules() -> dict[str, tuple[Column, list[float]]]:
    if not RULES:
        mean = _ratio("word_chars", "n_words")
        RULES.update(
            symbols=(_ratio("n_symbols", "n_words"), [3.0, 2.0, 1.5, 1.0, *SHARES]),
            marks=(_ratio("n_marks", "n_words"), [3.0, 2.0, 1.5, 1.0, *SHARES]),
            upper=(_ratio("n_upper", "word_chars"), SHARES),
            dup_lines=(_ratio("n_dup_lines", "n_lines"), SHARES),
            repeats=(_ratio("n_repeat_words", "n_words"), SHARES),
            long_words=(mean, [40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0]),
            short_words=(-mean, [-1.5, -2.0, -2.5, -3.0, -3.5, -4.0]),
        )
    return RULES


def repeated(key: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def per_doc(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def count(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each document of a chunk."""
    starts, ends, first = X.words(raw, at)
    n_docs = len(at) - 1
    out = {"n_words": np.diff(first)}
    solid = ~X._IS_SPACE[raw]
    out["word_chars"] = per_doc(solid & ((raw & 0xC0) != 0x80), at)
    out["n_symbols"], out["n_marks"] = per_doc(_SYMBOL[raw], at), per_doc(_MARK[raw], at)
    upper = _UPPER[raw]
    if len(raw) > 1:
        upper[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    out["n_upper"] = per_doc(upper, at)
    # lines: one more than the line feeds of each document
    breaks = np.flatnonzero(raw == 10)
    begin = np.sort(np.concatenate([at[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, at[1:]]))
    owner = np.repeat(np.arange(n_docs), 1 + per_doc(raw == 10, at))
    full = per_span(solid, begin, end) > 0
    begin, end, owner = begin[full], end[full], owner[full]
    key = X.mixed(X.word_hashes(raw, begin, end) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    out["n_lines"] = np.bincount(owner, minlength=n_docs)
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n_docs)
    # words in windows that occur twice in the document
    grams = X.gram_hashes(X.word_hashes(raw, starts, ends), GRAM)
    covered = np.zeros(len(starts), bool)
    if len(grams):
        ok = np.flatnonzero(X.within(first, GRAM, len(starts)))
        doc = np.searchsorted(first, ok, "right").astype(np.uint64)
        twice = np.zeros(len(starts) + 1, np.int64)
        twice[ok[repeated(X.mixed(grams[ok] + doc * np.uint64(0x9E3779B97F4A7C15)))] + 1] = 1
        sums = np.cumsum(twice)
        low = np.maximum(np.arange(len(starts)) - GRAM + 1, 0)
        covered = sums[1:] - sums[low] > 0
    out["n_repeat_words"] = per_doc(covered, first)
    return out


def per_span(flags: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[end] - sums[begin]


def with_counts(docs: DataFrame) -> DataFrame:
    """docs and COUNTS (long)."""
    docs = docs.drop(*COUNTS)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType(), False) for c in COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            for a, b in X.slices(column):
                found = count(*X.buffers(column.slice(a, b - a)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(found[c].astype(np.int64)) for c in COUNTS]], [*part.schema.names, *COUNTS])

    return docs.mapInArrow(run, schema)


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of the binomial distribution."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def stratum() -> Column:
    return F.when(F.col("lang").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("lang")))


def next_step(sums: list[np.ndarray], steps: list[int]) -> list[int] | None:
    """The steps after tightening the rule that gains most, None if none gains. sums: for each rule, by how many of its cutoffs documents exceed, the worth of those that pass yet."""
    best = (0.0, None)
    for r, (worth, held) in enumerate(zip(sums, steps)):
        size = len(worth) - 1
        gains = np.cumsum(worth[::-1])[::-1]  # of rejecting so many or more
        for bucket in range(size - held, 0, -1):  # from lenient to strict
            if gains[bucket] > best[0]:
                best = (float(gains[bucket]), (r, size - bucket + 1))
    return None if best[1] is None else [best[1][1] if r == best[1][0] else held for r, held in enumerate(steps)]


def tighter(buckets: np.ndarray, worth: np.ndarray, sizes: list[int]) -> list[list[int]]:
    """The path: for each step how many cutoffs of each rule hold. buckets: of a row a kind and a column a rule, how many cutoffs it exceeds."""
    now: list[list[int]] = []
    left = np.ones(len(worth), bool)
    while (steps := next_step([np.bincount(buckets[left, r], worth[left], size + 1) for r, size in enumerate(sizes)], now[-1] if now else [0] * len(sizes))) is not None:
        now.append(steps)
        left &= (buckets <= np.array(sizes) - np.array(steps)).all(1)
    return now


def tighter_by_sums(kinds: DataFrame, names: list[str], sizes: list[int]) -> dict[str, list[list[int]]]:
    """tighter() of each stratum where there are too many kinds for the driver: it gets their sums, once a step."""
    bucket = F.posexplode(F.array(*names)).alias("rule", "bucket")
    paths: dict[str, list[list[int]]] = {}
    open_ = kinds
    while True:
        sums: dict = {}
        for x in open_.select("stratum", "worth", bucket).groupBy("stratum", "rule", "bucket").agg(F.sum("worth").alias("worth")).collect():  # strata * cutoffs at most
            sums.setdefault(x.stratum, [np.zeros(size + 1) for size in sizes])[x.rule][x.bucket] = x.worth
        going = {s: steps for s, own in sums.items() if (steps := next_step(own, paths[s][-1] if s in paths else [0] * len(sizes))) is not None}
        if not going:
            return paths
        for s, steps in going.items():
            paths.setdefault(s, []).append(steps)
        most = F.element_at(F.create_map(*[F.lit(x) for s in sorted(going) for x in (s, [size - n for size, n in zip(sizes, going[s])])]), F.col("stratum"))
        within = [F.col(rule) <= F.get(most, F.lit(r)) for r, rule in enumerate(names)]
        open_ = kinds.where(F.col("stratum").isin(sorted(going))).where(functools.reduce(operator.and_, within))


def first_steps(path: list[list[int]], sizes: list[int]) -> list[list[int]]:
    """For each rule and bucket the first step of the path that rejects it, one past the last for none."""
    return [[next((k for k, step in enumerate(path) if bucket >= size - step[r] + 1), len(path)) for bucket in range(size + 1)] for r, size in enumerate(sizes)]


DRIVER_KINDS = 200_000


def calibrate(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, price: float = 50.0, driver_kinds: int = DRIVER_KINDS) -> dict[str, dict[str, float]]:
    """Certified cutoffs by stratum and rule; a rule without one is absent."""
    work = Workspace(docs.sparkSession, "quality")
    known = with_counts(labelled(docs.select("doc_id", "text", "lang"), labels, "quality")).where(~base_failed())
    # a score's bucket: how many cutoffs it exceeds; it exceeds cutoff i, lenient first, if that is len(cuts) - i or more
    buckets = [sum((score > c).cast("int") for c in cuts).alias(rule) for rule, (score, cuts) in rules().items()]
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    names, sizes = list(rules()), [len(cuts) for _, cuts in rules().values()]
    known = known.select(stratum().alias("stratum"), "label", half.alias("half"), *buckets)
    known = work.save(known.groupBy("stratum", "label", "half", *names).agg(F.count(F.lit(1)).alias("n")), "kinds")
    laying = known.where("half = 0").select("stratum", (F.col("n") * F.when(F.col("label") == 0, 1.0).otherwise(-price)).alias("worth"), *names)
    if laying.count() <= driver_kinds:
        laid = defaultdict(list)
        for row in laying.collect():
            laid[row[0]].append(row[1:])
        paths = {s: path for s, rows in laid.items() if (path := tighter(np.array([x[1:] for x in rows]), np.array([x[0] for x in rows]), sizes))}
    else:
        paths = tighter_by_sums(laying, names, sizes)
    found: dict[str, dict[str, float]] = {}
    if paths:
        arrays = {s: first_steps(path, sizes) for s, path in paths.items()}
        at = F.element_at(F.create_map(*[F.lit(x) for s in sorted(arrays) for x in (s, sum(arrays[s], []))]), F.col("stratum"))
        start = np.concatenate([[0], np.cumsum([size + 1 for size in sizes])])
        step = F.least(*[F.get(at, F.col(rule) + int(start[r])) for r, rule in enumerate(names)])
        counts = known.where("half = 1").where(F.col("stratum").isin(sorted(paths))).groupBy("stratum", "label", step.alias("step")).agg(F.sum("n").alias("n"))
        seen: dict = defaultdict(dict)
        for r in counts.collect():  # strata * 2 * steps at most
            seen[r.stratum, int(r.label)][r.step] = r.n
        for s, path in paths.items():
            good, bad = seen[s, 1], seen[s, 0]
            total, lost, won, best = sum(good.values()), 0, 0, (0.0, None)
            for k, steps in enumerate(path):
                lost, won = lost + good.get(k, 0), won + bad.get(k, 0)
                if not total or tail(lost, total, risk) > delta / len(paths):
                    break
                if won - price * lost > best[0]:
                    best = (won - price * lost, steps)
            found[s] = {rule: rules()[rule][1][n - 1] for rule, n in zip(names, best[1] or []) if n}
    work.drop("kinds")
    return found


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs with COUNTS, base_failed and kept."""
    docs = docs.drop("base_failed", "kept")
    cuts = calibrate(docs, labels, **options)
    bad = F.lit(False)
    for rule, (score, _) in rules().items():
        limits = {s: c[rule] for s, c in cuts.items() if rule in c}
        if limits:
            limit = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]), stratum())
            bad = bad | F.coalesce(score > limit, F.lit(False))
    out = with_counts(docs).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~bad)
