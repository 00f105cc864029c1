"""Texts made to agree in fast hashes are still different texts, to every operator that compares by content."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cladeworks.llm import line_dedup, near, substring
from cladeworks.llm import text as X

PAIR = ("bluli66lsome words here and more69l30759some words here and more", "bluli66|some words here and more69l{*7l_some words here and more")
P1, P2, MASK = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 2**64 - 1


def twins(n):
    """n pairs of different 64-byte texts that share XXH64 for every seed.

    A lane is rotl(acc + P2 * input) * P1; for two rounds of one lane, a change of the first that turns one bit of the sum moves the lane by a known amount,
    which the second input takes back. Bytes needn't be printable: they become ASCII by trial.
    """
    r, out = random.Random(5), []
    inverse = pow(P2, -1, 2**64)
    rotl = lambda x, k: ((x << k) | (x >> (64 - k))) & MASK
    while len(out) < n:
        seed = 42
        a, b = (r.randbytes(32) for _ in range(2))
        lane = (seed + P1 + P2) & MASK
        first, second = int.from_bytes(a[:8], "little"), int.from_bytes(b[:8], "little")
        other = r.getrandbits(64)
        x = rotl((lane + first * P2) & MASK, 31) * P1 & MASK
        y = rotl((lane + other * P2) & MASK, 31) * P1 & MASK
        made = (second + (x - y) * inverse) & MASK
        twin = other.to_bytes(8, "little") + a[8:] + made.to_bytes(8, "little") + b[8:]
        if xxhash.xxh64_intdigest(a + b, seed) == xxhash.xxh64_intdigest(twin, seed):
            out.append((a + b, twin))
    return out


def test_the_pair_agrees_in_fast_hashes(spark):
    got = spark.createDataFrame([(t,) for t in PAIR], "text string").select(F.xxhash64("text"), F.xxhash64(F.lit("second"), "text")).distinct().collect()
    assert len(got) == 1 and PAIR[0] != PAIR[1]


def test_content_hashes_differ(spark):
    said = [t for pair in twins(100) for t in pair]
    assert len(set(said)) == 200 and len({xxhash.xxh64_intdigest(t, 42) for t in said}) == 100
    rows = spark.createDataFrame([(bytearray(t),) for t in said], "b binary").select(*X.halves(F.sha2("b", 256)))
    assert rows.distinct().count() == 200
    texts = spark.createDataFrame([(t,) for t in (*PAIR, "", None)], "text string").select(*X.two_hashes("text"))
    assert texts.distinct().count() == 3  # null counts as empty


def test_lines(spark):
    """Each line is in five documents: neither in ten."""
    docs = spark.createDataFrame([(i, f"own {i}\n{PAIR[i % 2]}") for i in range(10)], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.drop_common_lines(docs).collect()} == {0}
    docs = spark.createDataFrame([(i, f"own {i}\n{PAIR[0]}") for i in range(10)], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.drop_common_lines(docs).collect()} == {1}


def test_near(spark):
    docs = spark.createDataFrame(list(enumerate(PAIR)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_copies) for r in near.near_duplicates(docs).collect()}
    assert got == {0: (0, 1), 1: (1, 1)} and near.keep_one(docs).count() == 2


def test_substring(spark):
    """The first five words differ; the last four of the pair and sixty more repeat."""
    tail = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{t} {tail}") for i, t in enumerate(PAIR)], "doc_id long, text string")
    got = substring.drop_repeats(docs).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(69, 64)} and {r.text for r in got} == {" ".join(t.split()[:5]) for t in PAIR}


@pytest.mark.parametrize("pair", [PAIR])
def test_pipeline_stage_keeps_both(spark, pair, tmp_path):
    import corpus_pipeline as P

    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(pair)], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(P.STAGES)["jaccard_join"](spark, docs, str(tmp_path)).count() == 2
