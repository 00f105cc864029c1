"""The path of cutoffs is laid on every labelled document of its half, on the driver and by sums."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cladeworks.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_paths_by_sums_are_those_of_the_driver(spark):
    """Four strata of random kinds, good documents in some of all rules, one stratum without a bad one."""
    r = random.Random(11)
    names, sizes = ["a", "b", "c"], [5, 3, 7]
    rows = [(f"s{k}", (1.0 if r.random() < 0.6 and k < 3 else -2.0) * r.randint(1, 9), *[r.choice([0, 0, r.randint(0, n)]) for n in sizes]) for k in range(4) for _ in range(80)]
    got = quality.tighter_by_sums(spark.createDataFrame(rows, "stratum string, worth double, a int, b int, c int"), names, sizes)
    want = {f"s{k}": quality.tighter(np.array([x[2:] for x in rows if x[0] == f"s{k}"]), np.array([x[1] for x in rows if x[0] == f"s{k}"]), sizes) for k in range(4)}
    assert got == {s: p for s, p in want.items() if p} and max(map(len, got.values())) > 1 and "s3" not in got
    assert quality.tighter_by_sums(spark.createDataFrame(rows, "stratum string, worth double, a int, b int, c int").limit(0), names, sizes) == {}


def test_rare_documents_beyond_the_first_thousands_shape_the_path(spark):
    """120,000 labelled documents; the only bad ones are forty, of four kinds. A sample of 50,000 of a half would miss some."""
    words = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60))
    bad = (F.col("id") % 3000 == 7).alias("bad")
    text = F.when(bad, F.concat(F.lit(words), F.lit(" "), F.repeat(F.lit("#"), (20 + F.col("id") / 3000 % 4 * 30).cast("int")))).otherwise(F.lit(words))
    docs = spark.range(120_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    labels = spark.range(120_000).select(F.col("id").alias("doc_id"), (~bad).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    seen = []
    plain = quality.tighter
    quality.tighter = lambda buckets, worth, sizes: seen.append(worth) or plain(buckets, worth, sizes)
    try:
        cuts = quality.calibrate(docs, labels)
    finally:
        quality.tighter = plain
    half = spark.range(120_000).where(F.crc32(F.col("id").cast("string")) % 2 == 0)
    want = half.agg(F.count_if(bad), F.count_if(~bad)).first()
    assert (sum(x[x > 0].sum() for x in seen), -sum(x[x < 0].sum() for x in seen) / 50) == tuple(want) and want[1] > 50_000
    assert cuts == quality.calibrate(docs, labels, driver_kinds=0) and "symbols" in cuts["sen"]
