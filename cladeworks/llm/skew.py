"""Joins in which a few keys may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import fresh

SHARE, PARTS = 1000, 64


def hot_keys(counts: DataFrame, n: str, on: list[str], share: int = SHARE) -> DataFrame:
    """Keys (`on`, one row each, n rows) that have more than 1 / share of all rows: fewer than `share` of them, whatever the data."""
    total = counts.agg(F.sum(n).alias("_total"))  # one row
    return counts.crossJoin(F.broadcast(total)).where(F.col(n) * share > F.col("_total")).select(*on)


def skewed_join(big: DataFrame, small: DataFrame, on: list[str], hot: DataFrame, by: Column, how: str = "inner", parts: int = PARTS) -> DataFrame:
    """big joined with small (unique on `on`). Rows of hot keys are dealt over `parts` tasks by the hash `by`, small's rows repeated there.

    hot comes from hot_keys(), so its broadcast is bounded. `by` must depend on the row alone, or a rerun task would deal anew.
    """
    x = fresh([*big.columns, *small.columns])
    flag, salt = x + "hot", x + "salt"
    hot = F.broadcast(hot.select(*on).withColumn(flag, F.lit(True)))
    dealt = big.join(hot, on, "left").withColumn(salt, F.when(F.col(flag), F.pmod(by, F.lit(parts))).otherwise(F.lit(0)).cast("int")).drop(flag)
    every = F.when(F.col(flag), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    repeated = small.join(hot, on, "left").withColumn(salt, F.explode(every)).drop(flag)
    return dealt.join(repeated, [*on, salt], how).drop(salt)
