"""Fourteen assertions over outputs. Each is a table of violations; a run is the table of passes, warnings and failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Id, name, severity.
SPECS = (
    ("A-01", "missing values render as NA", "fail"), ("A-02", "normalised RF in 0 to 1", "fail"), ("A-03", "no quartet value under 4 shared tips", "fail"), ("A-04", "no proportion from one taxon", "fail"),
    ("A-05", "risk in 0 to 1", "fail"), ("A-06", "no saturated RF distribution", "fail"), ("A-07", "no empty alignment", "fail"), ("A-08", "supports vary", "warn"), ("A-09", "bootstrap in 0 to 100", "fail"),
    ("A-10", "likelihood difference plausible", "fail"), ("A-11", "evidence coverage", "warn"), ("A-12", "probe discriminates", "fail"), ("A-13", "thresholds ordered", "fail"), ("A-14", "far mode on cards", "fail"),
)


def outside(v: Column, low: float, high: float) -> Column:
    """True for NaN too: Spark holds NaN larger than any number, so it is asked first."""
    return v.isNotNull() & (F.isnan(v) | (v < low) | (v > high))


def violations(state: dict[str, DataFrame]) -> DataFrame:
    """assertion_id, n: violations found by each assertion. state has the tables that exist:

    fields(value, rendered), steps(gene_id, nrf, quartet, quartet_state, n_shared), proportions(proportion, n_total),
    evaluations(marker_id, risk), alignments(marker_id, effective_columns), lpp(v), ufboot(v), lnl(v),
    run(coverage, n_markers, level1_max, level2_max, far_active, n_far_cards), probe(conflict_risk, identical_risk).
    """
    found = []

    def rows(name: str, table: str, condition: Column) -> None:
        if table in state:
            found.append(state[table].agg(F.count_if(condition).alias("n")).select(F.lit(name).alias("assertion_id"), "n"))

    def whole(name: str, table: str, bad: Column) -> None:
        if table in state:
            found.append(state[table].agg(F.coalesce(bad, F.lit(False)).cast("long").alias("n")).select(F.lit(name).alias("assertion_id"), "n"))

    rows("A-01", "fields", F.col("value").isNull() & ~F.col("rendered").isin("NA", "N/A"))
    rows("A-02", "steps", outside(F.col("nrf"), 0, 1))
    rows("A-03", "steps", F.col("quartet").isNotNull() & (F.coalesce(F.col("n_shared") < 4, F.lit(False)) | F.coalesce(F.col("quartet_state").isin("not_measurable", "rejected"), F.lit(False))))
    rows("A-04", "proportions", F.col("proportion").isNotNull() & (F.col("n_total") < 2))
    rows("A-05", "evaluations", outside(F.col("risk"), 0, 1))
    n = F.count("nrf")
    whole("A-06", "steps", (n >= 5) & (F.count_if(F.col("nrf").isin(0.0, 0.5, 1.0)) / F.nullif(n, F.lit(0)) > 0.20))
    rows("A-07", "alignments", F.col("effective_columns") <= 0)
    v = F.col("v")
    whole("A-08", "lpp", (F.count_if((v <= 0) | (v > 1)) > 0) | (F.count_if(v.isin(0.0, 1.0)) / F.nullif(F.count("v"), F.lit(0)) > 0.9))
    rows("A-09", "ufboot", outside(v, 0, 100))
    rows("A-10", "lnl", F.abs(v) > 30)
    c = F.col("coverage")
    rows("A-11", "run", F.when(c.isNull(), F.col("n_markers") > 0).otherwise(F.isnan(c) | (F.abs(c) == float("inf")) | (c < 0.5)))
    rows("A-12", "probe", F.col("conflict_risk") == F.col("identical_risk"))
    a, b = F.col("level1_max"), F.col("level2_max")
    rows("A-13", "run", a.isNull() | b.isNull() | ~((a >= 0) & (a < b) & (b <= 1)))
    rows("A-14", "run", F.col("far_active") & (F.coalesce("n_far_cards", F.lit(0)) == 0))
    return reduce(DataFrame.unionByName, found)


def run(spark, state: dict[str, DataFrame]) -> DataFrame:
    """assertion_id, name, severity, result (pass, warn, fail), n. An assertion without its table is not_checked, no pass."""
    specs = spark.createDataFrame(list(SPECS), "assertion_id string, name string, severity string")
    found = specs.join(violations(state), "assertion_id", "left")
    return found.select("assertion_id", "name", "severity", F.when(F.col("n").isNull(), "not_checked").when(F.col("n") == 0, "pass").otherwise(F.col("severity")).alias("result"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
