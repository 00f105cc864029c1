"""Products: tables as TSV, cards as JSON lines, trees, FASTA, a text summary and an HTML page, and stage state."""

from __future__ import annotations

import dataclasses
import html
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import NA, fasta_record, na

MODES = {"force": "overwrite", "no_clobber": "ignore", None: "errorifexists"}
SCHEMA_VERSION = 2


def write_tsv(df: DataFrame, path: str, policy: str | None = None) -> None:
    """A table with a header, missing values as NA."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(NA)).alias(c) for c in df.columns])
    text.write.mode(MODES[policy]).csv(path, sep="\t", header=True, quote="\u0000", escape="\u0000")


def marker_summary(occ: DataFrame, scores: DataFrame, sites: DataFrame, grades: DataFrame) -> DataFrame:
    """marker_id with rendered occupancy, quality, level, sites and consistency grade."""
    joined = occ.join(scores, "marker_id", "left").join(sites, "marker_id", "left").join(grades, "marker_id", "left")
    return joined.select(
        "marker_id", na(F.col("occupancy")).alias("occupancy_score"), na(F.col("score")).alias("marker_quality_score"), F.coalesce("level", F.lit("unknown")).alias("marker_quality_level"),
        F.coalesce(F.col("pis").cast("string"), F.lit(NA)).alias("pis"), F.coalesce(F.col("effective_columns").cast("string"), F.lit(NA)).alias("effective_columns"), F.coalesce("grade", F.lit(NA)).alias("consistency_grade"),
    )


# Columns of the evaluation table.
EVALUATION = (
    "marker_id overall_risk hgt_risk_level hgt_evidence_confidence notes detector rank_used n_total n_mono rf rf_state quartet quartet_state monophyly monophyly_state n_signals_used weights risk_basis "
    "thresholds_in_effect far_active trimming_regime gene_tree_source upstream_shared assertion_ids_fired"
).split()


def hgt_evaluation(evaluations: DataFrame, level1_max: float, level2_max: float, far: bool = False, trimming: str = "", source: str = "", fired: str = "") -> DataFrame:
    """The 24 columns of EVALUATION as text. A signal without a value is not_measurable, or rejected where its marker is; fired: ids of assertions that failed."""
    has = lambda c, kind="double": F.col(c) if c in evaluations.columns else F.lit(None).cast(kind)
    nrf, quartet, n_mono, n_total = has("nrf"), has("quartet"), has("n_mono", "long"), has("n_total", "long")
    mono = n_mono / F.nullif(n_total, F.lit(0))
    refused = F.coalesce(has("state", "string") == "rejected", F.lit(False))
    state = lambda v: F.when(v.isNotNull(), "measured").when(refused, "rejected").otherwise("not_measurable")
    by_tree = F.lit("quartet" in evaluations.columns)
    plain = lambda v: F.coalesce(v.cast("string"), F.lit(NA))
    signals = sum((v.isNotNull().cast("int") for v in (nrf, quartet)), F.when(by_tree, 0).otherwise(mono.isNotNull().cast("int")))
    weights = F.when(by_tree, json.dumps({"quartet": 0.5, "rf": 0.5})).otherwise(json.dumps({"monophyly": 1.0}))
    notes = F.regexp_replace(F.concat_ws("; ", has("reason", "string"), has("note", "string")), "[\\t\\n]", " ")
    made = [
        F.col("marker_id").cast("string"), na(F.col("risk")), F.col("level"), plain(F.col("confidence")), notes, F.when(by_tree, "species_tree").otherwise("taxonomy"), plain(has("test_rank", "string")), plain(n_total), plain(n_mono),
        plain(nrf), state(nrf), plain(quartet), state(quartet), plain(mono), state(mono), plain(signals), weights, F.when(F.col("risk").isNull(), NA).when(by_tree, "rf_and_quartet").otherwise("monophyly_only"),
        F.lit(json.dumps({"level1_max": level1_max, "level2_max": level2_max}, sort_keys=True)), F.lit(str(far)), F.lit(trimming or NA), F.lit(source or NA), plain(has("cached", "boolean")), F.lit(fired or NA),
    ]
    return evaluations.select(*[c.alias(n) for c, n in zip(made, EVALUATION)])


def run_config(options, versions: dict[str, str], databases: DataFrame | None = None) -> str:
    """The run's options, versions and, by path, the hashes of its databases as one JSON document with sorted keys."""
    hashes = {r.path: r.sha for r in databases.select("path", "sha").collect()} if databases is not None else {}
    return json.dumps({"schema_version": SCHEMA_VERSION, "options": dataclasses.asdict(options), "versions": versions, "databases": hashes}, sort_keys=True, indent=2, default=str)


def decision_cards(evaluations: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """card: a JSON document for each marker, keys sorted."""
    limits = F.struct(*[F.lit(v).alias(k) for k, v in sorted(thresholds.items())])
    columns = sorted(evaluations.columns)
    return evaluations.select("marker_id", F.to_json(F.struct(*[F.col(c) for c in columns], F.lit(SCHEMA_VERSION).alias("schema_version"), limits.alias("thresholds")), {"ignoreNullFields": "false"}).alias("card"))


def write_cards(cards: DataFrame, path: str, policy: str | None = None) -> None:
    cards.select("card").write.mode(MODES[policy]).text(path)


def write_fasta(seqs: DataFrame, path: str, policy: str | None = None) -> None:
    """id, seq as FASTA; a record is one output row."""
    seqs.select(F.regexp_replace(fasta_record(F.col("id"), F.col("seq")), "\n$", "").alias("value")).write.mode(MODES[policy]).text(path)


def write_newick(trees: DataFrame, path: str, policy: str | None = None) -> None:
    """One tree a line, blank ones dropped."""
    trees.where("trim(newick) <> ''").select("newick").write.mode(MODES[policy]).text(path)


def partition_nexus(parts: DataFrame) -> DataFrame:
    """line: a Nexus charset for each marker."""
    return parts.orderBy("start").select(F.concat(F.lit("  charset "), F.col("marker_id").cast("string"), F.lit(" = "), F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string"), F.lit(";")).alias("line"))


def excluded_profile(grades: DataFrame, categories: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Markers that are not consistent, with category and level; absent ones are NA."""
    joined = grades.where("grade <> 'consistent'").join(categories, "marker_id", "left").join(evaluations.select("marker_id", "level", "risk"), "marker_id", "left")
    return joined.select("marker_id", "grade", F.coalesce("category", F.lit(NA)).alias("category"), F.coalesce("level", F.lit("unknown")).alias("level"), na(F.col("risk")).alias("risk"))


def summary_text(report: DataFrame) -> str:
    """The run in words, from the one-row report."""
    r = report.first()
    shown = "NA" if r.coverage is None else f"{r.coverage:.2f}"
    out = [f"markers: {r.n_markers}", f"level 1/2/3: {r.n_level_1}/{r.n_level_2}/{r.n_level_3}", f"unknown: {r.n_unknown}", f"evidence coverage: {shown}"]
    if r.coverage is not None and r.coverage < 0.5:
        out.append("WARNING: less than half of the markers have evidence")
    return "\n".join(out) + "\n"


def html_page(title: str, tables: dict[str, DataFrame], rows: int = 200) -> str:
    """A page of tables. Of a table with more than `rows` rows it shows the first and says so."""
    out = [f"<!DOCTYPE html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>" + "".join(f"<th>{html.escape(c)}</th>" for c in df.columns) + "</tr>")
        shown = df.limit(rows + 1).collect()
        for r in shown[:rows]:
            out.append("<tr>" + "".join(f"<td>{'N/A' if v is None else html.escape(str(v))}</td>" for v in r) + "</tr>")
        out.append("</table>")
        if len(shown) > rows:  # a page is for reading; the table itself is a product of its own
            out.append(f"<p class='cut'>The first {rows} of {df.count()} rows; all are in the table {html.escape(name)}.</p>")
    return "".join(out)


class Stages:
    """Stage products as Parquet folders with a manifest; a later stage refuses missing or empty products."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def save(self, stage: str, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.root}/{stage}/{name}")
        note = json.dumps({"schema_version": SCHEMA_VERSION, "stage": stage, "tables": sorted(tables)})
        self.spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/{stage}/_manifest_json")

    def load(self, stage: str) -> dict[str, DataFrame]:
        note = json.loads(self.spark.read.text(f"{self.root}/{stage}/_manifest_json").first()[0])
        if note["schema_version"] != SCHEMA_VERSION:
            raise ValueError(f"stage {stage} was written with schema version {note['schema_version']}")
        return {name: self.spark.read.parquet(f"{self.root}/{stage}/{name}") for name in note["tables"]}
