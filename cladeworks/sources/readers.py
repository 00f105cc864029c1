"""Readers of the text formats of comparative genomics, as DataFrames. Files are listed and read by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import has_control_chars, has_level_marker, mol_type
from ..operators import newick as N

# Which extension of a stem counts first, and merged profile libraries that are no single profiles.
GENOME_EXTENSIONS = ("faa", "fna", "fasta", "fa")
MERGED_LIBRARIES = ("Pfam-A", "tigrfam", "Pfam-B")


def stem(path):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """path, ordinal, line: the lines of each file in order."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.select("path", F.posexplode(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n")).alias("ordinal", "line"))


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """path, ordinal, seq_id, seq: every record of FASTA files, duplicates included.

    A record ends where a line begins with `>`, which Spark's text source splits by: a file is read in as many ranges as its
    size asks for (spark.sql.files.maxPartitionBytes), each from the first record that begins in it, and no row is larger
    than a record. ordinal rises through a file: the range, the row in it, the place in the row. Text before the first
    record is no record. Files with bare carriage returns for line ends are one row.
    """
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n>").text(path).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("range"), F.monotonically_increasing_id().alias("row"), "value")
    headless = ~F.col("value").startswith(">")
    # the first row of a file still has its `>`; one without is text before the records, and few files have any
    order = F.struct("range", "row")
    first = raw.groupBy("path").agg(F.min_by(headless, order).alias("headless"), F.min(order)["row"].alias("row")).where("headless").select("path", "row")
    kept = raw.join(first, ["path", "row"], "left_anti")
    text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^>", "")
    records = kept.select("path", "range", "row", F.posexplode(F.split(text, "\n>")).alias("place", "record"))
    head = F.substring_index("record", "\n", 1)
    body = F.when(F.instr("record", "\n") > 0, F.substring(F.col("record"), F.instr("record", "\n"), F.length("record"))).otherwise("")
    ordinal = F.struct("range", "row", "place").alias("ordinal")
    return records.select("path", ordinal, F.regexp_extract(head, r"^\s*(\S*)", 1).alias("seq_id"), F.regexp_replace(body, r"\s", "").alias("seq"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """path, seq_id, seq: the last record of an id counts."""
    return fasta_records(spark, path).groupBy("path", "seq_id").agg(F.max_by("seq", "ordinal").alias("seq"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("path", "seq_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_fasta(spark: SparkSession, path: str) -> DataFrame:
    """fasta(), but an id that repeats in a file raises at the action."""
    found = fasta_records(spark, path).groupBy("path", "seq_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("seq", "ordinal").alias("seq"))
    return found.select("path", "seq_id", F.when(F.col("n") == 1, F.col("seq")).otherwise(F.raise_error(F.concat(F.lit("sequence id occurs twice: "), "seq_id"))).alias("seq"))


def molecule(seqs: DataFrame) -> str:
    """DNA, RNA or protein by the letters of the first ten sequences (by id); none at all: protein."""
    from ..functions.scalars import strange_letters

    first = seqs.orderBy("seq_id").limit(10).agg(F.concat_ws("", F.collect_list("seq")).alias("all"))
    r = first.select("all", *[F.size(strange_letters(F.col("all"), m)).alias(m) for m in ("DNA", "RNA")]).first()
    return "protein" if not r["all"] else "DNA" if r.DNA == 0 else "RNA" if r.RNA == 0 else "protein"


def wrong_letters(seqs: DataFrame, kind: str) -> DataFrame:
    """seq_id, letters: sequences with letters that the molecule doesn't have."""
    from ..functions.scalars import strange_letters

    return seqs.select("seq_id", strange_letters(F.col("seq"), kind).alias("letters")).where("size(letters) > 0")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """path, seq_id, seq, quality of four-line records; n_lines % 4 <> 0 raises at the action."""
    rows = lines(spark, path).withColumn("k", (F.col("ordinal") / 4).cast("int"))
    wide = rows.groupBy("path", "k").agg(F.array_sort(F.collect_list(F.struct("ordinal", "line"))).alias("r")).where("size(r) > 1 or r[0].line <> ''")
    ok = F.when((F.size("r") == 4) & F.col("r")[0]["line"].startswith("@"), F.col("r")[1]["line"]).otherwise(F.raise_error(F.lit("a FASTQ record has four lines, the first with @")))
    return wide.select("path", F.regexp_extract(F.col("r")[0]["line"], r"^@(\S*)", 1).alias("seq_id"), ok.alias("seq"), F.col("r")[3]["line"].alias("quality"))


def listing(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, length, stem, extension of the files of a folder, empty ones included (Spark's own scans skip these)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    found, rows = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, recursive), []
    while found.hasNext():
        f = found.next()
        rows.append((f.getPath().toString(), f.getLen()))
    files = spark.createDataFrame(rows, "path string, length long")
    return files.select("path", "length", stem(F.col("path")).alias("stem"), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("extension"))


def genome_files(files: DataFrame) -> DataFrame:
    """genome_id, path, mol_type: one non-empty file a stem; .faa before .fna; .fasta and .fa only where there is neither."""
    order = F.array_position(F.array(*map(F.lit, GENOME_EXTENSIONS)), F.col("extension"))
    ok = files.withColumn("turn", order).where("turn > 0 and length > 0")
    first = ok.agg((F.min("turn") <= 2).alias("primary"))
    ok = ok.crossJoin(F.broadcast(first)).where(~F.col("primary") | (F.col("turn") <= 2))
    return ok.groupBy("stem").agg(F.min_by("path", "turn").alias("path")).select(F.col("stem").alias("genome_id"), "path", mol_type(F.col("path")).alias("mol_type"))


def ignored_files(files: DataFrame, used: DataFrame) -> DataFrame:
    return files.join(used.select("path"), "path", "left_anti").select("path", F.when(F.col("length") == 0, "empty").otherwise("unused").alias("why"))


def profiles(files: DataFrame) -> DataFrame:
    """marker_id of each profile file that is no merged library."""
    return files.where("extension = 'hmm'").where(~F.col("stem").isin(*MERGED_LIBRARIES)).select(F.col("stem").alias("marker_id")).distinct().orderBy("marker_id")


def marker_sequences(spark: SparkSession, path: str) -> DataFrame:
    """marker_id, genome_id, seq from per-marker FASTA files; the stem names the marker."""
    return fasta(spark, path).select(stem(F.col("path")).alias("marker_id"), F.col("seq_id").alias("genome_id"), "seq")


def domain_hits(spark: SparkSession, path: str) -> DataFrame:
    """Rows of domain tables: target, score, evalue, domain scores and coordinates; the stem is genome or genome__marker."""
    cols = F.split(F.trim("line"), r"\s+")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")).where("line not like '#%'").withColumn("c", cols).where("size(c) >= 22")
    at = lambda i, t: F.col("c")[i].try_cast(t)
    return rows.select(
        stem(F.col("path")).alias("source"), F.col("c")[0].alias("target"), F.col("c")[3].alias("query"), at(6, "double").alias("evalue"), at(7, "double").alias("score"), at(12, "double").alias("domain_evalue"), at(13, "double").alias("domain_score"),
        at(15, "int").alias("hmm_start"), at(16, "int").alias("hmm_end"), at(17, "int").alias("ali_start"), at(18, "int").alias("ali_end"), at(19, "int").alias("env_start"), at(20, "int").alias("env_end"),
        (at(18, "int") - at(17, "int") + 1).alias("length"),
    )


def quality_table(spark: SparkSession, path: str, genomes: DataFrame) -> DataFrame:
    """genome_id, completeness, contamination of known genomes."""
    rows = spark.read.csv(path, sep="\t", header=True)
    out = rows.select(F.col("Bin Id").alias("genome_id"), F.col("Completeness").try_cast("double").alias("completeness"), F.col("Contamination").try_cast("double").alias("contamination"))
    return out.where("completeness is not null and contamination is not null").join(genomes.select("genome_id"), "genome_id", "left_semi")


def taxonomy_table(spark: SparkSession, path: str) -> DataFrame:
    """tip, lineage, ordinal: two columns by tab, else comma; comments, a header (no rank marker), short rows and unsafe or empty tips go; a tip's last row counts."""
    rows = lines(spark, path).where("line <> '' and not startswith(line, '#')")
    parts = F.when(F.instr("line", "\t") > 0, F.split("line", "\t")).otherwise(F.split("line", ",", 2))
    out = rows.withColumn("c", parts).where("size(c) >= 2").select("path", "ordinal", F.trim(F.col("c")[0]).alias("tip"), F.trim(F.col("c")[1]).alias("lineage"))
    out = out.where((F.col("ordinal") > 0) | has_level_marker(F.col("lineage"))).where("tip <> ''").where(~has_control_chars(F.col("tip")))
    return out.groupBy("tip").agg(F.max_by("lineage", "ordinal").alias("lineage"), F.max("ordinal").alias("ordinal"))


def category_map(spark: SparkSession, path: str) -> DataFrame:
    """marker_id, category; rows without both are skipped, never invented."""
    rows = lines(spark, path).where("trim(line) <> '' and line not like '#%'").withColumn("c", F.split("line", "\t")).where("size(c) >= 2")
    out = rows.select(F.trim(F.col("c")[0]).alias("marker_id"), F.trim(F.col("c")[1]).alias("category"))
    return out.where("marker_id <> '' and category <> '' and marker_id <> 'marker_id'")


def ranking(spark: SparkSession, path: str, column: str) -> DataFrame:
    """marker_id, score (null where not a number)."""
    return spark.read.csv(path, sep="\t", header=True).select("marker_id", F.col(column).try_cast("double").alias("score"))


def newick_trees(spark: SparkSession, path: str) -> DataFrame:
    """path, ordinal, newick of every tree of Newick or Nexus files."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p, text in zip(batch.path, batch.value):
                if text.lstrip().lower().startswith("#nexus"):
                    found = [x.split("=", 1)[1].strip() for x in text.split("\n") if x.strip().lower().startswith("tree ") and "=" in x]
                else:
                    found = N.split_many(text)
                out += [(p, i, t) for i, t in enumerate(found)]
            yield pd.DataFrame(out, columns=["path", "ordinal", "newick"])

    return whole.mapInPandas(run, "path string, ordinal int, newick string")


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """marker_id and the measures cached beside gene trees, by file stem."""
    schema = "pis long, effective_columns long, rcv double, gc_bias double, n_sequences long"
    return spark.read.schema(schema).json(path, multiLine=True).select(stem(F.col("_metadata.file_path")).alias("marker_id"), "*")
