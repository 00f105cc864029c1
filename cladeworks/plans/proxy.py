"""Stand-ins for genomes, hits, qualities, lineages, alignments, risks and trees over the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("genome_id"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("genome_id"), (F.col("l_partkey") % 500).alias("marker_id"), F.col("l_orderkey").alias("target"), F.col("l_quantity").alias("score"),
        (F.col("l_partkey") % 97 + F.col("l_linenumber")).alias("length"), F.col("l_linenumber").alias("ordinal"),
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.abs(F.round(F.col("s_acctbal") * 100)).cast("long")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("genome_id"), (50 + cents % 5000 / 100).alias("completeness"), (cents % 1300 / 100).alias("contamination"), (F.col("s_suppkey") % 5).alias("kind")
    )


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tip, and a lineage string with ranks d, p, g; every seventh tip has an empty genus."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 25 and 5 rows at any scale
    genus = F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(F.concat("n_name", F.lit("-"), (F.col("s_suppkey") % 3).cast("string")))
    return joined.select(F.col("s_suppkey").alias("tip"), F.concat(F.lit("d__"), "r_name", F.lit(";p__"), "n_name", F.lit(";g__"), genus).alias("lineage"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """marker_id, taxon, seq: all letters of every document. Rows shorter than their marker's longest end in gaps, which the column operators count and nobody stores."""
    seq = F.coalesce(F.upper(F.regexp_replace("text", "[^A-Za-z]+", "")), F.lit(""))
    return table(spark, sf_dir, "documents").select(F.col("source").alias("marker_id"), F.col("doc_id").alias("taxon"), seq.alias("seq"))


def risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """marker_id, nrf, quartet, risk (null: unknown) from part keys."""
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 500).alias("marker_id")).distinct()
    nrf = F.when(F.col("marker_id") % 11 == 0, None).otherwise((F.col("marker_id") * 37 % 101) / 100.0)
    q = F.when(F.col("marker_id") % 13 == 0, None).otherwise((F.col("marker_id") * 53 % 101) / 100.0)
    return p.select("marker_id", nrf.alias("nrf"), q.alias("quartet"), (F.col("marker_id") * 17 % 40).alias("pis"))


N_TREES = 6


def grouped_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_id, tip, inner, outer: tree 0 by nation and region; tree k moves every (k + 3)rd tip to the next nation and leaves out some tips."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    k = F.explode(F.sequence(F.lit(0), F.lit(N_TREES - 1)))
    moved = (F.col("s_nationkey") + F.when((F.col("tree_id") > 0) & (F.col("s_suppkey") % (F.col("tree_id") + 3) == 0), 1).otherwise(0)) % 25
    tips = s.select("*", k.alias("tree_id")).where((F.col("tree_id") == 0) | (F.col("s_suppkey") % 9 != F.col("tree_id"))).withColumn("inner", moved)
    return tips.join(F.broadcast(n), tips.inner == n.n_nationkey).select("tree_id", F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("tip"), F.col("inner").cast("int"), F.col("n_regionkey").cast("int").alias("outer"))


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tree_id, newick."""

    def joined(c):
        return F.when(F.size(c) == 1, c[0]).otherwise(F.concat(F.lit("("), F.array_join(c, ","), F.lit(")")))

    t = grouped_tips(spark, sf_dir)
    a = t.groupBy("tree_id", "outer", "inner").agg(F.array_sort(F.collect_list("tip")).alias("x")).select("tree_id", "outer", joined(F.col("x")).alias("x"))
    b = a.groupBy("tree_id", "outer").agg(F.array_sort(F.collect_list("x")).alias("x")).select("tree_id", joined(F.col("x")).alias("x"))
    return b.groupBy("tree_id").agg(F.array_sort(F.collect_list("x")).alias("x")).select("tree_id", F.concat(joined(F.col("x")), F.lit(";")).alias("newick"))


SQL = r"""genomes AS (SELECT s_suppkey AS genome_id FROM supplier),
hits AS (SELECT l_suppkey AS genome_id, l_partkey % 500 AS marker_id, l_orderkey AS target, l_quantity AS score, l_partkey % 97 + l_linenumber AS length, l_linenumber AS ordinal FROM lineitem),
cells AS (SELECT genome_id, marker_id, CASE count(DISTINCT target) FILTER (score >= 15) WHEN 0 THEN 'absent' WHEN 1 THEN 'single_copy' ELSE 'multi_copy' END AS state FROM hits GROUP BY ALL),
occ AS (SELECT marker_id, count(*) FILTER (state = 'single_copy') AS n_single, count(*) FILTER (state = 'multi_copy') AS n_multi,
  (count(*) FILTER (state = 'single_copy'))::DOUBLE / (SELECT count(*) FROM genomes) AS occupancy,
  (count(*) FILTER (state = 'multi_copy'))::DOUBLE / (SELECT count(*) FROM genomes) AS multi_rate FROM cells GROUP BY ALL),
quality AS (SELECT s_suppkey AS genome_id, 50 + (abs(round(s_acctbal * 100))::BIGINT % 5000) / 100 AS completeness, (abs(round(s_acctbal * 100))::BIGINT % 1300) / 100 AS contamination, s_suppkey % 5 AS kind FROM supplier),
lineage AS (SELECT s_suppkey AS tip, 'd__' || r_name || ';p__' || n_name || ';g__' || CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE n_name || '-' || (s_suppkey % 3) END AS lineage
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
taxa AS (SELECT tip, nullif(regexp_extract(lineage, '(?:^|;)d__([^;]*)', 1), '') AS domain, nullif(regexp_extract(lineage, '(?:^|;)p__([^;]*)', 1), '') AS phylum,
  nullif(regexp_extract(lineage, '(?:^|;)g__([^;]*)', 1), '') AS genus FROM lineage),
aln AS (SELECT source AS marker_id, doc_id AS taxon, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS seq FROM documents),
aln_cells AS (SELECT marker_id, taxon, unnest(range(length(seq))) AS pos, unnest(string_split(seq, '')) AS residue FROM aln WHERE seq <> ''),
risks AS (SELECT marker_id, CASE WHEN marker_id % 11 = 0 THEN NULL ELSE (marker_id * 37 % 101) / 100.0::DOUBLE END AS nrf,
  CASE WHEN marker_id % 13 = 0 THEN NULL ELSE (marker_id * 53 % 101) / 100.0::DOUBLE END AS quartet, marker_id * 17 % 40 AS pis
  FROM (SELECT DISTINCT p_partkey % 500 AS marker_id FROM part)),
tips0 AS (SELECT k AS tree_id, s_suppkey, (s_nationkey + CASE WHEN k > 0 AND s_suppkey % (k + 3) = 0 THEN 1 ELSE 0 END) % 25 AS inner_ FROM supplier, range(6) r(k) WHERE k = 0 OR s_suppkey % 9 <> k),
tips AS (SELECT tree_id, 't' || s_suppkey AS tip, inner_, n_regionkey AS outer_ FROM tips0 JOIN nation ON inner_ = n_nationkey),
groups AS (SELECT tree_id, 'i' || inner_ AS g, tip FROM tips UNION ALL SELECT tree_id, 'o' || outer_, tip FROM tips),
n_tips AS (SELECT tree_id, count(*) AS n FROM tips GROUP BY 1)"""


def oracle(select: str, more: str = "") -> str:
    return f"WITH {SQL}{', ' + more if more else ''} {select}"
