"""The jobs as queries: each runs twice into one new folder and returns the whole output as it stands then."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeworks.plans import proxy as P
from cladeworks.plans.marker_queries import BEST, STRATUM
from cladeworks.scratch import fresh

from . import clade_panels, sequence_ledger
from .common import configured


def job1_clade_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, config = fresh(spark, "clade_panels"), configured("clade_panels")
    clade_panels.run(spark, sf_dir, out, config)
    return clade_panels.run(spark, sf_dir, out, config)


def job2_sequence_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, config = fresh(spark, "sequence_ledger"), configured("sequence_ledger")
    sequence_ledger.run(spark, sf_dir, f"{out}/ledger", f"{out}/checkpoint", config)
    return sequence_ledger.run(spark, sf_dir, f"{out}/ledger", f"{out}/checkpoint", config)


QUERIES = {"job1_clade_panels": job1_clade_panels, "job2_sequence_ledger": job2_sequence_ledger}

PANELS = f"""{BEST}, g AS (SELECT genome_id, r_name AS clade, completeness, contamination FROM quality JOIN supplier ON s_suppkey = genome_id JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
h AS (SELECT clade, count(*) AS total, count(*) FILTER ({STRATUM} = 'high') / count(*)::DOUBLE AS high FROM g GROUP BY 1),
p AS (SELECT clade, total, CASE WHEN high > 0.7 THEN 30.0 WHEN high > 0.3 THEN 20.0 ELSE 15.0 END AS score_floor, CASE WHEN high > 0.7 THEN 0.75 WHEN high > 0.3 THEN 0.55 ELSE 0.35 END::DOUBLE AS min_occupancy,
  CASE WHEN high > 0.7 THEN 60 WHEN high > 0.3 THEN 80 ELSE 150 END AS max_markers FROM h),
st AS (SELECT clade, genome_id, marker_id, CASE count(DISTINCT target) FILTER (score >= score_floor) WHEN 0 THEN 'absent' WHEN 1 THEN 'single_copy' ELSE 'multi_copy' END AS state FROM hits JOIN g USING (genome_id) JOIN p USING (clade) GROUP BY ALL),
oc AS (SELECT clade, marker_id, count(*) FILTER (state = 'single_copy') / any_value(total)::DOUBLE AS occupancy FROM st JOIN p USING (clade) GROUP BY ALL),
panel AS (SELECT clade, marker_id, occupancy, row_number() OVER (PARTITION BY clade ORDER BY occupancy DESC, marker_id)::INT AS rank, max_markers FROM oc JOIN p USING (clade) WHERE occupancy >= min_occupancy)"""

ORACLES = {
    "job1_clade_panels": P.oracle("SELECT clade, marker_id, rank, round(occupancy, 6) AS occupancy, genome_id, state, target, score, length FROM panel JOIN st USING (clade, marker_id) JOIN best USING (genome_id, marker_id) WHERE rank <= max_markers AND state <> 'absent'", PANELS),
    "job2_sequence_ledger": r"""
WITH s AS (SELECT source AS marker_id, doc_id AS taxon, coalesce(text, '') AS raw, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', '', 'g')) AS seq FROM documents),
r AS (SELECT *, length(seq)::INT AS n_sites, length(regexp_replace(seq, '[^GC]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(seq, '[^ACGTUN]', '', 'g')), 0) AS gc, length(regexp_replace(seq, '[^XBZJUO]', '', 'g'))::INT AS n_ambiguous,
  regexp_matches(raw, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\x{202A}-\x{202E}\x{2066}-\x{2069}\x{200E}\x{200F}]') AS control_chars, sha256(seq) AS sha FROM s),
f AS (SELECT *, sha256(CASE WHEN taxon IS NULL THEN '-' ELSE strlen(taxon::VARCHAR) || ':' || taxon END || '64:' || sha) AS h FROM r),
m AS (SELECT marker_id, count(*) AS n_sequences, sum(('0x' || substr(h, 1, 15))::BIGINT)::HUGEINT AS s1, sum(('0x' || substr(h, 16, 15))::BIGINT)::HUGEINT AS s2 FROM f GROUP BY 1)
SELECT f.marker_id, taxon, n_sites, round(gc, 6) AS gc, n_ambiguous, control_chars, sha, n_sequences, sha256(n_sequences || ':' || s1 || ':' || s2) AS fingerprint, 0::BIGINT AS last_batch
FROM f JOIN m ON f.marker_id IS NOT DISTINCT FROM m.marker_id""",
}
