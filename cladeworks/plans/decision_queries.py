"""Queries over trees, risks and reports, with their SQL. Tree answers come from the grouping keys in SQL, from Newick strings in Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import scalars as S
from ..operators import alignment as A
from ..operators import assertions as C
from ..operators import consensus as K
from ..operators import decisions as D
from ..operators import evaluation as E
from ..operators import induced as I
from ..operators import provenance as V
from ..operators import splits as B
from ..operators import taxonomy as T
from ..operators import trees as R
from ..scratch import saved
from . import proxy as P
from .registry import register

r6 = lambda c, n=6: F.round(c, n)


def clades(s, d):
    return R.clades(P.trees(s, d))


def nodes(s, d):
    return saved(R.nodes(P.trees(s, d)), "nodes")


def pairs(s, d):
    return s.createDataFrame([(0, k) for k in range(1, P.N_TREES)], "a int, b int")


def taxa_long(s, d):
    """Tips of the trees with their nation and region as phylum and domain."""
    t = T.parse_table(P.lineage(s, d), "dpg").withColumn("tip", F.concat(F.lit("t"), F.col("tip").cast("string")))
    return T.long(t)


TAXA = """tl AS (SELECT 't' || tip AS tip, 'domain' AS rank, domain AS taxon, 0 AS i FROM taxa WHERE domain IS NOT NULL UNION ALL SELECT 't' || tip, 'phylum', phylum, 1 FROM taxa WHERE phylum IS NOT NULL UNION ALL SELECT 't' || tip, 'genus', genus, 5 FROM taxa WHERE genus IS NOT NULL)"""
# clades by content: every inner node's sorted tips, and the splits that count
CLADES = """cl AS (SELECT tree_id, string_agg(tip, ',' ORDER BY tip) AS c, count(*) AS n FROM groups GROUP BY tree_id, g HAVING count(*) >= 2),
root AS (SELECT tree_id, string_agg(tip, ',' ORDER BY tip) AS c, count(*) AS n FROM tips GROUP BY 1), allc AS (SELECT DISTINCT tree_id, c, n FROM (SELECT * FROM cl UNION ALL SELECT * FROM root))"""
register("tree_tips", lambda s, d: P.trees(s, d).select("tree_id", F.explode(S.newick_tips(F.col("newick"))).alias("tip")), P.oracle("SELECT tree_id::INT AS tree_id, tip FROM tips"))
register("tree_nodes", lambda s, d: R.nodes(P.trees(s, d)).groupBy("tree_id", "is_leaf").agg(F.count(F.lit(1)).alias("n")), P.oracle("SELECT tree_id::INT AS tree_id, is_leaf, count(*) AS n FROM (SELECT tree_id, TRUE AS is_leaf, tip AS c FROM tips UNION ALL SELECT tree_id, FALSE, c FROM allc) GROUP BY ALL", CLADES))
register("tree_clades", lambda s, d: clades(s, d).select("tree_id", F.array_join(F.array_sort("tips"), ",").alias("c"), F.size("tips").cast("long").alias("n")).distinct(), P.oracle("SELECT tree_id::INT AS tree_id, c, n FROM allc", CLADES))
SPLITS = """sp AS (SELECT DISTINCT g.tree_id, g.g AS g, string_agg(t.tip, ',' ORDER BY t.tip) FILTER (g2.tip IS NOT NULL) AS inside, string_agg(t.tip, ',' ORDER BY t.tip) FILTER (g2.tip IS NULL) AS outside,
count(g2.tip) AS n_in, count(*) - count(g2.tip) AS n_out FROM (SELECT DISTINCT tree_id, g FROM groups) g JOIN tips t ON t.tree_id = g.tree_id LEFT JOIN groups g2 ON g2.tree_id = g.tree_id AND g2.g = g.g AND g2.tip = t.tip GROUP BY g.tree_id, g.g),
splits AS (SELECT DISTINCT tree_id, CASE WHEN string_split(inside, ',') <= string_split(outside, ',') THEN inside ELSE outside END AS side FROM sp WHERE n_in >= 2 AND n_out >= 2)"""
register("tree_split_sides", lambda s, d: R.splits(clades(s, d)).select("tree_id", F.array_join("side", ",").alias("side")), P.oracle("SELECT tree_id::INT AS tree_id, side FROM splits", SPLITS))
SPLIT_SUMS = """hashed AS (SELECT *, ('0x' || substr(sha256(tip), 1, 10))::BIGINT AS h1, ('0x' || substr(sha256(tip), 11, 10))::BIGINT AS h2, ('0x' || substr(sha256(tip), 21, 10))::BIGINT AS h3 FROM tips),
whole AS (SELECT tree_id, count(*) AS n, sum(h1) AS h1, sum(h2) AS h2, sum(h3) AS h3 FROM hashed GROUP BY 1),
inside AS (SELECT tree_id, count(*) AS n, sum(h1) AS h1, sum(h2) AS h2, sum(h3) AS h3 FROM hashed JOIN groups USING (tree_id, tip) GROUP BY tree_id, g),
parted AS (SELECT i.tree_id, w.n AS n_tips, row(i.n, i.h1, i.h2, i.h3) AS x, row(w.n - i.n, w.h1 - i.h1, w.h2 - i.h2, w.h3 - i.h3) AS y FROM inside i JOIN whole w USING (tree_id) WHERE i.n >= 2 AND w.n - i.n >= 2),
sums AS (SELECT DISTINCT tree_id, n_tips, CASE WHEN x < y THEN x ELSE y END AS side FROM parted)"""
register("tree_splits", lambda s, d: R.splits(clades(s, d)).select("tree_id", F.array_join("side", ",").alias("side")), P.oracle("SELECT tree_id::INT AS tree_id, side FROM splits", SPLITS))
register(
    "tree_split_sums",
    lambda s, d: B.splits(nodes(s, d), ["tree_id"]).select("tree_id", "n_tips", "side.*"),
    P.oracle("SELECT tree_id::INT AS tree_id, n_tips, side[1] AS n, side[2]::BIGINT AS h1, side[3]::BIGINT AS h2, side[4]::BIGINT AS h3 FROM sums", SPLIT_SUMS),
)
RF = """pr AS (SELECT k AS b FROM range(1, 6) r(k)), common AS (SELECT b, t.tip FROM pr JOIN tips t ON t.tree_id = b JOIN tips z ON z.tree_id = 0 AND z.tip = t.tip),
cg AS (SELECT c.b, w.which, g.g, c.tip FROM common c, (VALUES (0), (1)) w(which) JOIN groups g ON g.tree_id = CASE WHEN w.which = 0 THEN 0 ELSE c.b END AND g.tip = c.tip),
cs AS (SELECT b, which, g, string_agg(tip, ',' ORDER BY tip) AS inside, count(*) AS n FROM cg GROUP BY ALL),
cn AS (SELECT b, count(*) AS n_shared, string_agg(tip, ',' ORDER BY tip) AS every, min(tip) AS least FROM common GROUP BY 1),
ck AS (SELECT DISTINCT cs.b, which, CASE WHEN list_contains(string_split(inside, ','), least) THEN inside ELSE array_to_string(list_filter(string_split(every, ','), lambda x: NOT list_contains(string_split(inside, ','), x)), ',') END AS key FROM cs JOIN cn USING (b) WHERE n >= 2 AND n_shared - n >= 2)"""
register(
    "rf_distance", lambda s, d: R.rf_distance(pairs(s, d), nodes(s, d)).select("a", "b", F.col("n_shared").cast("long").alias("n_shared"), "rf", r6("normalized_rf").alias("normalized_rf")),
    P.oracle("SELECT 0 AS a, b::INT AS b, n_shared, coalesce(rf, 0)::BIGINT AS rf, round(CASE WHEN n_shared <= 3 THEN 0.0 ELSE coalesce(rf, 0)::DOUBLE / (2 * (n_shared - 3)) END, 6) AS normalized_rf FROM cn LEFT JOIN (SELECT b, count(*) AS rf FROM (SELECT b, key FROM ck GROUP BY ALL HAVING count(*) = 1) GROUP BY 1) USING (b)", RF),
)
QUARTETS = RF + """, few AS (SELECT b, tip, row_number() OVER (PARTITION BY b ORDER BY tip) AS i FROM common),
q0 AS (SELECT w.b, w.tip AS t1, x.tip AS t2, y.tip AS t3, z.tip AS t4 FROM few w JOIN few x ON w.b = x.b AND w.tip < x.tip JOIN few y ON x.b = y.b AND x.tip < y.tip JOIN few z ON y.b = z.b AND y.tip < z.tip WHERE w.i <= 8 AND x.i <= 12 AND y.i <= 14),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b ORDER BY t1, t2, t3, t4) AS i FROM q0) WHERE i <= 200),
side AS (SELECT DISTINCT b, which, string_split(key, ',') AS s FROM ck),
shape AS (SELECT q.b, i, side.which, min(CASE WHEN (list_contains(s, t1))::INT = (list_contains(s, t2))::INT THEN 1 WHEN (list_contains(s, t1))::INT = (list_contains(s, t3))::INT THEN 2 ELSE 3 END) AS p FROM q JOIN side USING (b) WHERE (list_contains(s, t1))::INT + (list_contains(s, t2))::INT + (list_contains(s, t3))::INT + (list_contains(s, t4))::INT = 2 GROUP BY ALL),
agree AS (SELECT q.b, q.i, coalesce(x.p, 0) = coalesce(y.p, 0) AS same FROM q LEFT JOIN shape x ON x.b = q.b AND x.i = q.i AND x.which = 0 LEFT JOIN shape y ON y.b = q.b AND y.i = q.i AND y.which = 1)"""
register("quartet_agreement", lambda s, d: R.quartet_agreement(pairs(s, d), nodes(s, d), 200).select("a", "b", "n_quartets", r6("agreement").alias("agreement")), P.oracle("SELECT 0 AS a, b::INT AS b, count(*) AS n_quartets, round(avg(same::INT), 6) AS agreement FROM agree GROUP BY b", QUARTETS))
# the place of a quartet in lexicographic order, from its tips' places
STRIDE = """sized AS (SELECT b, count(*) AS n FROM common GROUP BY 1), few AS (SELECT b, n, tip, row_number() OVER (PARTITION BY b ORDER BY tip) - 1 AS i FROM common JOIN sized USING (b)),
q0 AS (SELECT w.b, w.n, w.tip AS t1, x.tip AS t2, y.tip AS t3, z.tip AS t4, w.n * (w.n - 1) * (w.n - 2) * (w.n - 3) // 24 AS total,
  (w.n * (w.n - 1) * (w.n - 2) * (w.n - 3) - (w.n - w.i) * (w.n - w.i - 1) * (w.n - w.i - 2) * (w.n - w.i - 3)) // 24
  + ((w.n - w.i - 1) * (w.n - w.i - 2) * (w.n - w.i - 3) - (w.n - x.i) * (w.n - x.i - 1) * (w.n - x.i - 2)) // 6
  + ((w.n - x.i - 1) * (w.n - x.i - 2) - (w.n - y.i) * (w.n - y.i - 1)) // 2 + z.i - y.i - 1 AS place
  FROM few w JOIN few x ON w.b = x.b AND w.i < x.i JOIN few y ON x.b = y.b AND x.i < y.i JOIN few z ON y.b = z.b AND y.i < z.i),
q AS (SELECT *, place AS i FROM (SELECT *, greatest(1, total // 200) AS step FROM q0) WHERE place % step = 0 AND place < least(total, step * 200)),"""
STRIDED = RF + ", " + STRIDE + QUARTETS[QUARTETS.index("side AS ("):]
register("quartet_stride", lambda s, d: R.quartet_agreement(pairs(s, d), nodes(s, d), None, 200).select("a", "b", "n_quartets", r6("agreement").alias("agreement")), P.oracle("SELECT 0 AS a, b::INT AS b, count(*) AS n_quartets, round(avg(same::INT), 6) AS agreement FROM agree GROUP BY b", STRIDED))
MONO = TAXA + ", " + CLADES + """, tg AS (SELECT t.tree_id, rank, i, taxon, string_agg(t.tip, ',' ORDER BY t.tip) AS grp, count(*) AS n FROM tips t JOIN tl USING (tip) GROUP BY ALL),
tested AS (SELECT tg.*, CASE WHEN EXISTS (SELECT 1 FROM allc WHERE allc.tree_id = tg.tree_id AND (allc.c = tg.grp OR allc.c = array_to_string(list_filter(string_split(root.c, ','), lambda x: NOT list_contains(string_split(tg.grp, ','), x)), ','))) THEN 1 ELSE 0 END AS mono
FROM tg JOIN root ON root.tree_id = tg.tree_id WHERE tg.n >= 2 AND root.n - tg.n >= 2), mp AS (SELECT tree_id, rank, i, avg(mono) AS proportion, count(*) AS n_total, sum(mono)::BIGINT AS n_mono FROM tested GROUP BY ALL)"""


def mono(s, d):
    return R.monophyly(nodes(s, d), taxa_long(s, d))


register("monophyly_proportion", lambda s, d: mono(s, d).select("tree_id", "rank", r6("proportion").alias("proportion"), "n_total", "n_mono"), P.oracle("SELECT tree_id::INT AS tree_id, rank, round(proportion, 6) AS proportion, n_total, n_mono FROM mp", MONO))


def screened(s, d, requested=None):
    c = clades(s, d)
    return D.taxonomy_screen(mono(s, d), T.scope_rank(R.tips(c), T.parse_table(P.lineage(s, d), "dpg").withColumn("tip", F.concat(F.lit("t"), F.col("tip").cast("string")))), requested)


register("monophyly_rank_fallback", lambda s, d: screened(s, d).select("tree_id", "test_rank", r6("risk").alias("risk"), "n_total"), P.oracle("SELECT tree_id::INT AS tree_id, first(rank ORDER BY (rank = 'genus') DESC, i DESC) AS test_rank, round(1 - first(proportion ORDER BY (rank = 'genus') DESC, i DESC), 6) AS risk, first(n_total ORDER BY (rank = 'genus') DESC, i DESC) AS n_total FROM mp GROUP BY 1", MONO))
register("monophyly_requested", lambda s, d: screened(s, d, "family").select("tree_id", "test_rank", "cross_rank"), P.oracle("SELECT tree_id::INT AS tree_id, first(rank ORDER BY i DESC) AS test_rank, TRUE AS cross_rank FROM mp GROUP BY 1", MONO))
register("reference_legality", lambda s, d: R.legality(P.trees(s, d), s.createDataFrame([(0, 1), (1, 0), (2, 2), (9, 1)], "a int, b int")), P.oracle("SELECT * FROM (VALUES (0, 1, 'POLYTOMY'), (1, 0, 'TIPSET_MISMATCH'), (2, 2, 'POLYTOMY'), (9, 1, 'MALFORMED')) v(a, b, verdict)"))
# a fifth of a nation's customers as two ladders: by key, and with every seventh moved up by so much, in a third of the nations not at all; some have a polytomy or lack tips
MOVED = "c_custkey + CASE WHEN c_custkey % 7 = 0 THEN (c_nationkey % 3) * {step} ELSE 0 END"


def ladders(s, d, step):
    own = P.table(s, d, "customer").select("c_nationkey", (F.col("c_nationkey") * 5 + F.col("c_custkey") % 5).alias("tree_id"), F.expr(MOVED.format(step=step)).alias("place"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("tip"))
    whole = F.array_sort(F.collect_list(F.struct("place", "tip")))  # a tree's tips
    order = F.when(F.lit(step > 0) & (F.first("c_nationkey") % 8 == 5), F.slice(whole, 2, 1 << 30)).otherwise(whole)
    names = F.transform("o", lambda x: x["tip"])
    steps = F.concat(F.repeat(F.lit("("), F.size("o") - 1), F.get(names, F.lit(0)), F.array_join(F.transform(F.slice(names, 2, F.size("o")), lambda t: F.concat(F.lit(","), t, F.lit(")"))), ""), F.lit(";"))
    star = F.concat(F.lit("("), F.array_join(names, ","), F.lit(");"))
    return own.groupBy("tree_id", "c_nationkey").agg(order.alias("o")).select("tree_id", F.when(F.lit(step > 0) & (F.col("c_nationkey") % 8 == 6), star).otherwise(steps).alias("newick"))


LADDERS = f"""rows AS (SELECT *, count(*) OVER (PARTITION BY t) AS size FROM (SELECT c_nationkey * 5 + c_custkey % 5 AS t, c_nationkey AS nation, 'c' || c_custkey AS tip, c_custkey AS x, {MOVED.format(step=400)} AS y FROM customer)),
placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY x) AS i, row_number() OVER (PARTITION BY t ORDER BY y, tip) AS j, row_number() OVER (PARTITION BY t ORDER BY tip) - 1 AS k, count(*) OVER (PARTITION BY t) AS n,
  ('0x' || substr(sha256(tip), 1, 15))::BIGINT::HUGEINT AS h FROM rows WHERE size >= 4 AND nation % 8 NOT IN (5, 6)),
heads AS (SELECT t, 0 AS w, i AS k, n, sum(h) OVER (PARTITION BY t ORDER BY i) AS h, sum(h) OVER (PARTITION BY t) AS total FROM placed UNION ALL SELECT t, 1, j, n, sum(h) OVER (PARTITION BY t ORDER BY j), sum(h) OVER (PARTITION BY t) FROM placed),
parts AS (SELECT DISTINCT t, w, n, least(h, total - h) AS h FROM heads WHERE k >= 2 AND n - k >= 2),
rf AS (SELECT t, count(*) AS rf FROM (SELECT t, h FROM parts GROUP BY ALL HAVING count(*) = 1) GROUP BY 1),
places AS (SELECT DISTINCT t, n, total, CASE WHEN total > 200 THEN floor(m * (total / 200.0::DOUBLE))::BIGINT ELSE m END AS place FROM (SELECT DISTINCT t, n, n * (n - 1) * (n - 2) * (n - 3) // 24 AS total FROM placed), range(200) r(m) WHERE total > 200 OR m < total),
qs AS (SELECT a.t, [a.i, b.i, c.i, e.i] AS xs, [a.j, b.j, c.j, e.j] AS ys FROM placed a JOIN placed b ON a.t = b.t AND a.k < b.k JOIN placed c ON b.t = c.t AND b.k < c.k JOIN placed e ON c.t = e.t AND c.k < e.k
  JOIN places p ON p.t = a.t AND p.place = (p.n * (p.n - 1) * (p.n - 2) * (p.n - 3) - (p.n - a.k) * (p.n - a.k - 1) * (p.n - a.k - 2) * (p.n - a.k - 3)) // 24
  + ((p.n - a.k - 1) * (p.n - a.k - 2) * (p.n - a.k - 3) - (p.n - b.k) * (p.n - b.k - 1) * (p.n - b.k - 2)) // 6 + ((p.n - b.k - 1) * (p.n - b.k - 2) - (p.n - c.k) * (p.n - c.k - 1)) // 2 + e.k - c.k - 1),
mates AS (SELECT t, list_sort([list_position(xs, list_sort(xs)[1]), list_position(xs, list_sort(xs)[2])]) AS p, list_sort([list_position(ys, list_sort(ys)[1]), list_position(ys, list_sort(ys)[2])]) AS q FROM qs),
quartet AS (SELECT t, avg((p = q OR NOT list_has_any(p, q))::INT) AS agreement FROM mates GROUP BY 1)"""
register(
    "tree_conflicts",
    lambda s, d: R.conflicts(ladders(s, d, 0), ladders(s, d, 400)).select("tree_id", "verdict", "n_shared", r6("nrf").alias("nrf"), r6("agreement").alias("agreement"), D.conflict_note(F.col("nrf")).alias("note")),
    P.oracle("""SELECT c.t::VARCHAR AS tree_id, CASE WHEN size < 4 THEN 'TOO_FEW_TIPS' WHEN nation % 8 = 5 THEN 'TIPSET_MISMATCH' WHEN nation % 8 = 6 THEN 'POLYTOMY' ELSE 'LEGAL' END AS verdict, m.n::INT AS n_shared, m.nrf, m.agreement, CASE WHEN nrf IS NULL THEN 'not_measurable' WHEN nrf < 0.1 THEN 'concordant' WHEN nrf < 0.3 THEN 'minor_conflict' ELSE 'major_conflict' END AS note
FROM (SELECT DISTINCT t, nation, size FROM rows) c LEFT JOIN (SELECT p.t, p.n, round(coalesce(rf, 0) / (2.0::DOUBLE * (p.n - 3)), 6) AS nrf, round(agreement, 6) AS agreement FROM (SELECT DISTINCT t, n FROM placed) p LEFT JOIN rf USING (t) JOIN quartet USING (t)) m USING (t)""", LADDERS),
)
FOCAL = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def merged_regions(s, d):
    """Tree k holds the regions as groups, two of them under one branch: which pairs can it not tell apart."""
    focal = R.tips(clades(s, d)).join(taxa_long(s, d).where("rank = 'domain'"), "tip").where("tree_id = 0").select(F.col("taxon").alias("grp"), "tip")
    names = focal.groupBy("grp").agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list("tip")), ","), F.lit(")")).alias("x"))  # a tree's tips
    at = F.array_position(F.array(*map(F.lit, FOCAL)), F.col("grp")) - 1
    k = F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree_id")
    turned = names.select("x", at.alias("at"), k).groupBy("tree_id").agg(F.array_sort(F.collect_list(F.struct(F.pmod(F.col("at") - F.col("tree_id"), F.lit(5)).alias("p"), "x"))).alias("g"))
    x = lambda i: F.get("g", F.lit(i))["x"]
    tree = F.concat(F.lit("(("), x(0), F.lit(","), x(1), F.lit("),("), x(2), F.lit(",("), x(3), F.lit(","), x(4), F.lit(")));"))
    return R.collapsed(R.nodes(turned.select("tree_id", tree.alias("newick"))), focal)


register("clades_merged", merged_regions, P.oracle("""SELECT k::INT AS tree_id, least(a, b) AS x, greatest(a, b) AS y FROM (SELECT k, names[(k + i) % 5 + 1] AS a, names[(k + i + 1) % 5 + 1] AS b
FROM range(5) r(k), (VALUES (0), (3)) v(i), (SELECT ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'] AS names)) WHERE (SELECT count(DISTINCT outer_) FROM tips WHERE tree_id = 0) = 5"""))
register("special_nodes", lambda s, d: R.special_node(clades(s, d), R.tips(clades(s, d)).join(taxa_long(s, d).where("rank = 'domain'"), "tip").select("tree_id", F.col("taxon").alias("name"), "tip")).select("tree_id", "name", F.size("tips").alias("n")), P.oracle("""SELECT w.tree_id::INT AS tree_id, name, min(allc.n)::INT AS n FROM (SELECT tree_id, taxon AS name, list(t.tip) AS w FROM tips t JOIN tl ON tl.tip = t.tip AND rank = 'domain' GROUP BY ALL) w JOIN allc ON allc.tree_id = w.tree_id AND list_has_all(string_split(allc.c, ','), w.w) GROUP BY ALL""", TAXA + ", " + CLADES))
CONSENSUS = """same AS (SELECT tip FROM tips GROUP BY 1 HAVING count(DISTINCT tree_id) = 6), hs AS (SELECT tip, ('0x' || substr(sha256(tip), 1, 10))::BIGINT AS h1, ('0x' || substr(sha256(tip), 11, 10))::BIGINT AS h2 FROM same),
every AS (SELECT count(*) AS n, sum(h1) AS h1, sum(h2) AS h2, min(tip) AS least FROM hs), held AS (SELECT tree_id, g, count(*) AS n, sum(h1) AS h1, sum(h2) AS h2, bool_or(tip = (SELECT least FROM every)) AS outside FROM groups JOIN hs USING (tip) GROUP BY ALL),
cluster AS (SELECT DISTINCT tree_id, CASE WHEN outside THEN e.n - c.n ELSE c.n END AS n, CASE WHEN outside THEN e.h1 - c.h1 ELSE c.h1 END AS h1, CASE WHEN outside THEN e.h2 - c.h2 ELSE c.h2 END AS h2 FROM held c, every e WHERE c.n >= 2 AND e.n - c.n >= 2)"""


def clusters_of(s, d):
    table = nodes(s, d)
    return K.clusters(table, K.common_tips(table))


register(
    "consensus_clusters", lambda s, d: K.majority(clusters_of(s, d)).select("cluster.n", "cluster.h1", "cluster.h2", r6("support").alias("support")),
    P.oracle("SELECT n::BIGINT AS n, h1::BIGINT AS h1, h2::BIGINT AS h2, round(count(*) / 6.0::DOUBLE, 6) AS support FROM cluster GROUP BY ALL HAVING count(*) > 3", CONSENSUS),
)


def greedy_tree(s, d):
    table = nodes(s, d)
    common = K.common_tips(table)
    return K.as_newick(K.assembled(K.greedy(K.clusters(table, common), table, common), table, common))


register("consensus_greedy", greedy_tree)
INDUCED = """kept AS (SELECT tree_id, tip FROM tips WHERE (substr(tip, 2)::BIGINT + tree_id) % 3 > 0), kh AS (SELECT *, ('0x' || substr(sha256(tip), 1, 10))::BIGINT AS h1, ('0x' || substr(sha256(tip), 11, 10))::BIGINT AS h2 FROM kept),
kc AS (SELECT tree_id, count(*) AS n, sum(h1)::BIGINT AS h1, sum(h2)::BIGINT AS h2 FROM kh JOIN groups USING (tree_id, tip) GROUP BY tree_id, g HAVING count(*) >= 2 UNION SELECT tree_id, count(*), sum(h1)::BIGINT, sum(h2)::BIGINT FROM kh GROUP BY 1)"""


def induced(s, d):
    """The trees on two thirds of their tips, another third left out in each."""
    kept = R.tips(clades(s, d)).where((F.substring("tip", 2, 10).cast("long") + F.col("tree_id")) % 3 > 0)
    return saved(I.induced_trees(nodes(s, d), kept), "induced")


register(
    "induced_trees", lambda s, d: B.clade_sums(induced(s, d), ["tree_id"]).select("tree_id", "clade.n", "clade.h1", "clade.h2"),
    P.oracle("SELECT tree_id::INT AS tree_id, n, h1, h2 FROM kc", INDUCED),
)
register(
    "internal_branches", lambda s, d: I.internal_branches(nodes(s, d)).select("tree_id", "support", "clade.n"),
    P.oracle("SELECT tree_id::INT AS tree_id, NULL::DOUBLE AS support, n FROM (SELECT tree_id, c, n FROM cl EXCEPT SELECT tree_id, c, n FROM root)", CLADES),
)
register("consensus_splits", lambda s, d: R.consensus(clades(s, d), 0.3).select(F.array_join("side", ",").alias("side"), r6("support").alias("support")), P.oracle("SELECT side, round(count(DISTINCT tree_id) / 6.0::DOUBLE, 6) AS support FROM splits GROUP BY 1 HAVING count(DISTINCT tree_id) / 6.0 > 0.3", SPLITS))
register("gene_tree_filter", lambda s, d: R.filter_gene_trees(P.trees(s, d), 4, 0.5).select("tree_id", "dropped"), P.oracle("SELECT DISTINCT tree_id::INT AS tree_id, 'low_support' AS dropped FROM tips"))
# a tree string a supplier, with one of these faults or none; @ is its name
FAULTS = [
    ("((A,B),(@,D));", ""), ("((A,B),(A,@));", "duplicate_tips"), ("((A:-1,B),(C,@));", "negative_length"), ("((A,B),(C,@);", "unbalanced"), ("((A,),(C,@));", "empty_tip"), ("(A,@)", "no_semicolon"),
    (")A,@(;", "unbalanced"), ("(('A(1)','it''s ),;[')x,(@,D)x);", "duplicate_internal"), ("(('a:-1','a,,b')[((],(@,D));", ""), ("((A,B),('@,D));", "unbalanced"),
]


def by_turn(texts):
    """One of the texts for each supplier, by key, with its name for @."""
    chosen = F.element_at(F.array(*map(F.lit, texts)), (F.col("s_suppkey") % len(texts) + 1).cast("int"))
    return F.replace(chosen, F.lit("@"), F.col("s_name"))


def chosen_sql(texts):
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for t in texts)
    return f"replace([{quoted}][s_suppkey % {len(texts)} + 1], '@', s_name)"


register("newick_validate", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", F.array_join(S.newick_problems(by_turn([t for t, _ in FAULTS])), ",").alias("problems")), f"SELECT s_suppkey, {chosen_sql([v for _, v in FAULTS])} AS problems FROM supplier")
LABELS = [("((A, 'B(1) of @'),('it''s'[x,y]:1,@))'r,(s';", "A|B(1) of @|it's|@"), ("(@:2,(b,'c,d')0.9,e)x;", "@|b|c,d|e"), ("('[@]',(a[(,z],q),a);", "[@]|a|q")]
register("newick_labels", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", F.array_join(S.newick_tips(by_turn([t for t, _ in LABELS])), "|").alias("tips")), f"SELECT s_suppkey, {chosen_sql([v for _, v in LABELS])} AS tips FROM supplier")
SUPPORTED = "concat('((A,B)', s_suppkey % 101, ',(C,D)', s_suppkey * 7 % 120, ',(E,F)x)', s_nationkey, ';')"
register("mean_support", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", r6(S.mean_support(F.expr(SUPPORTED))).alias("support")), """SELECT s_suppkey, round(CASE WHEN y <= 100 THEN (x + y) / 2.0::DOUBLE / CASE WHEN greatest(x, y) > 1 THEN 100 ELSE 1 END END, 6) AS support FROM (SELECT s_suppkey, s_suppkey % 101 AS x, s_suppkey * 7 % 120 AS y FROM supplier)""")
register("nhx", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", F.concat(F.lit("(A[&&NHX:taxon="), F.col("s_name"), F.lit(":completeness=9],B);")).alias("n")).select("s_suppkey", S.nhx_values(F.col("n"))[0]["taxon"].alias("taxon"), S.strip_nhx(F.col("n")).alias("plain")), "SELECT s_suppkey, s_name AS taxon, '(A,B);' AS plain FROM supplier")
register("mad_root", lambda s, d: R.mad_rooted(P.trees(s, d)).select("tree_id", "method"))
register("gene_trees_nj", lambda s, d: R.neighbour_joining(P.alignment(s, d)).select("marker_id", F.size(S.newick_tips(F.col("newick"))).alias("n_tips"), "method"), P.oracle("SELECT marker_id, count(*)::INT AS n_tips, 'nj-builtin' AS method FROM aln GROUP BY 1 HAVING count(*) >= 4"))
RULES = [("r1", "monophyletic", "phylum", 2), ("r2", "monophyletic", "domain", 2), ("r3", "sister", "phylum", 2)]
register("mustpass", lambda s, d: T.must_pass(clades(s, d), R.tips(clades(s, d)), T.parse_table(P.lineage(s, d), "dpg").withColumn("tip", F.concat(F.lit("t"), F.col("tip").cast("string"))), s.createDataFrame(RULES, "rule string, relation string, level string, min_taxa int"), 1000), P.oracle("""SELECT tg.tree_id::INT AS tree_id, rule, relation, rank, taxon, n::INT AS members, CASE WHEN relation <> 'monophyletic' THEN 'not_checked' WHEN EXISTS (SELECT 1 FROM allc WHERE allc.tree_id = tg.tree_id AND allc.c = tg.grp) THEN 'pass' ELSE 'violation' END AS result
FROM tg JOIN (VALUES ('r1', 'monophyletic', 'phylum'), ('r2', 'monophyletic', 'domain'), ('r3', 'sister', 'phylum')) r(rule, relation, level) ON tg.rank = r.level WHERE n >= 2""", MONO))

# decisions
EVAL = """ev0 AS (SELECT *, CASE WHEN nrf IS NULL OR quartet IS NULL THEN NULL ELSE round(0.5 * nrf + 0.5 * (1 - quartet), 9) END AS risk FROM risks),
ev1 AS (SELECT *, CASE WHEN risk IS NULL THEN 'unknown' WHEN risk < 0.25 THEN 'level_1' WHEN risk < 0.6 THEN 'level_2' ELSE 'level_3' END AS level, least(abs(risk - 0.25), abs(risk - 0.6)) / 0.6 AS dist FROM ev0),
ev AS (SELECT *, CASE WHEN risk IS NULL THEN NULL WHEN dist >= 0.4 THEN 'high' WHEN dist >= 0.15 THEN 'medium' ELSE 'low' END AS confidence,
CASE WHEN nrf IS NULL AND quartet IS NULL THEN 'no_evidence' WHEN nrf IS NULL THEN 'rf_unmeasured' WHEN quartet IS NULL THEN 'quartet_unmeasured' END AS reason FROM ev1)"""


def ev(s, d):
    return D.evaluate(P.risks(s, d))


register("risk_level", lambda s, d: ev(s, d).select("marker_id", r6("risk").alias("risk"), "level", "confidence", "reason", "state"), P.oracle("SELECT marker_id, round(risk, 6) AS risk, level, confidence, reason, CASE WHEN risk IS NULL THEN 'not_measurable' ELSE 'measured' END AS state FROM ev", EVAL))
register("risk_level_far", lambda s, d: D.evaluate(P.risks(s, d), far=True).groupBy("level").agg(F.count(F.lit(1)).alias("n")), P.oracle("SELECT CASE WHEN risk IS NULL THEN 'unknown' WHEN risk < 0.25 THEN 'level_1' WHEN risk < 0.95 THEN 'level_2' ELSE 'level_3' END AS level, count(*) AS n FROM ev GROUP BY 1", EVAL))
register("hgt_report", lambda s, d: D.report(ev(s, d)).withColumns({"mean_risk": r6("mean_risk"), "coverage": r6("coverage")}), P.oracle("SELECT count(*) FILTER (level = 'level_1') AS n_level_1, count(*) FILTER (level = 'level_2') AS n_level_2, count(*) FILTER (level = 'level_3') AS n_level_3, count(*) FILTER (level = 'unknown') AS n_unknown, count(*) AS n_markers, round(avg(coalesce(risk, 0)), 6) AS mean_risk, count(*) FILTER (confidence = 'high') AS n_high_confidence, round(count(*) FILTER (level <> 'unknown') / count(*)::DOUBLE, 6) AS coverage FROM ev", EVAL))
BASIS = "concat_ws('+', CASE WHEN nrf IS NOT NULL THEN 'rf' END, CASE WHEN quartet IS NOT NULL THEN 'quartet' END)"
register(
    "risk_tally", lambda s, d: D.tally(ev(s, d).withColumns({"detector": F.when(F.col("marker_id") % 3 == 0, "taxonomy").otherwise("species_tree"), "basis": F.expr(BASIS)}), ["level", "detector", "basis"], [["level", "detector", "basis"], ["level", "detector"], ["level"], ["basis"], []]).withColumn("mean_risk", r6("mean_risk")),
    P.oracle("""SELECT level, detector, basis, grouping_id(level, detector, basis)::BIGINT AS grouping_id, count(*) AS n, round(avg(risk), 6) AS mean_risk
FROM (SELECT *, CASE WHEN marker_id % 3 = 0 THEN 'taxonomy' ELSE 'species_tree' END AS detector, concat_ws('+', CASE WHEN nrf IS NOT NULL THEN 'rf' END, CASE WHEN quartet IS NOT NULL THEN 'quartet' END) AS basis FROM ev)
GROUP BY GROUPING SETS ((level, detector, basis), (level, detector), (level), (basis), ())""", EVAL),
)
register("unmeasured_reasons", lambda s, d: D.reasons(ev(s, d)), P.oracle("SELECT reason, count(*) AS n, array_to_string(list_sort(list(marker_id::VARCHAR))[1:8], ',') AS first FROM ev WHERE level = 'unknown' GROUP BY 1", EVAL))
register("risk_backfill", lambda s, d: D.backfill(P.risks(s, d).select("marker_id"), ev(s, d)).select("marker_id", r6("hgt_risk").alias("hgt_risk")), P.oracle("SELECT marker_id, round(risk, 6) AS hgt_risk FROM ev", EVAL))
BANDS = [(0.2, 0.5), (0.3, 0.6), (0.4, 0.7), (0.5, 0.9)]
BAND_SQL = ", bands AS (SELECT * FROM (VALUES (0, 0.2::DOUBLE, 0.5::DOUBLE), (1, 0.3, 0.6), (2, 0.4, 0.7), (3, 0.5, 0.9)) v(band, l1, l2))"
register("threshold_scan", lambda s, d: D.threshold_scan(ev(s, d), D.bands(s, BANDS)).withColumn("mean_risk", r6("mean_risk")), P.oracle("SELECT band, l1, l2, count(*) FILTER (risk < l1) AS n_l1, count(*) FILTER (risk >= l1 AND risk < l2) AS n_l2, count(*) FILTER (risk >= l2) AS n_l3, count(*) FILTER (risk IS NULL) AS n_unknown, count(*) FILTER (risk IS NULL OR risk < l2) AS n_selected, count(*) FILTER (risk = l1 OR risk = l2) AS n_at_boundary, round(avg(risk), 6) AS mean_risk FROM ev, bands GROUP BY ALL", EVAL + BAND_SQL))
JACCARD = "SELECT x.band AS a, y.band AS b, round(count(*) FILTER ((risk IS NULL OR risk < x.l2) AND (risk IS NULL OR risk < y.l2)) / (count(*) FILTER ((risk IS NULL OR risk < x.l2) OR (risk IS NULL OR risk < y.l2)))::DOUBLE, 6) AS jaccard FROM ev, bands x, bands y WHERE x.band < y.band GROUP BY ALL"
register("scan_jaccard", lambda s, d: D.scan_jaccard(ev(s, d), D.bands(s, BANDS)).withColumn("jaccard", r6("jaccard")), P.oracle(JACCARD, EVAL + BAND_SQL))
register("scan_stability", lambda s, d: D.scan_stability(D.scan_jaccard(ev(s, d), D.bands(s, BANDS)).withColumn("jaccard", r6("jaccard"))), P.oracle(f"SELECT min(jaccard) AS min_jaccard, min(jaccard) >= 0.5 AS stable FROM ({JACCARD})", EVAL + BAND_SQL))


def legs(s, d):
    return P.risks(s, d).select("marker_id", (F.col("nrf") / 4).alias("nrf_a"), (F.col("quartet") / 3 + 0.6).alias("quartet_a"), (F.col("nrf") / 3).alias("nrf_b"), (F.col("quartet") / 2 + 0.5).alias("quartet_b"), "pis")


AGREE = "CASE WHEN nrf IS NOT NULL AND quartet IS NOT NULL THEN nrf / 4 <= 0.15 AND quartet / 3 + 0.6 >= 0.7 END AS fa, CASE WHEN nrf IS NOT NULL AND quartet IS NOT NULL THEN nrf / 3 <= 0.15 AND quartet / 2 + 0.5 >= 0.7 END AS fb"
GRADES = f"gr AS (SELECT marker_id, pis, nrf, quartet, CASE WHEN pis < 5 THEN 'inconclusive' WHEN fa IS NULL OR fb IS NULL THEN 'inconclusive' WHEN fa AND fb THEN 'consistent' WHEN fa OR fb THEN 'inconsistent' ELSE 'inconclusive' END AS grade FROM (SELECT *, {AGREE} FROM risks))"
register("consistency_grade", lambda s, d: D.consistency(legs(s, d), 3, 5).select("marker_id", "grade", r6("strength_a").alias("strength_a")), P.oracle("SELECT marker_id, grade, round(quartet / 3 + 0.6 - nrf / 4, 6) AS strength_a FROM gr", GRADES))
register("grade_tally", lambda s, d: D.grade_tally(D.consistency(legs(s, d), 3, 5)), P.oracle("SELECT count(*) FILTER (grade = 'consistent') AS consistent, count(*) FILTER (grade = 'inconsistent') AS inconsistent, count(*) FILTER (grade = 'inconclusive') AS inconclusive FROM gr", GRADES))
register("hybrid_verdict", lambda s, d: D.hybrid(ev(s, d), D.consistency(legs(s, d), 3, 5)), P.oracle("SELECT marker_id, CASE WHEN level = 'level_3' THEN 'excluded_by_transfer' WHEN grade = 'consistent' THEN 'passes_both' ELSE 'excluded_by_consistency' END AS verdict FROM ev LEFT JOIN gr USING (marker_id)", EVAL + ", " + GRADES))
register("pis_floor", lambda s, d: D.pis_floor(ev(s, d), 10).select("marker_id", "level", "note"), P.oracle("SELECT marker_id, level, CASE WHEN pis < 10 AND level <> 'unknown' THEN 'inconclusive' END AS note FROM ev", EVAL))
register("conflict_note", lambda s, d: P.risks(s, d).select("marker_id", D.conflict_note(F.col("nrf")).alias("note")), P.oracle("SELECT marker_id, CASE WHEN nrf IS NULL THEN 'not_measurable' WHEN nrf < 0.1 THEN 'concordant' WHEN nrf < 0.3 THEN 'minor_conflict' ELSE 'major_conflict' END AS note FROM risks"))
register("recommend_tree", lambda s, d: D.recommend(P.risks(s, d).select("marker_id", "nrf", (F.col("marker_id") % 7 > 0).alias("has_coalescent"), (F.col("marker_id") % 5 > 0).alias("has_report"), (F.col("marker_id") % 2 == 0).alias("shared"))).select("marker_id", "tree", "confidence"), P.oracle("""SELECT marker_id, CASE WHEN marker_id % 7 = 0 THEN 'concat' WHEN marker_id % 5 = 0 THEN 'unknown' WHEN nrf IS NULL THEN 'none' WHEN nrf < 0.1 THEN 'concat' ELSE 'coalescent' END AS tree,
CASE WHEN marker_id % 7 = 0 THEN 'medium' WHEN marker_id % 5 = 0 THEN 'unknown' WHEN nrf IS NULL THEN 'inconclusive' WHEN nrf < 0.1 THEN CASE WHEN marker_id % 2 = 0 THEN 'medium' ELSE 'high' END WHEN nrf < 0.3 THEN 'medium' ELSE 'low' END AS confidence FROM risks"""))
register("independence", lambda s, d: D.independence(P.risks(s, d).select((F.col("marker_id") % 3 == 0).alias("cached"))).withColumn("shared_ratio", r6("shared_ratio")), P.oracle("SELECT round(count(*) FILTER (marker_id % 3 = 0) / count(*)::DOUBLE, 6) AS shared_ratio, TRUE AS ref_built_from_tested_markers FROM risks"))


def similar(s, d):
    return P.table(s, d, "lineitem").groupBy((F.col("l_partkey") % 10).alias("q"), (F.col("l_suppkey") % 10).alias("s")).agg(F.sum("l_quantity").alias("score"))


register("bbh", lambda s, d: D.reciprocal_best(similar(s, d)), P.oracle("SELECT x.q, x.s FROM b x JOIN b y ON x.q = y.s AND x.s = y.q WHERE x.q < y.q", "h AS (SELECT l_partkey % 10 AS q, l_suppkey % 10 AS s, sum(l_quantity) AS score FROM lineitem GROUP BY ALL), b AS (SELECT q, first(s ORDER BY score DESC, s) AS s FROM h WHERE q <> s GROUP BY q)"))
register("ortholog_length", lambda s, d: D.length_representative(P.table(s, d, "documents").select(F.col("source").alias("marker_id"), F.col("doc_id").alias("id"), F.length("text").alias("length"))), P.oracle("SELECT marker_id, median, first(id ORDER BY abs(l - median), id) AS id FROM (SELECT source AS marker_id, doc_id AS id, length(text)::INT AS l FROM documents) JOIN (SELECT source AS marker_id, (list_sort(list(length(text)))[count(*) // 2 + 1])::INT AS median FROM documents GROUP BY 1) USING (marker_id) GROUP BY ALL"))

# evaluation
register("ablation_displacement", lambda s, d: E.displacement(P.risks(s, d).select("marker_id", F.col("nrf").alias("score")), P.risks(s, d).where("marker_id % 6 > 0").select("marker_id", F.col("quartet").alias("score"))).where("marker_id is not null"), P.oracle("""SELECT coalesce(x.marker_id, y.marker_id) AS marker_id, x.r AS rank_baseline, y.r AS rank_ablated, y.r - x.r AS displacement, CASE WHEN x.r IS NULL THEN 'ablated_only' WHEN y.r IS NULL THEN 'baseline_only' ELSE 'both' END AS presence
FROM (SELECT marker_id, rank() OVER (ORDER BY nrf DESC)::INT AS r FROM risks WHERE nrf IS NOT NULL) x FULL JOIN (SELECT marker_id, rank() OVER (ORDER BY quartet DESC)::INT AS r FROM risks WHERE quartet IS NOT NULL AND marker_id % 6 > 0) y USING (marker_id)"""))
register("kendall_tau", lambda s, d: E.kendall_tau(P.risks(s, d).select(F.col("nrf").alias("a"), F.col("quartet").alias("b"))).withColumn("tau", r6("tau")), P.oracle("""SELECT round(s / sqrt((n - ta) * (n - tb)), 6) AS tau FROM (SELECT sum(sign(x.nrf - y.nrf) * sign(x.quartet - y.quartet))::DOUBLE AS s, count(*)::DOUBLE AS n, count(*) FILTER (x.nrf = y.nrf)::DOUBLE AS ta, count(*) FILTER (x.quartet = y.quartet)::DOUBLE AS tb
FROM risks x JOIN risks y ON x.marker_id < y.marker_id WHERE x.nrf IS NOT NULL AND y.nrf IS NOT NULL AND x.quartet IS NOT NULL AND y.quartet IS NOT NULL)"""))
register("precision_recall", lambda s, d: E.detection(P.risks(s, d).where("marker_id % 3 = 0"), ev(s, d).where("level = 'level_3'")).select("tp", "fp", "fn", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1")), P.oracle("SELECT tp, fp, fn, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1 FROM (SELECT count(*) FILTER (marker_id % 3 = 0 AND level = 'level_3') AS tp, count(*) FILTER (marker_id % 3 <> 0 AND level = 'level_3') AS fp, count(*) FILTER (marker_id % 3 = 0 AND level <> 'level_3') AS fn FROM ev)", EVAL))
TOLD = "SELECT marker_id, marker_id % 3 = 0 AS t, level = 'level_3' AS c, row_number() OVER (ORDER BY marker_id) - 1 AS place, count(*) OVER () AS n FROM ev"
register(
    "bootstrap_f1", lambda s, d: E.bootstrap_f1(P.risks(s, d).where("marker_id % 3 = 0"), ev(s, d).where("level = 'level_3'"), P.risks(s, d), 200).select(*[r6(c).alias(c) for c in ("f1", "low", "high")]),
    P.oracle("SELECT round((SELECT f1 FROM whole), 6) AS f1, round(quantile_cont(f1, 0.025), 6) AS low, round(quantile_cont(f1, 0.975), 6) AS high FROM boot", EVAL + f""", told AS MATERIALIZED ({TOLD}),
whole AS (SELECT coalesce(2 * count(*) FILTER (t AND c) / nullif(2 * count(*) FILTER (t AND c) + count(*) FILTER (t <> c), 0)::DOUBLE, 0) AS f1 FROM told),
draws AS (SELECT id // (SELECT any_value(n) FROM told) AS k, ('0x' || substr(sha256('0:' || id), 1, 15))::BIGINT % (SELECT any_value(n) FROM told) AS place FROM (SELECT unnest(range((SELECT 200 * any_value(n) FROM told))) AS id)),
boot AS (SELECT k, coalesce(2 * count(*) FILTER (t AND c) / nullif(2 * count(*) FILTER (t AND c) + count(*) FILTER (t <> c), 0)::DOUBLE, 0) AS f1 FROM draws JOIN told USING (place) GROUP BY k)"""),
)


def state(s, d):
    e = ev(s, d)
    run = e.agg((F.count_if(F.col("level") != "unknown") / F.count(F.lit(1))).alias("coverage"), F.count(F.lit(1)).alias("n_markers")).withColumns({"level1_max": F.lit(D.LEVEL1_MAX), "level2_max": F.lit(D.LEVEL2_MAX), "far_active": F.lit(False), "n_far_cards": F.lit(0)})
    steps = e.select(F.col("marker_id").alias("gene_id"), "nrf", "quartet", F.lit("measured").alias("quartet_state"), F.lit(10).alias("n_shared"))
    fields = e.select(F.col("nrf").alias("value"), S.na(F.col("nrf")).alias("rendered"))
    return {"fields": fields, "steps": steps, "evaluations": e, "run": run, "probe": s.createDataFrame([(1.0, 0.0)], "conflict_risk double, identical_risk double"), "proportions": s.createDataFrame([(0.5, 2)], "proportion double, n_total int")}


register("assertions", lambda s, d: C.run(s, state(s, d)).select("assertion_id", "result", "n"), "SELECT v.*, 0::BIGINT AS n FROM (VALUES ('A-01', 'pass'), ('A-02', 'pass'), ('A-03', 'pass'), ('A-04', 'pass'), ('A-05', 'pass'), ('A-06', 'pass'), ('A-07', 'not_checked'), ('A-08', 'not_checked'), ('A-09', 'not_checked'), ('A-10', 'not_checked'), ('A-11', 'pass'), ('A-12', 'pass'), ('A-13', 'pass'), ('A-14', 'pass')) v(assertion_id, result)")

# formats and labels
NAMES = "CASE s_suppkey % 6 WHEN 0 THEN 'a.fastq' WHEN 1 THEN 'b.PHY' WHEN 2 THEN 'c.sto' WHEN 3 THEN 'd.faa' WHEN 4 THEN 'e' ELSE 'f' END"
FIRST = "CASE s_suppkey % 6 WHEN 4 THEN '>x' WHEN 5 THEN ' 4 10 ' ELSE '' END"
register("sequence_format", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", S.sequence_format(F.expr(NAMES), F.expr(FIRST)).alias("format")), "SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'fastq' WHEN 1 THEN 'phylip' WHEN 2 THEN 'stockholm' WHEN 5 THEN 'phylip' ELSE 'fasta' END AS format FROM supplier")
register("tree_format", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", S.tree_format(F.expr("CASE s_suppkey % 3 WHEN 0 THEN 'a.nex' ELSE 'b.nwk' END"), F.expr("CASE s_suppkey % 3 WHEN 1 THEN '(A[&&NHX:x=1],B);' ELSE '(A,B);' END")).alias("format")), "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'nexus' WHEN 1 THEN 'nhx' ELSE 'newick' END AS format FROM supplier")
register("tree_source_priority", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", S.tree_source_priority(F.expr("CASE s_suppkey % 5 WHEN 0 THEN 'astral' WHEN 1 THEN 'consensus' WHEN 2 THEN 'concat' WHEN 3 THEN 'first_gene_tree' ELSE 'none' END")).alias("priority")), "SELECT s_suppkey, (4 - s_suppkey % 5)::INT AS priority FROM supplier")
register("embedded_labels", lambda s, d: P.table(s, d, "supplier").select("s_suppkey", L.embedded_lineage_column(F.expr("concat('g', s_suppkey, '_d_Bact_p_P', s_suppkey % 9, '_x_y_g_', CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END)")).alias("r")).select("s_suppkey", "r.domain", "r.phylum", "r.genus"), "SELECT s_suppkey, 'Bact' AS domain, 'P' || (s_suppkey % 9) || '_x_y' AS phylum, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_name END AS genus FROM supplier")
register("stale_trees", lambda s, d: V.to_rebuild(A.content_hash(P.alignment(s, d)), A.content_hash(P.alignment(s, d).where("taxon % 50 <> 7"))), P.oracle("SELECT DISTINCT marker_id FROM aln WHERE taxon % 50 = 7"))
register("provenance_gaps", lambda s, d: V.incomplete(P.table(s, d, "supplier").select(F.when(F.col("s_suppkey") % 4 == 0, "TODO").otherwise(F.col("s_name")).alias("name"), F.when(F.col("s_suppkey") % 3 == 0, None).otherwise("v1").alias("version"))), "SELECT 'name' AS field, count(*) AS n FROM supplier WHERE s_suppkey % 4 = 0 UNION ALL SELECT 'version', count(*) FROM supplier WHERE s_suppkey % 3 = 0")
