"""Queries of the corpus operators, each over its whole table, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, extract, line_dedup, merkle, mixing, near, quality, secrets, substring, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive(table(spark, sf_dir, "pages"), payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "n_links")


CONTROL_TURN = "</s>[INST] ok [/INST]"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)], rows.schema)
    convs = chat.conversations(rows.unionByName(extra))
    return convs.select("conv_id", "key").join(chat.read_back(chat.prefix_trees(convs)), "key").drop("key")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.flag(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.cosine", "m.lcs")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"] != secrets.MODEL)
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    counts = [F.size(F.expr(f"filter(spans, x -> x.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS]
    return out.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lower = F.translate("text", line_dedup.UPPER, line_dedup.LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf_hash(*merkle.FIELDS[:-1], lower))
    out = merkle.proofs(docs, more={"tampered": tampered})
    out = out.withColumns({"proof_sha256": merkle.siblings_hash(F.col("path")), "folded_root": merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_chat_format": op3_chat_format,
    "op4_html_extract": op4_html_extract,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_mix_sources": op7_mix_sources,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_secrets": op11_secrets,
    "op12_merkle_manifest": op12_merkle_manifest,
}


def merkle_levels(name: str, levels: int) -> str:
    """Nodes `name`0 (tree, i, h, n) folded so many levels up, and each node's siblings before and after."""
    run = "OVER (PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
    out = []
    for k in range(levels):
        out.append(f"""{name}s{k} AS (SELECT *, CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS before,
  CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS after FROM {name}{k})""")
        folded = f"SELECT tree, i // 16 AS i, any_value(n) AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY tree, i // 16"
        out.append(f"{name}{k + 1} AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM ({folded}))")
    return ",\n".join(out)


def merkle_sql(levels: int = 5) -> str:
    """The manifest for groups of at most 16 ** levels rows."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(({x})::VARCHAR) || ':' || ({x})::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"
    lower = f"translate(text, '{line_dedup.UPPER}', '{line_dedup.LOWER}')"
    joins = "".join(f" JOIN as{k} ON as{k}.tree = r.tree AND as{k}.i = r.i // {16**k}" for k in range(levels)) + f" JOIN b0 ON b0.key = r.tree JOIN b{levels} ON true"
    joins += "".join(f" JOIN bs{k} ON bs{k}.i = b0.i // {16**k}" for k in range(levels))
    steps = [f"{x}s{k}" for x in "ab" for k in range(levels)]
    siblings = " || ".join(f"{s}.before || {s}.after" for s in steps)
    folds = "coalesce(tampered, leaf)"
    parts = []
    for k, s in enumerate(steps):
        parts.append(f"f{k} AS (SELECT * EXCLUDE (f), CASE WHEN {s}_n = 1 THEN f ELSE sha256({s}_before || f || {s}_after) END AS f FROM {f'f{k - 1}' if k else 'p'})")
    columns = ", ".join(f"{s}.n AS {s}_n, {s}.before AS {s}_before, {s}.after AS {s}_after" for s in steps)
    return f"""
WITH bits AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT *, {leaf("text")} AS leaf, coalesce('s' || source, '') AS tree,
  xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc FROM documents, bits),
r AS (SELECT *, CASE WHEN crc % 5 = 0 THEN {leaf(lower)} END AS tampered, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS total FROM d),
a0 AS (SELECT tree, i, leaf AS h, total AS n FROM r),
{merkle_levels("a", levels)},
b0 AS (SELECT tree AS key, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, count(*) OVER () AS n FROM a{levels}),
{merkle_levels("b", levels)},
p AS (SELECT doc_id, leaf, b0.h AS subroot, b{levels}.h AS root, sha256({siblings}) AS proof_sha256, {columns}, {folds} AS f FROM r{joins}),
{", ".join(parts)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps) - 1}"""

def secrets_sql() -> str:
    """Patterns, both Markov models and the scan."""
    quoted = {kind: "'" + p.replace("'", "''") + "'" for kind, p in {**secrets.KINDS, secrets.MODEL: secrets.TOKEN, "plain": secrets.ORDINARY}.items()}

    def located(kind: str, rank: int) -> str:
        p = quoted[kind]
        return f"""SELECT rid, '{kind}' AS kind, {rank} AS rank, said[i] AS said, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(said[1:i - 1], lambda g: length(g))), 0) AS start
  FROM (SELECT rid, said, gaps, unnest(range(1, len(said) + 1)) AS i FROM (SELECT rid, regexp_extract_all(text, {p}) AS said, string_split_regex(text, {p}) AS gaps FROM d))"""

    def steps(name: str, tokens: str) -> str:
        return f"""{name} AS (SELECT step, sum(n) AS n FROM (SELECT n, unnest(list_transform(range(1, length(s)), lambda i: {secrets.STATES} * instr('{secrets.ALPHABET}', s[i]) + instr('{secrets.ALPHABET}', s[i + 1]))) AS step
  FROM (SELECT ' ' || lower(token) || ' ' AS s, count(*) AS n FROM ({tokens}) GROUP BY token)) GROUP BY step)"""

    values = " UNION ALL ".join(f"SELECT unnest(regexp_extract_all(text, {quoted[k]}, {2 if k == 'assign' else 0})) AS token FROM d" for k in secrets.KINDS)
    stripped = f"SELECT unnest(regexp_extract_all(regexp_replace(text, {quoted['assign']}, ' ', 'g'), {quoted['plain']})) AS token FROM d"
    plain = f"SELECT token FROM ({stripped}) WHERE NOT regexp_matches(token, {quoted['access']}) AND NOT regexp_matches(token, {quoted['hex']})"
    made = f"""SELECT unnest([h, upper(h), b, regexp_replace(b, '[+/=]', '', 'g'), upper(regexp_replace(b, '[+/=]', '', 'g'))]) AS token
  FROM (SELECT sha256('random string ' || i) AS h, to_base64(unhex(h)) AS b FROM range({secrets.RANDOM_STRINGS}) r(i))"""
    share = lambda x: f"(coalesce({x}.n, 0) + {secrets.SMOOTH}::DOUBLE) / (sum(coalesce({x}.n, 0)) OVER (PARTITION BY g.step // {secrets.STATES}) + {secrets.SMOOTH}::DOUBLE * {secrets.STATES})"
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(located(kind, i) for i, kind in enumerate(secrets.KINDS))}),
base_spans AS (SELECT rid, kind, rank, start, start + length(said) AS stop FROM base WHERE kind <> 'assign' OR length(regexp_extract(said, {quoted["assign"]}, 2)) >= {secrets.MIN_ASSIGNED}),
{steps("seen", f"SELECT token FROM ({values}) WHERE length(token) >= 8")},
{steps("made", made)},
{steps("plain", plain)},
model AS (SELECT g.step, log2(({share("seen")} + {share("made")}) / 2 / ({share("plain")})) AS bits
  FROM range({secrets.STATES**2}) g(step) LEFT JOIN seen ON seen.step = g.step LEFT JOIN made ON made.step = g.step LEFT JOIN plain ON plain.step = g.step),
tokens AS MATERIALIZED ({located(secrets.MODEL, len(secrets.KINDS))}),
likely AS (SELECT token FROM (SELECT token, unnest(list_transform(range(1, length(s)), lambda i: {secrets.STATES} * instr('{secrets.ALPHABET}', s[i]) + instr('{secrets.ALPHABET}', s[i + 1]))) AS step
  FROM (SELECT DISTINCT said AS token, ' ' || lower(said) || ' ' AS s FROM tokens)) JOIN model USING (step) GROUP BY token HAVING sum(bits) >= {secrets.PRIOR_BITS}),
new AS (SELECT t.rid, t.kind, t.rank, t.start, t.start + length(t.said) AS stop FROM tokens t JOIN likely ON likely.token = t.said
  WHERE NOT EXISTS (SELECT 1 FROM base_spans b WHERE b.rid = t.rid AND b.start < t.start + length(t.said) AND b.stop > t.start)),
every AS (SELECT *, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS said FROM (SELECT * FROM base_spans UNION ALL SELECT * FROM new))
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (kind <> '{secrets.MODEL}'), '')) AS base_sha256, coalesce(string_agg(said, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN every USING (rid) GROUP BY rid, doc_id"""


ORACLES = {
    "op1_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(40), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [strpos('0123456789abcdef', hex[i + 1])]), '') AS bits, min(page_id) OVER (PARTITION BY hex) AS lo FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(5), lambda j: (bits[5 * i + j + 1])::INT * (2 ** (4 - j))::INT))::INT]), '') AS payload_digest,
  CASE WHEN page_id = lo THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = lo THEN NULL ELSE lo END AS refers_to
FROM b""",
    "op3_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (SELECT *, length(text) + length(role) + 13
    + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2 + (length(text) - length(replace(text, '<s>', ''))) // 3 + (length(text) - length(replace(text, '</s>', ''))) // 4
    + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7 + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7 + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8 AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op7_mix_sources": r"""
WITH d AS (SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
c AS (SELECT *, 2 * source_size AS cap,
    sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER o, 0) AS rest,
    sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, max(CASE WHEN rest / ws * w <= cap THEN rest / ws END) OVER () AS level FROM c),
t AS (SELECT source, source_size, round(coalesce(least(level * w, cap), cap)::DOUBLE, 6) AS target,
    CASE WHEN source_size > 0 THEN floor(round(coalesce(least(level * w, cap), cap)::DOUBLE, 6) / source_size)::BIGINT ELSE 0 END AS whole FROM l),
r AS (SELECT d.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS r,
    sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY d.source, h) AS own, row_number() OVER (PARTITION BY d.source, h) AS turn
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (whole + CASE WHEN size > 0 AND turn <= ceil((r - (upto - own)) / size - 0.5) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT rid, ws, unnest(range(len(ws) - 34)) AS i FROM d WHERE len(ws) >= 35),
w AS (SELECT rid, i, md5(array_to_string(ws[i + 1:i + 35], ' ')) AS h FROM p),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
g AS (SELECT DISTINCT rid, i + j AS pos FROM r, (SELECT unnest(range(35)) AS j)),
k AS (SELECT rid, ws, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d),
o AS (SELECT k.rid, count(g.pos) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY k.pos) FILTER (g.pos IS NULL), '') AS kept
  FROM k LEFT JOIN g ON k.rid = g.rid AND k.pos = g.pos GROUP BY k.rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN o USING (rid)""",
    "op9_line_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
g AS (SELECT rid, count(*) FILTER (c.key IS NOT NULL) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '') AS kept
  FROM k LEFT JOIN c ON k.key = c.key GROUP BY rid)
SELECT doc_id, len(ls)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN g USING (rid)""",
    "op12_merkle_manifest": merkle_sql(),
    "op11_secrets": secrets_sql(),
}
