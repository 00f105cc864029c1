"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Base kinds are regular expressions. The method adds tokens of 16 characters or more that look random: two first-order
Markov chains over characters are trained from labelled samples and a token is a finding of kind `model` if

    sum of log2 P(character | the one before, random) - log2 P(character | the one before, ordinary) >= PRIOR_BITS,

that is, if it is likelier random even where one token in 2 ** PRIOR_BITS is. States are letters, without regard to
case, digits, and `outside`, which separators count as: shouted words, camelCase, paths and slugs of ordinary words stay
ordinary.

Labelled samples: ordinary are all tokens of 6 characters or more of the corpus outside base findings, counted as often
as they occur, so that unlisted secrets among them weigh little; random are all base findings of the corpus, and
RANDOM_STRINGS generated strings in five alphabets (a documented bound of a made sample; everything else covers every
text). Both random samples have an equal say in each context.

All of it is DataFrame functions. Training counts tokens where the texts are, then the transitions of each different
token; the trained table has STATES * STATES numbers whatever the corpus and travels as a literal. A scan is a
projection: no shuffle. Offsets come from the lengths of matches and of the gaps between them, in blocks, so that a text with very
many matches doesn't cost their square.

Defined cases: null text counts as empty and has no spans; repeated rows and null ids each have their own result; a text of
any length is scanned whole; without any text the ordinary model is uniform; an empty table gives an empty result; extra
columns pass through, a column `spans` is replaced. Model findings that overlap a base finding are dropped, base ones never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds and their patterns
KINDS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
MIN_ASSIGNED = 6
MODEL = "model"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
STATES = len(ALPHABET) + 1  # 0: outside
TOKEN, ORDINARY = r"[A-Za-z0-9+/_-]{16,}={0,2}", r"[A-Za-z0-9+/_-]{6,}={0,2}"
RANDOM_STRINGS, SMOOTH, PRIOR_BITS = 4096, 0.5, 20.0
BLOCK = 256
SPAN = "struct<kind:string,start:int,end:int>"


def once(value: Column, use) -> Column:
    """use(value), with value computed once however often `use` reads it."""
    return F.transform(F.array(value), use)[0]


def running(sizes: Column) -> Column:
    """Sums up to and with each entry, block by block."""

    def total(values):
        return F.aggregate(values, F.lit(0), lambda a, b: a + b)

    def placed(x):
        blocks, sums = x["blocks"], x["sums"]
        before = F.transform(sums, lambda _, i: total(F.slice(sums, 1, i)))
        return once(before, lambda off: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda _, k: F.get(off, i) + total(F.slice(b, 1, k + 1))))))

    blocks = F.when(F.size(sizes) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
    return once(F.coalesce(blocks, F.array().cast("array<array<int>>")), lambda bs: once(F.struct(bs.alias("blocks"), F.transform(bs, total).alias("sums")), placed))


def located(text: Column, pattern: str) -> Column:
    """array of (said, start, end), in code points, of a pattern's matches from left to right."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(x):
        sizes = F.transform(x["said"], lambda said, i: F.length(F.get(x["gaps"], i)) + F.length(said))
        spans = lambda ends: F.transform(x["said"], lambda said, i: F.struct(said.alias("said"), (F.get(ends, i) - F.length(said)).alias("start"), F.get(ends, i).alias("end")))
        return once(once(sizes, running), spans)

    none = F.array().cast("array<struct<said:string,start:int,end:int>>")
    return F.when(text.rlike(pattern), once(F.struct(matches.alias("said"), gaps.alias("gaps")), placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """array of (kind, start, end) of the base kinds."""

    def of(kind, pattern):
        found = located(text, pattern)
        if kind == "assign":
            found = F.filter(found, lambda x: F.length(F.regexp_extract(x["said"], pattern, 2)) >= MIN_ASSIGNED)
        return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*[of(kind, pattern) for kind, pattern in KINDS.items()])


def transitions(token: Column) -> Column:
    """The token's steps from state to state, from outside and back, as STATES * from + to."""
    said = F.split(F.concat(F.lit(" "), F.lower(token), F.lit(" ")), "")
    states = F.transform(said, lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))
    return once(states, lambda s: F.transform(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda to, i: F.get(s, i) * STATES + to))


def counted(tokens: DataFrame, name: str) -> DataFrame:
    """step, and how often each transition occurs in the tokens (column token)."""
    different = tokens.groupBy("token").agg(F.count(F.lit(1)).alias(name))
    return different.select(name, F.explode(transitions(F.col("token"))).alias("step")).groupBy("step").agg(F.sum(name).alias(name))


def random_strings(docs: DataFrame, n: int = RANDOM_STRINGS) -> DataFrame:
    """token: n random strings in each of five alphabets, the same in every run."""
    sha = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 256)
    base64 = F.base64(F.unhex(sha))
    kinds = [sha, F.upper(sha), base64, F.regexp_replace(base64, "[+/=]", ""), F.upper(F.regexp_replace(base64, "[+/=]", ""))]
    return docs.sparkSession.range(n).select(F.explode(F.array(*kinds)).alias("token"))


def labelled(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(random, ordinary): tokens of base findings, and all other tokens of 6 characters or more, one row an occurrence."""
    said = F.coalesce(F.col(text), F.lit(""))
    found = [F.when(said.rlike(p), F.regexp_extract_all(said, F.lit(p), F.lit(2 if kind == "assign" else 0))).otherwise(F.array().cast("array<string>")) for kind, p in KINDS.items()]
    random = docs.select(F.explode(F.concat(*found)).alias("token")).where(F.length("token") >= 8)
    rest = F.when(said.rlike(KINDS["assign"]), F.regexp_replace(said, F.lit(KINDS["assign"]), F.lit(" "))).otherwise(said)
    tokens = docs.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("token"))
    return random, tokens.where(~F.col("token").rlike(KINDS["access"]) & ~F.col("token").rlike(KINDS["hex"]))


def train(random: DataFrame, ordinary: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """step, bits: log2 ratio of each transition, from samples of tokens (column token); STATES * STATES rows."""
    made = random_strings(random) if made is None else made
    grid = random.sparkSession.range(STATES * STATES).select(F.col("id").cast("int").alias("step"))
    for sample, name in ((random, "seen"), (made, "made"), (ordinary, "plain")):
        grid = grid.join(counted(sample, name), "step", "left").fillna(0, [name])
    grid = grid.withColumn("state", F.floor(F.col("step") / STATES))
    totals = grid.groupBy("state").agg(*[F.sum(c).alias(f"{c}_all") for c in ("seen", "made", "plain")])
    share = lambda c: (F.col(c) + SMOOTH) / (F.col(f"{c}_all") + SMOOTH * STATES)
    bits = F.log2((share("seen") + share("made")) / 2 / share("plain"))
    return grid.join(totals, "state").select("step", bits.alias("bits"))


def as_literal(model: DataFrame) -> Column:
    """The trained numbers, STATES * STATES of them whatever the corpus, as one array."""
    bits = model.agg(F.sort_array(F.collect_list(F.struct("step", "bits"))).alias("m")).select("m.bits").first()[0]
    return F.split(F.lit(",".join(map(repr, bits))), ",").cast("array<double>")


def score(token: Column, bits: Column) -> Column:
    """The token's log2 likelihood ratio."""
    return F.aggregate(transitions(token), F.lit(0.0), lambda a, step: a + F.get(bits, step))


def scan(docs: DataFrame, text: str = "text", model: DataFrame | None = None, prior_bits: float = PRIOR_BITS) -> DataFrame:
    """docs with spans: array of (kind, start, end) in code points, end exclusive, by start and then kind (the base kinds in their order, then `model`).

    model: what train() gives; None trains it on docs.
    """
    bits = as_literal(train(*labelled(docs, text)) if model is None else model)
    said = F.coalesce(F.col(text), F.lit(""))
    likely = F.filter(located(said, TOKEN), lambda x: score(x["said"], bits) >= prior_bits)

    def merged(x):
        new = F.filter(x["likely"], lambda c: ~F.exists(x["base"], lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])))
        new = F.transform(new, lambda c: F.struct(F.lit(MODEL).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        rank = lambda s: F.array_position(F.array(*map(F.lit, [*KINDS, MODEL])), s["kind"])
        keyed = F.transform(F.concat(x["base"], new), lambda s: F.struct(s["start"], rank(s), s.alias("span")))
        return F.transform(F.array_sort(keyed), lambda k: k["span"])

    spans = once(F.struct(base_spans(said).alias("base"), likely.alias("likely")), merged)
    return docs.drop("spans").withColumn("spans", spans.cast(f"array<{SPAN}>"))
