"""Scalar functions over ids, lineages, sequences and Newick strings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranks with their one-letter codes, and residues that carry no signal.
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")
CODES = dict(zip("dpcofgs", RANKS))
AMINO = "ACDEFGHIKLMNPQRSTVWY"
GAPS = "-.~"
AMBIGUOUS = "XBZJUO?*"
NA = "NA"


def source_type(genome_id: Column) -> Column:
    """mag, sag or isolate from the name; mag wins."""
    return (
        F.when(genome_id.rlike("(?i)(^|[^a-z])(mag|bin)([^a-z]|$)"), "mag").when(genome_id.rlike("(?i)(^|[^a-z])sag([^a-z]|$)"), "sag").otherwise("isolate")
    )


def mol_type(path: Column) -> Column:
    return F.when(F.lower(path).endswith(".fna"), "nucleotide").otherwise("protein")


def sequence_format(path: Column, first_line: Column) -> Column:
    """By extension, else by the first line."""
    p = F.lower(path)
    return (
        F.when(p.rlike(r"\.(fastq|fq)$"), "fastq").when(p.rlike(r"\.(phy|phylip)$"), "phylip").when(p.rlike(r"\.(sto|stockholm)$"), "stockholm").when(p.rlike(r"\.(fa|faa|fna|fasta|fas)$"), "fasta")
        .when(first_line.startswith("@"), "fastq").when(first_line.startswith("# STOCKHOLM"), "stockholm").when(first_line.rlike(r"^\s*\d+\s+\d+\s*$"), "phylip").when(first_line.startswith(">"), "fasta")
    )


def tree_format(path: Column, first_line: Column) -> Column:
    p = F.lower(path)
    return F.when(p.rlike(r"\.(nex|nexus)$") | first_line.rlike("(?i)^#nexus"), "nexus").when(first_line.contains("[&&NHX"), "nhx").otherwise("newick")


def rank_value(lineage: Column, code: str) -> Column:
    """Value of a rank in a `d__X;p__Y` lineage; null if absent or empty. The last of repeated ranks counts."""
    values = F.regexp_extract_all(lineage, F.lit(rf"(?:^|;)\s*{code}__([^;]*)"), F.lit(1))
    last = F.trim(F.element_at(values, -1))
    return F.when(F.size(values) > 0, F.when((last != "") & ~last.contains("__"), last))


def parse_lineage(lineage: Column, codes: str = "dpcofgs") -> list[Column]:
    return [rank_value(lineage, c).alias(CODES[c]) for c in codes]


def segment_lineage(label: Column) -> Column:
    """Map from rank to value of a `_d_X_p_Y` label, cut at known codes."""
    parts = F.split(label, "_(?=[dpcofgs]_)")
    named = F.filter(parts, lambda x: x.rlike("^[dpcofgs]_."))
    ranks = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    entries = F.transform(named, lambda x: F.struct(F.element_at(ranks, F.substring(x, 1, 1)), F.regexp_replace(F.substr(x, F.lit(3)), "^_+|_+$", "")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["col1"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["col1"] == k), -1)))


def read_lineage(label: Column, codes: str = "dpcofgs") -> list[Column]:
    """Ranks of a label in whichever format it has: `d__X;p__Y` where a letter and two underscores occur, else `_d_X_p_Y`."""
    segments = segment_lineage(label)
    return [F.when(label.rlike("[a-z]__"), rank_value(label, c)).otherwise(F.nullif(F.element_at(segments, CODES[c]), F.lit(""))).alias(CODES[c]) for c in codes]


# Letters of each molecule.
ALPHABETS = {"DNA": "ATGCNRYKMSWBDHV.-", "RNA": "AUGCNRYKMSWBDHV.-", "protein": "ACDEFGHIKLMNPQRSTVWYBJZX.*-"}


def strange_letters(seq: Column, molecule: str) -> Column:
    """The letters of a sequence that its molecule doesn't have, sorted."""
    letters = F.array_distinct(F.filter(F.split(F.upper(seq), ""), lambda c: c != ""))
    return F.array_sort(F.array_except(letters, F.array(*map(F.lit, ALPHABETS[molecule]))))


def has_level_marker(value: Column) -> Column:
    return value.contains("__") | value.rlike("_[a-z]_")


def has_control_chars(value: Column) -> Column:
    """Control characters but tab, line feed and carriage return, and direction overrides."""
    return value.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\u202A-\u202E\u2066-\u2069\u200E\u200F]")


def char_count(seq: Column, letter: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def once(value: Column, use) -> Column:
    """use(value), with value computed once however often `use` reads it."""
    return F.transform(F.array(value), use)[0]


def letter_counts(seq: Column, letters: str) -> Column:
    """How often each of the letters (A to Z) occurs, upper-cased; null for a null sequence. Splitting at a letter is the fastest count."""
    return once(F.upper(seq), lambda s: F.when(s.isNotNull(), F.array(*[F.size(F.split(s, c, -1)) - 1 for c in letters])))


def gc_content(seq: Column, is_protein: Column) -> Column:
    """GC share of ACGTUN; null for proteins and sequences without these."""

    def share(n):
        return F.when(F.aggregate(n, F.lit(0), lambda a, x: a + x) > 0, (n[0] + n[1]) / F.aggregate(n, F.lit(0), lambda a, x: a + x))

    return F.when(~is_protein, once(letter_counts(seq, "GCATUN"), share))


def weighted(pairs: list[tuple[Column, float]]) -> tuple[Column, Column]:
    """Weighted mean over the measured values, and how many there are; none measured: null."""
    weight = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in pairs), F.lit(0.0))
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in pairs), F.lit(0.0))
    n = sum((v.isNotNull().cast("int") for v, _ in pairs), F.lit(0))
    return F.when(weight > 0, total / weight), n


def na(value: Column, digits: int = 4) -> Column:
    """Text of a measure, NA when there is none."""
    return F.when(value.isNull(), NA).otherwise(F.format_string(f"%.{digits}f", value))


def strip_nhx(newick: Column) -> Column:
    return F.regexp_replace(newick, r"\[&&NHX[^\]]*\]", "")


def strip_brackets(newick: Column) -> Column:
    return F.regexp_replace(newick, r"\[[^\]]*\]", "")


def nhx_values(newick: Column) -> Column:
    """One map of keys to values for each NHX note, in order."""
    return F.transform(F.regexp_extract_all(newick, F.lit(r"\[&&NHX:([^\]]*)\]"), F.lit(1)), lambda x: F.str_to_map(x, F.lit(":"), F.lit("=")))


_QUOTED, _BARE = r"'(?:[^']|'')*'", r"[^(),:;\s']+"


def strip_notes(newick: Column) -> Column:
    """Without bracketed notes; brackets inside quotes are part of a label."""
    return F.regexp_replace(newick, rf"({_QUOTED})|\[[^\]]*\]", "$1")


def _labels(newick: Column, after: str) -> Column:
    """Labels that follow one of these characters, unquoted. Quoted labels are passed as a whole, whatever they hold."""
    said = F.regexp_extract_all(strip_notes(newick), F.lit(rf"[{after}]\s*({_QUOTED}|{_BARE})|{_QUOTED}"), F.lit(1))
    unquoted = lambda x: F.when(x.startswith("'"), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'"))).otherwise(x)
    return F.transform(F.filter(said, lambda x: x != ""), unquoted)


def newick_tips(newick: Column) -> Column:
    """The labels of the tips, each once, as they are named."""
    lone = F.when(~newick.contains("("), F.array_except(_labels(F.concat(F.lit("("), newick), "("), F.array(F.lit(""))))
    return F.array_distinct(F.coalesce(lone, _labels(newick, "(,")))


def newick_problems(newick: Column) -> Column:
    """Names of the structural faults of a Newick string. Quoted labels hide what they hold."""
    plain = F.regexp_replace(strip_notes(newick), _QUOTED, "Q")
    step = lambda a, c: F.when(a < 0, a).when(c == "(", a + 1).when(c == ")", a - 1).otherwise(a)
    depth = F.aggregate(F.split(F.regexp_replace(plain, "[^()]", ""), ""), F.lit(0), step)  # below zero it stays there
    tips = _labels(newick, "(,")
    named = F.filter(_labels(newick, ")"), lambda x: ~x.rlike(r"^[0-9.eE+-]+$"))
    found = [
        ("empty", F.trim(plain) == ""), ("unbalanced", (depth != 0) | plain.contains("'")), ("negative_length", plain.rlike(r":\s*-\d")), ("empty_tip", plain.rlike(r"[(,]\s*(?=[,):])")),
        ("duplicate_tips", F.size(F.array_distinct(tips)) < F.size(tips)), ("no_semicolon", ~F.trim(plain).endswith(";")), ("duplicate_internal", F.size(F.array_distinct(named)) < F.size(named)),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in found]), lambda x: x.isNotNull())


def mean_support(newick: Column) -> Column:
    """Mean of the numeric inner labels but the root's; above 1 they count as percent, out of 0-100 they are void."""
    raw = F.transform(F.regexp_extract_all(F.regexp_replace(strip_notes(newick), _QUOTED, "Q"), F.lit(r"\)([0-9.eE+-]+)(?=[:,)])"), F.lit(1)), lambda x: x.try_cast("double"))
    ok = F.filter(raw, lambda x: x.isNotNull())
    scale = F.when(F.array_max(ok) > 1, 100.0).otherwise(1.0)
    total = F.aggregate(ok, F.lit(0.0), lambda a, x: a + x)
    return F.when((F.size(ok) > 0) & (F.array_min(ok) >= 0) & (F.array_max(ok) <= 100), total / F.size(ok) / scale)


def tree_source_priority(source: Column) -> Column:
    out = F.lit(0)
    for name, rank in (("astral", 4), ("consensus", 3), ("concat", 2), ("first_gene_tree", 1)):
        out = F.when(source == name, rank).otherwise(out)
    return out


def fasta_record(name: Column, seq: Column, width: int = 80) -> Column:
    body = F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")
    return F.concat(F.lit(">"), name, F.lit("\n"), body, F.lit("\n"))
