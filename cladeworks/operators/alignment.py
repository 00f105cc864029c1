"""Alignment columns: informativeness, gaps, composition, concatenation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import AMBIGUOUS, AMINO, GAPS, gc_content, letter_counts, once


SITES, CHUNK, PIECE = 1024, 32 << 20, 4 << 20  # columns a block, bytes of sequences summed together, letters counted at once
LETTER = 21  # bits of a letter's code point; a key is the column inside its block, then the letter
NO_SIGNAL = [ord(c) for c in GAPS + AMBIGUOUS + " "]
GAP_CODES = [ord(c) for c in GAPS]


def tallied(column: np.ndarray, letter: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, and how often each (column, letter) occurs, or the sums of counts; dense where letters are few."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    span = int(letter.max()) + 1
    flat = column * span + letter
    if (int(column.max()) + 1) * span <= 4 * len(flat) + (1 << 20):
        dense = np.bincount(flat, counts)
        at = np.flatnonzero(dense)
        n = dense[at]
    else:
        at, which = np.unique(flat, return_inverse=True)
        n = np.bincount(which, counts)
    return at // span << LETTER | at % span, n.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    return tallied(keys >> LETTER, keys & ((1 << LETTER) - 1), counts)


def counted(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys (column over the whole length, letter) and counts of one marker's sequences, PIECE letters at a time."""
    sizes = np.asarray(pc.utf8_length(seqs).fill_null(0)).astype(np.int64)
    ends, row, found = np.cumsum(sizes), 0, []
    while row < len(seqs):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE, "right")))
        raw = "".join(x for x in seqs.slice(row, end - row).to_pylist() if x)
        codes = np.frombuffer(raw.encode("ascii"), np.uint8) if raw.isascii() else np.frombuffer(raw.encode("utf-32-le"), np.uint32)
        part = sizes[row:end]
        found.append(tallied(np.arange(len(codes)) - np.repeat(np.cumsum(part) - part, part), codes))
        row = end
    keys, counts = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return (keys, counts) if len(found) < 2 else summed(keys, counts)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


PARTIAL = "block long, keys array<long>, counts array<long>"


def column_counts(aln: DataFrame) -> DataFrame:
    """marker_id and PARTIAL: how often each letter stands in each column, by blocks of SITES columns, counted where the sequences are."""
    kind = aln.schema["marker_id"].dataType.simpleString()

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        markers = table["marker_id"].combine_chunks().dictionary_encode()
        which = np.asarray(markers.indices.fill_null(-1))
        seqs = table["seq"].combine_chunks()
        del table, held
        for m in np.unique(which).tolist():
            keys, counts = counted(seqs.take(pa.array(np.flatnonzero(which == m))))
            block = keys >> LETTER
            block //= SITES
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
            n, ends = len(cuts), np.append(cuts, len(keys))
            name = pa.nulls(n, markers.dictionary.type) if m < 0 else markers.dictionary.take(pa.array([m] * n, pa.int32()))
            keys = keys - (block * SITES << LETTER)
            yield pa.RecordBatch.from_arrays([name, pa.array(block[cuts]), _lists(keys, ends), _lists(counts, ends)], ["marker_id", "block", "keys", "counts"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return aln.select("marker_id", "seq").mapInArrow(run, f"marker_id {kind}, {PARTIAL}")


def site_counts(aln: DataFrame) -> DataFrame:
    """marker_id, pis, effective_columns, gap_fraction. Rows shorter than their marker's longest end in gaps.

    Letters are counted by column where the sequences are, a chunk at a time; Spark deals the counts by block of columns and
    adds them up, so that no Python worker holds more than a chunk, however many there are.
    """
    sizes = aln.groupBy("marker_id").agg((F.count("seq") * F.max(F.length("seq"))).alias("full"))
    dealt = column_counts(aln).repartition("marker_id", "block").select("marker_id", "block", F.explode(F.arrays_zip("keys", "counts")).alias("x"))
    letters = dealt.groupBy("marker_id", "block", F.col("x.keys").alias("key")).agg(F.sum("x.counts").alias("n"))
    letter, n = F.col("key").bitwiseAND(F.lit((1 << LETTER) - 1)), F.col("n")
    told, gap = (n >= 2) & ~letter.isin(NO_SIGNAL), letter.isin(GAP_CODES)
    columns = letters.groupBy("marker_id", "block", F.shiftright("key", LETTER).alias("column")).agg(F.count_if(told).alias("told"), F.bool_or(~gap).alias("solid"), F.sum(F.when(gap, n).otherwise(0)).alias("gaps"), F.sum(n).alias("n"))
    by_marker = columns.groupBy("marker_id").agg(F.count_if(F.col("told") >= 2).alias("pis"), F.count_if("solid").alias("effective_columns"), F.sum("gaps").alias("gaps"), F.sum("n").alias("n"))
    missing = F.col("full") - F.col("n")  # the gaps that the rows end in
    return by_marker.join(sizes, "marker_id").select("marker_id", "pis", "effective_columns", ((F.col("gaps") + missing) / F.col("full")).alias("gap_fraction"))


def amino_shares(aln: DataFrame) -> DataFrame:
    """marker_id, taxon, freq: the share of each of the twenty residues, in order; null for sequences without any."""

    def shares(n):
        return once(F.aggregate(n, F.lit(0), lambda a, x: a + x), lambda total: F.when(total > 0, F.transform(n, lambda x: x / total)))

    return aln.select("marker_id", "taxon", once(letter_counts(F.col("seq"), AMINO), shares).alias("freq"))


def aa_composition(aln: DataFrame) -> DataFrame:
    """marker_id, taxon, residue, freq over the twenty residues, zeros included; sequences without any have no rows."""
    residue = F.element_at(F.array(*map(F.lit, AMINO)), F.col("i") + 1)
    return amino_shares(aln).select("marker_id", "taxon", F.posexplode("freq").alias("i", "freq")).select("marker_id", "taxon", residue.alias("residue"), "freq")


def distances(aln: DataFrame, term) -> DataFrame:
    """marker_id, taxon, d: the sum of term(share, mean share) over residues, null without residues. Means are a row a marker."""
    shares = amino_shares(aln)
    means = shares.groupBy("marker_id").agg(F.array(*[F.avg(F.get("freq", F.lit(i))) for i in range(len(AMINO))]).alias("mean"))
    total = F.aggregate(F.zip_with("freq", "mean", term), F.lit(0.0), lambda a, x: a + x)
    return shares.join(means, "marker_id").select("marker_id", "taxon", total.alias("d"))


def rcv(aln: DataFrame) -> DataFrame:
    """marker_id, rcv: the largest half distance of a sequence's composition from the mean; null under two sequences. Markers without residues have no row."""
    each = distances(aln, lambda f, m: F.abs(f - m) / 2)
    return each.groupBy("marker_id").agg(F.when(F.count("d") >= 2, F.max("d")).alias("rcv"), F.count("d").alias("n_sequences")).where("n_sequences > 0")


def grouped_rcv(aln: DataFrame, groups: DataFrame) -> DataFrame:
    """marker_id, grp, rcv, n_sequences inside each group of taxa. groups: taxon, grp."""
    named = aln.join(groups, "taxon").select(F.struct("marker_id", "grp").alias("marker_id"), "taxon", "seq")
    return rcv(named).select("marker_id.marker_id", "marker_id.grp", "rcv", "n_sequences")


def gc_spread(aln: DataFrame, protein: bool = False) -> DataFrame:
    """marker_id, gc_bias: population deviation of GC; null for proteins and under two sequences."""
    gc = aln.select("marker_id", gc_content(F.col("seq"), F.lit(protein)).alias("gc"))
    return gc.groupBy("marker_id").agg(F.when(F.count("gc") >= 2, F.stddev_pop("gc")).alias("gc_bias"))


def chi_square(aln: DataFrame) -> DataFrame:
    """marker_id, taxon, chi2 of composition against the marker's mean."""
    return distances(aln, lambda f, m: (f - m) ** 2 / F.greatest(m, F.lit(1e-6))).where("d is not null").withColumnRenamed("d", "chi2")


def kmer_signature(seqs: DataFrame, k: int = 4, step: int = 1, letters: str = "ACGT") -> DataFrame:
    """id, kmer, freq of each sequence; k-mers with other letters are left out. k = step = 3 gives codon usage."""
    s = F.split(F.upper("seq"), "")
    n = F.greatest(F.length("seq") - k + 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice(s, j + 1, n).alias(f"l{j}") for j in range(k)])  # a substring of a long text would be counted out from its start each time
    found = seqs.select("id", F.posexplode(shifted).alias("pos", "l")).where(F.col("pos") % step == 0)
    rows = found.select("id", F.concat(*[F.col(f"l.l{j}") for j in range(k)]).alias("kmer")).where(F.col("kmer").rlike(f"^[{letters}]+$"))
    counts = rows.groupBy("id", "kmer").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("freq", F.col("n") / F.sum("n").over(Window.partitionBy("id"))).select("id", "kmer", "freq")


def partitions(lengths: DataFrame) -> DataFrame:
    """marker_id, start, stop of each marker in the concatenation. lengths: marker_id, position, len; a row a marker."""
    upto = Window.orderBy("position", "marker_id").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum("len").over(upto)
    return lengths.withColumn("stop", stop).select("marker_id", (F.col("stop") - F.col("len") + 1).alias("start"), "stop")


def supermatrix(aln: DataFrame) -> DataFrame:
    """taxon, seq: each taxon's sequences by marker, gaps where it has none or a shorter one. Letters are shuffled, gaps are filled in a taxon's own row."""
    lengths = aln.groupBy("marker_id").agg(F.max(F.length("seq")).alias("len")).agg(F.array_sort(F.collect_list(F.struct("marker_id", "len"))).alias("panel"))  # one row: the panel
    own = aln.groupBy("taxon").agg(F.map_from_entries(F.collect_list(F.struct("marker_id", "seq"))).alias("own"))  # a taxon's markers
    filled = F.transform("panel", lambda p: F.rpad(F.coalesce(F.element_at("own", p["marker_id"]), F.lit("")), p["len"], F.lit("-")))
    return own.crossJoin(F.broadcast(lengths)).select("taxon", F.array_join(filled, "").alias("seq"))


def panel(aln: DataFrame) -> DataFrame:
    """marker_id, start, stop of each marker in the concatenation, by marker: a row a marker."""
    return partitions(aln.groupBy("marker_id").agg(F.max(F.length("seq")).cast("long").alias("len")).withColumn("position", F.col("marker_id")))


def concatenated(aln: DataFrame) -> DataFrame:
    """taxon, runs (start, seq; ascending): the rows of the supermatrix without the gaps between and behind a taxon's sequences. As large as the input."""
    placed = aln.join(F.broadcast(panel(aln)), "marker_id", "left")  # a row a marker
    run = F.when(F.col("seq") != "", F.struct("start", "seq"))
    return placed.groupBy("taxon").agg(F.array_sort(F.collect_list(run)).alias("runs"))


GAP_BYTES = memoryview(b"-" * (1 << 20))


def supermatrix_digests(aln: DataFrame) -> DataFrame:
    """taxon, sha, sites: SHA-256 and length of each row of supermatrix(aln), all its gaps hashed, without making the row.

    The gaps before a taxon's first sequence are hashed once a task and place; the others are fed from one buffer.
    """
    sites = panel(aln).agg(F.coalesce(F.max("stop"), F.lit(0)).alias("sites"))  # one row

    def gaps(state, n: int):
        while n > 0:
            state.update(GAP_BYTES[:n])
            n -= len(GAP_BYTES)

    def run(batches):
        before: dict[int, object] = {}  # as many as markers
        for batch in batches:
            out = []
            for runs, width in zip(batch.column("runs"), batch.column("sites").to_pylist()):
                runs, state, at = runs.as_py() or [], hashlib.sha256(), 1
                if runs:
                    at = runs[0]["start"]
                    if at not in before:
                        gaps(state, at - 1)
                        before[at] = state
                    state = before[at].copy()
                for r in runs:
                    if r["start"] < at:
                        raise ValueError("a taxon has two sequences of one marker")
                    gaps(state, r["start"] - at)
                    state.update(r["seq"].encode())
                    at = r["start"] + len(r["seq"])
                gaps(state, width + 1 - at)
                out.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("taxon"), pa.array(out, pa.string()), batch.column("sites")], ["taxon", "sha", "sites"])

    kind = aln.schema["taxon"].dataType.simpleString()
    return concatenated(aln).crossJoin(F.broadcast(sites)).mapInArrow(run, f"taxon {kind}, sha string, sites long")


def split_concatenated(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """marker_id, taxon, seq from concatenated rows (taxon and runs, or a whole seq) and parts (marker_id, start, stop), a short table.

    From runs: gaps before and between them are filled, those behind the last in a part are not, and a part without any has
    no row. Each part is cut out of the runs that reach into it alone.
    """
    if "runs" not in rows.columns:
        rows = rows.select("taxon", F.array(F.struct(F.lit(1).cast("long").alias("start"), "seq")).alias("runs"))
    start, stop = F.col("start"), F.col("stop")
    within = lambda r: (r["start"] <= stop) & (r["start"] + F.length(r["seq"]) > start)

    def added(done, r):
        skipped = F.greatest(start - r["start"], F.lit(0))  # letters of the run before the part
        letters = F.substring(r["seq"], (skipped + 1).cast("int"), (stop - F.greatest(start, r["start"]) + 1).cast("int"))
        return F.concat(F.rpad(done, F.greatest(r["start"] - start, F.lit(0)).cast("int"), F.lit("-")), letters)

    found = rows.crossJoin(F.broadcast(parts)).where(F.exists("runs", within))
    # a run that begins inside the part comes after all that is there yet, so that padding only lengthens
    return found.select("marker_id", "taxon", F.aggregate(F.filter("runs", within), F.lit(""), added).alias("seq"))


def content_hash(seqs: DataFrame) -> DataFrame:
    """marker_id, sha: hash of a marker's sequences, whatever their order. Sorted lines stream through one hash a marker and are never held together."""
    line = F.concat(F.col("taxon").cast("string"), F.lit("\0"), "seq", F.lit("\n"))
    rows = seqs.select("marker_id", line.alias("line")).repartition("marker_id").sortWithinPartitions("marker_id", "line")

    def run(batches):
        marker, state = None, None
        for batch in batches:
            out = []
            for m, text in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or m != marker:
                    out += [] if state is None else [(marker, state.hexdigest())]
                    marker, state = m, hashlib.sha256()
                state.update((text or "").encode())
            yield finished(out, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if state is not None:
            yield finished([(marker, state.hexdigest())], kind)

    def finished(out, kind):
        return pa.RecordBatch.from_arrays([pa.array([m for m, _ in out], kind), pa.array([h for _, h in out], pa.string())], ["marker_id", "sha"])

    return rows.mapInArrow(run, f"marker_id {seqs.schema['marker_id'].dataType.simpleString()}, sha string")


def composition_report(aln: DataFrame, outlier: float = 0.2, protein: bool = True) -> DataFrame:
    """marker_id, rcv, gc_bias, n_sequences, outlier_flag, most deviating first. Proteins have no gc_bias."""
    joined = rcv(aln).join(gc_spread(aln, protein), "marker_id", "left")
    return joined.withColumn("outlier_flag", F.coalesce(F.col("rcv") > outlier, F.lit(False))).orderBy(F.col("rcv").desc_nulls_last(), "marker_id")
