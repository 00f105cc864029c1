"""Neighbour joining of markers whose matrix of distances is too large for a task, in rounds that hold CELLS distances each.

1. Sequences are dealt to strips of up to STRIP_BYTES. Every two strips are compared in a task of their own, once for the sums of
   the rows and once for the nearest columns of each row; distances are not kept.
2. A round gets the rows that are wanted (`held.wanted`): distances between sequences are counted again, strip by strip, and
   those to joined nodes come from the rows stored in earlier rounds. One task a marker assembles them and makes all joins that
   they decide (`held.some_joins`). It returns what is known of the nodes left, and the rows of new ones, which are stored.
3. A marker with no more than CELLS distances left ends by `joining.joins`.

The joins are those of the search over all pairs. A task holds CELLS distances, two strips, or some hundred bytes a sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import remove, saved, written
from . import held as H
from . import joining as J
from . import newick as N

CELLS = 16_000_000  # distances that a task holds, 8 bytes each
STRIP_BYTES, STRIPS = 32_000_000, 8  # the largest strip, and how many there are at least
TASKS = 200
SOME = 256  # sequences of a strip that are compared with another strip at once
PIECE_BYTES, BATCH_BYTES = 2_000_000, 16_000_000  # of a row of distances, and of rows that pass to Python at once
REWRITE = 50  # rounds' folders after which the rows stored are written anew; sooner where half of them are of joined nodes
LIVE_ROWS = 2_000_000  # nodes left that are broadcast, about 50 MB
PIECE = "tree int, first int, rows array<int>, cols array<int>, body binary"
ROW = "tree int, place int, stored int, cols array<int>, body binary"
ROUND = "tree int, place int, stored int, cols array<int>, live array<struct<place:int,stored:int,asked:boolean>>, body binary, what string"


def strips(aln: DataFrame, strip_bytes: int) -> DataFrame:
    """tree, strip, n_strips, place, kind, taxon, seq: places by taxon, kinds by the first place of an equal sequence. aln: tree, taxon, seq."""
    base = saved(aln.withColumn("row", F.monotonically_increasing_id()), "nj-sequences")
    tree = Window.partitionBy("tree")
    ordered = tree.orderBy(F.asc_nulls_last("taxon"), "row")
    cost = F.octet_length("seq") + 512
    narrow = base.select("tree", "row", "taxon", cost.cast("long").alias("cost"), F.sha2("seq", 256).alias("sha"))  # what is ordered in one task a marker is numbers, no sequences
    narrow = narrow.withColumns({"place": F.row_number().over(ordered) - 1, "before": F.sum("cost").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cost"), "all": F.sum("cost").over(tree)})
    strip = F.floor(F.col("before") / F.least(F.lit(float(strip_bytes)), F.col("all") / STRIPS)).cast("int")
    placed = narrow.select("tree", "row", "place", strip.alias("strip"), F.min("place").over(Window.partitionBy("tree", "sha")).alias("kind"))
    placed = placed.withColumn("n_strips", F.max("strip").over(tree) + 1)
    return saved(base.join(placed, ["tree", "row"]).drop("row"), "nj-strips")


def _blocks(seqs: DataFrame) -> DataFrame:
    """A row's sequence goes to every pair of strips (i, j) that its own is in."""
    other = seqs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_strips") - 1)))
    return other.withColumns({"i": F.least("strip", "other"), "j": F.greatest("strip", "other")}).drop("other", "n_strips").repartition(TASKS, "tree", "i", "j")


def _compared(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions in two strips and their distances, some rows of the first at a time."""
    i, strip = int(pdf.i.iloc[0]), pdf.strip.to_numpy()
    left, right = np.flatnonzero(strip == i), np.flatnonzero(strip == int(pdf.j.iloc[0]))
    seq = pdf.seq.to_numpy()
    to = J.across(list(seq[right]))
    left = left[np.argsort([len(seq[k]) for k in left], kind="stable")]
    for at in range(0, len(left), SOME):
        some = left[at : at + SOME]
        yield some, right, to(list(seq[some]))


def _sums(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(pdf))
    for left, right, d in _compared(pdf):
        total[left] += d.sum(axis=1)
        if pdf.i.iloc[0] < pdf.j.iloc[0]:
            total[right] += d.sum(axis=0)
    return pd.DataFrame({"tree": pdf.tree, "place": pdf.place, "sum": total})


def _merged(cols: np.ndarray, near: np.ndarray, q: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """The nearest of more columns than are kept."""
    if q.shape[1] <= H.NEAR:
        return cols, near, q, rest
    by = np.argpartition(q, H.NEAR, axis=1)
    rest = np.minimum(rest, np.take_along_axis(q, by[:, H.NEAR : H.NEAR + 1], axis=1)[:, 0])
    return *(np.take_along_axis(x, by[:, : H.NEAR], axis=1) for x in (cols, near, q)), rest


def _nearest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Each strip's nearest columns in the other one."""
    place, u = pdf.place.to_numpy(np.int32), pdf.u.to_numpy()
    k, n = H.NEAR, len(pdf)
    kept = np.full((n, k), -1, np.int32), np.full((n, k), J._FAR), np.full((n, k), J._FAR), np.full(n, J._FAR)

    def take(rows: np.ndarray, columns: np.ndarray, d: np.ndarray) -> None:
        cols, near, rest = H.nearest(d, u[columns])
        q = np.where(cols >= 0, near - u[columns][cols], J._FAR)
        cols = np.where(cols >= 0, place[columns][cols], -1)
        for to, x in zip(kept, _merged(*(np.concatenate([a[rows], b], axis=1) for a, b in zip(kept, (cols, near, q))), np.minimum(kept[3][rows], rest))):
            to[rows] = x

    for left, right, d in _compared(pdf):
        d[place[left][:, None] == place[right]] = J._FAR
        take(left, right, d)
        if pdf.i.iloc[0] < pdf.j.iloc[0]:
            take(right, left, np.ascontiguousarray(d.T))
    out = []
    for strip in pdf.strip.unique():
        rows = np.flatnonzero(pdf.strip.to_numpy() == strip)
        rows = rows[np.argsort(place[rows])]
        body = H.packed(dict(zip(("cols", "near", "q", "rest"), (x[rows] for x in kept))) | {"place": place[rows], "sums": pdf["sum"].to_numpy()[rows], "kind": pdf.kind.to_numpy()[rows]})
        out.append((int(pdf.tree.iloc[0]), int(strip), body))
    return pd.DataFrame(out, columns=["tree", "strip", "body"])


def _strip(pdf: pd.DataFrame) -> pd.DataFrame:
    """A strip's nearest columns in all strips."""
    parts = [H.unpacked(b) for b in pdf.body]
    one = parts[0]
    for other in parts[1:]:
        cols, near, q, rest = _merged(*(np.concatenate([one[x], other[x]], axis=1) for x in ("cols", "near", "q")), np.minimum(one["rest"], other["rest"]))
        one |= {"cols": cols, "near": near, "q": q, "rest": rest}
    return pd.DataFrame({"tree": pdf.tree[:1], "strip": pdf.strip[:1], "body": [H.packed({k: v for k, v in one.items() if k != "q"})]})


def _state(tree: int, nodes: dict[str, np.ndarray], cells: int) -> pa.RecordBatch:
    asked = np.zeros(len(nodes["place"]), bool)
    asked[H.wanted(nodes, cells)] = True
    live = [{"place": p, "stored": r, "asked": a} for p, r, a in zip(nodes["place"].tolist(), nodes["stored"].tolist(), asked.tolist())]
    return _round(tree, "state", live=live, body=H.packed(nodes))


_TYPES = pa.schema([("tree", pa.int32()), ("place", pa.int32()), ("stored", pa.int32()), ("cols", pa.list_(pa.int32())), ("live", pa.list_(pa.struct([("place", pa.int32()), ("stored", pa.int32()), ("asked", pa.bool_())]))), ("body", pa.binary()), ("what", pa.string())])


def _round(tree: int, what: str, **cells) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"tree": tree, "what": what} | cells], schema=_TYPES)


def _begin(cells: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((H.unpacked(body.as_py()) for batch in batches for body in batch.column("body")), key=lambda p: p["place"][0])
        of = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        yield _state(key[0].as_py(), H.begin(of["sums"], of["kind"], of["cols"], of["near"], of["rest"]), cells)

    return run


def first(seqs: DataFrame, cells: int) -> str:
    """The folder of the state before any join: sums and nearest columns of all sequences. What is asked of a round is in `live`."""
    sums = _blocks(seqs.drop("taxon", "kind")).groupBy("tree", "i", "j").applyInPandas(_sums, "tree int, place int, sum double").groupBy("tree", "place").agg(F.sum("sum").alias("sum"))
    sums = saved(sums.withColumn("u", F.col("sum") / F.greatest(F.count(F.lit(1)).over(Window.partitionBy("tree")) - 2, F.lit(1))), "nj-sums")
    near = _blocks(seqs.drop("taxon").join(sums, ["tree", "place"])).groupBy("tree", "i", "j").applyInPandas(_nearest, "tree int, strip int, body binary")
    whole = near.repartition(TASKS, "tree", "strip").groupBy("tree", "strip").applyInPandas(_strip, "tree int, strip int, body binary")
    return written(whole.groupBy("tree").applyInArrow(_begin(cells), ROUND), "nj-round", "what")


def _pieces(rows: np.ndarray, cols: np.ndarray, d: np.ndarray) -> Iterator[dict]:
    """Distances in cells of some MB."""
    step = max(PIECE_BYTES // (8 * max(len(cols), 1)), 1)
    for at in range(0, len(rows), step):
        yield {"rows": rows[at : at + step].tolist(), "cols": cols.tolist(), "body": np.ascontiguousarray(d[at : at + step]).tobytes()}


_PIECE_TYPES = pa.schema([("tree", pa.int32()), ("first", pa.int32()), ("rows", pa.list_(pa.int32())), ("cols", pa.list_(pa.int32())), ("body", pa.binary())])


def _leaf_rows(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of the sequences asked to a strip's."""
    table = pa.Table.from_batches(list(batches))
    asks, place, seq = table["asks"].to_numpy(), table["place"].to_numpy(), table["seq"].to_pylist()
    left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
    if len(left) and len(right):
        d = J.across([seq[k] for k in right])([seq[k] for k in left])
        for piece in _pieces(place[left], place[right], d):
            yield pa.RecordBatch.from_pylist([piece | {"tree": key[0].as_py(), "first": 1}], schema=_PIECE_TYPES)


def _stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stored row all, if it is asked, else the cells of columns asked."""
    for batch in batches:
        for k in range(batch.num_rows):
            at = {c: batch.column(c)[k] for c in ("tree", "place", "asked", "cols", "body", "all_asked")}
            cols, row = at["cols"].values.to_numpy(), np.frombuffer(at["body"].as_py())
            if not at["asked"].as_py():
                some = at["all_asked"].values.to_numpy()
                where = np.minimum(np.searchsorted(cols, some), len(cols) - 1)
                found = cols[where] == some
                cols, row = some[found], row[where[found]]
            if len(cols):
                yield pa.RecordBatch.from_pylist([{"tree": at["tree"].as_py(), "first": 1, "rows": [at["place"].as_py()], "cols": cols.tolist(), "body": row.tobytes()}], schema=_PIECE_TYPES)


def _advance(number: int, cells: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A marker's joins of this round: its state comes first, then the distances asked."""
        tree, d = key[0].as_py(), None
        for batch in batches:
            for k in range(batch.num_rows):
                body = batch.column("body")[k].as_buffer()
                if d is None:
                    if batch.column("first")[k].as_py() != 0:
                        raise ValueError("the state must come before the distances")
                    nodes = H.unpacked(body.to_pybytes())
                    held, place, stored = H.wanted(nodes, cells), nodes["place"], nodes["stored"]
                    d = np.full((len(held), len(place)), np.nan)
                    at = np.full(int(place.max()) + 2, -1)
                    at[place] = np.arange(len(place))
                    slot = np.full(len(place), -1)
                    slot[held] = np.arange(len(held))
                    continue
                rows, cols = (at[np.minimum(batch.column(c)[k].values.to_numpy(), len(at) - 1)] for c in ("rows", "cols"))
                part = np.frombuffer(body).reshape(len(rows), len(cols))
                live = np.flatnonzero(cols >= 0)
                if stored[rows[0]]:  # a column stored later has this distance in its own row
                    live = live[stored[cols[live]] <= stored[rows[0]]]
                cols, part = cols[live], part if len(live) == len(cols) else part[:, live]
                r, c = np.flatnonzero(slot[rows] >= 0), np.flatnonzero(slot[cols] >= 0)
                if len(r):
                    d[np.ix_(slot[rows[r]], cols)] = part[r] if len(r) < len(rows) else part
                if len(c):
                    d[np.ix_(slot[cols[c]], rows)] = part[:, c].T
        d[np.arange(len(held)), held] = 0
        if np.isnan(d).any():
            raise ValueError("a distance asked did not come")
        n = len(place)
        if len(held) == n:
            out, left, last = J.joins(d, nodes["kind"])
            out, left = [(int(place[a]), int(place[b]), la, lb) for a, b, la, lb in out], place[left]
            last = {"cols": left.tolist(), "body": last.tobytes()}
        else:
            (out, nodes, new), last = H.some_joins(nodes, held, d, number), {"cols": [], "body": b""}
            for at, row in new:
                yield _round(tree, "row", place=at, stored=number, cols=nodes["place"].tolist(), body=row.tobytes())
            yield _state(tree, nodes, cells)
        yield _round(tree, "joins", stored=number, cols=last["cols"], body=np.array(out, float).tobytes() + last["body"])

    return run


def _newick(key: tuple, names: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
    """A marker's tree; its last round tells the three nodes left, and their distances after its joins."""
    made = made.sort_values("stored")
    joins = np.concatenate([np.frombuffer(b) for b in made.body])
    steps = ((int(a), int(b), la, lb) for a, b, la, lb in joins[:-9].reshape(-1, 4))
    text = N.joined([str(t) for t in names.sort_values("place").taxon], steps, list(made.cols.iloc[-1]), joins[-9:].reshape(3, 3))
    return pd.DataFrame({"tree": [key[0]], "newick": [text]})


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows here are large; the setting is as before afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trees(aln: DataFrame, cells: int = CELLS, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """tree, newick of many sequences a tree. aln: tree (int), taxon, seq."""
    with _small_batches(aln.sparkSession):
        seqs = strips(aln, strip_bytes)
        made = _rounds(seqs, cells)
    names = seqs.select("tree", "place", "taxon").groupBy("tree")
    return names.cogroup(made.groupBy("tree")).applyInPandas(_newick, "tree int, newick string")


def _rounds(seqs: DataFrame, cells: int) -> DataFrame:
    """What each round joins, until all is joined. Folders that later rounds do not need are removed."""
    spark, path, number = seqs.sparkSession, first(seqs, cells), 0
    made, rows, n_rows = [], [], 0
    while True:
        state = spark.read.schema(ROUND).parquet(path).where("what = 'state'")
        of = state.select(F.size("live").alias("n"), F.expr("size(filter(live, x -> x.stored > 0))").alias("held"), F.expr(f"size(filter(live, x -> x.stored = {number}))").alias("new")).collect()  # a row a marker that is not done
        if not of:
            break
        live = state.select("tree", F.inline("live"))
        live = F.broadcast(live) if sum(r.n for r in of) <= LIVE_ROWS else live
        to = F.array(F.struct("strip", F.lit(False).alias("asks")))
        to = F.when(F.col("asked"), F.concat(to, F.transform(F.sequence(F.lit(0), F.col("n_strips") - 1), lambda s: F.struct(s.alias("strip"), F.lit(True).alias("asks"))))).otherwise(to)
        leaves = seqs.join(live.where("stored = 0"), ["tree", "place"]).select("tree", "place", "seq", F.inline(to))
        pieces = leaves.repartition(TASKS, "tree", "strip").groupBy("tree", "strip").applyInArrow(_leaf_rows, PIECE)
        new = sum(r.new for r in of) if number else 0
        if new:
            rows, n_rows = [*rows, f"{path}/what=row"], n_rows + new
        if n_held := sum(r.held for r in of):
            held = spark.read.schema(ROW).parquet(*rows).join(live.where("stored > 0"), ["tree", "place", "stored"])
            if len(rows) > 1 and (len(rows) >= REWRITE or n_rows > 2 * n_held):
                old, rows, n_rows = rows, [written(held.select("tree", "place", "stored", "cols", "body"), "nj-rows")], n_held
                for folder in old:
                    remove(spark, folder)
                held = spark.read.schema(ROW).parquet(*rows).join(live, ["tree", "place", "stored"])
            asked = state.select("tree", F.expr("array_sort(transform(filter(live, x -> x.asked), x -> x.place))").alias("all_asked"))  # a row a marker
            pieces = pieces.unionAll(held.join(F.broadcast(asked), "tree").mapInArrow(_stored_rows, PIECE))
        none = F.array().cast("array<int>")
        pieces = state.select("tree", F.lit(0).alias("first"), none.alias("rows"), none.alias("cols"), "body").unionAll(pieces)
        dealt = pieces.repartition(min(TASKS, 4 * len(of)), "tree").sortWithinPartitions("tree", "first")  # the order within a marker is kept by the grouping
        before, number = path, number + 1
        path = written(dealt.groupBy("tree").applyInArrow(_advance(number, cells), ROUND), "nj-round", "what")
        remove(spark, f"{before}/what=state")
        made.append(f"{path}/what=joins")
    return spark.read.schema("tree int, stored int, cols array<int>, body binary").parquet(*made)
