"""Hard-negative mining with Fagin's threshold algorithm.

Vectors become whole numbers (``floor(scale * x)``), a score is an inner product
of such vectors, exact. An anchor's positives are its best rows of the same
label; for each positive the best rows of other labels whose score lies in a
window below the positive's are its hard negatives.

Candidates lie in blocks of some BLOCK rows, written once. A block holds, for
every dimension, its rows sorted by that component. For an anchor the lists are
read from the top where its component is positive, from the bottom where it is
negative, not at all where it is zero (sorted access); rows met for the first time
are scored whole (random access). No unseen row can score above the sum of
the anchor's components times the last values read. Reading stops once this
threshold is *strictly* below the k-th score of every window, or below the lower
end of a window that is not full: a tie could still win by its smaller id.
Depth doubles from round to round.

Anchors (a stated query set) are packed ANCHORS to a row and meet each block once,
by an equi-join on the block's number, so a task holds one block and one pack. Each
cell returns at most k rows per window; ranks over the cells are taken by a window
per anchor (and positive), of which Spark keeps the first k before the shuffle.

* Rows with a null label, a null vector, or a null or non-finite component take no
  part. Vectors of unequal length are taken as if they ended in zeros; an empty
  vector scores 0 with everybody.
* Higher scores come first, ties by smaller id, a null id last.
* Repeated rows: each counts as a row of its own. An anchor is never its own
  positive, a copy of it may be; equal anchors are mined once and returned as often
  as they occur.
* Arithmetic falls back from float64 to Python integers where products could
  pass 2^53. Components saturate at 64 bits; a score beyond them ends the job.
* An empty table, or one without anchors, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import ship, stored

BLOCK = 4096
ANCHORS = 128
FIRST = 128
EXACT = 2.0**53

BLOCKS = "block int, dims int, ids array<long>, labels array<long>, width int, parts binary, orders binary"
POSITIVES = "anchor_no long, vec_id long, score long, own boolean"
NEGATIVES = "anchor_no long, place int, vec_id long, score long"


def usable(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, parts (whole numbers), anchor of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return rows.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        whole.alias("parts"), F.coalesce("anchor", F.lit(False)).alias("anchor"),
    )


def matrix(parts: pa.ListArray, dims: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix, filled up with zeros (or cut) to ``dims`` columns."""
    lengths = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    longest = int(lengths.max(initial=0))
    dims = longest if dims is None else dims
    flat = parts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), max(longest, dims)), np.int64)
    out[row, column] = flat
    return out[:, :dims]


def narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of a partition, in the order of their ids, with a sorted list per dimension."""
    number = TaskContext.get().partitionId()
    for batch in batches:
        longest = int(batch.column("parts").value_lengths().to_numpy(zero_copy_only=False).max(initial=1))
        most = max(1, min(BLOCK, BLOCK * 64 // max(longest, 1)))
        for at in range(0, len(batch), most):
            part = batch.slice(at, most)
            part = part.take(pc.sort_indices(part, [("vec_id", "ascending")], null_placement="at_end"))
            values = matrix(part.column("parts"))
            orders = np.argsort(values, axis=0, kind="stable").T
            values = narrow(values)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int32()),
                "dims": pa.array([values.shape[1]], pa.int32()),
                "ids": pa.array([part.column("vec_id")], pa.list_(pa.int64())),
                "labels": pa.array([part.column("label")], pa.list_(pa.int64())),
                "width": pa.array([values.itemsize], pa.int32()),
                "parts": pa.array([values.tobytes()], pa.binary()),
                "orders": pa.array([np.ascontiguousarray(orders, np.uint32).tobytes()], pa.binary()),
            })


class Block:
    """Candidates in id order, and per dimension their places in ascending order of the component."""

    def __init__(self, row: dict):
        self.ids, self.labels = row["ids"], np.array(row["labels"], np.int64)
        self.n, self.dims = len(self.ids), row["dims"]
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
        whole = np.frombuffer(row["parts"], kind).reshape(self.n, self.dims)
        self.largest = max(abs(int(whole.min(initial=0))), abs(int(whole.max(initial=0))))
        self.whole, self.floats = whole, whole.astype(np.float64)
        self.up = np.frombuffer(row["orders"], np.uint32).reshape(self.dims, self.n)
        self.down = self.up[:, ::-1]

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """Rounds of sorted access: new places, their scores, and the threshold for the unseen."""
        exact = float(self.largest) * float(np.abs(anchor.astype(np.float64)).sum()) < EXACT
        values, a = (self.floats, anchor.astype(np.float64)) if exact else (self.whole.astype(object), anchor.astype(object))
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unseen, depth = np.ones(self.n, bool), 0
        while depth < self.n and len(plus) + len(minus):
            upto = min(self.n, max(FIRST, 2 * depth))
            met = np.zeros(self.n, bool)
            met[self.down[plus, depth:upto]] = True
            met[self.up[minus, depth:upto]] = True
            fresh = np.flatnonzero(met & unseen)
            unseen[fresh] = False
            last = upto - 1
            threshold = values[self.down[plus, last], plus] @ a[plus] + values[self.up[minus, last], minus] @ a[minus]
            yield fresh, values[fresh] @ a, threshold
            depth = upto
        rest = np.flatnonzero(unseen)
        if len(rest):
            yield rest, values[rest] @ a, -np.inf


def best_first(places: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((places, -scores)) if scores.dtype != object else np.array(
        sorted(range(len(scores)), key=lambda i: (-scores[i], places[i])), np.int64)
    return places[order], scores[order]


def nearest(block: Block, anchor: np.ndarray, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` rows of the anchor's label in a block."""
    places, scores = np.zeros(0, np.int64), np.zeros(0)
    for fresh, found, threshold in block.read(anchor):
        same = block.labels[fresh] == label
        places, scores = best_first(np.concatenate([places, fresh[same]]), np.concatenate([scores, found[same]]))
        places, scores = places[:k], scores[:k]
        if len(scores) == k and threshold < scores[-1]:
            break
    return places, scores


def inside(block: Block, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list:
    """Per window (lowest, highest score) the first ``k`` rows of another label in a block."""
    low, high = min(w[0] for w in windows), max(w[1] for w in windows)
    places, scores = np.zeros(0, np.int64), np.zeros(0)
    for fresh, found, threshold in block.read(anchor):
        good = (block.labels[fresh] != label) & (found >= low) & (found <= high)
        places, scores = best_first(np.concatenate([places, fresh[good]]), np.concatenate([scores, found[good]]))
        keep, cuts, done = np.zeros(len(places), bool), [], True
        for least, most in windows:
            a = int(np.searchsorted(-scores, -most, "left"))
            b = min(a + k, int(np.searchsorted(-scores, -least, "right")))
            keep[a:b] = True
            cuts.append((a, b))
            done &= bool(threshold < (scores[b - 1] if b - a == k else least))
        if done:
            return [(places[a:b], scores[a:b]) for a, b in cuts]
        places, scores = places[keep], scores[keep]
    out = []
    for least, most in windows:
        good = (scores >= least) & (scores <= most)
        out.append((places[good][:k], scores[good][:k]))
    return out


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray, list[dict]]]:
    """Per row: its block, the anchors' components and the anchors."""
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch.column(c)[i].as_py() for c in ("ids", "labels", "dims", "width", "parts", "orders")}
            block, anchors = Block(row), batch.column("anchors").slice(i, 1).flatten()
            yield block, matrix(anchors.field("parts"), block.dims), anchors.to_pylist()


def positive_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, vectors, anchors in cells(batches):
            out = []
            for vector, row in zip(vectors, anchors, strict=True):
                for p, score in zip(*nearest(block, vector, row["label"], k + 1), strict=True):
                    own = block.ids[p] == row["vec_id"] and bool((block.whole[p] == vector).all())
                    out.append((row["anchor_no"], block.ids[p], int(score), own))
            yield table(out, ("anchor_no", "vec_id", "score", "own"), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))

    return run


def negative_rows(k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, vectors, anchors in cells(batches):
            out = []
            for vector, row in zip(vectors, anchors, strict=True):
                windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in row["positives"]]
                open_ = [j for j, (a, b) in enumerate(windows) if a <= b]
                if open_:
                    found = inside(block, vector, row["label"], [windows[j] for j in open_], k)
                    for j, (places, scores) in zip(open_, found, strict=True):
                        out += [(row["anchor_no"], j, block.ids[p], int(s)) for p, s in zip(places, scores, strict=True)]
            yield table(out, ("anchor_no", "place", "vec_id", "score"), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))

    return run


def table(rows: list[tuple], names: tuple, kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], list(names))


def met(blocks: DataFrame, anchors: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """Every pack of anchors beside every block: one row per cell."""
    packs = anchors.groupBy(F.expr(f"anchor_no div {ANCHORS}").alias("pack")).agg(
        F.collect_list(F.struct(*columns)).alias("anchors")
    )
    dealt = packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select("block", "anchors")
    return blocks.repartition(n, "block").join(dealt.repartition(n, "block"), "block")


def first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, vec_id: str, vector: str, label: Column | str, anchor: Column,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors. A negative's score n and its
    positive's p satisfy low * p <= 100 * n <= high * p.
    """
    spark = rows.sparkSession
    ship(spark)
    total = rows.count()
    n = max(1, -(-total // BLOCK))
    given = usable(rows.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"),
        (F.col(label) if isinstance(label, str) else label).alias("label"), anchor.alias("anchor"),
    ), scale)
    blocks = stored(given.select("vec_id", "label", "parts").repartition(n).mapInArrow(packed, BLOCKS), "negatives-blocks")
    anchors = stored(
        given.where("anchor").groupBy("vec_id", "label", "parts").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("anchor_no", F.monotonically_increasing_id()), "negatives-anchors")

    near = met(blocks, anchors, n, ["anchor_no", "vec_id", "label", "parts"])
    near = first(near.mapInArrow(positive_rows(positives), POSITIVES), ["anchor_no"], positives + 1)
    # the rows in order; the anchor itself, where it is among them, goes (one of its copies)
    listed = F.array_sort(F.collect_list(F.struct("rank", "own", "vec_id", "score")))
    own = F.array_position(F.transform("found", lambda x: x["own"]), True).cast("int")
    found = near.groupBy("anchor_no").agg(listed.alias("found")).select(
        "anchor_no",
        F.slice(F.filter("found", lambda x, i: i + 1 != own), 1, positives).alias("positives"),
    )
    paired = stored(anchors.join(found.where(F.size("positives") > 0), "anchor_no"), "negatives-positives")

    far = met(blocks, paired, n, ["anchor_no", "label", "parts", "positives"])
    far = first(far.mapInArrow(negative_rows(negatives, low, high), NEGATIVES), ["anchor_no", "place"], negatives)
    whole = far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        paired.select("anchor_no", F.col("vec_id").alias("anchor_id"), "copies", "positives"), "anchor_no")
    return whole.withColumn("positive", F.get("positives", F.col("place"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    ).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), "rank", "negative_id",
        F.col("positive.score").alias("positive_score"), "negative_score",
    )
