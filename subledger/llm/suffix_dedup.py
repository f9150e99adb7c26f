"""Suffix-array dedup after bucket-pointer refinement, by content hashes: repeated strings of ``SPAN`` bytes.

A suffix array over all positions is more than needed: of the order among
suffixes only this counts, which positions share their first SPAN bytes and
which of those comes first. So suffixes are put in buckets and the buckets are
refined until that is known, and singletons drop out early, as in bucket-pointer
refinement (Schuermann and Stoye 2005):

1. Initial buckets by q-grams (q = ``Q`` = SPAN / 4). Of the q-grams inside a
   position's SPAN bytes the one with the smallest hash (leftmost on a tie)
   represents it; equal strings pick the same one at the same place, so it is
   enough to shuffle each picked q-gram with the run of positions it stands for,
   one row per 38 bytes or so.
2. A bucket is refined by the bucket identifiers at later offsets:
   b50(i) = (b25(i), b25(i + 25)), b100(i) = (b50(i), b50(i + 50)), each level
   reusing the one before. They are hashes of the text, made where it is read, and
   stand for the pointers that sorting the buckets would give; suffixes are never
   ordered. The identifiers of a run's first and last position
   tell runs with equal content; of such a class the first run stays and all
   positions of the others are repeats.
   The strings that begin between l and l + ``BAND`` - 1 bytes before a q-gram
   have ``CORE`` bytes in common; a class stays open for such a band only if its
   bucket holds another class with an equal identifier (16 bits) of that core.
3. Only open bands of classes are refined further, from runs to single positions,
   by b100 of each position.

Identifiers are 64-bit hashes within a bucket that is a 64-bit hash itself, so
two strings are taken as equal on 128 bits. Every task first settles what
repeats within itself: of a class it sends on the first run only, so a group of
copies leaves each task as one row.

"First" is by smallest doc_id (null last), then the hash of the text, then the
start. Rows that repeat a doc_id and its text (by all 64 bits of its hash, which
every row carries) are one document and get the same result. Null and empty
texts have no bytes; texts under SPAN bytes lose none. Very long texts are handled
in blocks that overlap. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import ship, stored, text_or_empty
from subledger.llm.hashing import BASE, byte_values, grams, mixed, paired

SPAN = 100
Q = SPAN // 4
#: Bands of starts before a q-gram, and what all strings of a band share.
BANDS = 4
BAND = (SPAN - Q + 1) // BANDS
CORE = SPAN - BAND + 1
#: Bytes handled at once, and rows that a task settles within itself at once.
BLOCK = 1 << 20
FLUSH = 1 << 20
#: Bits for the place of a byte in what is laid end to end: two blocks, or RUNS runs of under 2 SPAN bytes.
PLACE_BITS = 22
RUNS = 1 << 13
#: A place is a start and, in its last 7 bits, a run's length less one.
RUN_BITS = 7


def tie() -> Column:
    """Tells texts of one doc_id (null included) apart."""
    return F.xxhash64(text_or_empty())


class Buckets:
    """q-gram buckets of some byte strings laid end to end."""

    def __init__(self, parts: list[bytes]):
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.end = np.cumsum(self.size)
        data = np.frombuffer(b"".join(parts), np.uint8)
        self.first = mixed(grams(byte_values()[data], Q, BASE), 1)

    def half(self, at: np.ndarray) -> np.ndarray:
        return paired(self.first[at], self.first[at + Q], 2)

    def whole(self, at: np.ndarray) -> np.ndarray:
        """b100: one identifier for the SPAN bytes from each position."""
        return paired(self.half(at), self.half(at + 2 * Q), 3)

    def bands(self, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """16 bits per band of the q-gram at ``at``; 0 if the part does not reach as far."""
        begin, end = (self.end - self.size)[part], self.end[part]
        out = np.zeros(len(at), np.uint64)
        for k in range(BANDS):
            some = np.flatnonzero((at - k * BAND >= begin) & (at - k * BAND + CORE <= end))
            i = at[some] - k * BAND
            core = paired(self.half(i), paired(self.first[i + 2 * Q], self.first[i + CORE - Q], 5), 6)
            out[some] |= (core >> np.uint64(48) | np.uint64(1)) << np.uint64(16 * k)
        return out

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, position, place of the q-gram that represents it) of all positions."""
        n = int(self.end[-1]) if len(self.end) else 0
        at = np.arange(max(0, n - SPAN + 1))
        part = np.repeat(np.arange(len(self.size)), self.size)[: len(at)]
        at = at[at + SPAN <= self.end[part]]
        if not len(at):
            return at, at, at
        places = np.arange(len(self.first), dtype=np.uint64)
        low = self.first >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | places
        width, want = 1, SPAN - Q + 1
        while width * 2 <= want:  # sliding minimum over `width` q-grams, doubled
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
        return part[at], at, (low[at] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)

    def runs(self) -> tuple[np.ndarray, ...]:
        """(part, start in the laid out bytes, positions, bucket, class, bands) of every run."""
        part, at, anchor = self.anchors()
        if not len(at):
            return at, at, at, *[np.zeros(0, np.uint64)] * 3
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1])])
        count = np.diff(np.append(new, len(at)))
        begin, part, anchor = at[new], part[new], anchor[new]
        with np.errstate(over="ignore"):
            kind = paired(self.whole(begin), self.whole(begin + count - 1) + count.astype(np.uint64), 4)
        return part, begin, count, self.first[anchor], kind, self.bands(part, anchor)


def place(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return start << RUN_BITS | (count - 1)


MARKS = pa.schema(
    [
        ("copy", pa.bool_()), ("bucket", pa.int64()), ("kind", pa.int64()), ("bands", pa.int64()), ("doc_id", pa.int64()),
        ("tie", pa.int64()), ("place", pa.int64()),
    ]
)
MARKS_DDL = "copy boolean, bucket long, kind long, bands long, doc_id long, tie long, place long"


class Settled:
    """Rows gathered in a task; of rows with equal (bucket, kind) only the first goes on.

    The others are told as copies: places alone, neighbours joined to runs.
    """

    def __init__(self):
        self.rows: list[tuple] = []
        self.n = 0

    def add(self, bucket, kind, bands, doc_id, no_id, ties, at) -> None:
        self.rows.append((bucket, kind, bands, doc_id, no_id, ties, at))
        self.n += len(at)

    def flush(self) -> Iterator[pa.RecordBatch]:
        bucket, kind, bands, doc_id, no_id, ties, at = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        self.rows, self.n = [], 0
        by = np.lexsort((at, ties, doc_id, no_id, kind, bucket))
        b, k, d, x, t, p = bucket[by], kind[by], doc_id[by], no_id[by], ties[by], at[by]
        new = np.r_[True, (b[1:] != b[:-1]) | (k[1:] != k[:-1])]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]  # the first of each row's class
        copy = (d != d[lead]) | (x != x[lead]) | (t != t[lead]) | (p != p[lead])
        first = by[new]
        first.sort()  # by document again, which compresses better
        yield marks(False, bucket[first], kind[first], bands[first], doc_id[first], no_id[first], ties[first], at[first])
        d, x, t, p = d[copy], x[copy], t[copy], p[copy]
        if len(p):
            by = np.lexsort((p, t, d, x))
            d, x, t = d[by], x[by], t[by]
            p = joined_runs(d, x, t, p[by])
            left = p >= 0
            d, x, t, p = d[left], x[left], t[left], p[left]
            none = np.zeros(len(p), np.uint64)
            spread = mixed(d.view(np.uint64) ^ t.view(np.uint64) ^ p.view(np.uint64), 7)  # buckets of their own
            yield marks(True, spread, none, none, d, x, t, p)


def marks(copy: bool, bucket, kind, bands, doc_id, no_id, ties, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(at), copy)), *[pa.array(c.view(np.int64)) for c in (bucket, kind, bands)],
            pa.array(doc_id, mask=no_id), pa.array(ties), pa.array(at),
        ],
        schema=MARKS,
    )


def joined_runs(doc_id, no_id, ties, at) -> np.ndarray:
    """Sorted places in which each row that continues the row before is -1 and counted there."""
    count = (at & (1 << RUN_BITS) - 1) + 1
    begin = at >> RUN_BITS
    follows = (doc_id[1:] == doc_id[:-1]) & (no_id[1:] == no_id[:-1]) & (ties[1:] == ties[:-1])
    follows &= begin[1:] == begin[:-1] + count[:-1]
    head = np.r_[True, ~follows]
    first = np.flatnonzero(head)
    before = np.cumsum(count) - count
    offset = before - before[first][np.cumsum(head) - 1]  # positions since the run's head
    # a place can hold 2^RUN_BITS positions, and a row brings SPAN - Q + 1 at most
    piece = offset // ((1 << RUN_BITS) - (SPAN - Q + 1))
    head |= np.r_[True, piece[1:] != piece[:-1]]
    first = np.flatnonzero(head)
    total = np.add.reduceat(count, first)
    out = np.full(len(at), -1)
    out[first] = begin[first] << RUN_BITS | (total - 1)
    return out


def ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("doc_id")
    none = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), none


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of positions by q-gram bucket and class, settled within the task."""
    out = Settled()
    for batch in batches:
        ids, none = ids_of(batch)
        ties = batch.column("tie").to_numpy()
        parts, owner, shift, size = [], [], [], 0

        def close():
            part, begin, count, bucket, kind, bands = Buckets(parts).runs()
            if len(part):
                doc = np.array(owner)[part]
                base = np.cumsum([0, *map(len, parts[:-1])])
                start = begin - base[part] + np.array(shift)[part]
                out.add(bucket, kind, bands, ids[doc], none[doc], ties[doc], place(start, count))

        for i, text in enumerate(batch.column("text")):
            data = text.as_py().encode("utf-8", "surrogatepass")
            for a in range(0, max(0, len(data) - SPAN + 1), BLOCK):
                piece = data[a : a + BLOCK + SPAN - 1]
                if size and size + len(piece) > 2 * BLOCK:
                    close()
                    parts, owner, shift, size = [], [], [], 0
                    if out.n >= FLUSH:
                        yield from out.flush()
                parts.append(piece)
                owner.append(i)
                shift.append(a)
                size += len(piece)
        if parts:
            close()
        if out.n >= FLUSH:
            yield from out.flush()
    if out.n:
        yield from out.flush()


def position_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single positions of some runs by bucket and b100, settled within the task."""
    out = Settled()
    for batch in batches:
        ids, none = ids_of(batch)
        ties = batch.column("tie").to_numpy()
        for i, (text, runs) in enumerate(zip(batch.column("text"), batch.column("runs"), strict=True)):
            data = text.as_py().encode("utf-8", "surrogatepass")
            for a in range(0, len(runs.values), RUNS):
                some_runs = runs.values.slice(a, RUNS)
                at, bucket = some_runs.field("place").to_numpy(), some_runs.field("bucket").to_numpy().view(np.uint64)
                start, count = at >> RUN_BITS, (at & (1 << RUN_BITS) - 1) + 1
                found = Buckets([data[x : x + n + SPAN - 1] for x, n in zip(start.tolist(), count.tolist(), strict=True)])
                each, here, anchor = found.anchors()  # the positions of all runs, in order
                band = (anchor - here) // BAND
                some = np.flatnonzero(some_runs.field("open").to_numpy()[each] >> band & 1)
                each, here = each[some], here[some]
                shift = start - (found.end - found.size)
                n = len(each)
                out.add(
                    bucket[each], found.whole(here), np.zeros(n, np.uint64), np.full(n, ids[i]), np.full(n, none[i]),
                    np.full(n, ties[i]), place(here + shift[each], np.ones(n, np.int64)),
                )
                if out.n >= FLUSH:
                    yield from out.flush()
    if out.n:
        yield from out.flush()


def order() -> list[Column]:
    return [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("place")]


def is_first(window: Window) -> Column:
    here = F.struct("doc_id", "tie", "place")
    return here == F.first(here).over(window)


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])


SPANS = "n_removed long, spans array<struct<begin:long,end:long>>"


def merged(places: pd.Series) -> pd.DataFrame:
    """Maximal removed runs of bytes from places (start, number of positions)."""
    rows = []
    for x in places:
        at = np.sort(np.asarray(x, np.int64))
        begin, end = at >> RUN_BITS, (at >> RUN_BITS) + (at & (1 << RUN_BITS) - 1) + SPAN
        reach = np.maximum.accumulate(end)
        new = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
        stop = reach[np.append(new[1:], len(at)) - 1]
        spans = [{"begin": int(a), "end": int(b)} for a, b in zip(begin[new], stop, strict=True)]
        rows.append((int((stop - begin[new]).sum()), spans))
    return pd.DataFrame(rows, columns=["n_removed", "spans"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_removed, spans of every document that loses bytes; stored."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tie().alias("tie"), text_or_empty().alias("text"))
    classes = Window.partitionBy("bucket", "kind").orderBy(*order())

    # runs in buckets, refined to classes; all windows use the one shuffle on bucket
    runs = texts.mapInArrow(run_rows, MARKS_DDL).repartition("bucket")
    several = Window.partitionBy("bucket", "lead").orderBy("kind", *order())
    other = (F.lag("kind").over(several) != F.col("kind")) | (F.lead("kind").over(several) != F.col("kind"))
    left = (
        runs.withColumn("lead", is_first(classes) & ~F.col("copy"))
        .withColumn("other", F.coalesce(other, F.lit(False))).where("not lead or other")
    )
    open_ = F.lit(0)
    for k in range(BANDS):
        band = F.col(f"band{k}")
        beside = Window.partitionBy("bucket", "lead").orderBy(band, "kind", *order())
        left = left.withColumn(f"band{k}", F.shiftrightunsigned("bands", 16 * k).bitwiseAND(0xFFFF))
        same = F.coalesce((F.lag(band).over(beside) == band) | (F.lead(band).over(beside) == band), F.lit(False))
        left = left.withColumn(f"open{k}", F.when(F.col("lead") & (band != 0) & same, 1 << k).otherwise(0))
        open_ = open_ + F.col(f"open{k}")
    refined = stored(
        left.withColumn("open", open_).where("not lead or open > 0").select("bucket", "lead", "open", "doc_id", "tie", "place"),
        "suffix-classes",
    )

    # open bands of classes, refined to positions
    per_doc = (
        refined.where("lead").drop("lead").distinct()
        .groupBy("doc_id", "tie").agg(F.collect_list(F.struct("bucket", "open", "place")).alias("runs"))
    )
    with_runs = texts.join(per_doc, same_document(texts, per_doc)).select(
        texts["doc_id"], texts["tie"], "text", "runs"
    )
    single = with_runs.mapInArrow(position_rows, MARKS_DDL).drop("bands").repartition("bucket")
    later = single.withColumn("lead", is_first(classes) & ~F.col("copy")).where("not lead")
    copies = refined.where("not lead").select("doc_id", "tie", "place").unionByName(later.select("doc_id", "tie", "place"))
    merge = F.pandas_udf(merged, SPANS)
    return stored(
        copies.groupBy("doc_id", "tie").agg(F.collect_list("place").alias("places"))
        .select("doc_id", "tie", merge("places").alias("m")).select("doc_id", "tie", "m.*"),
        "suffix-spans",
    )


def kept_bytes(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, tie, kept (binary): what is left of the documents in ``spans``, one row each."""
    ship(docs.sparkSession)

    @F.pandas_udf("binary")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for data, gone in zip(text, spans, strict=True):
            data, at, parts = data.encode("utf-8", "surrogatepass"), 0, []
            for span in gone:
                parts.append(data[at : span["begin"]])
                at = span["end"]
            out.append(b"".join([*parts, data[at:]]))
        return pd.Series(out)

    texts = docs.select("doc_id", tie().alias("tie"), text_or_empty().alias("text"))
    return texts.join(spans, same_document(texts, spans)).select(
        texts["doc_id"], texts["tie"], cut("text", "spans").alias("kept")
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``.

    Texts are shuffled only for documents that keep a part of themselves.
    """
    spans = removed_spans(docs)
    base = docs.select(
        "doc_id", tie().alias("tie"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        F.sha2(text_or_empty(), 256).alias("whole"),
    )
    sized = base.join(spans, same_document(base, spans), "left").select(
        base["doc_id"], base["tie"], "n_bytes", "whole",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "spans",
    )
    sized = stored(sized, "suffix-sizes")
    part = sized.where("n_removed > 0 and n_removed < n_bytes").select("doc_id", "tie", "spans")
    part = part.dropDuplicates(["doc_id", "tie"])
    cut = kept_bytes(docs, part).select("doc_id", "tie", F.sha2("kept", 256).alias("part"))
    cut = cut.dropDuplicates(["doc_id", "tie"])
    empty = F.sha2(F.lit(""), 256)
    kept = F.when(F.col("n_removed") == 0, F.col("whole")).when(
        F.col("n_removed") == F.col("n_bytes"), empty
    ).otherwise(F.col("part"))
    return sized.join(cut, same_document(sized, cut), "left").select(
        sized["doc_id"], "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256")
    )
