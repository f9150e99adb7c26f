"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprints that differ in at most ``RADIUS`` bits must meet in some table
with certainty. Give bit i the non-zero vector phi(i) of RADIUS + 1 bits; table
v (each non-zero v) masks a fingerprint to the bits with <phi(i), v> = 1 mod 2.
At most RADIUS differing bits span at most RADIUS dimensions, so some v is
orthogonal to all of them: that table sees two equal keys (Pagh 2016).

Only distinct fingerprints take part, so a group of copies is one row. Buckets
are read as sorted streams; a bucket gives links that span its components, not
its pairs. A bucket over ``BUCKET`` rows is dealt again by the same construction
on the bits its table ignores; a second-level bucket fixes all but about 14
bits, so it holds at most some 2^14 distinct fingerprints and is compared in
blocks. Nothing is capped. The links' components come from alternating large
and small stars, each round written to the shared folder.

A null or empty text (no words) has fingerprint 0 and is linked like any other.
Null doc_ids never name a component unless all its rows have none. Repeated
rows share a fingerprint. Very long texts are hashed whole, some words at a time; one text is the
largest thing a task holds. An empty table gives no rows. Rows with one fingerprint, a third of
all perhaps, meet their component by a join on it, which AQE splits. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import ship, stored, text_or_empty, without

SHINGLE = 3
SEED = 42
RADIUS = 3
BUCKET = 1024
#: Words hashed at once in a task.
WORDS = 1 << 17
BLOCK = 128


# --- fingerprints -----------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text; 0 if it has no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as asked
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=SEED)
    ones, n, digest = np.zeros(64, np.int64), len(words) - shingle + 1, xxhash.xxh64_intdigest
    for a in range(0, n, WORDS):
        part = words[a : min(n, a + WORDS) + shingle - 1]
        hashes = [digest(b" ".join(x), SEED) for x in zip(*[part[i:] for i in range(shingle)], strict=False)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: pa.Array) -> pa.Array:
    made = np.fromiter((fingerprint(t.as_py()) for t in text), np.uint64, len(text))
    return pa.array(made.view(np.int64))


# --- covering tables --------------------------------------------------------


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """One mask per table: 2^(radius + 1) - 1 masks over the given bit positions."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << bit for i, bit in enumerate(bits) if (1 + i % vectors & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def tables(radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """The masks of the first level, and of the second (all of table 0, then 1, ...)."""
    first = covering_masks(list(range(64)), radius)
    second = []
    for mask in first:
        rest = [i for i in range(64) if not mask >> i & 1]
        second += [mask | more for more in covering_masks(rest, radius)]
    return first, second


def keyed(rows: DataFrame, masks: Column) -> DataFrame:
    """(mask, key, fp) for each table of ``masks`` (array of struct no, mask)."""
    return rows.withColumn("m", F.explode(masks)).select(
        F.col("m.no").alias("mask"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp"
    )


def spanning(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of a bucket the place of the first in its component."""
    if len(fps) == 2:
        near = int(fps[0] ^ fps[1]).bit_count() <= radius
        return np.array([0, 0 if near else 1])
    label = np.arange(len(fps))
    while True:
        new = label.copy()
        for a in range(0, len(fps), BLOCK):
            near = np.bitwise_count(fps[a : a + BLOCK, None] ^ fps[None, :]) <= radius
            new[a : a + BLOCK] = np.where(near, label[None, :], len(fps)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def links_of(limit: int | None, radius: int):
    """Links within the runs of equal (mask, key) of a sorted stream.

    Yields (a, b, mask): a link between fingerprints a and b, or with a null b
    a row of a bucket that is over ``limit`` and has to be dealt again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # the last run's fingerprints so far
        size, over, last = 0, False, None

        def close() -> pd.DataFrame | None:
            if over or size < 2:
                return None
            fps = np.concatenate(held)
            root = spanning(fps, radius)
            some = np.flatnonzero(root != np.arange(len(fps)))
            if not len(some):
                return None
            return pd.DataFrame({"a": fps[some].view(np.int64), "b": fps[root[some]].view(np.int64), "mask": last[0]})

        for batch in batches:
            mask, key = batch["mask"].to_numpy(), batch["key"].to_numpy()
            fps = batch["fp"].to_numpy().view(np.uint64)
            if not len(fps):
                continue
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = np.concatenate([[0], edge, [len(fps)]])
            if len(cuts) > 3:  # runs of one row that begin and end here need nothing
                wide = np.diff(cuts) > 1
                wide[[0, -1]] = True
            else:
                wide = np.ones(len(cuts) - 1, bool)
            made = []
            for i in np.flatnonzero(wide):
                a, b = cuts[i], cuts[i + 1]
                now = (int(mask[a]), int(key[a]))
                if now != last:
                    if (got := close()) is not None:
                        made.append(got)
                    held, size, over, last = [], 0, False, now
                held.append(fps[a:b])
                size += b - a
                if limit and size > limit:
                    over = True
                if over:
                    made.append(pd.DataFrame({"a": np.concatenate(held).view(np.int64), "b": pd.NA, "mask": now[0]}))
                    held = []
            if made:
                out = pd.concat(made, ignore_index=True)
                yield out.astype({"b": "Int64"})
        if (got := close()) is not None:
            yield got.astype({"b": "Int64"})

    return run


def bucket_links(rows: DataFrame, limit: int | None, radius: int) -> DataFrame:
    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return dealt.mapInPandas(links_of(limit, radius), "a long, b long, mask int")


def near_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within ``radius`` bits."""
    first, second = tables(radius)
    entry = lambda no, mask: F.struct(F.lit(no).alias("no"), F.lit(signed(mask)).alias("mask"))
    level1 = F.array(*[entry(i, m) for i, m in enumerate(first)])
    found = stored(bucket_links(keyed(classes.select("fp"), level1), BUCKET, radius), "simhash-links")
    n = len(first)
    level2 = F.array(
        *[F.array(*[entry(i * n + j, second[i * n + j]) for j in range(n)]) for i in range(n)]
    )
    large = found.where(F.col("b").isNull()).select(F.col("a").alias("fp"), "mask")
    again = large.withColumn("all", F.element_at(level2, F.col("mask") + 1))
    rest = bucket_links(keyed(again, F.col("all")).distinct(), None, radius)
    links = found.where(F.col("b").isNotNull()).unionByName(rest).select("a", "b").distinct()
    return stored(links, "simhash-links")


# --- components -------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` but roots.

    Alternating stars: each round links every node's larger neighbours, then
    its smaller ones, to its smallest neighbour. A round's links never outnumber
    its nodes and links before; minima are partial aggregates, so a node with
    very many links leaves a map task as one row.
    """

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return (
            both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )

    def small(e: DataFrame) -> DataFrame:
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        down = e.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return down.unionByName(low.select("a", F.col("m").alias("b"))).distinct()

    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    seen = None
    while True:
        e = stored(small(large(e)), "stars")
        now = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp, component_id for every row of ``docs``."""
    ship(docs.sparkSession)
    thin = stored(
        docs.select(
            "doc_id",
            F.xxhash64(text_or_empty()).alias("text_key"),
            F.arrow_udf(fingerprints, "long")(text_or_empty()).alias("fp"),
        ),
        "simhash",
    )
    classes = thin.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    root = components(near_links(classes))
    member = classes.join(root, classes["fp"] == root["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = member.join(named, "root").select("fp", "component_id")
    return thin.join(ids, "fp").select("doc_id", "text_key", "fp", "component_id")


def hex16(fp: str) -> Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component.

    Of rows that share that doc_id the one with the smallest text hash stays;
    rows equal in both stay together (exact dedup settles those).
    """
    found = stored(near_duplicates(docs), "simhash-groups")
    # a component without any doc_id is told apart by its fingerprint
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("own")]
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    stays = found.groupBy(*group).agg(F.min(best).alias("stay"), F.count(F.lit(1)).alias("n")).where("n > 1")
    many = stays.select(
        F.col("component_id").alias("c"), F.col("own").alias("o"), "stay"
    )
    bad = found.join(
        many,
        found["component_id"].eqNullSafe(many["c"])
        & F.when(found["component_id"].isNull(), found["fp"]).eqNullSafe(many["o"]),
    ).where(best != F.col("stay"))
    return without(docs, bad.select("doc_id", "text_key"))
