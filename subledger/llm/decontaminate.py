"""Benchmark decontamination by winnowing.

Words are hashed, k consecutive words give a gram, and of every ``w``
consecutive grams the one with the smallest hash (rightmost on a tie) is a
fingerprint. Two texts that share k + w - 1 words share a window of w grams,
hence its fingerprint at the same place: with K = 8 and W = 6 no shared span of
13 words is missed. An item of m < 13 words, but not none, is matched whole by
the scheme (k = m, w = 1).

A bit map of the benchmark's fingerprints (2^LEAST_BITS bits, or 64 for each of them, up to
2^MAP_BITS, 32 MB) is broadcast and only thins out the documents'
fingerprints; a shuffle join on the fingerprint decides. Every joined pair is
extended word by word to both sides, so hash collisions never count. Items that have a
fingerprint with the same words around it in common are joined as one context; their ids come in
once per document.

Lower-casing touches A-Z only; a word is a run of ASCII digits, letters and
code points from U+0080. Null or empty texts have no words, are never hit and
never contaminated. Repeated item rows count once per item_id; a null item_id
is the empty string in lists. Repeated documents get equal rows. Very long texts are taken
whole; one text is the largest thing a task holds. An empty table of documents gives no
rows, an empty benchmark hits nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import chunks, ship, stored, text_or_empty, without
from subledger.llm.hashing import BASE, GRAM, byte_values, grams, mixed, rolled

SPAN = 13
K, W = 8, 6
LEAST_BITS, MAP_BITS = 24, 28
CHUNK = 1 << 18


@lru_cache(1)
def byte_table() -> np.ndarray:
    """A 64-bit value per byte after lower-casing; 0 ends words."""
    table = byte_values().copy()
    table[0x41:0x5B] = table[0x61:0x7B]
    for a, b in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
        table[a:b] = 0
    return table


class Words:
    """The words of some texts: byte ranges, hashes, and the words of each text."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\0" + b"\0".join(raw) + b"\0"
        value = byte_table()[np.frombuffer(self.data, np.uint8)]
        change = np.flatnonzero(np.diff((value != 0).astype(np.int8)))
        self.begin, self.end = change[::2] + 1, change[1::2] + 1
        with np.errstate(over="ignore"):
            self.hash = mixed(rolled(value, self.begin, self.end, BASE) + (self.end - self.begin).astype(np.uint64), 1)
        stops = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        self.upto = np.searchsorted(self.begin, stops)  # words of texts 0..i
        self.since = np.concatenate([[0], self.upto[:-1]])
        self.text = np.repeat(np.arange(len(raw)), self.upto - self.since)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k words from each word on, and whether they lie in one text."""
        found = grams(self.hash, k, GRAM)
        return mixed(found, k), self.text[: len(found)] == self.text[k - 1 :]

    def fingerprints(self, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
        """Winnowed grams: first words and hashes."""
        grams, whole = self.grams(k)
        if w == 1:
            at = np.flatnonzero(whole)
            return at, grams[at]
        n = len(grams) - w + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        low, place = grams[:n].copy(), np.arange(n)
        for j in range(1, w):
            later = grams[j : n + j]
            less = later <= low
            low[less] = later[less]
            place[less] = np.flatnonzero(less) + j
        inside = self.text[:n] == self.text[k + w - 2 : k + w - 2 + n]
        at = np.unique(place[inside])
        return at, grams[at]

    def words(self, a: int, b: int) -> list[str]:
        """Words a..b-1, lower-cased, of one text."""
        return [
            self.data[x:y].lower().decode("utf-8", "surrogatepass")
            for x, y in zip(self.begin[a:b], self.end[a:b], strict=True)
        ]

    def row(self, at: int, k: int, w: int, gram: int) -> dict:
        """A fingerprint with the words that any window around it can hold."""
        i = self.text[at]
        a, b = max(self.since[i], at - w + 1), min(self.upto[i], at + k + w - 1)
        return {
            "gram": int(np.int64(gram.view(np.int64))), "k": k, "at": int(at - self.since[i]),
            "before": int(at - a), "words": self.words(a, b),
        }


HITS = pa.list_(
    pa.struct([("gram", pa.int64()), ("k", pa.int32()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.list_(pa.string()))])
)
HIT = "gram long, k int, at int, before int, words array<string>"


def schemes(n_words: int) -> tuple[int, int]:
    return (K, W) if n_words >= SPAN else (n_words, 1)


def item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for item, text in zip(batch["item"], batch["text"], strict=True):
            words = Words([text])
            n = len(words.hash)
            if n:
                k, w = schemes(n)
                at, grams = words.fingerprints(k, w)
                out += [{"item": item, **words.row(a, k, w, g)} for a, g in zip(at, grams, strict=True)]
        if out:
            yield pd.DataFrame(out)


def bit_map(items: DataFrame) -> tuple[np.ndarray, int]:
    """A bit per fingerprint by its first bits, and how many these are; fetched packed, 4 KB a row."""
    bits = min(MAP_BITS, max(LEAST_BITS, (64 * items.count()).bit_length()))
    slot = F.shiftrightunsigned("gram", 64 - bits) + 1  # buckets hold 1 to 32,768 and so on
    rows = items.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toPandas()
    out = np.zeros((1 << bits >> 3) + 4096, np.uint8)
    for bucket, part in zip(rows["bucket"], rows["bits"], strict=True):
        at = (int(bucket) - 1) * 4096
        out[at : at + len(part)] = np.frombuffer(part, np.uint8)
    return out, bits


def document_rows(shared, lengths: list[int]):
    """Per document its number of words and the fingerprints that pass the bit map."""
    sizes = [(K, W)] * (SPAN in lengths) + [(m, 1) for m in lengths if m < SPAN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = shared.value
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                words = Words(part.column("text").to_pylist())
                found = [[] for _ in range(len(part))]
                for k, w in sizes:
                    at, grams = words.fingerprints(k, w)
                    slot = grams >> np.uint64(64 - bits)
                    hit = table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1
                    for i in np.flatnonzero(hit):
                        found[words.text[at[i]]].append(words.row(at[i], k, w, grams[i]))
                kept = [part.column(c) for c in ("doc_id", "text_key", "row_no")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(words.upto - words.since, pa.int64()), pa.array(found, HITS)],
                    ["doc_id", "text_key", "row_no", "n_words", "hits"],
                )

    return run


def extended(
    at: pd.Series, k: pd.Series, before: pd.Series, words: pd.Series, item_before: pd.Series, item_words: pd.Series
) -> pd.DataFrame:
    """The shared span [first, upto) of a document around a gram; empty if it is too short."""
    first, upto = [], []
    for p, n, i, x, j, y in zip(at, k, before, words, item_before, item_words, strict=True):
        left = 0
        while left < min(i, j) and x[i - left - 1] == y[j - left - 1]:
            left += 1
        right = 0
        while i + right < len(x) and j + right < len(y) and x[i + right] == y[j + right]:
            right += 1
        good = right >= n and left + right >= (SPAN if n == K and len(y) >= SPAN else n)
        first.append(p - left if good else 0)
        upto.append(p + right if good else 0)
    return pd.DataFrame({"first": first, "upto": upto})


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items, contaminated for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    items = stored(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_or_empty().alias("text")
        ).mapInPandas(item_rows, f"item string, {HIT}"),
        "winnow-items",
    )
    lengths = sorted({SPAN if r["n"] >= SPAN else r["n"] for r in items.select(
        F.when((F.col("k") == K) & (F.size("words") >= SPAN), F.lit(SPAN)).otherwise(F.col("k")).alias("n")
    ).distinct().collect()})  # at most 13 values
    shared = spark.sparkContext.broadcast(bit_map(items))
    base = stored(
        docs.select(
            "doc_id",
            F.xxhash64(text_or_empty()).alias("text_key"),
            F.monotonically_increasing_id().alias("row_no"),
            text_or_empty().alias("text"),
        ).mapInArrow(
            document_rows(shared, lengths),
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, row_no long, n_words long, hits array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>",
        ),
        "winnow-documents",
    )
    hits = base.select("row_no", F.explode("hits").alias("h")).select("row_no", "h.*")
    around = ["gram", "k", "before", "words"]
    contexts = stored(items.select(*around).distinct().withColumn("context", F.monotonically_increasing_id()), "winnow-contexts")
    members = items.join(contexts, around).select("context", "item").distinct()
    probe = contexts.withColumnsRenamed({"before": "item_before", "words": "item_words"})
    extend = F.pandas_udf(extended, "first int, upto int")
    spans = (
        hits.join(probe, ["gram", "k"])
        .withColumn("s", extend("at", "k", "before", "words", "item_before", "item_words"))
        .select("row_no", "context", "s.first", "s.upto")
        .where("upto > first")
        .distinct()
    )
    spans = stored(spans, "winnow-spans")
    in_order = Window.partitionBy("row_no").orderBy("first", "upto")
    reached = F.coalesce(F.max("upto").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (
        spans.select("row_no", "first", "upto").distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("upto") - F.greatest("first", reached)))
        .groupBy("row_no").agg(F.sum("new").alias("n_hit"))
    )
    named = (
        spans.select("row_no", "context").distinct().join(members, "context")
        .groupBy("row_no").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        base.select("row_no", "doc_id", "text_key", "n_words")
        .join(covered.join(named, "row_no"), "row_no", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    return without(docs, contamination(docs, benchmark).where("contaminated"))
