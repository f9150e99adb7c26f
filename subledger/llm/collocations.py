"""Phrase collocations by a weighted de Bruijn graph.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words
``[^\\x20\\x09]+``; everything is per language (null: ``und``).

1. ``frequent_hashes``: a count per 64-bit hash of a word or of two words in a row, summed
   over all texts. What occurs LEAST times or more goes into a bit map whose size
   follows the number of such hashes (up to 2^MAP_BITS bits, 32 MB) and is broadcast.
   It only says where a piece can be cut: a word, or a step between two words, that is
   rarer lies in no phrase of LEAST occurrences. A false hit keeps a step that could
   have been cut, so the map's size decides about work, never about results.
2. ``graph``: the strings between cuts give the graph's edges, their runs of LONGEST words,
   each from the node of its first LONGEST - 1 words to that of its last; and their tails (last LONGEST - 1
   words, or all) as piece-end corrections. Both are counted per slice of a
   batch, then summed by a shuffle on the words themselves.
3. ``compacted``: an edge whose end node has one edge in, one edge out and equal weights is
   followed by that edge only. Pointer doubling along such steps (on edge numbers) finds for every
   edge the last of its path and the distance to it; a cycle has no last edge and is left as
   it is. A path becomes a row of up to SEGMENT edges: its words, once, and one weight.
4. ``counts``: f of a node is the weight of its outgoing edges plus the tails that end in
   it; dropping the last word again and again, f of all shorter phrases follows from the
   longer ones and the tails. No shorter phrase is ever counted in the texts.
5. ``scored``: the cut with the lowest score counts; products are decimals of 38 digits. Candidates
   whose score cannot reach the first ones, by bounds from their outer words, have no cut looked up.

Phrases with LEAST or more occurrences, and their parts, thus have exact counts; rarer
ones may come out lower, never higher, and are dropped. Inside one slice equal phrases are told
by 128 bits of hash.

A null or empty text has no words. Very long texts are taken whole; one text is the
largest thing a task holds. Repeated rows count as often as they occur. Ties in score go to
the larger count, then to the phrase in UTF-8 byte order. An empty table gives no
rows; a language without candidates gives none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.common import chunks, ship, stored, text_or_empty
from subledger.llm.hashing import BASE, GRAM, byte_values, grams, mixed, rolled

LONGEST = 5
LEAST = 100
TOP = 2000
CHUNK = 1 << 20
MAP_BITS = 28
SEGMENT = 512
#: Most languages whose totals are broadcast; with more they are joined by a shuffle.
LANGUAGES = 100_000
SALTS = 64

STOP, BREAK, PLAIN = 0, 1, 2
LOWERED = bytes(x + 32 if 0x41 <= x <= 0x5A else x for x in range(256))

HASHES = "kind int, hash long, lang string, n long"
RUNS = "lang string, tail boolean, phrase string, n long"


@lru_cache(1)
def byte_kind() -> np.ndarray:
    kind = np.full(256, PLAIN, np.int8)
    kind[[0x20, 0x09]] = BREAK
    kind[[0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = STOP
    return kind


class Pieces:
    """The words of some texts: where they stand, their hashes, and which follow each other in a piece."""

    def __init__(self, texts: list[bytes]):
        self.data = (b"\n" + b"\n".join(texts) + b"\n").translate(LOWERED)
        self.raw = raw = np.frombuffer(self.data, np.uint8)
        kind = byte_kind()[raw]
        change = np.flatnonzero(np.diff((kind == PLAIN).view(np.int8)))
        self.begin, self.end = change[::2] + 1, change[1::2] + 1
        size = (self.end - self.begin).astype(np.uint64)
        self.hash = mixed(rolled(byte_values()[raw], self.begin, self.end, BASE) + size, 1)
        stops = np.cumsum(kind == STOP)
        self.linked = stops[self.begin[1:]] == stops[self.begin[:-1]]  # word i and i + 1

    def steps(self, salt: int) -> np.ndarray:
        """A hash of word i and word i + 1."""
        return mixed(grams(self.hash, 2, GRAM), salt)

    def phrases(self, first: np.ndarray, n: int) -> pa.StringArray:
        """The ``n`` words from each word of ``first`` on, joined by one space."""
        begin, end = self.begin[first], self.end[first + n - 1]
        words = sum(self.end[first + j] - self.begin[first + j] for j in range(n))
        spaced = end - begin != words + n - 1  # not one character between words
        tabs = np.zeros(len(first), bool)
        for j in range(1, n):
            tabs |= self.raw[self.begin[first + j] - 1] != 0x20
        odd = np.flatnonzero(spaced | tabs)
        source, begin, end = self.raw, begin.copy(), end.copy()
        if len(odd):  # written out behind the texts
            more = [b" ".join(self.data[a:b] for a, b in zip(self.begin[i : i + n], self.end[i : i + n], strict=True)) for i in first[odd]]
            size = np.cumsum([0, *map(len, more)])
            begin[odd], end[odd] = len(source) + size[:-1], len(source) + size[1:]
            source = np.concatenate([source, np.frombuffer(b"".join(more), np.uint8)])
        stops = np.r_[0, np.cumsum(end - begin)]
        at = np.arange(stops[-1]) + np.repeat(begin - stops[:-1], end - begin)
        return pa.StringArray.from_buffers(
            len(first), pa.py_buffer(stops.astype(np.int32).tobytes()), pa.py_buffer(source[at].tobytes()))


def language_salt(lang: str) -> int:
    """Tells the hashes of languages apart."""
    return int(mixed(rolled(byte_values()[np.frombuffer(lang.encode() + b"\0", np.uint8)], np.array([0]), np.array([len(lang.encode()) + 1]), BASE), 7)[0]) | 1


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Slices of about CHUNK bytes of a batch, dealt by language."""
    for part in chunks(batch, "text", CHUNK):
        dealt: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
            dealt.setdefault(lang, []).append(text)
        yield from dealt.items()


def hash_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: all words of a language; kind 1: a word's hash or that of two words, and how often."""
    for batch in batches:
        for lang, texts in by_language(batch):
            found = Pieces(texts)
            salt = language_salt(lang)
            both = np.concatenate([mixed(found.hash, salt), found.steps(salt)[found.linked]])
            hashes, n = np.unique(both, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.r_[np.int32(0), np.ones(len(hashes), np.int32)], pa.int32()),
                "hash": pa.array(np.r_[np.int64(0), hashes.view(np.int64)]),
                "lang": pa.array([lang] + [None] * len(hashes), pa.string()),
                "n": pa.array(np.r_[np.int64(len(found.hash)), n]),
            })


def equal_runs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct pair of hashes, and how often the pair occurs."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    same, other = a[1:] == a[:-1], b[1:] != b[:-1]
    if (same & other).any():  # equal first hashes of different phrases: by both
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        same, other = a[1:] == a[:-1], b[1:] != b[:-1]
    at = np.flatnonzero(np.r_[True, ~same | other])
    return order[at], np.diff(np.r_[at, len(a)])


def run_rows(shared, bits: int, longest: int):
    """Edges (``longest`` words) and tails (the last ``longest - 1`` or all) of the uncut strings."""

    def known(hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - bits)
        return (shared.value[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in by_language(batch):
                found = Pieces(texts)
                salt = language_salt(lang)
                word = known(mixed(found.hash, salt))
                step = found.linked & known(found.steps(salt)) & word[1:] & word[:-1]
                if not len(word):
                    continue
                # strings between cuts: for each word its place in its string and the words left in it
                last = np.flatnonzero(np.r_[~step, True])
                size = np.diff(np.r_[-1, last])
                left = np.repeat(last, size) - np.arange(len(word)) + 1
                place = np.repeat(size, size) - left
                other = mixed(found.hash, 3)
                for n in range(1, longest + 1):
                    if n == longest:
                        at = np.flatnonzero(left >= n)
                    elif n == longest - 1:
                        at = np.flatnonzero(left == n)
                    else:  # a string of n words is its own tail
                        at = np.flatnonzero((left == n) & (place == 0))
                    at = at[word[at]]
                    if not len(at):
                        continue
                    some, n_times = equal_runs(mixed(grams(found.hash, n, GRAM), n)[at], grams(other, n, GRAM)[at])
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(some), pa.string()),
                        "tail": pa.array([n < longest] * len(some), pa.bool_()),
                        "phrase": found.phrases(at[some], n),
                        "n": pa.array(n_times, pa.int64()),
                    })

    return run


def spoken(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))


def frequent_hashes(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with all words of each language; the hashes that occur ``least`` times or more."""
    counted = texts.mapInArrow(hash_counts, HASHES).groupBy("kind", "hash", "lang").agg(F.sum("n").alias("n"))
    kept = stored(counted.where((F.col("kind") == 0) | (F.col("n") >= least)), "collocations-hashes")
    return kept.where("kind = 0").select("lang", "n"), kept.where("kind = 1").select("hash")


def bit_map(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit per hash, 16 bits for each on average, 2^MAP_BITS at most: that many are fetched, packed."""
    bits = min(MAP_BITS, max(16, (16 * max(1, hashes.count())).bit_length()))
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1  # buckets hold 1 to 32,768 and so on
    rows = hashes.groupBy((F.bitmap_bucket_number(slot)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    ).toPandas()
    out = np.zeros((1 << bits) + 8 * 4096 >> 3, np.uint8)
    for bucket, part in zip(rows["bucket"], rows["bits"], strict=True):
        at = (int(bucket) - 1) * 4096
        out[at : at + len(part)] = np.frombuffer(part, np.uint8)[: len(out) - at]
    return out, bits


def words(phrase: str | Column, first: int | Column, n: int | Column) -> Column:
    parts = F.split(phrase, " ")
    return F.array_join(F.slice(parts, first, n), " ")


def without_last(phrase: str) -> Column:
    return F.regexp_replace(phrase, " [^ ]*$", "")


def without_first(phrase: str) -> Column:
    return F.expr(f"substring({phrase}, instr({phrase}, ' ') + 1)")


def graph(texts: DataFrame, hashes: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, id): the edges with their weights; (lang, phrase, n): the tails."""
    spark = texts.sparkSession
    table, bits = bit_map(hashes)
    shared = spark.sparkContext.broadcast(table)
    rows = texts.mapInArrow(run_rows(shared, bits, longest), RUNS)
    summed = rows.groupBy("lang", "tail", "phrase").agg(F.sum("n").alias("n"))
    summed = stored(summed.withColumn("id", F.monotonically_increasing_id()), "collocations-runs")
    return summed.where("not tail").drop("tail"), summed.where("tail").drop("tail", "id")


def followers(edges: DataFrame) -> DataFrame:
    """(id, last): edges whose end node has no other edge in, one edge out and equal weights, with that edge.

    Degrees are partial sums, so a node with very many edges is one row per task.
    """
    none = F.lit(None).cast("long")
    ends = edges.select("lang", "n", without_first("phrase").alias("node"), F.col("id").alias("before"), none.alias("after")).union(
        edges.select("lang", "n", without_last("phrase").alias("node"), none.alias("before"), F.col("id").alias("after")))
    inward = F.col("before").isNotNull()
    nodes = ends.groupBy("lang", "node").agg(
        F.count("before").alias("n_in"), F.count("after").alias("n_out"),
        F.sum(F.when(inward, F.col("n"))).alias("w_in"), F.sum(F.when(~inward, F.col("n"))).alias("w_out"),
        F.max("before").alias("id"), F.max("after").alias("last"),
    )
    return nodes.where("n_in = 1 and n_out = 1 and w_in = w_out and id != last").select("id", "last")


def path_places(links: DataFrame) -> DataFrame:
    """(id, last, steps) of all edges in paths of two or more, by pointer doubling; none of cycles."""
    links = stored(links, "collocations-links")
    ids = links.select(F.col("id").alias("last"), F.lit(True).alias("more"))
    # open: something follows the last edge so far; only these rows go through a round
    state = stored(links.join(ids, "last", "left").select(
        "id", "last", F.lit(1).cast("long").alias("steps"), F.col("more").isNotNull().alias("open")), "collocations-paths")
    is_open, before = state.where("open").count(), None
    while is_open and is_open != before:  # what stays open for ever is in a cycle
        jump = state.select(
            F.col("id").alias("last"), F.col("last").alias("further"), F.col("steps").alias("more"), F.col("open").alias("still"))
        moved = state.where("open").join(jump, "last").select(
            "id", F.col("further").alias("last"), (F.col("steps") + F.col("more")).alias("steps"), F.col("still").alias("open"))
        state = stored(state.where("not open").unionByName(moved), "collocations-paths")
        before, is_open = is_open, state.where("open").count()
    inner = state.where("not open").drop("open")
    ends = inner.select("last").distinct()
    return inner.unionByName(ends.select(F.col("last").alias("id"), "last", F.lit(0).cast("long").alias("steps")))


def compacted(edges: DataFrame) -> DataFrame:
    """(lang, phrase, n): unary paths as one row of up to SEGMENT edges each, other edges as they are."""
    # numbers are unique on both sides, so what belongs together is gathered by a group, not a join
    text, path = edges.select("id", "lang", "phrase", "n"), path_places(followers(edges))
    both = text.unionByName(path, allowMissingColumns=True).groupBy("id").agg(
        *[F.max(c).alias(c) for c in ("lang", "phrase", "n", "last", "steps")])
    placed = stored(both.drop("id"), "collocations-edges")
    segment = F.floor(F.col("steps") / SEGMENT)
    paths = placed.where("last is not null").groupBy("lang", "last", segment.alias("segment")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("at"), "phrase"))).alias("found"))
    first = F.col("found")[0]["phrase"]
    more = F.transform(F.slice("found", F.lit(2), F.greatest(F.size("found") - 1, F.lit(0))), lambda x: F.substring_index(x["phrase"], " ", -1))
    whole = F.array_join(F.concat(F.array(first), more), " ")
    alone = placed.where("last is null").select("lang", "phrase", "n")
    return paths.select("lang", whole.alias("phrase"), "n").unionByName(alone)


def counts(edges: DataFrame, tails: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, n, f) of all phrases of 1 to ``longest`` words with ``f >= least``, n their words.

    ``edges`` may be compacted: a row of m words stands for m - longest + 1 edges of its weight.
    """
    parts = F.split("phrase", " ")
    starts = F.sequence(F.lit(1), F.size(parts) - (longest - 1))
    many = F.size(parts) > longest
    level = edges.where(~many).select("lang", F.col("n").alias("f"), "phrase").unionByName(
        edges.where(many).select("lang", F.col("n").alias("f"), F.explode(F.transform(
            starts, lambda i: F.array_join(F.slice(parts, i, F.lit(longest)), " "))).alias("phrase")))
    levels = [level.where(F.col("f") >= least).select("lang", "phrase", F.lit(longest).alias("n"), "f")]
    for n in range(longest - 1, 0, -1):
        outward = level.select("lang", without_last("phrase").alias("phrase"), "f")
        ending = tails.where(F.size(F.split("phrase", " ")) >= n).select(
            "lang", F.substring_index("phrase", " ", -n).alias("phrase"), F.col("n").alias("f"))
        level = stored(outward.unionByName(ending).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), f"collocations-{n}")
        levels.append(level.where(F.col("f") >= least).select("lang", "phrase", F.lit(n).alias("n"), "f"))
    return stored(reduce(DataFrame.unionByName, levels), "collocations-counts")


def big(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def thousandfold(above: Column, below: Column) -> Column:
    """floor(1000 * above / below), exact."""
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * above, below)


def kept_candidates(found: DataFrame) -> DataFrame:
    """Phrases of two words or more that no longer phrase of equal count contains."""
    # f of a longer phrase is never above that of a part, so "100 f >= 100 a" says equal
    inner = found.where("n > 2").select(
        "lang", F.col("f").alias("longer"), F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("n") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("n") - m + 1), lambda i: words("phrase", i, m)),
        ))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = found.where("n > 1").join(inner, ["lang", "phrase"], "left").where("longer is null or longer < f")
    return kept.select("lang", "phrase", F.col("f").alias("a"), F.col("n").alias("size"))


def promising(kept: DataFrame, found: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Candidates that can be among the first ``top`` of their language, by proven bounds.

    No part of a phrase is more frequent than its first or last word, so no cut scores below
    1000 a n / (f(first) f(last)); and the outermost cuts score 1000 n / max(f(first),
    f(last)) at most, as the other part is as frequent as the phrase at least. What cannot
    reach the ``top``-th largest lower bound is left out before the cuts are looked up.
    """
    word = found.where("n = 1")
    first, last = (word.select("lang", F.col("phrase").alias(c), F.col("f").alias(f"f_{c}")) for c in ("head", "rest"))
    few = (lambda df: F.broadcast(df)) if totals.count() <= LANGUAGES else (lambda df: df)  # one row per language
    bound = kept.withColumns({
        "head": F.substring_index("phrase", " ", 1), "rest": F.substring_index("phrase", " ", -1),
    }).join(first, ["lang", "head"]).join(last, ["lang", "rest"]).join(few(totals), "lang").select(
        "lang", "phrase", "a", "size", "n",
        thousandfold(big("a") * big("n"), big("f_head") * big("f_rest")).alias("least"),
        thousandfold(big("n"), F.greatest(big("f_head"), big("f_rest"))).alias("most"),
    )
    bound = stored(bound, "collocations-bounds")
    score = bound.select("lang", "phrase", "a", F.col("least").alias("score"))
    floor = ranked(score, top).where(F.col("rank") == top).select("lang", F.col("score").alias("floor"))
    return bound.join(few(floor), "lang", "left").where("floor is null or most >= floor").drop("least", "most", "floor")


def scored(found: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that can be among the first ``top``."""
    cuts = promising(kept_candidates(found), found, totals, top).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    ).withColumns({
        "head": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)"),
    })
    left = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = cuts.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).withColumn(
        "score", thousandfold(big("a") * big("n"), big("l") * big("r")))
    best = exact.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    return best.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language; taken first in parts of it, then over what these leave."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= top).drop("part", "rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n words, f) of all phrases with f >= ``least``; (lang, n) with all words."""
    ship(docs.sparkSession)
    texts = spoken(docs)
    totals, hashes = frequent_hashes(texts, least)
    edges, tails = graph(texts, hashes, longest)
    return counts(stored(compacted(edges), "collocations-unitigs"), tails, longest, least), totals


def mined(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` collocations."""
    found, totals = phrase_counts(docs, least, longest)
    return ranked(scored(found, totals, top), top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
