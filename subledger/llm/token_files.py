"""Token files: canonical length-limited Huffman codes in independent blocks.

1. Every text is encoded once with the tokenizers library, the end id appended,
   and stored as compressed 16- or 32-bit ids.
2. The ids of all documents are counted (numpy counts per task, summed by
   Spark); the counts, at most one per vocabulary entry, give code lengths of
   at most ``MOST_BITS`` bits by package-merge, and lengths alone give the
   canonical code.
3. The documents are sorted by doc_id in ranges and written as blocks of about
   ``BLOCK`` ids: the bit stream, the documents in it, and the bit offset of
   every ``STEP``-th id. A block starts and ends with a document and is read
   without any other. The offsets let a reader start in the middle of a block,
   and let the table-driven decoder go through all stretches of a block at once.

The file format is two Parquet tables: ``code`` (id, bits) and ``blocks`` (part,
block, start_in_part, n_tokens, n_bits, doc_ids, doc_tokens, stream, marks).

Null and empty texts have only the end id. Documents are in ascending doc_id
order, null first; rows that share a doc_id are in the order of their texts'
hashes. Very long texts are encoded whole; one text, and the block it is in, is the largest thing a
task holds. Extra columns are ignored; an empty table gives empty files.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subledger.llm.common import chunks, ship, stored, text_or_empty
from subledger.llm.piece_ids import expanded

END_ID = 1
MOST_BITS = 20
BLOCK = 1 << 19
STEP = 128
CHUNK = 1 << 23
#: Parts of words whose ids a task keeps.
KEPT = 2_000_000
#: Latin letters that no normaliser joins with the stops and commas behind them.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
STEM = f"^[{LETTER}]+$"
SIMPLE = re.compile(rf"[{LETTER}]+|[.,]+")


# --- ids --------------------------------------------------------------------


class WordIds:
    """Ids of texts, by a bounded dictionary of the parts of words that the library has encoded.

    The tokenizer drops white space and cuts at every change between letters and
    punctuation. So a text's ids are those of its words, one after the other, and
    a word of letters with stops and commas behind has the ids of both parts.
    Arrow splits a chunk of texts and tells its distinct words and parts; the
    library sees only parts that are new, those that are single words to it many
    to a call.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has a core of its own
        self.library = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat, self.offset, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, parts: pa.Array) -> np.ndarray:
        """The numbers of distinct parts, after learning those that are new."""
        if len(self.known) > KEPT:
            self.clear()
        at = pc.index_in(parts, value_set=self.known)
        new = parts.filter(at.is_null())
        number = at.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            number[at.is_null().to_numpy(zero_copy_only=False)] = np.arange(len(self.known), len(self.known) + len(new))
            size, flat = self.learn(new.to_pylist())
            self.offset = np.concatenate([self.offset, len(self.flat) + np.cumsum(size) - size])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
            self.known = pa.concat_arrays([self.known, new])
        return number

    def learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        simple = np.array([SIMPLE.fullmatch(x) is not None for x in new])
        words = [x for x, s in zip(new, simple, strict=True) if s]
        calls = [words[i : i + 200] for i in range(0, len(words), 200)]
        got = self.library.encode_batch([" ".join(c) for c in calls], add_special_tokens=False)
        counts = [np.bincount(np.array(g.word_ids, np.int64), minlength=len(c)) for g, c in zip(got, calls, strict=True)]
        if any(len(n) != len(c) or not n.all() for n, c in zip(counts, calls, strict=True)):
            raise ValueError("the library does not see one word per part")
        single = self.library.encode_batch([x for x, s in zip(new, simple, strict=True) if not s], add_special_tokens=False)
        size = np.zeros(len(new), np.int64)
        size[simple] = np.concatenate([np.zeros(0, np.int64), *counts])
        size[~simple] = [len(g.ids) for g in single]
        flat = np.empty(int(size.sum()), np.int32)
        of_simple = np.repeat(simple, size)
        flat[of_simple] = np.fromiter(chain.from_iterable(g.ids for g in got), np.int32)
        flat[~of_simple] = np.fromiter(chain.from_iterable(g.ids for g in single), np.int32)
        return size, flat

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (and the last's end)."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        stem = pc.ascii_rtrim(distinct, characters=".,")
        simple = pc.match_substring_regex(stem, STEM)
        stem = pc.if_else(simple, stem, distinct)
        tail = pc.if_else(simple, pc.replace_substring_regex(distinct, "^[^.,]+", ""), "")
        parts = pa.concat_arrays([stem, tail]).dictionary_encode()
        number = self.places(parts.dictionary)
        at = number[parts.indices.to_numpy()].reshape(2, -1).T.ravel()  # stem, tail, stem, tail, ...
        flat, ends = expanded(self.flat, self.offset, self.size, at)
        offset = ends[:-1:2]
        ids, ends = expanded(flat, offset, np.diff(ends[::2]), words.indices.to_numpy())
        counts = pc.list_value_length(split).to_numpy()
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def packed(ids: np.ndarray) -> bytes:
    narrow = len(ids) == 0 or ids.max() < 1 << 16
    return (b"2" if narrow else b"4") + zstandard.ZstdCompressor(1).compress(
        ids.astype("<u2" if narrow else "<u4").tobytes()
    )


def unpacked(cell: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(cell[1:])
    return np.frombuffer(data, "<u2" if cell[:1] == b"2" else "<u4").astype(np.int64)


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, text_key and the packed ids (with the end id) of every row of ``docs``; stored."""
    ship(docs.sparkSession)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                flat, cuts = coder.encode(part.column("text"))
                cells = [packed(np.append(flat[a:b], end_id)) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(cells, pa.binary())],
                    ["doc_id", "text_key", "ids"],
                )

    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(ids, f"doc_id {kind}, text_key long, ids binary"), "token-ids")


# --- the code ---------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the best prefix code with at most ``most`` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << most:
        raise ValueError(f"{n} ids do not fit in {most} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(most):
        weight = np.concatenate([leaves, packages])
        by = np.argsort(weight, kind="stable")
        levels.append(by < n)  # True: a leaf
        weight = weight[by]
        packages = weight[0 : len(weight) // 2 * 2 : 2] + weight[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


class Code:
    """Canonical codes for ids of given lengths, and the table that decodes them."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        ids, bits = ids[order], bits[order]
        self.most = int(bits[-1]) if len(bits) else 1
        width = np.left_shift(1, self.most - bits)  # table slots of each code
        first = np.cumsum(width) - width
        # id << 8 | bits by the next most bits of the stream; a lone id leaves half the table empty
        self.table = np.full(1 << self.most, self.most, np.uint64)
        slots = np.repeat((ids.astype(np.uint64) << np.uint64(8)) | bits.astype(np.uint64), width)
        self.table[: len(slots)] = slots
        size = int(ids.max()) + 1 if len(ids) else 0
        # codes by id, at the high end of 64 bits
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids] = first.astype(np.uint64) << np.uint64(64 - self.most)
        self.length[ids] = bits

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """The bit stream, the offset of every STEP-th id, and the number of bits."""
        length = self.length[ids]
        end = np.cumsum(length)
        begin = end - length
        word, bit = begin >> 6, (begin & 63).astype(np.uint64)
        code = self.code[ids]
        out = np.zeros((int(end[-1]) >> 6) + 2, np.uint64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] = np.add.reduceat(code >> bit, first)
        over = np.flatnonzero(end > (word + 1) << 6)  # codes that go on in the next word
        out[word[over] + 1] |= code[over] << (np.uint64(64) - bit[over])
        n_bits = int(end[-1])
        return out.astype(">u8").tobytes()[: (n_bits + 7) // 8], begin[::STEP], n_bits

    def decode(self, stream: bytes, marks: np.ndarray, n_tokens: int) -> np.ndarray:
        """All ids of a block; every stretch between two marks is a lane."""
        words = np.frombuffer(stream + bytes(24 - len(stream) % 8), ">u8").astype(np.uint64)
        lanes, at = len(marks), np.array(marks).astype(np.uint64)
        out = np.empty((STEP, lanes), np.uint64)
        last = n_tokens - (lanes - 1) * STEP  # ids of the last lane
        six, low, one = np.uint64(6), np.uint64(63), np.uint64(1)
        shift, length = np.uint64(64 - self.most), np.uint64(255)
        for i in range(STEP):
            if i == last:
                at, lanes = at[:-1], lanes - 1
                if not lanes:
                    break
            word, bit = (at >> six).view(np.int64), at & low
            window = words[word] << bit | words[word + 1] >> one >> (low - bit)
            slot = self.table[(window >> shift).view(np.int64)]
            out[i, :lanes] = slot
            at = at + (slot & length)
        return (out.T.ravel()[:n_tokens] >> np.uint64(8)).view(np.int64)


def counted(tokens: DataFrame) -> pd.DataFrame:
    """id, n over all documents: at most one row per vocabulary entry."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(0, np.int64)
        for batch in batches:
            for a in range(0, len(batch), 256):
                ids = np.concatenate([unpacked(cell) for cell in batch["ids"].iloc[a : a + 256]])
                got = np.bincount(ids, minlength=len(sums))
                got[: len(sums)] += sums
                sums = got
        some = np.flatnonzero(sums)
        yield pd.DataFrame({"id": some, "n": sums[some]})

    rows = tokens.select("ids").mapInPandas(count, "id long, n long")
    return rows.groupBy("id").agg(F.sum("n").alias("n")).toPandas()


# --- files ------------------------------------------------------------------

BLOCKS = (
    "part int, block long, start_in_part long, n_tokens long, n_bits long, doc_ids array<string>,"
    " doc_tokens array<long>, stream binary, marks array<long>"
)


def written(tokens: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """The tables (code, blocks) of the packed ids in ``tokens``; both stored."""
    spark = tokens.sparkSession
    counts = counted(tokens).sort_values("id")
    ids, n = counts["id"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64)
    bits = code_lengths(n, max(most_bits, int(max(len(ids) - 1, 1)).bit_length()))
    code = stored(
        spark.createDataFrame(pd.DataFrame({"id": ids, "bits": bits}), "id long, bits int"), "token-code"
    )
    shared = spark.sparkContext.broadcast((ids, bits))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book, held, size, block, done = Code(*shared.value), [], 0, 0, 0

        def close(part: int) -> pd.DataFrame:
            stream, marks, n_bits = book.encode(np.concatenate([x for _, x in held]))
            return pd.DataFrame(
                {
                    "part": [part], "block": [block], "start_in_part": [done], "n_tokens": [size], "n_bits": [n_bits],
                    "doc_ids": [[i for i, _ in held]], "doc_tokens": [[len(x) for _, x in held]],
                    "stream": [stream], "marks": [marks],
                }
            )

        part = 0
        for batch in batches:
            for part, doc_id, cell in batch.itertuples(index=False, name=None):
                held.append((doc_id, unpacked(cell)))
                size += len(held[-1][1])
                if size >= BLOCK:
                    yield close(part)
                    held, done, size, block = [], done + size, 0, block + 1
        if held:
            yield close(part)

    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = (
        tokens.repartitionByRange(n_parts, F.col("doc_id").asc_nulls_first(), "text_key")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text_key")
        .select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("string").alias("doc_id"), "ids")
    )
    return code, stored(in_order.mapInPandas(write, BLOCKS), "token-blocks")


def documents(code: DataFrame, blocks: DataFrame, doc_id_type: str = "long") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files.

    ``start`` needs the ids of all earlier ranges: a running sum over one row
    per range, which is as many rows as the write had partitions.
    """
    spark = blocks.sparkSession
    ship(spark)
    table = code.toPandas()  # at most one row per vocabulary entry
    shared = spark.sparkContext.broadcast(
        (table["id"].to_numpy(dtype=np.int64), table["bits"].to_numpy(dtype=np.int64))
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Code(*shared.value)
        for batch in batches:
            for part, start, n, doc_ids, sizes, stream, marks in batch.itertuples(index=False, name=None):
                ids = book.decode(stream, marks, n).astype("<u4")
                ends = np.cumsum(sizes)
                yield pd.DataFrame(
                    {
                        "part": part, "doc_id": doc_ids, "start_in_part": start + ends - sizes, "n_tokens": sizes,
                        "ids_crc32": [zlib.crc32(ids[e - s : e].tobytes()) for e, s in zip(ends, sizes, strict=True)],
                    }
                )

    rows = blocks.select(
        "part", "start_in_part", "n_tokens", "doc_ids", "doc_tokens", "stream", "marks"
    ).mapInPandas(read, "part int, doc_id string, start_in_part long, n_tokens long, ids_crc32 long")
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(offsets), "part").select(
        F.col("doc_id").cast(doc_id_type).alias("doc_id"),
        (F.col("offset") + F.col("start_in_part")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    code, blocks = written(tokenised(docs, path))
    return documents(code, blocks, docs.schema["doc_id"].dataType.simpleString())
