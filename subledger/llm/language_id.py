"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text becomes a sequence of lower-cased letters in which every run of other
characters is one gap; its 1- to 3-grams are hashed into ``BUCKETS`` features.
Training counts (language, bucket) over all labelled rows as Spark partial
sums, so the driver gets a matrix of languages x BUCKETS, which it fetches and
broadcasts. Scoring is a sparse row-by-matrix product per batch in numpy. More
languages than ``MODEL_MB`` holds are handled in blocks of that size, one after
the other; of the blocks' best languages the best one counts, and the score is
over the languages of all blocks.

A text that is null or has no letter is ``und`` with score 0; with no labelled
row at all every text is ``und``, but ``known_language`` still rejects only those
that are null or have no letter. Equal scores go to the language first in code
point order. Rows with a null or empty ``lang`` teach nothing. Repeated rows
count as often as they occur. Very long texts are read whole; one text is the largest thing a
task holds. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import chunks, fresh, ship, stored, text_or_empty
from subledger.session import checkpoint_dir

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.1
UNKNOWN = "und"
#: Most megabytes of a count matrix (languages x BUCKETS x 8 bytes); beyond it there are several.
MODEL_MB = 256
#: Bytes a count takes on the driver: as fetched, as a frame and in two matrices.
FETCHED = 48
#: Languages whose sums a task holds at once.
HELD = 256
#: Bytes of text handled at once in a task.
CHUNK = 1 << 18
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@lru_cache(1)
def letters() -> np.ndarray:
    """Code point -> code point of its lower case, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, where each text's begin, and which texts have a letter."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]]) + 2
    points = np.frombuffer(
        ("\0\0" + "\0\0".join(texts) + "\0\0").encode("utf-32-le", "surrogatepass"), np.uint32
    )
    low = letters()[points]
    keep = np.empty(len(low), bool)
    keep[0] = True
    np.logical_or(low[1:] != 0, low[:-1] != 0, out=keep[1:])
    ends = begin + sizes
    for at in (1, ends, ends + 1):  # two gaps after each text: no n-gram that starts in it leaves it
        keep[at] = True
    place = np.cumsum(keep) - 1
    starts = place[begin - 1] + 1
    seq = low[keep].astype(np.uint64)
    seq = np.concatenate([seq, np.zeros(2, np.uint64)])
    n = len(seq) - 2
    out = np.empty((n, len(ORDERS)), np.int32)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j, order in enumerate(ORDERS):
            total = total + (seq[j : n + j] + np.uint64(1)) * np.uint64(MIX[j])
            mixed = (total ^ (total >> np.uint64(29))) * np.uint64(MIX[order % 3])
            out[:, j] = (mixed >> shift).astype(np.int32)
    out[np.concatenate([[0, 1], place[ends], place[ends + 1]])] = BUCKETS  # a gap between texts weighs nothing
    has = np.add.reduceat((seq[:n] != 0).astype(np.int64), starts) > 0
    has[sizes == 0] = False
    return out, starts, has


def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) summed over this task's rows; bucket -1 counts its texts."""
    sums: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}

    def summed() -> Iterator[pa.RecordBatch]:
        for lang, got in sums.items():
            some = np.flatnonzero(got)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(some) + 1)),
                    "bucket": pa.array(np.append(some, -1), pa.int32()),
                    "n": pa.array(np.append(got[some], texts[lang]), pa.int64()),
                }
            )
        sums.clear()
        texts.clear()

    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            part = part.take(pc.sort_indices(part.column("lang")))
            grams, starts, _ = features(part.column("text").to_pylist())
            langs = np.array(part.column("lang").to_pylist(), object)
            first = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1]])
            cut = np.append(starts[first], len(grams))
            for i, k in enumerate(first):
                lang = langs[k]
                if lang not in sums and len(sums) >= HELD:
                    yield from summed()
                got = np.bincount(grams[cut[i] : cut[i + 1]].ravel(), minlength=BUCKETS)[:BUCKETS]
                sums[lang] = sums.get(lang, 0) + got
                upto = first[i + 1] if i + 1 < len(first) else len(langs)
                texts[lang] = texts.get(lang, 0) + int(upto - k)
    yield from summed()


def block(found: DataFrame, n_texts: int | None = None) -> tuple[list[str], np.ndarray]:
    """Languages in order and the matrix log P(bucket | language), from their counts.

    After the buckets come a row of zeros, for gaps between texts, and the prior
    (``n_texts``: labelled texts of all languages, those of ``found`` if not given).
    """
    rows = found.toPandas()
    names = sorted(rows["lang"].unique())
    where = {lang: i for i, lang in enumerate(names)}
    matrix = np.zeros((BUCKETS + 2, len(names)))
    matrix[rows["bucket"].to_numpy(), rows["lang"].map(where).to_numpy(dtype=int)] = rows["n"]
    if names:
        seen = matrix[:BUCKETS] + SMOOTHING
        matrix[:BUCKETS] = np.log(seen / seen.sum(axis=0))
        matrix[-1] = np.log(matrix[-1] / (n_texts or matrix[-1].sum()))
    return names, matrix.astype(np.float32)


class Model:
    """What the labelled rows of ``docs`` teach, in blocks of languages."""

    def __init__(self, docs: DataFrame):
        ship(docs.sparkSession)
        labelled = docs.where(
            F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != "")
        ).select("text", "lang")
        self.most = max(1, int(MODEL_MB * 1e6) // (BUCKETS * FETCHED))
        self.one = labelled.select("lang").distinct().count() <= self.most
        self.found = (
            labelled.mapInArrow(counts, "lang string, bucket int, n long")
            .groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"))
        )

    def blocks(self) -> Iterator[tuple[list[str], np.ndarray]]:
        """Blocks in order of their languages; only one is held at a time."""
        if self.one:
            yield block(self.found)
            return
        found = stored(self.found, "language-counts")
        texts = found.where("bucket = -1")
        n_texts, last = texts.agg(F.sum("n")).first()[0], ""
        while some := texts.where(F.col("lang") > last).orderBy("lang").limit(self.most).collect():
            last = some[-1]["lang"]
            yield block(found.where(F.col("lang").between(some[0]["lang"], last)), n_texts)


def scores(
    texts: list[str], names: list[str], matrix: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: the best language, its log probability, the sum of all relative to it, whether it has a letter."""
    grams, starts, has = features(texts)
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.inf), has
    log = np.empty((len(texts), len(names)))
    for k in range(len(names)):
        column = np.ascontiguousarray(matrix[:, k])
        each = column[grams[:, 0]].astype(np.float64)
        for j in range(1, grams.shape[1]):
            each += column[grams[:, j]]
        log[:, k] = np.add.reduceat(each, starts) + column[-1]
    top = log.argmax(axis=1)
    best = log[np.arange(len(texts)), top]
    total = np.exp(log - best[:, None]).sum(axis=1)
    labels = [names[t] if h else UNKNOWN for t, h in zip(top, has, strict=True)]
    return labels, best, total, has


def held_out() -> Column:
    """crc32 of the doc_id as text leaves 1 on division by 3 (null: empty text)."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


MARK = "struct<label:string,best:double,total:double,has:boolean>"


def classifier(shared: Broadcast) -> Callable[[Column], Column]:
    @F.arrow_udf(MARK)
    def classify(text: pa.Array) -> pa.Array:
        labels, out = [], [(np.zeros(0), np.zeros(0), np.zeros(0, bool))]
        for part in chunks(pa.RecordBatch.from_arrays([text], ["text"]), "text", CHUNK):
            label, *numbers = scores(part.column("text").to_pylist(), *shared.value)
            labels += label
            out.append(numbers)
        return pa.StructArray.from_arrays(
            [pa.array(labels, pa.string()), *[pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]],
            ["label", "best", "total", "has"],
        )

    return classify


def best_of_blocks(docs: DataFrame, model: Model, row: str, made: str) -> DataFrame:
    """``docs`` with the marks that one matrix of all languages would give in ``made``: a pass over the texts per block."""
    spark = docs.sparkSession
    docs = stored(docs.withColumn(row, F.monotonically_increasing_id()), "language-docs")
    path = f"{checkpoint_dir(spark)}/llm-language-blocks-{uuid.uuid4().hex}"
    for k, matrix in enumerate(model.blocks()):
        shared = spark.sparkContext.broadcast(matrix)
        marks = docs.select(row, F.lit(k).alias("k"), classifier(shared)(text_or_empty()).alias("m"))
        marks.select(row, "k", "m.*").write.mode("append").parquet(path)
        shared.destroy()
    each = F.sort_array(F.collect_list(F.struct("k", "label", "best", "total", "has")))  # languages are in order of k
    marks = spark.read.parquet(path).groupBy(row).agg(each.alias("each"), F.max("best").alias("top"))
    top = F.filter("each", lambda x: x["best"] == F.col("top"))[0]
    total = F.aggregate("each", F.lit(0.0), lambda a, x: a + x["total"] * F.exp(x["best"] - F.col("top")))
    mark = F.struct(top["label"].alias("label"), F.col("top").alias("best"), total.alias("total"), top["has"].alias("has"))
    return docs.join(marks.select(row, mark.alias(made)), row)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the columns lang_pred, score and has_letter (or those names with ``_``)."""
    spark = docs.sparkSession
    ship(spark)
    made, row, label, score, letter = fresh(docs, "made", "row", "lang_pred", "score", "has_letter")
    if model.one:
        shared = spark.sparkContext.broadcast(next(model.blocks()))
        marked = docs.withColumn(made, classifier(shared)(text_or_empty()))
    else:
        marked = best_of_blocks(docs, model, row, made)
    has = F.col(made)["has"]
    return marked.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(made)["label"].alias(label),
        F.when(has, 1 / F.col(made)["total"]).otherwise(0.0).alias(score),
        has.alias(letter),
    )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows not held out."""
    model = Model(docs.where(~held_out()))
    slim = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(slim, model).drop("text", "has_letter")


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language; those with a null or letterless text are rejected."""
    model = Model(docs.where(~held_out()))
    out = predict(docs, model)
    has_letter = out.columns[-1]
    return out.where(F.col(has_letter)).select(*[F.col(f"`{c}`") for c in docs.columns])
