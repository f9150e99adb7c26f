"""Quality filtering by weak supervision: rules vote, EM weighs them, a posterior decides.

Every text is measured once (whole, in slices of a batch). Each rule in RULES
then votes *good*, votes *bad* or abstains; nothing has to pass all of them. How often
each pattern of votes occurs is counted in Spark over all documents that the two hard
rules below leave. There are at most 3^rules patterns (59,049, in practice some
hundred), whatever the corpus, so expectation-maximisation runs on the driver over these
counts. It estimates the share of good documents and, per rule, how often it
votes good, bad or not at all on good and on bad documents. A rule is held to be better
than a coin: a bad vote never speaks for a document, a good vote or an abstention never
against it, and no rate is taken as surer than RATES. Of what passes the hard rules at
least half is taken to be good. So a document that no rule votes against stays,
and one bad vote outweighs the good ones only if the rule fires among bad documents far
more often than among good ones. The posterior log-odds are a sum over the votes, hence
a plain column expression: no join, no broadcast.

Words are ``[^\\x20\\x09-\\x0D]+``. Two hard rules (``base_failed``) come before the
verdict: under 50 words, or more than half of the words in repeated 3-word windows.

A null text has no words, as an empty one, and fails. Very long texts are taken whole;
one text is the largest thing a task holds. Repeated rows and rows without an id get
rows of their own and all count in the estimate. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import chunks, ship, stored, text_or_empty

CHUNK = 1 << 21
BLANK = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
STOPS = b".!?"
#: What prose has few of: words that hold one of these bytes are odd.
ODD = bytes(x for x in range(0x21, 0x7F) if not chr(x).isalpha() and chr(x) not in ".,;:!?'\"()-")
MARKED = bytes(0x78 if x in ODD else x if x in BLANK else 0x61 for x in range(256))

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_shouts", "n_stops", "n_distinct", "n_odd", "n_top",
)

RATES = (0.002, 0.998)
ROUNDS = 200
THRESHOLD = 0.5


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(codes) < 4 or distinct == len(codes):
        return 0
    pair = codes[:-1] * distinct + codes[1:]
    if distinct >= 1 << 20:  # keeps the product within 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * distinct + codes[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(codes), bool)
    for k in range(3):
        inside[k : k + len(window)] |= twice
    return int(inside.sum())


def measure(raw: bytes, n_chars: int) -> tuple[int, ...]:
    """The MEASURES of one text of ``n_chars`` code points."""
    count = lambda some: len(raw) - len(raw.translate(None, some))
    words = raw.split()  # at ASCII white space, as the pattern says
    index: dict[bytes, int] = {}
    codes = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip(BLANK)]
    return (
        len(words), n_chars - count(BLANK), count(SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(codes, len(index)), len(lines), count(UPPER), count(LOWER), raw.count(b"!"),
        count(STOPS), len(index), sum(b"x" in w for w in raw.translate(MARKED).split()),
        int(np.bincount(codes).max(initial=0)),
    )


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            text = part.column("text")
            rows = map(measure, text.cast(pa.binary()).to_pylist(), pc.utf8_length(text).to_pylist())
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", *MEASURES]
            )


def per_hundred(count: str, whole: Column | str = "n_words") -> Column:
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(F.col(count) * 100, whole)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains (null too)."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("tinyint").alias(self.name)


def rules() -> list[Rule]:
    """Ten rules over the measures; of a text without the thing measured they abstain."""
    letters = F.nullif(F.col("n_upper") + F.col("n_lower"), F.lit(0))
    length = F.try_divide("word_chars", "n_words")
    lines = F.when(F.col("n_lines") > 1, F.col("n_lines"))
    variety = F.try_divide(F.col("n_distinct"), F.least("n_words", F.lit(400)))
    never = F.lit(False)
    return [
        Rule("symbols", per_hundred("n_symbols") > 10, never),
        Rule("odd_words", per_hundred("n_odd") > 20, per_hundred("n_odd") <= 5),
        Rule("capitals", per_hundred("n_upper", letters) > 50, never),
        Rule("shouting", per_hundred("n_shouts") > 20, never),
        Rule("repetition", per_hundred("n_repeat_words") > 30, never),
        Rule("top_word", per_hundred("n_top") > 25, per_hundred("n_top") <= 15),
        Rule("lines", per_hundred("n_dup_lines", lines) > 30, never),
        # longer means come from scripts without spaces: no vote
        Rule("length", (length < 2) | length.between(12, 20), length.between(3, 10)),
        Rule("variety", variety < 0.2, variety >= 0.4),
        Rule("sentences", (F.col("n_stops") == 0) & (F.col("n_words") >= 100),
             (per_hundred("n_stops") >= 1) & (per_hundred("n_stops") <= 40)),
    ]


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule the weight (log-odds) of a good vote, a bad one, and none."""

    good: float
    up: np.ndarray
    down: np.ndarray
    none: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of rows of votes (-1, 0, 1), in favour of good."""
        said = (votes == 1) @ self.up + (votes == -1) @ self.down + (votes == 0) @ self.none
        return math.log(self.good / (1 - self.good)) + said


def fitted(votes: np.ndarray, counts: np.ndarray) -> Model:
    """EM over distinct patterns of votes and how often they occur.

    It starts from a plain count: more bad votes than one against each two good ones is bad.
    """
    n, zero = counts.sum(), np.zeros(votes.shape[1])
    model = Model(0.5, zero, zero, zero)
    if not n:
        return model
    up, down, none = votes == 1, votes == -1, votes == 0
    good = np.where(down.sum(axis=1) * 2 > up.sum(axis=1), 0.1, 0.9)
    rate = lambda weight, said: np.clip((weight @ said + 1) / (weight.sum() + 3), *RATES)
    for _ in range(ROUNDS):
        g, b = counts * good, counts * (1 - good)
        before, model = model, Model(
            float(np.clip((g.sum() + 1) / (n + 2), 0.5, RATES[1])),
            np.maximum(np.log(rate(g, up) / rate(b, up)), 0),
            np.minimum(np.log(rate(g, down) / rate(b, down)), 0),
            np.maximum(np.log(rate(g, none) / rate(b, none)), 0),
        )
        good = 1 / (1 + np.exp(-model.log_odds(votes)))
        moved = [np.abs(x - y).max() for x, y in ((before.up, model.up), (before.down, model.down), (before.none, model.none))]
        if max(*moved, abs(before.good - model.good)) < 1e-9:
            break
    return model


def judged(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the measures, a vote per rule, ``p_good`` (posterior), ``base_failed``, ``kept``."""
    ship(docs.sparkSession)
    table = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    kind = table.schema["doc_id"].dataType.simpleString()
    found = stored(
        table.mapInArrow(measured, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES)), "quality-measures")
    used = rules()
    names = [r.name for r in used]
    # ids and measures are columns of this table only: the rules' names cannot clash
    voted = found.select("*", *[r.vote() for r in used])
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    seen = voted.where(~failed).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).toPandas()
    model = fitted(seen[names].to_numpy(np.int64).reshape(-1, len(names)), seen["n"].to_numpy(np.float64))
    odds = reduce(add, [
        F.when(F.col(name) == 1, float(up)).when(F.col(name) == -1, float(down)).otherwise(float(none))
        for name, up, down, none in zip(names, model.up, model.down, model.none, strict=True)
    ], F.lit(math.log(model.good / (1 - model.good))))
    return voted.withColumn("p_good", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("p_good") >= threshold))
