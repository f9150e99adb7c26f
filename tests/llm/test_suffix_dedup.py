from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from subledger.llm import suffix_dedup as sd
from tests.llm.data import AWKWARD, documents


def brute(rows, span=100):
    """By a set of all strings seen so far, document after document."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, []
    for doc_id, text, *_ in ordered:
        data, gone = (text or "").encode(), set()
        for s in range(len(data) - span + 1):
            first = seen.setdefault(data[s : s + span], (doc_id, s))
            if first != (doc_id, s):
                gone.update(range(s, s + span))
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        n_spans = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc_id, len(data), len(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n_docs):
    rng = random.Random(seed)
    text = lambda n, letters="abcdefghij klé": "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.choice([60, 99, 100, 101, 130, 400, 1500])) for _ in range(12)]
    rows = []
    for i in range(n_docs):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(text(rng.choice([0, 1, 40, 120, 300])))
            source = rng.choice(shared)
            a = rng.randint(0, max(0, len(source) - 90))
            parts.append(source[a : a + rng.choice([90, 100, 250, 2000])])
        rows.append((i, "".join(parts)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, n_docs, 5)]
    rows += [(2000, "=" * 1000), (2001, "=" * 99), (2002, "ab" * 300 + "=" * 150), (2003, " " * 100), (2004, "abc" * 40)]
    return rows


def result(spark, rows, n=4):
    got = sd.report(documents(spark, rows).repartition(n))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = passages(seed, 60)
    assert result(spark, rows) == brute(rows)


def test_blocks_and_flushes_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 150)
    monkeypatch.setattr(sd, "FLUSH", 3)
    monkeypatch.setattr(sd, "RUNS", 2)
    rows = passages(3, 30)
    assert result(spark, rows, 3) == brute(rows)


def test_a_line_that_very_many_documents_share(spark):
    line = "this very line of a licence stands in a great many of the documents, each time with something else around it"
    rng = random.Random(9)
    rows = [(i, f"{rng.random()} {i * 7919} " * 4 + line + f" {i} {rng.random()}") for i in range(300)]
    assert result(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] not in (8, 9)]
    long = " ".join(f"word{i % 97} and so on" for i in range(300))
    rows += [(8, long), (9, long + " x"), (None, long), (20, "é" * 90), (21, "xé" + "é" * 80)]
    assert result(spark, rows) == brute(rows)
    assert sd.report(documents(spark, [])).count() == 0


def test_repeated_rows_are_one_document(spark):
    long = "some text that is longer than a hundred bytes, and of which no part of a hundred bytes occurs in it twice"
    got = result(spark, [(1, long), (1, long), (2, long)])
    sha = hashlib.sha256(long.encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    n = len(long)
    assert got == sorted([(1, n, 0, 0, sha), (1, n, 0, 0, sha), (2, n, n, 1, none)], key=repr)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_texts_of_one_id_whose_hashes_share_25_bits(spark, doc_id):
    """Each is a document of its own: what the first loses, the second does not."""
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    other, head, tail = text(150), text(200), text(300)
    pool = [f"{other if i % 2 else head}{tail} {i}" for i in range(20_000)]
    low = spark.createDataFrame([(t,) for t in pool], "t string").select(
        "t", F.xxhash64("t").alias("h"), F.xxhash64("t").bitwiseAND((1 << 25) - 1).alias("low")
    )
    by_low = {}
    for t, h, bits in low.collect():
        by_low.setdefault(bits, {})[t[:150] == other] = (h, t)
    pair = sorted(next(x for x in by_low.values() if len(x) == 2).values())
    rows = [(1, other), *[(doc_id, t) for _, t in pair]]
    assert result(spark, rows) == brute(rows)


def test_a_very_long_document_that_others_share_in_part(spark):
    rng = random.Random(12)
    long = "".join(rng.choice("abcdefghij klmnop") for _ in range(400_000))
    rows = [(1, long), (2, "".join(long[i : i + 150] + f" cut {i} " for i in range(0, 300_000, 300)))]
    assert result(spark, rows, 2) == brute(rows)
