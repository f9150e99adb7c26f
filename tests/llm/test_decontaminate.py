from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from subledger.llm import decontaminate as dc
from tests.llm.data import AWKWARD, documents


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        m = min(13, len(words))
        if m:
            for i in range(len(words) - m + 1):
                windows.setdefault(tuple(words[i : i + m]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, *_ in docs:
        words, hit, found = words_of(text), set(), set()
        for m in {len(w) for w in windows}:
            for i in range(len(words) - m + 1):
                if (w := tuple(words[i : i + m])) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[w]
        out.append((doc_id, len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()), key=repr)


def benchmark(spark, items):
    return spark.createDataFrame([(a, b, "extra") for a, b in items], "item_id long, text string, words string")


def test_small_vocabulary_matches_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "B", "é", "d1"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 8, 12, 13, 14, 20, 40]))) for i in range(5, 30)]
    items = [x for x in items if len(x[1].split()) > 3 or x[0] % 5 == 0] + [(None, "only here, not there"), (7, None), (9, items[3][1])]
    docs = [(i, text(rng.choice([0, 2, 12, 13, 30, 200]))) for i in range(150)]
    docs += [(900 + i, text(20) + ", " + items[i % len(items)][1].upper() + "! " + text(9) if items[i % len(items)][1] else "") for i in range(60)]
    docs += AWKWARD
    got = dc.contamination(documents(spark, docs), benchmark(spark, items))
    assert result(got) == brute(docs, items)


def test_long_spans_and_rare_hits(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(60))) for i in range(20)]
    docs = []
    for i in range(200):
        words, source = text(rng.choice([40, 300])), items[i % 20][1].split()
        a, n = rng.randint(0, 40), rng.choice([0, 8, 12, 13, 14, 20])
        at = rng.randint(0, 40)
        docs.append((i, "\n".join(words[:at] + source[a : a + n] + words[at:])))
    frame = documents(spark, docs)
    assert result(dc.contamination(frame, benchmark(spark, items))) == brute(docs, items)
    kept = dc.clean(frame, benchmark(spark, items))
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in brute(docs, items) if not d[4]}


def test_items_that_share_a_phrase_are_one_context(spark):
    phrase = " ".join(f"s{i}" for i in range(30))
    items = [(i, phrase) for i in range(40)] + [(100 + i, f"own{i} {phrase} end{i}") for i in range(10)]
    docs = [(i, f"a{i} b {phrase} c") for i in range(30)] + [(50, f"own3 {phrase}"), (51, phrase[:60])]
    assert result(dc.contamination(documents(spark, docs), benchmark(spark, items))) == brute(docs, items)


def test_the_bit_map_follows_the_benchmark_and_only_thins_out(spark, monkeypatch):
    rows = lambda n: spark.range(n).select(F.xxhash64("id").alias("gram"))
    monkeypatch.setattr(dc, "LEAST_BITS", 16)
    sizes = {n: dc.bit_map(rows(n)) for n in (0, 10, 50_000)}
    assert [b for _, b in sizes.values()] == [16, 16, 22]
    for n, (table, bits) in sizes.items():
        grams = np.array([r.gram for r in rows(n).collect()], np.int64).view(np.uint64) >> np.uint64(64 - bits)
        assert all(table[g >> 3] >> (g & 7) & 1 for g in grams.tolist()) and int(np.unpackbits(table).sum()) == len(set(grams.tolist()))
    items = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(30))) for i in range(20)]
    docs = [(i, " ".join(f"w{(i * 3 + j) % 60}" for j in range(50))) for i in range(30)]
    want = brute(docs, items)
    for bits in (3, 28):  # with eight bits nearly everything passes
        monkeypatch.setattr(dc, "MAP_BITS", bits)
        assert result(dc.contamination(documents(spark, docs), benchmark(spark, items))) == want


def test_chunks_do_not_matter(monkeypatch, spark):
    items = [(1, "x y z " * 10)]
    docs = [(i, "q " * (i % 7) + "x y z " * 6) for i in range(40)]
    monkeypatch.setattr(dc, "CHUNK", 50)
    assert result(dc.contamination(documents(spark, docs), benchmark(spark, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs = documents(spark, AWKWARD)
    none = benchmark(spark, [])
    assert result(dc.contamination(docs, none)) == brute(AWKWARD, [])
    assert dc.contamination(documents(spark, []), benchmark(spark, [(1, "a b")])).count() == 0
    assert dc.clean(docs, none).count() == len(AWKWARD)
