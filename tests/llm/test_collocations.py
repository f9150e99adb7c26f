"""Collocations against a count of every phrase."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from subledger.llm import collocations
from subledger.llm.collocations import compacted, counts, frequent_hashes, graph, mined, phrase_counts, ranked, spoken
from tests.llm.data import AWKWARD, documents


def pieces(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def all_counts(table, longest=5):
    f, n = Counter(), Counter()
    for text, lang in table:
        for words in pieces(text):
            n[lang or "und" if lang != "" else ""] += len(words)
            for k in range(1, longest + 1):
                f.update(("und" if lang is None else lang, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def brute(table, least, top=2000, longest=5):
    f, n = all_counts(table, longest)
    often = {p: a for p, a in f.items() if a >= least}
    dropped = set()
    for (lang, p), a in often.items():
        w = p.split(" ")
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                part = (lang, " ".join(w[i : i + m]))
                if 100 * a >= 100 * f[part]:
                    dropped.add(part)
    rows = defaultdict(list)
    for (lang, p), a in often.items():
        w = p.split(" ")
        if len(w) < 2 or (lang, p) in dropped:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows[lang].append((-score, -a, p.encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in rows.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def run(spark, table, **more):
    return sorted(tuple(r) for r in mined(documents(spark, [(i, *r) for i, r in enumerate(table)]), **more).collect())


def random_table(seed, n=60, words="the of a on b", marks=" . , \n "):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.integers(0, 60)):
            text += str(rng.choice(words.split())) + str(rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]))
        out.append((text, [None, "en", "de"][rng.integers(3)]))
    return out


@pytest.mark.parametrize("seed,least", [(1, 2), (2, 5), (3, 1), (4, 30)])
def test_against_brute_force(spark, seed, least):
    table = random_table(seed)
    assert run(spark, table, least=least) == brute(table, least)


def test_counts_of_all_frequent_phrases(spark):
    table = random_table(5) + [("x y " * 40, "en"), ("p q r s t u v w " * 9, "en"), ("p q r s t u v w " * 9, "de")]
    docs = documents(spark, [(i, *r) for i, r in enumerate(table)])
    found, totals = phrase_counts(docs, least=3)
    f, n = all_counts(table)
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == {p: a for p, a in f.items() if a >= 3}
    assert {r.lang: r.n for r in totals.collect()} == dict(n)


def test_unary_paths_become_one_row_and_give_the_same_counts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 16)
    long = " ".join(f"w{i}" for i in range(100))
    table = [(long, "en")] * 3 + [("a b c d e f " * 8, "en"), (long.replace("w50", "z"), "en"), ("lone words here", "en")]
    texts = spoken(documents(spark, [(i, *r) for i, r in enumerate(table)]))
    _, hashes = frequent_hashes(texts, 1)
    edges, tails = graph(texts, hashes, 5)
    packed = compacted(edges)
    sizes = [r[0] for r in packed.select(F.size(F.split("phrase", " "))).collect()]
    assert packed.count() < edges.count() / 4 and 20 in sizes and max(sizes) == 20
    plain = sorted(map(tuple, counts(edges, tails, 5, 1).collect()))
    assert sorted(map(tuple, counts(packed, tails, 5, 1).collect())) == plain
    assert {(r[0], r[1]): r[3] for r in plain} == dict(all_counts(table)[0])


def test_cycles_and_one_word(spark):
    table = [("a b c d e f g " * 30, "en"), ("x " * 50, "en"), ("x " * 50, "de"), ("a b a b a b a b a b", "fr")]
    for least in (1, 2, 40):
        assert run(spark, table, least=least) == brute(table, least)


def test_cuts_never_change_frequent_counts(spark, monkeypatch):
    """A tiny bit map lets rare steps pass; a large one cuts at them. The results are equal."""
    table = random_table(6, words="the of a on b c d e f g h i j k l m")
    want = brute(table, 4)
    for bits in (16, 28):
        monkeypatch.setattr(collocations, "MAP_BITS", bits)
        assert run(spark, table, least=4) == want


def test_awkward_rows(spark):
    table = [(r[1], r[2] if len(r) > 2 else None) for r in AWKWARD] + [("A\x1cB A\x1cB A\x1cB  ", ""), ("É é É é", "fr")] * 2
    assert run(spark, table, least=2) == brute(table, 2)
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en")], least=1) == []


def test_spaces_and_tabs_inside_phrases(spark):
    table = [("a\tb  c d \t e f\nA b c D e f g  h", "en"), ("é\t\té é ü\tü ü", "en")] * 3
    assert run(spark, table, least=2) == brute(table, 2)


@pytest.mark.parametrize("top", [1, 3, 10])
def test_bounds_leave_the_first_rows(spark, top):
    table = random_table(9, n=150, words="the of a on b c d e f g h i j")
    for lang in ("en", "de", None):
        table += [("the of a on. " * 300, lang), (" ".join(f"q{i} r{i}, q{i} r{i}." for i in range(12)), lang)]
    docs = documents(spark, [(i, *r) for i, r in enumerate(table)])
    found, totals = phrase_counts(docs, least=2)
    kept = collocations.kept_candidates(found)
    assert collocations.promising(kept, found, totals, top).count() < kept.count()
    assert run(spark, table, least=2, top=top) == brute(table, 2, top)


def test_very_many_languages(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LANGUAGES", 2)
    table = [(t, f"lang{i % 9}") for i, (t, _) in enumerate(random_table(10))]
    assert run(spark, table, least=2, top=4) == brute(table, 2, 4)


def test_chunks_and_first_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 200)
    table = random_table(8)
    assert run(spark, table, least=2, top=7) == brute(table, 2, 7)


def test_exact_products_and_order(spark):
    big = 3 * 10**9
    rows = spark.createDataFrame(
        [("en", "b", 5, 7), ("en", "a", 5, 7), ("en", "c", 9, 7), ("en", "d", 1, 8)], "lang string, phrase string, a long, score long")
    assert [r.phrase for r in ranked(rows, 3).orderBy("rank").collect()] == ["d", "c", "a"]
    found = spark.createDataFrame(
        [("en", "x y", 2, big), ("en", "x", 1, big + 1), ("en", "y", 1, big + 7)], "lang string, phrase string, n int, f long")
    totals = spark.createDataFrame([("en", 10**15 + 3)], "lang string, n long")
    (row,) = collocations.scored(found, totals, 10).collect()
    assert row.score == 1000 * big * (10**15 + 3) // ((big + 1) * (big + 7))
