"""Quality rules: measures against plain Python, the EM against planted accuracies, verdicts against labels."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from subledger.llm import quality_rules
from subledger.llm.quality_rules import fitted, judged, measure
from tests.llm.data import AWKWARD, documents

SF = "/root/testdata/sf0.01"
_words = np.random.default_rng(11)
PROSE = " ".join("".join(_words.choice(list("aeinorstl"), 5)) + ("." if i % 9 == 8 else "") for i in range(200))


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(inside))


@pytest.mark.parametrize("text", [
    None, "", " \t\n\x0b\r", "a b", "a b c a b c", "x\x1cy   z w", "été 中文 \U0001f600 # $ |", "a\na\n\na\r\n a\na",
    "the the the the", "a b c d a b x b c d", "one\ntwo " * 300, "|" * 50, "q " * 2000 + "end",
])
def test_measures(text):
    assert measure((text or "").encode(), len(text or ""))[:5] == plain(text)


def test_measures_of_random_texts():
    rng = np.random.default_rng(7)
    for _ in range(300):
        text = "".join(rng.choice(list("ab c\n\té#|"), rng.integers(0, 60)))
        assert measure(text.encode(), len(text))[:5] == plain(text)
    codes = rng.integers(0, 1 << 20, 3000)  # many distinct words take the other way to number windows
    words = [str(c) for c in np.concatenate([codes, codes[:40]])]
    monkey = np.array([{w: i for i, w in enumerate(dict.fromkeys(words))}[w] for w in words])
    assert quality_rules.repeated_words(monkey, 1 << 20) == quality_rules.repeated_words(monkey, len(set(words))) >= 80


def test_em_finds_planted_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(40_000) < 0.8
    rates = [(0.9, 0.05), (0.8, 0.02), (0.0, 0.01), (0.7, 0.1)]  # says bad: of bad, of good documents
    votes = np.stack([np.where(rng.random(len(good)) < np.where(good, g, b), -1, np.where(rng.random(len(good)) < 0.5, 1, 0))
                      for b, g in rates], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fitted(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.03
    for j, (b, g) in enumerate(rates):
        assert abs(model.down[j] - min(np.log(max(g, 0.002) / max(b, 0.002)), 0)) < 0.5
    verdict = model.log_odds(votes) >= 0
    assert (verdict == good).mean() > 0.95
    assert (model.up >= 0).all() and (model.down <= 0).all()


def test_a_document_that_no_rule_votes_against_stays(spark):
    junk = [(100 + i, " ".join(f"{w}###" for w in PROSE.split())) for i in range(30)]
    clean = [(i, PROSE + f" number{i}") for i in range(3)]
    kept = {r.doc_id: r.kept for r in judged(documents(spark, junk + clean)).collect()}
    assert all(kept[i] for i, _ in clean)
    empty = fitted(np.zeros((0, 10), int), np.zeros(0))
    assert empty.log_odds(np.zeros((1, 10), int))[0] == 0


def test_awkward_rows(spark):
    table = documents(spark, AWKWARD + [(20, PROSE), (20, PROSE), (None, PROSE)])
    got = sorted((tuple(r) for r in judged(table).select("doc_id", *quality_rules.MEASURES[:5], "base_failed", "kept").collect()), key=repr)
    want = []
    for row in AWKWARD + [(20, PROSE), (20, PROSE), (None, PROSE)]:
        m = plain(row[1])
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want.append((row[0], *m, failed, not failed))
    assert got == sorted(want, key=repr)
    assert judged(documents(spark, [])).count() == 0


def test_chunks_do_not_matter(spark, monkeypatch):
    table = documents(spark, AWKWARD + [(30 + i, PROSE * (i % 3)) for i in range(20)])
    whole = sorted(map(repr, judged(table).collect()))
    monkeypatch.setattr(quality_rules, "CHUNK", 100)
    assert sorted(map(repr, judged(table).collect())) == whole


def test_given_documents(spark):
    """Clean documents stay unless a hard rule drops them; those labelled bad go."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = judged(docs).join(labels, "doc_id").select("quality", "base_failed", "kept").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(rows) == 399 and np.mean(clean) > 0.99 and np.mean(bad) < 0.02
