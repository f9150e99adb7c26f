from __future__ import annotations

import zlib

import pytest

from subledger.llm import language_id as li
from tests.llm.data import AWKWARD, documents

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = got.collect()
    assert len(rows) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    got = li.identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    for i in (1, 2, 3, 10):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[11]["lang_pred"] != "und"
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] else b"") % 3 == 1)
    kept = li.known_language(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 5, 6, 7, 8, 9, 11}


def test_prediction_does_not_depend_on_neighbours():
    texts = ["Le chat", "x", "", "der Hund 12", "İstanbul", "a-b"]
    alone = [g[s[0] :].tolist() for g, s, _ in (li.features([t]) for t in texts)]
    grams, starts, has = li.features(texts)
    cut = [*starts, len(grams)]
    assert [grams[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)] == alone
    assert has.tolist() == [True, True, False, True, True, True]


def test_learns_only_from_rows_not_held_out(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rest = [i for i in range(60) if i not in held]
    rows = [(i, "aaa bbb", "xx") for i in held] + [(i, "aaa bbb", "yy") for i in rest]
    assert {r["lang_pred"] for r in li.identify(documents(spark, rows)).collect()} == {"yy"}


def test_no_labels_and_empty_table(spark):
    assert [tuple(r) for r in li.identify(documents(spark, [(2, "text")])).collect()] == [(2, True, "und", 0.0)]
    assert li.identify(documents(spark, [])).count() == 0


def test_without_labels_only_texts_without_a_letter_are_rejected(spark):
    held = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1)
    rows = [(100, "some text", None), (101, "12 !", None), (102, None, ""), (103, "", None), (104, "été", "")]
    for more in ([], [(held, "more text", "en")]):
        kept = li.known_language(documents(spark, rows + more)).collect()
        assert {r["doc_id"] for r in kept} == {100, 104, *[r[0] for r in more]}


def test_blocks_of_languages_do_not_matter(spark, monkeypatch):
    words = ["aaa bab", "bbb cac", "ccc dad", "ddd eae", "eee faf"]
    rows = [(i, f"{words[i % 5]} {words[i % 7 % 5]}", f"l{i % 5}") for i in range(60)]
    rows += [(100, None, "l1"), (101, "12", "l2"), (102, "zzz", None), (None, "aaa eee", None), (0, rows[0][1], "l0")]
    docs = documents(spark, rows)
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(map(tuple, li.identify(docs).collect()), key=key)
    monkeypatch.setattr(li, "MODEL_MB", 3.2)  # two languages in a block
    monkeypatch.setattr(li, "HELD", 1)
    got = sorted(map(tuple, li.identify(docs).collect()), key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    kept = li.known_language(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r[0] for r in rows if r[0] not in (100, 101)), key=repr)
