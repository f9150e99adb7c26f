from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from subledger.llm import exact_dedup
from tests.llm.data import AWKWARD, documents


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for key, group in groups.items():
        group.sort()
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(g[-1], group[0][-1], len(group), k == 0, sha) for k, g in enumerate(group)]
    return sorted(out, key=repr)


def test_report_matches_brute_force(spark):
    rows = AWKWARD + [(100 + i, "hot  copy" if i % 3 else "hot copy") for i in range(400)]
    got = exact_dedup.report(documents(spark, rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_heavy_digests_are_found_and_settled_map_side(spark):
    rows = [(i, "hot copy" if i % 3 == 0 else f"own text {i}") for i in range(3000)]
    docs = documents(spark, rows)
    thin = docs.selectExpr("doc_id", "sha2(translate(text, ' ', ''), 256) digest", "length(text) n_chars", "doc_id row_no")
    heavy = exact_dedup.verified_winners(thin, "row_no").collect()
    assert [(r["n"], r["win"]["doc_id"]) for r in heavy] == [(1000, 0)]
    assert sorted(map(tuple, exact_dedup.report(docs).collect()), key=repr) == brute(rows)


def test_distinct_texts_keeps_one_row_and_all_columns(spark):
    rows = AWKWARD + [(100 + i, "hot copy") for i in range(300)]
    docs = documents(spark, rows)
    got = exact_dedup.distinct_texts(docs)
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"] for r in got.collect()), key=repr)
    assert kept == sorted((r[0] for r in brute(rows) if r[3]), key=repr)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.report(docs).count() == 0
    assert exact_dedup.distinct_texts(docs).count() == 0


def test_light_copies_have_a_partial_step_and_no_window(spark, monkeypatch):
    """A digest just below the share: counted by partial sums, then joined."""
    monkeypatch.setattr(exact_dedup, "HEAVY_SHARE", 2.0)
    rows = AWKWARD + [(100 + i, "hot  copy" if i % 3 else "hot copy") for i in range(500)]
    got = exact_dedup.report(documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_main_path_has_no_python(spark):
    plan = exact_dedup.report(documents(spark, AWKWARD).limit(5))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
