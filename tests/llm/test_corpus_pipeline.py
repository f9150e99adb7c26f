"""The pipeline against its stages by brute force."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
from tests.llm import test_byte_bpe, test_decontaminate, test_exact_dedup, test_simhash
from tests.llm.data import AWKWARD, documents

SF = "/root/testdata/sf0.001"


def by_hand(rows, items):
    """The rows of documents that each stage leaves, then the last stage's result."""
    stages = [[r for r in rows if any(c.isalpha() for c in r[1] or "")]]
    left, seen = [], set()
    kept = [x[0] for x in test_exact_dedup.brute(stages[-1]) if x[3]]
    for r in sorted(stages[-1], key=lambda r: -len(r[1])):
        if r[0] in kept and (key := "".join(r[1].split())) not in seen:
            seen.add(key)
            left.append(r)
    stages.append(left)
    root = test_simhash.plain_components([test_simhash.plain_fingerprint(t) for _, t, *_ in left])
    first = {}
    for r, c in zip(left, root, strict=True):
        first[c] = min(first.get(c, r), r, key=lambda r: (r[0] is None, r[0] or 0))
    stages.append(list(first.values()))
    bad = {x[0] for x in test_decontaminate.brute(stages[-1], items) if x[4]}
    stages.append([r for r in stages[-1] if r[0] not in bad])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for i, text, *_ in stages[-1]:
        ids = test_byte_bpe.tiktoken_ids(text)
        out.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode())))
    return stages, sorted(out, key=repr)


def run_stages(spark, docs, sf_dir, rows, items):
    stages, want = by_hand(rows, items)
    for (name, stage), left in zip(corpus_pipeline.STAGES, stages, strict=False):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.stored(out, "test")
        assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == sorted((r[0] for r in left), key=repr), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert sorted(map(tuple, last.collect()), key=repr) == want


def test_given_tables(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(*c).collect()]
    rows, items = read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=repr)
    assert got == by_hand(rows, items)[1]


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(1)
    items = [(1, "some benchmark passage of more than thirteen words that stands in one of the documents here")]
    long = " ".join(rng.choice(["red", "green", "blue", "over", "under", "seven"]) for _ in range(400))
    rows = [r for r in AWKWARD if r[0] is not None and r[0] not in (7, 9)]
    rows += [(40 + i, f"{long} {i}") for i in range(30)] + [(90 + i, "a copy  of this" if i else "a copy of this") for i in range(50)]
    rows += [(200, "Before it: " + items[0][1].upper() + "!"), (201, items[0][1] + " " + long[::-1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run_stages(spark, documents(spark, rows), str(tmp_path), rows, items)
    run_stages(spark, documents(spark, []), str(tmp_path), [], items)


def test_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None
