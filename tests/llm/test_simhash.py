from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import re
import xxhash
from hypothesis import given
from hypothesis import strategies as st

from subledger.llm import simhash as sh
from tests.llm.data import AWKWARD, documents


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=3):
    """First place of each fingerprint's component."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@given(st.text(max_size=60))
def test_fingerprint(text):
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text_is_cut_without_effect(monkeypatch):
    text = " ".join(str(i * i % 91) for i in range(400))
    monkeypatch.setattr(sh, "WORDS", 7)
    assert sh.fingerprint(text) == plain_fingerprint(text)


def test_every_pair_within_the_radius_meets_in_some_table():
    first, second = sh.tables()
    assert len(first) == 15 and min(m.bit_count() for m in first) >= 32
    assert max(64 - m.bit_count() for m in second) <= 16
    rng = random.Random(4)
    for _ in range(5000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        met = [i for i, m in enumerate(first) if not m & diff]
        assert met
        for i in met:  # and again in some table of the second level
            assert any(not m & diff for m in second[i * 15 : i * 15 + 15])


def near_fps(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 10)]
    return sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(10)})


@pytest.mark.parametrize("limit", [sh.BUCKET, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, limit):
    monkeypatch.setattr(sh, "BUCKET", limit)  # 3: most buckets go through the second level
    fps = near_fps(random.Random(limit), 300)
    classes = spark.createDataFrame([(sh.signed(f),) for f in fps], "fp long")
    links = sh.near_links(classes)
    found = {r["node"]: r["root"] for r in sh.components(links).collect()}
    ours, theirs = {}, {}
    for f, r in zip(fps, plain_components(fps), strict=True):
        ours.setdefault(found.get(sh.signed(f), sh.signed(f)), set()).add(f)
        theirs.setdefault(r, set()).add(f)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_spanning_of_a_large_bucket():
    rng = random.Random(1)
    fps = near_fps(rng, 600)
    assert sh.spanning(np.array(fps, np.uint64), 3).tolist() == plain_components(fps)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    got = sh.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(i, 0) for i in range(1, 61)} | {(j, 100) for j in range(101, 160)}


def test_awkward_rows_match_brute_force(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = AWKWARD + [(50 + i, text.replace("seven", f"w{i}")) for i in range(30)]
    rows += [(200 + i, text) for i in range(200)]
    docs = documents(spark, rows)
    got = sh.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t or "") for _, t, *_ in rows]
    root = plain_components(fps)
    ids = {}
    for (doc_id, *_), r in zip(rows, root, strict=True):
        ids.setdefault(r, []).append(doc_id)
    want = [(d[0], f, min((x for x in ids[r] if x is not None), default=None)) for d, f, r in zip(rows, fps, root, strict=True)]
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)
    kept = sh.one_per_group(docs)
    assert kept.columns == docs.columns
    left = sorted((r["doc_id"] for r in kept.select("doc_id").distinct().collect()), key=repr)
    assert left == sorted({min((x for x in g if x is not None), default=None) for g in ids.values()}, key=repr)


def test_empty_table(spark):
    assert sh.near_duplicates(documents(spark, [])).count() == 0
    assert sh.one_per_group(documents(spark, [])).count() == 0
