"""Hard negatives against a brute force over all pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subledger.llm import hard_negatives
from subledger.llm.hard_negatives import Block, inside, mine, nearest, packed

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_no long, block string, score int"


def brute(table, k=5, low=80, high=100):
    """table: (vec_id, vector, label, is_anchor); every row is its own row."""
    used = [(i, [int(np.floor(256 * float(x))) for x in v], lab, a) for i, v, lab, a in table
            if v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v)]
    last = float("inf")
    out = []
    for n, (i, v, lab, is_anchor) in enumerate(used):
        if not is_anchor:
            continue
        found = [(-sum(x * y for x, y in zip(v, w, strict=False)), last if j is None else j, j, o)
                 for m, (j, w, o, _) in enumerate(used) if m != n]
        found.sort(key=lambda r: r[:2])
        for s, _, p, _ in [r for r in found if r[3] == lab][:k]:
            window = [r for r in found if r[3] != lab and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(i, p, at + 1, r[2], -s, -r[0]) for at, r in enumerate(window)]
    return sorted(out, key=repr)


def frame(spark, table):
    return spark.createDataFrame([(i, v, lab, 1, "x", 2) for i, v, lab, _ in table], SCHEMA)


def anchors(column="vec_id"):
    return F.col(column) % 10 == 0


def run(spark, table, **more):
    got = mine(frame(spark, table), "vec_id", "embedding", "label", anchors(), **more)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def some(seed, n, dims=6, values=5, labels=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) / 4 for x in rng.integers(-values, values + 1, dims)], int(rng.integers(labels)), i % 10 == 0)
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_many_ties(spark, monkeypatch, seed):
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    table = some(seed, 300, values=2)
    assert run(spark, table) == brute(table)


def test_nulls_repeats_and_unequal_lengths(spark):
    table = some(3, 120)
    nan, inf = float("nan"), float("inf")
    table += [(10, None, 1, True), (20, [1.0, None], 1, True), (11, [nan, 1.0], 2, False), (30, [inf] * 6, 0, True),
              (12, [1.0], None, False), (None, [0.5] * 6, 1, False), (None, [0.5] * 6, 2, False), (40, [], 1, True),
              (13, [1.0, 2.0], 1, False), (50, [0.0] * 6, 2, True), (60, [3e6] * 6, 0, True), (61, [-3e6] * 6, 1, False)]
    table += [table[0]] * 7 + [table[5]] * 3 + [(10, table[10][1], 2, True)]
    assert run(spark, table) == brute(table)


def test_no_rows_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1, False), (2, [1.0], 2, False)]) == []
    assert run(spark, [(10, [1.0], 1, True)]) == []


def test_other_limits(spark):
    table = some(4, 200)
    for k, low, high in ((1, 50, 90), (9, 80, 120)):
        assert run(spark, table, positives=k, negatives=k, low=low, high=high) == brute(table, k, low, high)


def block_of(vectors, labels):
    batch = pa.RecordBatch.from_pydict({
        "vec_id": pa.array(range(len(vectors)), pa.int64()), "label": pa.array(labels, pa.int64()),
        "parts": pa.array([list(map(int, v)) for v in vectors], pa.list_(pa.int64())),
    })

    class Nowhere:
        partitionId = staticmethod(lambda: 0)

    before, hard_negatives.TaskContext.get = hard_negatives.TaskContext.get, staticmethod(lambda: Nowhere)
    try:
        (row,) = packed(iter([batch]))
    finally:
        hard_negatives.TaskContext.get = before
    return Block(row.to_pylist()[0])


def test_reading_stops_before_the_end_and_only_strictly_below():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-50, 51, (4000, 3))
    block, anchor = block_of(vectors, [0] * 4000), np.array([40, -9, 0])
    rounds = list(block.read(anchor))
    assert sum(len(r[0]) for r in rounds) == 4000
    # the threshold bounds all that is still unseen
    later = [np.concatenate([r[1] for r in rounds[i + 1 :]] or [np.zeros(0)]) for i in range(len(rounds))]
    assert all(not len(x) or x.max() <= r[2] for r, x in zip(rounds, later, strict=True))
    reads = []
    block.read = lambda a, inner=block.read: (reads.append(r) or r for r in inner(a))
    places, scores = nearest(block, anchor, 0, 6)
    exact = vectors @ anchor
    assert list(places) == list(np.lexsort((np.arange(4000), -exact))[:6]) and len(reads) < len(rounds)
    # equal vectors: the threshold equals the k-th score, so ties have to be read to the end
    flat = block_of([[7, 7]] * 1000, [0] * 999 + [1])
    assert list(nearest(flat, np.array([1, 1]), 0, 3)[0]) == [0, 1, 2]
    assert [list(p) for p, _ in inside(flat, np.array([1, 1]), 0, [(14, 14), (0, 13)], 5)] == [[999], []]
