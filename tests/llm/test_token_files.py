from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subledger.llm import token_files as tf
from tests.llm.data import AWKWARD, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ours(texts, coder=None):
    ids, cuts = (coder or tf.word_ids(PATH)).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]


def plain(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abTHeéÉßçñİ .,.,'\"-|19\n\t\x0b\xa0́ſst中\U0001f600<|endoftext|>")), max_size=60), max_size=4))
def test_ids_are_the_library_s(texts):
    assert ours(texts) == [plain(t) for t in texts]


def test_special_tokens_and_contractions_in_texts():
    texts = ["a\x1cb \x1f .,. ,a a,,. a.b, \x85x\u2028y\x0bz", "a<|endoftext|>b <|startoftext|>", "don't I'll we've the's 's. x's,", "", "  ", "é . ́", "ÀÖØßÿ,é.", "a" * 5000]
    assert ours(texts) == [plain(t) for t in texts]


def test_dictionary_stays_bounded(monkeypatch):
    monkeypatch.setattr(tf, "KEPT", 20)
    coder = tf.WordIds(PATH)
    for i in range(30):
        text = f"word{i} other-{i} third, same"
        assert ours([text], coder) == [plain(text)]
        assert len(coder.known) <= 20 + 6


def huffman_cost(counts):
    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    return cost


def test_code_lengths_are_best_and_limited():
    rng = random.Random(3)
    for n in (2, 3, 7, 50, 300):
        counts = np.array([int(2 ** rng.uniform(0, 20)) for _ in range(n)])
        free = tf.code_lengths(counts, 40)
        assert int((free * counts).sum()) == huffman_cost(counts)
        for most in range(max(1, (n - 1).bit_length()), 16):
            bits = tf.code_lengths(counts, most)
            assert bits.max() <= most and sum(2.0 ** -int(b) for b in bits) <= 1
            assert (bits * counts).sum() >= (free * counts).sum()
    assert tf.code_lengths(np.array([1, 1, 2, 4, 8, 16]), 3).tolist() == [3, 3, 3, 3, 2, 2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=700))
def test_blocks_decode_to_what_was_encoded(values):
    ids = np.array(values)
    some, n = np.unique(ids, return_counts=True)
    code = tf.Code(some, tf.code_lengths(n, 20))
    stream, marks, n_bits = code.encode(ids)
    assert len(stream) == (n_bits + 7) // 8
    assert code.decode(stream, marks, len(ids)).tolist() == values
    middle = marks[len(marks) // 2 :]  # a reader can start at any checkpoint
    assert code.decode(stream, middle, len(ids) - len(marks) // 2 * tf.STEP).tolist() == values[len(marks) // 2 * tf.STEP :]


def brute(rows):
    start, out = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*plain(text or ""), 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_read_back_in_order(spark, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 500)
    rng = random.Random(8)
    rows = [r for r in AWKWARD if r[0] is not None]
    rows = [r for k, r in enumerate(rows) if r not in rows[:k] or r[1] == "plain text here"]
    rows += [(i, " ".join(rng.choice(["un", "deux,", "Trois.", "4", "cinq's"]) for _ in range(rng.randint(0, 90)))) for i in range(1000, 100, -1)]
    code, blocks = tf.written(tf.tokenised(documents(spark, rows), PATH))
    got = tf.documents(code, blocks)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == brute(rows)
    assert blocks.count() > 20


def test_rows_without_id_come_first_and_empty_tables(spark):
    rows = [(3, "x"), (None, "no id"), (-5, None)]
    assert sorted(map(tuple, tf.round_trip(documents(spark, rows), PATH).collect()), key=lambda r: r[1]) == brute(rows)
    assert tf.round_trip(documents(spark, []), PATH).count() == 0
