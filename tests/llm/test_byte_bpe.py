from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from subledger.llm import byte_bpe
from tests.llm.data import AWKWARD, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


CODERS = [byte_bpe.BytePairs(PATH, PATTERN, b, c) for b, c in ((1, 1), (3, 5), (48, 1 << 16))]
TEXTS = st.text(alphabet=st.sampled_from(list("aeinrst'lvdmL  \n\t\r.,!-19 é́中\U0001f600")), max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_any_tree_gives_the_library_s_ids(text):
    want = tiktoken_ids(text)
    for coder in CODERS:
        ids, cuts = coder.encode([text, text])
        assert ids.tolist() == want + want and cuts.tolist() == [0, len(want), 2 * len(want)]
        ids = ids[: len(want)]
        assert coder.decode(ids) == text.encode()


def tiktoken_ids(text, made={}):  # noqa: B006
    if not made:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
        made[0] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made[0].encode_ordinary(text)


def test_long_pretokens_and_runs(library):
    rng = random.Random(2)
    texts = ["a" * 3000, "=" * 1000, " " * 777 + "x", "\n" * 500, "ab" * 900]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(3000)) for _ in range(5)]
    texts += ["".join(rng.choice("éü中a1") for _ in range(1500)) for _ in range(5)]
    for coder in CODERS[1:]:
        for text in texts:
            assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("kind", ["=-", "-", "\n", "a", "ab", "random", "hex", "é中"])
def test_a_pretoken_of_a_megabyte(library, kind):
    """Seconds, not hours, whatever it is made of; the ids are the library's."""
    import time

    rng, n = random.Random(4), 1 << 20
    made = {"random": "".join(rng.choices("etaoinshrdlu", k=n)), "hex": "x" + "".join(rng.choices("abcdef", k=n - 1))}
    text = made.get(kind) or kind * (n // len(kind.encode()))
    coder = byte_bpe.BytePairs(PATH, PATTERN)
    begin = time.process_time()
    ids = coder.encode([text])[0].tolist()
    assert time.process_time() - begin < 30
    # the library itself needs minutes for one such pre-token of few different letters: a part stands for it
    small = text[: 20_000 if kind in ("random", "hex") else 100_000]
    assert coder.encode([small])[0].tolist() == library.encode_ordinary(small)
    assert coder.decode(np.array(ids)).decode() == text
    assert all(coder.settled(a, b) for a, b in zip(ids, ids[1:]))


def test_awkward_rows(spark, library):
    docs = documents(spark, AWKWARD)
    rows = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in AWKWARD), key=repr)
    assert sorted(((r["doc_id"], r["ids"], bytes(r["bytes"])) for r in rows), key=repr) == want
    assert byte_bpe.round_trip(documents(spark, []), PATH, PATTERN).count() == 0
    apart = byte_bpe.decoded(byte_bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(((r["doc_id"], r["ids"], bytes(r["bytes"])) for r in apart), key=repr) == want


def test_chunks_do_not_matter(spark, monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CHUNK", 10)
    docs = documents(spark, AWKWARD[:8] + AWKWARD[-2:])
    rows = byte_bpe.round_trip(docs, PATH, PATTERN).collect()
    assert len(rows) == 10 and all(bytes(r["bytes"]) == b"".join(byte_bpe.coder(PATH, PATTERN).tokens[i] for i in r["ids"]) for r in rows)


def test_dictionary_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT", 10)
    coder = byte_bpe.BytePairs(PATH, PATTERN)
    for i in range(50):
        coder.encode([f"word{i} other{i} third{i}"])
        assert len(coder.pieces.place) <= 10 + 6
    assert coder.decode(np.zeros(0, np.int32)) == b""
