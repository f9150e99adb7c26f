"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text is encoded by halving it down to leaves and joining the halves'
results upwards, on two levels:

* Merges. ``merge_tree`` cuts the bytes of one pre-token into leaves and joins neighbours
  up the tree. A token sequence is the encoding of its bytes exactly if every two
  adjacent tokens are (each pair encodes to itself). So ``merge_join`` encodes a window
  anew that grows from the seam to the right: each time the longest token that is such a pair with the one
  before it, with a step back (at last into the left half) where no token fits. It is
  over as soon as the window ends where a token of the right half begins and both are such a pair: all
  outside is then final. The work follows the window's length, not that of the halves.
* Pre-tokens. ``split_tree`` halves a long text. In the left half a match is
  settled if it ends before the half does and starts at least three characters
  before that end: the pattern looks at most one character past a match and
  three past a start. The rest of the left half and a doubling run of the right
  half are matched again until a match ends where one of the right half's
  matches ends; the pattern looks at nothing before a match, so all later
  matches agree.

Joining is associative, so any tree gives the same ids. Leaves are merged many
at a time, by arrays over all of them. A pre-token of any length thus takes time nearly in
proportion to it. Decoding concatenates the tokens' bytes
up a tree of the same kind. Ids of pre-tokens are kept in a bounded dictionary
per task.

Null and empty texts have no ids; an empty table gives no rows; repeated rows give equal rows. One
text is the largest thing a task holds. Lone surrogates cannot occur in Spark strings.
Ids that the vocabulary lacks make ``decode`` fail with a KeyError. Extra columns are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm.common import chunks, ship, text_or_empty
from subledger.llm.piece_ids import PieceIds

#: Leaves: bytes of a pre-token merged directly, characters of a text matched directly.
LEAF_BYTES = 48
LEAF_CHARS = 1 << 16
#: Pre-tokens whose ids a task keeps.
KEPT = 400_000
#: The pattern's reach past a match's start (its contractions have three characters).
REACH = 3
#: Bytes of text handled at once in a task.
CHUNK = 1 << 18
NONE = np.iinfo(np.int64).max


class BytePairs:
    """Encoder and decoder for a rank file and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str, leaf_bytes: int = LEAF_BYTES, leaf_chars: int = LEAF_CHARS):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.leaf_bytes, self.leaf_chars = leaf_bytes, leaf_chars
        self.pieces = PieceIds(self.learn, KEPT)
        self.settled = lru_cache(1 << 16)(self._settled)
        # every pair of tokens that merges, as left << 32 | right, in order
        rank = self.ranks.get
        made = [
            (a << 32 | b, i)
            for t, i in self.ranks.items()
            for k in range(1, len(t))
            if (a := rank(t[:k])) is not None and (b := rank(t[k:])) is not None
        ]
        pairs = np.array(made, np.int64).reshape(-1, 2)
        by = pairs[:, 0].argsort()
        self.pairs, self.merged = np.append(pairs[by, 0], NONE), np.append(pairs[by, 1], NONE)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)])
        # lengths of the tokens of four bytes or more by their first four, longest first
        lengths: dict[bytes, set[int]] = {}
        for t in self.ranks:
            if len(t) > 3:
                lengths.setdefault(t[:4], set()).add(len(t))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}
        self.longest = max(map(len, self.ranks))
        self.shorter = lru_cache(1 << 16)(self._shorter)

    # --- merges within one pre-token

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, NONE if it does not."""
        want = left << 32 | right
        at = np.searchsorted(self.pairs, want)
        return np.where(self.pairs[at] == want, self.merged[at], NONE)

    def merge_leaves(self, leaves: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, flat ids): in every leaf, the leftmost pair of the lowest rank again and again."""
        n_bytes = np.fromiter(map(len, leaves), np.int64, len(leaves))
        token = self.single[np.frombuffer(b"".join(leaves), np.uint8)]
        leaf = np.repeat(np.arange(len(leaves)), n_bytes)
        ends, done = [], []  # leaves without another merge leave the arrays
        pair = np.full(len(token), NONE)  # of each token and the next one of its leaf
        near = np.flatnonzero(leaf[1:] == leaf[:-1])
        pair[near] = self.rank(token[near], token[near + 1])
        while len(token):
            first = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
            low = np.repeat(np.minimum.reduceat(pair, first), np.diff(np.append(first, len(leaf))))
            over = low == NONE
            if over.any():
                ends.append(leaf[over])
                done.append(token[over])
                token, leaf, pair, low = token[~over], leaf[~over], pair[~over], low[~over]
                if not len(token):
                    break
            hit = np.flatnonzero(pair == low)
            hit = hit[np.r_[True, leaf[hit[1:]] != leaf[hit[:-1]]]]  # leftmost in its leaf
            token[hit] = pair[hit]
            keep = np.ones(len(token), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            token, leaf, pair, hit = token[keep], leaf[keep], pair[keep], moved[hit]
            pair[hit] = NONE
            for at in (hit[(hit + 1 < len(leaf))], hit[hit > 0] - 1):
                at = at[leaf[at] == leaf[at + 1]]
                pair[at] = self.rank(token[at], token[at + 1])
        if not done:
            return n_bytes, np.zeros(0, np.int64)
        leaf, token = np.concatenate(ends), np.concatenate(done)
        return np.bincount(leaf, minlength=len(leaves)), token[leaf.argsort(kind="stable")]

    def merge_leaf(self, data: bytes) -> list[int]:
        return self.merge_leaves([data])[1].tolist()

    def learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and flat ids of pre-tokens; those over a leaf go through the tree."""
        raw = [x.encode("utf-8") for x in new]
        short = np.fromiter((len(x) <= self.leaf_bytes for x in raw), bool, len(raw))
        size = np.zeros(len(raw), np.int64)
        size[short], flat = self.merge_leaves([x for x, s in zip(raw, short, strict=True) if s])
        if short.all():
            return size, flat.astype(np.int32)
        long = [self.merge_tree(x) for x, s in zip(raw, short, strict=True) if not s]
        size[~short] = list(map(len, long))
        out = np.empty(int(size.sum()), np.int32)
        of_short = np.repeat(short, size)
        out[of_short] = flat
        out[~of_short] = np.fromiter(chain.from_iterable(long), np.int32)
        return size, out

    def _settled(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens encode to them."""
        parts = [bytes([x]) for x in self.tokens[a] + self.tokens[b]]
        rank, least = self.ranks.get, None
        while len(parts) > 2:
            found = [rank(x + y, NONE) for x, y in zip(parts, parts[1:], strict=False)]
            least = min(found)
            if least == NONE:
                return False
            i = found.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts == [self.tokens[a], self.tokens[b]] and rank(parts[0] + parts[1]) is None

    def _shorter(self, token: int) -> int | None:
        """The next longest token that the token begins with."""
        t = self.tokens[token]
        return next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), None)

    def match(self, text: bytes, at: int) -> int:
        """The longest token at a place of a text."""
        for n in (*self.lengths.get(text[at : at + 4], ()), 3, 2, 1):
            token = self.ranks.get(text[at : at + n])
            if token is not None:
                return token
        raise KeyError(text[at : at + 1])

    def merge_join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        size = lambda t: len(self.tokens[t])
        keep, made = len(left), []  # tokens of the left half that stay, and the window's
        start, text = 0, b""  # the bytes read so far begin here, places counted from the seam
        begins = {0: 0}  # where each token of the right half begins, as far as it was read
        taken, stop = 0, 0
        at, dead = 0, set()  # dead: no encoding has a token that ends there

        def read_on() -> None:
            nonlocal taken, stop, text
            while taken < len(right) and stop < at + self.longest:  # twice as far each time
                more = right[taken : max(16, 2 * taken)]
                text += b"".join(map(self.tokens.__getitem__, more))
                for i, t in enumerate(more, taken + 1):
                    stop += size(t)
                    begins[stop] = i
                taken += len(more)

        read_on()
        token = self.match(text, at - start)
        while True:
            before = made[-1] if made else left[keep - 1] if keep else None
            while token is not None and (at + size(token) in dead or before is not None and not self.settled(before, token)):
                token = self.shorter(token)
            if token is None:  # none fits here: the one before has to be shorter
                dead.add(at)
                if made:
                    last = made.pop()
                    at -= size(last)
                    token = self.shorter(last)
                else:  # chosen without a look at the right half: any other may fit
                    keep -= 1
                    text, start = self.tokens[left[keep]] + text, start - size(left[keep])
                    at = start
                    token = self.match(text, 0)
                continue
            made.append(token)
            at += size(token)
            i = begins.get(at)
            if i is not None and (i == len(right) or self.settled(token, right[i])):
                return left[:keep] + made + right[i:]
            read_on()
            token = self.match(text, at - start)

    def merge_tree(self, data: bytes) -> list[int]:
        sizes, flat = self.merge_leaves([data[i : i + self.leaf_bytes] for i in range(0, len(data), self.leaf_bytes)])
        cuts, ids = [0, *np.cumsum(sizes).tolist()], flat.tolist()
        level = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        while len(level) > 1:
            joined = [self.merge_join(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = joined + level[len(level) - len(level) % 2 :]
        return level[0] if level else []

    # --- pre-tokens within one text

    def split_join(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left + right
        n, size = 0, 0  # unsettled matches of the left half and their characters
        while n < len(left) and (n == 0 or size < REACH):
            n += 1
            size += len(left[-n])
        head, tail = left[: len(left) - n], "".join(left[len(left) - n :])
        m = 1
        while True:
            text = tail + "".join(right[:m])
            ends, at = set(), len(tail)
            for piece in right[:m]:
                at += len(piece)
                ends.add(at)
            seam, at = [], 0
            for piece in self.find(text):
                at += len(piece)
                # settled in the window, and aligned with a match of the right half
                if m < len(right) and (at == len(text) or at - len(piece) + REACH > len(text)):
                    break
                seam.append(piece)
                if at in ends and at > len(tail):
                    rest = sum(1 for e in ends if e <= at)
                    return head + seam + right[rest:]
            if m >= len(right):
                return head + self.find(text)
            m *= 2

    def split_tree(self, text: str) -> list[str]:
        if len(text) <= self.leaf_chars:
            return self.find(text)
        half = len(text) // 2
        return self.split_join(self.split_tree(text[:half]), self.split_tree(text[half:]))

    # --- whole texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts, and where each text's begin (and the last's end)."""
        return self.pieces.ids([self.split_tree(t) for t in texts])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf_chars:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(2)
def coder(path: str, pattern: str) -> BytePairs:
    """One coder per Python worker."""
    return BytePairs(path, pattern)


def rows_by_chunk(batches: Iterator[pa.RecordBatch], path: str, pattern: str, decode: bool) -> Iterator[pa.RecordBatch]:
    """The ids (and what they decode to) of each chunk of texts; only one chunk is held."""
    own = coder(path, pattern)
    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            ids, cuts = own.encode(part.column("text").to_pylist())
            columns = {
                "doc_id": part.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32())),
            }
            if decode:
                back = [own.decode(ids[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
                columns["bytes"] = pa.array(back, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def encoded(docs: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """doc_id and ids of every row of ``docs``, and with ``decode`` the bytes the ids stand for."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", bytes binary" * decode
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        lambda batches: rows_by_chunk(batches, path, pattern, decode), schema
    )


def decoded(rows: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "bytes") -> DataFrame:
    """``rows`` with the bytes that its ids stand for."""
    ship(rows.sparkSession)

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(coder(path, pattern).decode)

    return rows.withColumn(name, decode(ids))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the decoded bytes of every row of ``docs``, in one pass through Python."""
    return encoded(docs, path, pattern, decode=True)
