"""A bounded dictionary from pieces of text to their token ids, with vectorised lookup."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np


class Places(dict):
    """Numbers for pieces; an unknown piece gets the next one and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


class PieceIds:
    """Ids of pieces, learned once each by ``learn`` (new pieces -> sizes, flat ids).

    Holds at most ``most`` pieces and those of one call.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        self.learn, self.most = learn, most
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.flat, self.offset, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def places(self, pieces: Iterable[str], count: int) -> np.ndarray:
        """The numbers of ``count`` pieces; valid until the next call."""
        if len(self.place) > self.most:
            self.clear()
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, count)
        if new := self.place.new:
            self.place.new = []
            size, flat = self.learn(new)
            self.offset = np.concatenate([self.offset, len(self.flat) + np.cumsum(size) - size])
            self.flat = np.concatenate([self.flat, flat])
            self.size = np.concatenate([self.size, size.astype(np.int32)])
        return at

    def expand(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces end to end, and where each piece's begin (and the last's end)."""
        return expanded(self.flat, self.offset, self.size, at)

    def ids(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lists of pieces end to end, and where each list's begin (and the last's end)."""
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids, ends = self.expand(self.places(chain.from_iterable(found), int(counts.sum())))
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


def expanded(flat: np.ndarray, offset: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[offset[i] : offset[i] + size[i]] for each i of ``at``, end to end, and the ends from 0 on."""
    n = size[at]
    ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    return flat[np.repeat(offset[at] - ends[:-1], n) + np.arange(ends[-1])], ends
