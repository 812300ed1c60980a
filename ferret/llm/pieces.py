"""Ids of repeated pieces, looked up once per distinct piece.

A task sees the same words over and over. ``PiecePool`` numbers distinct
pieces, asks a resolver for the ids of the new ones in bulk, and builds a
text's ids with array gathers. The pool is emptied when it holds
``MAX_PIECES``, so a task's memory does not grow with its input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np

MAX_PIECES = 200_000
CHUNK_CHARS = 4_000_000


class _Numbers(dict):
    def __init__(self):
        self.new: list = []

    def __missing__(self, piece):
        k = self[piece] = len(self)
        self.new.append(piece)
        return k


class PiecePool:
    def __init__(self, resolve: Callable[[list], list[Sequence[int]]], most: int = MAX_PIECES):
        self.resolve, self.most = resolve, most
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        got = self.resolve(new)
        lens = np.fromiter(map(len, got), np.int64, len(got))
        if isinstance(got[0], np.ndarray):
            flat = np.concatenate(got).astype(np.uint32)
        else:
            flat = np.fromiter((i for x in got for i in x), np.uint32, int(lens.sum()))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.ids = np.concatenate([self.ids, flat])

    def numbered(self, pieces: Iterable, n: int) -> np.ndarray:
        """Numbers of ``n`` pieces; new ones are looked up."""
        if len(self.numbers) > self.most:
            self._clear()
        which = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, n)
        if self.numbers.new:
            self._learn()
        return which

    def encode(self, texts: list[list]) -> list[np.ndarray]:
        """Ids of each text, given as its list of pieces."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return self._built(self.numbered(chain.from_iterable(texts), int(sizes.sum())), sizes)

    def _built(self, which: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        lens = self.lens[which]
        ends = np.concatenate([[0], np.cumsum(lens)])
        pos = np.repeat(self.starts[which] - ends[:-1], lens)
        pos += np.arange(len(pos))
        ids = self.ids[pos]
        cuts = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def chunks(texts: list[str], most: int = CHUNK_CHARS):
    """Runs of texts of about ``most`` characters (a longer text stands alone)."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run
