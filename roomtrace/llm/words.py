"""Ids of texts through a table of their distinct words, kept by each Python worker."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa


class WordTable:
    """Encodings of distinct words.

    ``encode_new`` gives the ids of new words, in order.  The table holds at most
    about ``most`` words; when it is full, those that were hardly used make room.
    It saves work and never changes a result.
    """

    def __init__(self, encode_new: Callable[[list], list], most: int = 400_000) -> None:
        self.encode_new, self.most = encode_new, most
        self._fill([], np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))

    def _fill(self, words: list, ids: np.ndarray, lengths: np.ndarray, uses: np.ndarray) -> None:
        self.at: dict = dict(zip(words, range(len(words))))
        self.ids = array("i", ids.astype(np.int32).tobytes())
        self.ends = array("q", np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64).tobytes())
        self.uses = uses

    def encode(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after another, and the number of ids of each word."""
        index = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(index < 0).tolist()
        if missing:
            new = {words[i] for i in missing}
            if self.at and len(self.at) + len(new) > self.most:
                self._make_room(self.most // 2)
                return self.encode(words)
            self._add(list(new))
            index[missing] = [self.at[words[i]] for i in missing]
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        uses = np.bincount(index, minlength=len(self.at))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        ends = np.frombuffer(self.ends, np.int64)
        starts = ends[index]
        lengths = ends[index + 1] - starts
        return gather(np.frombuffer(self.ids, np.int32), starts, lengths), lengths

    def _add(self, new: list) -> None:
        end = len(self.ids)
        for word, ids in zip(new, self.encode_new(new)):
            self.at[word] = len(self.at)
            self.ids.extend(ids)
            end += len(ids)
            self.ends.append(end)

    def _make_room(self, most: int) -> None:
        """Keeps the words used more than once, at most ``most`` of them, and halves their counts."""
        keep = np.flatnonzero(self.uses > 1)
        # A second call in a row empties the table.
        keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[:most]]) if len(self.at) > most else keep[:0]
        words, ends = list(self.at), np.array(self.ends, np.int64)
        lengths = np.diff(ends)[keep]
        ids = gather(np.array(self.ids, np.int32), ends[keep], lengths)
        self._fill([words[i] for i in keep.tolist()], ids, lengths, self.uses[keep] // 2)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``values`` from ``starts``, one after another."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch, one at a time; null is empty."""
    for value in batch.column(column):
        yield value.as_py() or ""


def blocks(batch: pa.RecordBatch, weight: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in runs of rows with about ``weight`` characters of text."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts(batch)):
        held.append(text)
        size += len(text)
        if size >= weight:
            yield batch.slice(first, i + 1 - first), held
            first, held, size = i + 1, [], 0
    if held:
        yield batch.slice(first), held
