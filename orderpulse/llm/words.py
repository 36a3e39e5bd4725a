"""Words and hashed shingles inside Python workers, and groups of rows from a sorted stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+`, in order."""
    found = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly."""
    values = (values ^ values >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ values >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return values ^ values >> np.uint64(31)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each `width` consecutive words; empty if there are fewer."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for n in range(width):
        total = total * _BASE + hashes[n:n + count]
    return mix(total)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of `width` consecutive words; a shorter text with words is one shingle."""
    hashes = word_hashes(text)
    return np.unique(window_hashes(hashes, min(width, max(1, len(hashes)))))


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    new[:1] = True
    return np.append(np.flatnonzero(new), len(new))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that hold whole groups of a stream sorted by `keys`, with the groups' starts and the end.

    Memory: one batch and one group, whose size the caller bounds.
    """
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = tuple(batch[k].iloc[-1] for k in keys)
        open_rows = np.logical_and.reduce([batch[k].to_numpy() == v for k, v in zip(keys, last, strict=True)])
        start = len(batch) - int(open_rows[::-1].argmin()) if not open_rows.all() else 0
        if start == 0 and held and tuple(held[-1][k].iloc[-1] for k in keys) == last:
            held.append(batch)  # the group goes on
            continue
        if done := [x for x in [*held, batch.iloc[:start]] if len(x)]:
            frame = pd.concat(done, ignore_index=True)
            yield frame, runs(*[frame[k].to_numpy() for k in keys])
        held = [batch.iloc[start:]]
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, runs(*[frame[k].to_numpy() for k in keys])


class WordTable:
    """What `describe` says about a word, as rows of a table; words are remembered up to `most` at a time."""

    def __init__(self, describe, width: int, dtype, most: int = 200_000):
        self.describe, self.known = describe, {}
        self.rows = np.zeros((most, width), dtype)

    def _number(self, word) -> int:
        n = self.known.get(word)
        if n is None:
            n = self.known[word] = len(self.known)
            self.rows[n] = self.describe(word)
        return n

    def numbers(self, words: list) -> np.ndarray:
        """Row numbers of the words; they hold until the next call."""
        if len(self.known) + len(words) > len(self.rows):
            self.known.clear()
            if len(words) > len(self.rows):
                self.rows = np.zeros((2 * len(words), self.rows.shape[1]), self.rows.dtype)
        return np.fromiter(map(self._number, words), np.int64, len(words))
