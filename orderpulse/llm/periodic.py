"""Periodic runs: stretches of words that repeat with a period, found as maximal pairs of a text's suffixes.

Suffixes that share enough words are sorted and form an LCP-interval tree, which is climbed from its leaves. Two
occurrences of an interval's string in different children are followed by different words; if the words before them differ
too, the pair is maximal, and the stretch from the first occurrence to the end of the second is periodic and cannot be
extended. Each interval keeps its occurrences in order, cut into lists of one left word, so that a look at the
neighbours within the longest allowed distance passes over a list at once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import bound, quoted, short_batches, text_of
from orderpulse.llm.words import mix, runs, window_hashes


@dataclass(frozen=True)
class RunSettings:
    """A run of period q has at least `min_length` and `exponent` * q words; `exponent` is 2 or more."""

    min_length: int = 6
    exponent: int = 4

    @property
    def least_match(self) -> int:
        """The fewest words that two occurrences in a run share, over all periods."""
        return min(max(self.min_length - d, (self.exponent - 1) * d) for d in range(1, self.min_length + 1))


def word_ids(documents: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all documents, one after the other, and where each starts. No two documents share a number."""
    parts, used = [], 0
    for words in documents:
        table: defaultdict = defaultdict(count(used).__next__)
        parts.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        used += len(table)
    edges = np.cumsum([0, *map(len, parts)])
    return np.concatenate([*parts, np.zeros(0, np.int64)]), edges


def _starts(*keys: np.ndarray) -> np.ndarray:
    """For each place of arrays in which equal keys are neighbours: where its group starts."""
    edges = runs(*keys)
    return np.repeat(edges[:-1], np.diff(edges))


def _window_keys(ids: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Keys whose order is that of the `width` words from each position on; `ids` goes on beyond the last of them."""
    most = int(ids.max()) + 2
    return [ids[at + k] * most + ids[at + k + 1] if k + 1 < width else ids[at + k] for k in range(0, width, 2)]


def repeated_windows(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next `width` words occur more than once, sorted by these words, and where each one's equals start."""
    hashes = window_hashes(mix(ids.astype(np.uint64)), width)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cells = (hashes & np.uint64((1 << (4 * len(hashes)).bit_length()) - 1)).astype(np.int64)
    some = np.flatnonzero(np.bincount(cells)[cells] > 1)  # few of the others pass
    keys = _window_keys(ids, some, width)
    order = np.lexsort(keys[::-1])
    group = _starts(*[key[order] for key in keys])
    several = np.bincount(group, minlength=len(group))[group] > 1
    return some[order][several], _starts(group[several])


def sorted_suffixes(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that share `width` words or more with another, in an order that keeps common prefixes together; the words
    that each shares with the one before (0 for the first of a group, whose members share `width`); the groups' starts and end.

    Ranks are refined by prefix doubling; only suffixes that are not alone yet are sorted again.
    """
    n = len(ids)
    at, first = repeated_windows(ids, width)
    m = len(at)
    if not m:
        return at, at, np.zeros(1, np.int64)
    place = np.full(n + 1, -1, np.int64)  # of a position among the repeated windows
    place[at] = np.arange(m)

    def ranks(level: np.ndarray, where: np.ndarray) -> np.ndarray:
        p = place[np.minimum(where, n)]
        return np.where(p >= 0, level[p], m + where)  # a window that occurs once has a rank of its own

    words = np.append(ids, np.full(width, -1))
    levels, step, active = [first], width, np.arange(m)
    while len(active):
        rank, where = levels[-1], np.minimum(at[active] + step, n)
        # The words themselves come first: windows that occur once have no rank among the others.
        keys = [rank[active], *_window_keys(words, where, width), np.where(place[where] >= 0, rank[place[where]], -1)]
        order = np.lexsort(keys[::-1])
        active, keys = active[order], [key[order] for key in keys]
        begin = _starts(*keys)
        refined = rank.copy()
        refined[active] = keys[0] + begin - _starts(keys[0])
        levels.append(refined)
        active, step = active[np.bincount(begin, minlength=len(begin))[begin] > 1], 2 * step
    suffixes = np.empty(m, np.int64)
    suffixes[levels[-1]] = at
    a, b = suffixes[:-1], suffixes[1:]
    shared = np.zeros(m - 1, np.int64)
    for number, level in reversed(list(enumerate(levels))):
        shared += np.where(ranks(level, a + shared) == ranks(level, b + shared), width << number, 0)
    going = np.ones(m - 1, bool)
    for _ in range(width - 1):
        going &= words[a + shared] == words[b + shared]
        shared += going
    groups = runs(first)
    lcp = np.append(0, shared)
    lcp[groups[:-1]] = 0
    return suffixes, lcp, groups


class Interval:
    """An LCP interval: occurrences of a string in order, cut into lists of one left word; `heads` holds each list's first."""

    __slots__ = ("depth", "places", "heads")

    def __init__(self, place: int):
        self.depth, self.places, self.heads = 0, [place], [place]

    def others_near(self, place: int, left: list[int], low: int, high: int) -> list[int]:
        """Occurrences `low` to `high` words away whose left word is another; a list of the same left word is one step."""
        places, heads, before, found = self.places, self.heads, left[place], []
        n = bisect_left(places, place) - 1
        while n >= 0 and place - places[n] <= high:
            if left[places[n]] == before:
                n = bisect_left(places, heads[bisect_right(heads, places[n]) - 1])
            elif place - places[n] >= low:
                found.append(places[n])
            n -= 1
        n = bisect_right(places, place)
        while n < len(places) and places[n] - place <= high:
            if left[places[n]] == before:
                head = bisect_right(heads, places[n])
                n = bisect_left(places, heads[head]) if head < len(heads) else len(places)
                continue
            if places[n] - place >= low:
                found.append(places[n])
            n += 1
        return found

    def add(self, place: int, left: list[int]) -> None:
        places, heads = self.places, self.heads
        n = bisect_left(places, place)
        if n == 0 or left[places[n - 1]] != left[place]:
            insort(heads, place)
        if n < len(places):
            head = bisect_left(heads, places[n])
            leads = head < len(heads) and heads[head] == places[n]
            if left[places[n]] != left[place]:
                if not leads:
                    heads.insert(head, places[n])
            elif leads:
                del heads[head]
        places.insert(n, place)


def maximal_pairs(suffixes: list[int], lcp: list[int], left: list[int], settings: RunSettings) -> list[tuple[int, int, int]]:
    """(start, distance, words shared) of the maximal pairs that a run allows, among sorted suffixes.

    `left` has the word before each position. The smaller child of an interval moves into the larger one; each occurrence
    meets the pairs it makes and one list between two of them.
    """
    factor, min_length, found, stack = settings.exponent - 1, settings.min_length, [], []

    def join(depth: int, one: Interval, two: Interval) -> Interval:
        few, many = (one, two) if len(one.places) < len(two.places) else (two, one)
        low, high = max(1, min_length - depth), depth // factor
        if low <= high:
            found.extend((min(place, other), abs(place - other), depth)
                         for place in few.places for other in many.others_near(place, left, low, high))
        for place in few.places:
            many.add(place, left)
        many.depth = depth
        return many

    for place, depth in zip(suffixes, [*lcp[1:], -1], strict=True):
        node = Interval(place)
        while stack and stack[-1].depth > depth:
            top = stack.pop()
            node = join(top.depth, top, node)
        if stack and stack[-1].depth == depth:
            node = join(depth, stack.pop(), node)
        node.depth = depth
        stack.append(node)
    return found


def runs_of(documents: list[list], settings: RunSettings = RunSettings()) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each document's runs, by start, then period."""
    ids, edges = word_ids(documents)
    suffixes, lcp, groups = sorted_suffixes(ids, settings.least_match)
    found: list[list] = [[] for _ in documents]
    if not len(suffixes):
        return found
    # A group without two occurrences near enough for the most words they share holds no such pair.
    numbers = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
    gaps = np.diff(suffixes[np.lexsort((suffixes, numbers))], append=0)
    gaps[groups[1:] - 1] = len(ids)
    near = np.minimum.reduceat(gaps, groups[:-1]) <= np.maximum.reduceat(lcp, groups[:-1]) // (settings.exponent - 1)
    before = np.append(-1, ids)
    before[edges[:-1]] = -1  # no word stands before a document's first
    left = before.tolist() if near.any() else []
    shortest: dict[tuple[int, int], int] = {}  # a multiple of the period makes a pair too, over the same stretch
    for g in np.flatnonzero(near).tolist():
        part = slice(groups[g], groups[g + 1])
        for start, distance, shared in maximal_pairs(suffixes[part].tolist(), lcp[part].tolist(), left, settings):
            stretch = start, distance + shared
            shortest[stretch] = min(distance, shortest.get(stretch, distance))
    rows = sorted((start, period, length) for (start, length), period in shortest.items())
    owners = np.searchsorted(edges, [start for start, _, _ in rows], side="right") - 1
    for owner, (start, period, length) in zip(owners.tolist(), rows, strict=True):
        found[owner].append((start - int(edges[owner]), length, period))
    return found


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: RunSettings = RunSettings()) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, runs (array of start, length, period), collapsed_text.

    Words are runs of anything but ASCII white space, numbered from 0. A run is a stretch of them with smallest period q,
    of `min_length` and `exponent` * q words at least, that neither neighbouring word extends. Runs come by start, then period.
    collapsed_text has the words, joined by one space, that no run contains after its first q words. A null or empty text has
    no words and no runs. Every row stands for itself, so null and repeated ids change nothing. Ids are of any type. Empty
    tables give no rows; other columns are not looked at. A document is worked on whole, in one task.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(quoted(key).alias("doc_id"), text_of(text).alias("text"))

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            documents = list(map(_words, batch["text"]))
            out: list[tuple] = []
            for words, found in zip(documents, runs_of(documents, settings), strict=True):
                stay = np.ones(len(words), bool)
                for start, length, period in found:
                    stay[start + period:start + length] = False
                left = words if stay.all() else [words[n] for n in np.flatnonzero(stay).tolist()]
                out.append((len(words), *([r[n] for r in found] for n in range(3)), b" ".join(left).decode("utf-8", "surrogatepass")))
            made = pd.DataFrame(out, columns=["n_words", "starts", "lengths", "periods", "collapsed_text"])
            made.insert(0, "doc_id", batch["doc_id"])
            yield made

    kind = rows.schema["doc_id"].dataType.simpleString()
    each = "starts array<long>, lengths array<long>, periods array<long>"
    found = rows.mapInPandas(scanned, f"doc_id {kind}, n_words long, {each}, collapsed_text string")
    zipped = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", "n_words", zipped.alias("runs"), "collapsed_text")


def longest_run(found: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period. Null without runs."""
    best = F.array_min(F.transform(found, lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run"))))
    return best["run"]
