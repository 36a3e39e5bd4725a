"""Spelling variants: words one edit apart, found by scans of sorted vocabularies with a banded edit matrix.

A scan compares a word with those that follow it in order. The matrix has a row for each letter of the compared word and
three cells in a row, as more would mean a second edit. Rows of the prefix that two adjacent words share (their LCP) are
kept; where a row's least cell exceeds one edit, all words with that prefix are skipped. All words of a chunk scan at once:
one matrix row per step and word, in numpy.

An edit in the second half leaves the first half to lead the scan, and a scan of the reversed words finds the others.
The sorted vocabulary is cut into chunks of bounded size; a word goes on into later chunks as long as they share its half.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, lower_ascii, quoted, small, text_of
from orderpulse.llm.words import runs

#: What words are made of, once A-Z are in lower case.
LETTERS = r"[a-z\u00C0-\u00FF]+"


@dataclass(frozen=True)
class SpellingSettings:
    """Code points and occurrences a word needs; how many times as often a word's form must occur; words in a chunk.

    A task holds a chunk and scans `lanes` words at once. Neither number changes a result.
    """

    min_chars: int = 5
    min_count: int = 3
    ratio: int = 2
    chunk_words: int = 10_000
    lanes: int = 20_000


def text_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, word): each longest run of letters in a text, A-Z in lower case. A null text has none."""
    found = F.regexp_extract_all(lower_ascii(text_of(text)), F.lit(LETTERS), F.lit(0))
    return docs.select(quoted(key).alias("id"), F.explode(found).alias("word"))


def vocabulary(words: DataFrame, settings: SpellingSettings = SpellingSettings()) -> DataFrame:
    """(word, n) of the words, one occurrence a row, that are long and frequent enough. Counted on the map side first."""
    return (
        words.where(F.length("word") >= settings.min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= settings.min_count))


# Chunks of a sorted vocabulary

def sorted_chunks(vocab: DataFrame, settings: SpellingSettings, words: int) -> DataFrame:
    """(chunk, word, n): `vocab` in ranges of about `chunk_words` words, kept, so that ranges stay as they are."""
    parts = max(1, -(-words // settings.chunk_words))
    return kept(vocab.repartitionByRange(parts, "word").select(F.spark_partition_id().alias("chunk"), "word", "n"))


def _needed(length, reverse: bool):
    """Leading code points that a word shares with any near one that its scan must find.

    The shorter of two near words has `length` code points or one less. Half of it is the same on one side of the edit.
    """
    return length // 2 if reverse else (length - 1) // 2


def travellers(chunks: DataFrame, bounds: list[tuple[int, str, str]], reverse: bool) -> DataFrame:
    """(chunk, word, n): words whose scan goes on into later chunks, by these chunks. `bounds` are sorted."""
    firsts = [first for _, first, _ in bounds]

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for chunk, word, n in zip(batch["chunk"].tolist(), batch["word"], batch["n"].tolist(), strict=True):
                half = word[:_needed(len(word), reverse)]
                later = bisect_right(firsts, word)
                while later < len(bounds) and bounds[later][1].startswith(half):
                    if bounds[later][0] != chunk and not _exceeds(word, bounds[later][1], bounds[later][2]):
                        out.append((bounds[later][0], word, n))
                    later += 1
            yield pd.DataFrame(out, columns=["chunk", "word", "n"])

    return chunks.mapInPandas(routed, "chunk int, word string, n long")


def _next_row(row: tuple, letter: str, word: str, depth: int) -> tuple:
    """Row `depth` of the matrix: edits between `depth` letters and depth - 1, depth and depth + 1 letters of `word`."""
    a, b, c = row
    left = min(a + (word[depth - 2:depth - 1] != letter), b + 1)
    middle = min(b + (word[depth - 1:depth] != letter), c + 1, left + 1)
    return left, middle, min(c + (word[depth:depth + 1] != letter), middle + 1)


def _exceeds(word: str, first: str, last: str) -> bool:
    """Whether the prefix that all words from `first` to `last` share is more than one edit from any prefix of `word`."""
    row = (2, 0, 1)
    for depth, (letter, other) in enumerate(zip(first, last), 1):
        if letter != other:
            return False
        row = _next_row(row, letter, word, depth)
        if min(row) > 1:
            return True
    return False


# Scans

class Packed:
    """Words as code points, one after the other."""

    def __init__(self, words: list[str]):
        joined = "".join(words).encode("utf-32-le", "surrogatepass")
        self.points = np.append(np.frombuffer(joined, "<u4"), np.zeros(1, np.uint32)).astype(np.int64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def at(self, words: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The code points at a place of words, -1 outside."""
        inside = (place >= 0) & (place < self.lengths[words])
        return np.where(inside, self.points[np.where(inside, self.starts[words] + place, 0)], -1)


def shared_prefix(one: Packed, a: np.ndarray, two: Packed, b: np.ndarray) -> np.ndarray:
    """How many code points each word `a` of `one` and `b` of `two` have in common at the start."""
    found, going, depth = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(going):
        letters = one.at(a[going], np.full(len(going), depth))
        going = going[(letters >= 0) & (letters == two.at(b[going], np.full(len(going), depth)))]
        depth += 1
        found[going] = depth
    return found


class SortedList:
    """A sorted list of words with the LCPs of neighbours and, for each word, the next one with a smaller LCP."""

    def __init__(self, words: list[str]):
        self.packed, self.size = Packed(words), len(words)
        every = np.arange(len(words))
        self.lcp = np.append(np.append(0, shared_prefix(self.packed, every[:-1], self.packed, every[1:])), -1)
        after, stack = [len(words)] * (len(words) + 1), []
        for n, depth in enumerate(self.lcp.tolist()):
            while stack and stack[-1][0] > depth:
                after[stack.pop()[1]] = n
            stack.append((depth, n))
        self.after = np.array(after)

    def beyond(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first word after each place that does not share `depth` letters with it; the list's size if there is none."""
        place = place + 1
        going = np.flatnonzero(self.lcp[place] >= depth)
        while len(going):
            place[going] = self.after[place[going]]
            going = going[self.lcp[place[going]] >= depth[going]]
        return place


def scan(listed: SortedList, queries: Packed, query: np.ndarray, place: np.ndarray, shared: np.ndarray,
         reverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of the listed words one edit from a query, at or after its `place`.

    `shared` is what the query and the word at `place` have in common. A scan ends where less than the half is shared.
    """
    need = _needed(queries.lengths[query], reverse)
    # Rows by depth for each lane. They start as those of an equal prefix and are written as the scan goes deeper.
    room = queries.lengths[query] + 3
    base = np.cumsum(room) - room
    rows = np.empty((int(room.sum()), 3), np.int8)
    rows[:] = (1, 0, 1)
    rows[base] = (2, 0, 1)
    hits: list[tuple] = []
    lane = np.flatnonzero((place < listed.size) & (shared >= need))
    place, same, depth = place[lane], shared[lane], shared[lane] + 1
    while len(lane):
        q, length = query[lane], listed.packed.lengths[place]
        row = rows[base[lane] + depth - 1]
        ended = depth > length
        # A word that ended is `depth - 1` letters long: the cell of the query's whole length is the distance.
        off = queries.lengths[q] - length
        whole = ended & (np.abs(off) <= 1)
        hit = np.flatnonzero(whole)
        hit = hit[row[hit, off[hit] + 1] == 1]
        if len(hit):
            hits.append((q[hit], place[hit]))
        letter = listed.packed.at(place, depth - 1)
        left = np.minimum(row[:, 0] + (queries.at(q, depth - 2) != letter), row[:, 1] + 1)
        middle = np.minimum(np.minimum(row[:, 1] + (queries.at(q, depth - 1) != letter), row[:, 2] + 1), left + 1)
        right = np.minimum(row[:, 2] + (queries.at(q, depth) != letter), middle + 1)
        leave = ended | (np.minimum(np.minimum(left, middle), right) > 1) | (depth > queries.lengths[q] + 1)
        stay = np.flatnonzero(~leave)
        at = base[lane[stay]] + depth[stay]
        rows[at, 0], rows[at, 1], rows[at, 2] = left[stay], middle[stay], right[stay]
        depth[stay] += 1
        gone = np.flatnonzero(leave)
        if len(gone):
            # On to the next word, or past all words with the prefix that is too far.
            onward = listed.beyond(place[gone], np.where(ended[gone], length[gone] + 1, depth[gone]))
            place[gone], depth[gone] = onward, listed.lcp[onward] + 1
            same[gone] = np.minimum(same[gone], listed.lcp[onward])
            alive = np.ones(len(lane), bool)
            alive[gone] = same[gone] >= need[lane[gone]]  # at the end of the list nothing is shared: -1
            if not alive.all():
                lane, place, depth, same = lane[alive], place[alive], depth[alive], same[alive]
    found = [np.concatenate(x) for x in zip(*hits, strict=True)] or [np.zeros(0, np.int64)] * 2
    return found[0], found[1]


def _pieces(batches: Iterator[pd.DataFrame], lanes: int) -> Iterator[tuple[bool, list[str], list[int]]]:
    """(travels, words, counts): each chunk's list whole, then its travellers, `lanes` or a batch more at a time."""
    held: tuple | None = None
    for batch in batches:
        edges = runs(batch["chunk"].to_numpy(), batch["travels"].to_numpy())
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = batch.iloc[low:high]
            key, words, counts = (part["chunk"].iloc[0], part["travels"].iloc[0]), part["word"].tolist(), part["n"].tolist()
            if held and held[0] == key and not (key[1] and len(held[1]) >= lanes):
                held[1].extend(words)
                held[2].extend(counts)
                continue
            if held:
                yield bool(held[0][1]), held[1], held[2]
            held = key, words, counts
    if held:
        yield bool(held[0][1]), held[1], held[2]


def _shares_half(one: str, two: str) -> bool:
    half = min(len(one), len(two)) // 2
    return one[:half] == two[:half]


PAIRS = "word string, n long, near string, near_n long"


def near_pairs(vocab: DataFrame, settings: SpellingSettings, words: int, reverse: bool) -> DataFrame:
    """(word, n, near, near_n): pairs one edit apart, each once; those that share the first half of the shorter word, or,
    from a scan of the reversed words, all others.

    `vocab` has `words` rows. What comes to the driver is the first and last word of each chunk.
    """
    turned = F.reverse("word") if reverse else F.col("word")
    chunks = sorted_chunks(vocab.select(turned.alias("word"), "n"), settings, words)
    ends = chunks.groupBy("chunk").agg(F.min("word"), F.max("word")).collect()
    bounds = sorted(map(tuple, ends), key=lambda bound: bound[1])
    rows = chunks.withColumn("travels", F.lit(0))
    if len(bounds) > 1:
        rows = rows.unionByName(travellers(chunks, bounds, reverse).withColumn("travels", F.lit(1)))
        rows = rows.repartition(len(bounds), "chunk")
    lanes = settings.lanes

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed, words, counts = SortedList([]), [], []
        for travels, others, other_counts in _pieces(batches, lanes):
            if travels:
                packed, every = Packed(others), np.arange(len(others))
                place = np.zeros(len(others), np.int64)
                starts = [(every, place, shared_prefix(packed, every, listed.packed, place))]
            else:
                listed, words, counts = SortedList(others), others, other_counts
                packed, every = listed.packed, np.arange(len(others))
                starts = [(e, e + 1, listed.lcp[e + 1]) for e in np.array_split(every, -(-len(others) // lanes))]
            for query, place, shared in starts:
                out = []
                for q, at in zip(*map(np.ndarray.tolist, scan(listed, packed, query, place, shared, reverse)), strict=True):
                    one, two = others[q], words[at]
                    if reverse:
                        one, two = one[::-1], two[::-1]
                    if _shares_half(one, two) != reverse:
                        out.append((one, other_counts[q], two, counts[at]))
                yield pd.DataFrame(out, columns=["word", "n", "near", "near_n"])

    return rows.sortWithinPartitions("chunk", "travels", "word").mapInPandas(scanned, PAIRS)


def spelling_groups(words: DataFrame, settings: SpellingSettings = SpellingSettings()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of `words` (word; one row an occurrence) that is long and frequent enough.

    Two words are near if one inserted, deleted or replaced code point tells them apart. A word's form is the near word of
    largest n, the smallest in code-point order among equals, if that n is at least `ratio` times its own; else null. Root is
    where forms lead to, the word itself without a form. Null words and an empty table give no rows.
    """
    vocab = kept(vocabulary(words, settings))
    size = vocab.count()
    pairs = near_pairs(vocab, settings, size, False).unionByName(near_pairs(vocab, settings, size, True))
    sides = F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = pairs.select(F.inline(sides)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    strong = -F.col("best.less") >= settings.ratio * F.col("n")
    formed = kept(vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n")))
    roots = follow(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "n", "n_near", "form", "form_n", "root")


def follow(steps: DataFrame) -> DataFrame:
    """(word, root): where the steps from `word` to `root` lead in the end. They must not lead in circles.

    A round doubles the steps taken. A form is at least twice as frequent as its word, so that six rounds go as far as
    counts can.
    """
    now = kept(steps)
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = kept(now.join(small(ahead), "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        now = further.drop("moved")
        if further.where("moved").isEmpty():
            return now
