"""Repeated passages: windows of words are counted exactly in buckets that super-k-mers are sent to.

A window's minimiser is the least hash among its short word runs. Consecutive windows that share one travel as one
packed string to the minimiser's bucket, so equal windows always meet, and each word is sent about three times
instead of once per window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm import bloom
from orderpulse.llm.common import kept, short_batches, text_of
from orderpulse.llm.words import mix, runs, whole_groups, window_hashes, word_hashes

NO_ID = -(1 << 63)
#: Tasks of the stage over buckets.
MOST_TASKS = 50_000


@dataclass(frozen=True)
class PassageSettings:
    """Words in a window and in the runs that minimisers are taken from; text bytes that a bucket gets on average;
    super-k-mers that make a minimiser hot; bytes of repeated strings a task remembers.

    The windows of a hot minimiser go to buckets one by one, by their own hash. None of the limits changes a result.
    """

    window: int = 20
    run: int = 4
    bucket_bytes: int = 16 << 20
    hot: int = 50_000
    remembered_bytes: int = 16 << 20


def minimisers(hashes: np.ndarray, window: int, run: int) -> np.ndarray:
    """Each window's least run hash."""
    least, span, size = window_hashes(hashes, run), window - run + 1, 1
    while 2 * size <= span:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    count = max(0, len(hashes) - window + 1)
    return np.minimum(least[:count], least[span - size:span - size + count]) if count else least[:0]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.hash(text_of(text)).alias("print"), text_of(text).alias("text"))


def hot_minimisers(rows: DataFrame, settings: PassageSettings) -> tuple[np.ndarray, int]:
    """Minimisers of more than `hot` super-k-mers, and the bytes of all texts.

    Few come back: each stands for `hot` super-k-mers. Tasks sum what they see and leave out
    what they see once, which at most keeps a minimiser off the list.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, size = [], 0
            for body in batch["text"]:
                size += len(body.encode())
                least = minimisers(word_hashes(body), settings.window, settings.run)
                if len(least):
                    found.append(least[runs(least)[:-1]])
            values, counts = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            often = counts > 1
            yield pd.DataFrame({"minimiser": np.append(values[often].astype(np.int64), 0),
                                "n": np.append(counts[often], 0), "size": np.append(np.zeros(often.sum(), np.int64), size)})

    sums = kept(rows.select("text").mapInPandas(counted, "minimiser long, n long, size long").groupBy("minimiser").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size")))
    hot = [r[0] for r in sums.where(F.col("n") > settings.hot).select("minimiser").collect()]
    return np.array(hot, np.int64).astype(np.uint64), int(sums.agg(F.sum("size")).first()[0] or 0)


PACKED = "bucket long, packed binary, removed binary"


def _pack(entries: list[tuple[bytes, tuple[int, int, int]]]) -> bytes:
    """Super-k-mers of a bucket in one compressed string: count, steps between ids, starts, text hashes, strings."""
    ids, prints, starts = (np.array([k[n] for _, k in entries], np.int64) for n in range(3))
    head = [np.int64(len(entries)), np.diff(ids, prepend=0), starts.astype(np.int32), prints.astype(np.int32)]
    return zstandard.compress(b"".join(x.tobytes() for x in head) + b"\n".join(s for s, _ in entries), 3)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.decompress(packed)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    starts, prints = np.frombuffer(raw, np.int32, 2 * count, 8 + 8 * count).reshape(2, count)
    return np.cumsum(np.frombuffer(raw, np.int64, count, 8)), prints, starts, raw[8 + 16 * count:]


def super_kmers(rows: DataFrame, settings: PassageSettings, hot: np.ndarray, buckets: int) -> DataFrame:
    """Packed super-k-mers by bucket. Of equal ones that a task sees only the earliest travels; the
    others are known to repeat it and go along as `removed` windows (id, print, first start, last start)."""
    window, run = settings.window, settings.run
    hot = np.sort(hot)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        told: dict[bytes, tuple] = {}
        room = settings.remembered_bytes
        for batch in batches:
            local: dict[bytes, tuple] = {}
            where: dict[bytes, int] = {}
            removed: list[tuple[int, int, int, int]] = []
            again: set[bytes] = set()

            def see(string: bytes, key: tuple, windows: int, bucket: int) -> None:
                first = local.get(string) or told.get(string)
                if first is None:
                    local[string], where[string] = key, bucket
                    return
                again.add(string)
                if first == key:  # the same document once more
                    return
                if first < key:
                    removed.append((*key, key[2] + windows - 1))
                else:  # it comes before the one that was seen first
                    if string in local:
                        removed.append((*first, first[2] + windows - 1))
                    local[string], where[string] = key, bucket

            for doc_id, text_print, body in zip(batch["id"].tolist(), batch["print"].tolist(), batch["text"], strict=True):
                hashes = word_hashes(body)
                least = minimisers(hashes, window, run)
                if not len(least):
                    continue
                words = body.encode("utf-8", "surrogatepass").split()
                joined = b" ".join(words)
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                stops = np.cumsum(lengths + 1) - 1
                begins = stops - lengths
                at = runs(least)
                is_hot = np.isin(least[at[:-1]], hot) if len(hot) else np.zeros(len(at) - 1, bool)
                homes = (least[at[:-1]] % np.uint64(buckets)).tolist()
                lows, highs = begins[at[:-1]].tolist(), stops[at[1:] - 1 + window - 1].tolist()
                edges = at.tolist()
                for n in np.flatnonzero(~is_hot).tolist():
                    see(joined[lows[n]:highs[n]], (doc_id, text_print, edges[n]), edges[n + 1] - edges[n], homes[n])
                if is_hot.any():
                    own = mix(window_hashes(hashes, window)) % np.uint64(buckets)
                    for n in np.flatnonzero(is_hot).tolist():
                        for start in range(edges[n], edges[n + 1]):
                            see(joined[begins[start]:stops[start + window - 1]], (doc_id, text_print, start), 1, int(own[start]))

            for string in again:
                key = local.get(string)
                if string in told or room >= len(string):
                    room -= 0 if string in told else len(string) + 200
                    told[string] = min(x for x in (key, told.get(string)) if x is not None)
            by_bucket: dict[int, list] = {}
            for string, key in local.items():
                by_bucket.setdefault(where[string], []).append((string, key))
            made = [(b, _pack(entries), b"") for b, entries in by_bucket.items()]
            if removed:  # to any bucket, a batch's own: batches without a new string would else share one
                gone = np.array(removed, np.int64).tobytes()
                made.append((zlib.crc32(gone) % buckets, _pack([]), gone))
            yield pd.DataFrame(made, columns=["bucket", "packed", "removed"])

    return rows.mapInPandas(packed, PACKED)


SPANS = "id long, print int, start long, stop long"


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15 | 1
    inverse = pow(base, -1, 1 << 64)
    made = []
    for factor in (base, inverse):
        steps = np.full(count, np.uint64(factor), np.uint64)
        steps[:1] = 1
        made.append(np.cumprod(steps))
    return made[0], made[1]


def repeated_windows(packed: DataFrame, settings: PassageSettings, buckets: int) -> DataFrame:
    """Spans of words (id, print, start, stop) under windows that also start earlier; spans of a document may overlap.

    There are as many tasks as buckets, up to a limit beyond which a task works through several, one after the other.
    """
    window = settings.window

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = inverses = np.zeros(0, np.uint64)
        for frame, edges in whole_groups(batches, ["bucket"]):
            removed = [np.frombuffer(b"".join(frame["removed"]), np.int64).reshape(-1, 4)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                texts, parts = [], []
                for number, blob in enumerate(frame["packed"].iloc[low:high]):
                    ids, prints, starts, text = _unpack(blob)
                    texts.append(text)
                    if not len(ids):
                        continue
                    octets = np.frombuffer(text, np.uint8)
                    if len(octets) > len(powers):
                        powers, inverses = _powers(len(octets) * 2)
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((octets.astype(np.uint64) + np.uint64(1)) * powers[:len(octets)])])
                    gaps = np.flatnonzero((octets == 32) | (octets == 10))
                    begins, stops = np.append(0, gaps + 1), np.append(gaps, len(octets))
                    first_word = np.append(0, np.searchsorted(gaps, gaps[octets[gaps] == 10]) + 1)
                    n_words = np.diff(np.append(first_word, len(begins)))
                    n_windows = n_words - window + 1
                    owner = np.repeat(np.arange(len(ids), dtype=np.int32), n_windows)
                    nth = (np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)).astype(np.int32)
                    word = first_word[owner] + nth
                    begin, stop = begins[word], stops[word + window - 1]
                    parts.append((mix((total[stop] - total[begin]) * inverses[begin]), ids[owner], prints[owner],
                                  starts[owner] + nth, np.full(len(owner), number, np.int32),
                                  begin.astype(np.int32), stop.astype(np.int32)))
                if not parts:
                    continue
                hashes, ids, prints, starts, number, begin, stop = map(np.concatenate, zip(*parts, strict=True))
                del parts
                order = np.argsort(hashes, kind="stable")
                same = hashes[order][1:] == hashes[order][:-1]
                twice = np.zeros(len(order), bool)
                twice[1:] |= same
                twice[:-1] |= same
                some = order[twice]
                some = some[np.lexsort((starts[some], prints[some], ids[some], hashes[some]))]
                # Equal hashes lie together, earliest first; the strings themselves decide. Rows that repeat id and
                # text bring the earliest window more than once; only a later one repeats it.
                seen, last, repeats = {}, None, []
                keys = zip(ids[some].tolist(), prints[some].tolist(), starts[some].tolist(), strict=True)
                for n, key, value, text, a, b in zip(some.tolist(), keys, hashes[some].tolist(), number[some].tolist(),
                                                     begin[some].tolist(), stop[some].tolist(), strict=True):
                    string = texts[text][a:b]
                    if value != last:
                        seen, last = {string: key}, value
                    elif seen.setdefault(string, key) != key:
                        repeats.append(n)
                n = np.array(repeats, np.int64)
                removed.append(np.stack([ids[n], prints[n], starts[n], starts[n]], 1))
            rows = np.concatenate(removed)
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            yield pd.DataFrame(_merged(rows, window), columns=["id", "print", "start", "stop"])

    return packed.repartition(min(buckets, MOST_TASKS), "bucket").sortWithinPartitions("bucket").mapInPandas(spans, SPANS)


def _merged(rows: np.ndarray, window: int) -> np.ndarray:
    """Sorted (id, print, first start, last start) as word spans; windows that follow each other become one."""
    if not len(rows):
        return rows
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1) | (rows[1:, 2] > rows[:-1, 3] + 1)
    first = np.flatnonzero(new)
    last = np.maximum.reduceat(rows[:, 3], first)
    return np.column_stack([rows[first, 0], rows[first, 1], rows[first, 2], last + window])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   settings: PassageSettings = PassageSettings()) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (its other words, joined by one space).

    A word goes if a window over it has a word sequence that also starts earlier: in a document with a smaller id, or earlier
    in the same one. Words are runs of anything but ASCII white space. A null text has no words; texts shorter
    than a window lose none. A null id is less than any other. Rows that repeat id and text are one document and
    share its result; rows that repeat an id with another text are told apart by a hash of the text, which
    decides their order. Ids are whole numbers (text that is none fails). Empty tables give no rows; other columns are not
    looked at.
    """
    short_batches(docs.sparkSession)
    rows = _rows(docs, key, text)
    hot, size = hot_minimisers(rows, settings)
    buckets = max(1, -(-3 * size // settings.bucket_bytes))
    packed = super_kmers(rows, settings, hot, buckets)
    spans = repeated_windows(packed, settings, buckets).groupBy("id", "print").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))  # a document's spans are fewer than its words
    spans = kept(spans)
    # Only documents with spans need to meet them; a filter spares most of the others the shuffle.
    bits, value = bloom.filter_bits(spans.count()), F.xxhash64("id", "print")
    marked = bloom.marked(rows, value, bloom.pages(spans, value, bits), bits, "some")
    met = marked.where("some").drop("some").join(spans, ["id", "print"], "left")
    joined = met.unionByName(marked.where("NOT some").drop("some"), allowMissingColumns=True).select(
        "id", "text", F.transform("spans", lambda s: s["start"]).alias("starts"),
        F.transform("spans", lambda s: s["stop"]).alias("stops"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, body, starts, stops in zip(batch["id"], batch["text"], batch["starts"], batch["stops"], strict=True):
                words, gone = body.encode("utf-8", "surrogatepass").split(), 0
                if starts is not None:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, stops, -1)
                    stay = np.cumsum(change[:-1]) == 0
                    gone = len(words) - int(stay.sum())
                    words_left = [words[n] for n in np.flatnonzero(stay).tolist()]
                else:
                    words_left = words
                out.append((None if doc_id == NO_ID else doc_id, len(words), gone,
                            b" ".join(words_left).decode("utf-8", "surrogatepass")))
            made = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_text"])
            yield made.assign(doc_id=pd.array([r[0] for r in out], "Int64"))  # exact, and null without id

    return joined.mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept_text string")
