"""Byte-level BPE by rounds over padded matrices: each round, every row merges its leftmost pair of least rank.

Distinct pieces of a batch are encoded once. Pieces of like length form one numpy matrix of token ids; a hash
table over id pairs gives all ranks of a round at once, and rows without a pair leave the matrix. Nothing
is gathered: documents stay in the partition that they were read in.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm.common import short_batches, unused, worker_cache

#: Characters of text whose pieces are looked at together, distinct pieces a worker remembers, and the widest
#: matrix row. Longer pieces (runs without a break) merge by a heap, as rounds would cost their length squared.
CHUNK_CHARS, KNOWN_PIECES, WIDEST = 1 << 20, 250_000, 1_024
_NONE = np.int32(np.iinfo(np.int32).max)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return tokens


class PairTable:
    """Open-addressing hash table from (left id, right id) to the rank of the joined token."""

    def __init__(self, tokens: list[bytes]):
        ids = {token: n for n, token in enumerate(tokens)}
        pairs = [(ids[t[:k]], ids[t[k:]], n) for n, t in enumerate(tokens) for k in range(1, len(t))
                 if t[:k] in ids and t[k:] in ids]
        left, right, rank = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else [np.zeros(0, np.int64)] * 3
        size = 1 << max(4, int(4 * len(pairs) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - size.bit_length() + 1), size - 1
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        keys = left << 32 | right
        slots, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] == -1]
            self.keys[slots[free]] = keys[free]  # of several that want one slot the last is in; the others go on
            placed = self.keys[slots[todo]] == keys[todo]
            self.ranks[slots[todo[placed]]] = rank[todo[placed]]
            todo = todo[~placed]
            slots[todo] = slots[todo] + 1 & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, `_NONE` where no token joins the pair; an id of -1 joins with nothing."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        flat = keys.ravel()
        out, todo = np.full(len(flat), _NONE, np.int32), np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slots(flat[todo])
        while len(todo):
            seen = self.keys[slots]
            hit = seen == flat[todo]
            out[todo[hit]] = self.ranks[slots[hit]]
            on = ~hit & (seen != -1)
            todo, slots = todo[on], slots[on] + 1 & self.mask
        return out.reshape(keys.shape)


class Encoder:
    """Encodes with one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex

        self.pairs = PairTable(tokens)
        self.pieces = regex.compile(pattern).findall
        single = {t[0]: n for n, t in enumerate(tokens) if len(t) == 1}
        self.single = np.array([single.get(b, -1) for b in range(256)], np.int32)
        if (self.single < 0).any():
            raise ValueError("the vocabulary must hold each single byte")
        self.known: dict[str, bytes] = {}

    def merge_rows(self, rows: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Merged ids of each row of a matrix padded with -1, packed."""
        done: list = [None] * len(rows)
        place, rows, lengths = np.arange(len(rows)), rows.copy(), lengths.copy()
        ranks = self.pairs.lookup(rows[:, :-1], rows[:, 1:]) if rows.shape[1] > 1 else np.full((len(rows), 1), _NONE, np.int32)
        while len(rows):
            at = ranks.argmin(1)  # the leftmost of the least
            least = ranks[np.arange(len(rows)), at]
            over = least == _NONE
            if over.any():  # compaction
                packed, wide = rows[over].astype("<u4").tobytes(), 4 * rows.shape[1]
                for n, (row, length) in enumerate(zip(place[over].tolist(), lengths[over].tolist(), strict=True)):
                    done[row] = packed[n * wide:n * wide + 4 * length]
                on = ~over
                rows, ranks, place, lengths, at, least = rows[on], ranks[on], place[on], lengths[on], at[on], least[on]
                if not len(rows):
                    break
                width = max(2, int(lengths.max()))
                rows, ranks = rows[:, :width], ranks[:, :width - 1]
            n = np.arange(len(rows))
            cols = np.arange(rows.shape[1])
            source = cols[None, :] + (cols[None, :] > at[:, None])
            rows = np.take_along_axis(np.pad(rows, ((0, 0), (0, 1)), constant_values=-1), source, 1)
            source = cols[None, :-1] + (cols[None, :-1] > at[:, None])
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=_NONE), source, 1)
            rows[n, at] = least
            lengths = lengths - 1
            # Only the pairs beside the merged token are new.
            right = np.where(at + 1 < rows.shape[1], rows[n, np.minimum(at + 1, rows.shape[1] - 1)], -1)
            fresh = self.pairs.lookup(least, right)
            inside = at < ranks.shape[1]
            ranks[n[inside], at[inside]] = fresh[inside]
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.lookup(rows[before, at[before] - 1], least[before])
        return done

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, by a heap over a linked list."""
        import heapq

        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        first = self.pairs.lookup(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(rank, n, ids[n], ids[n + 1]) for n, rank in enumerate(first) if rank != _NONE]
        heapq.heapify(heap)
        pair: dict[tuple[int, int], int] = {}

        def push(n: int) -> None:
            if n >= 0 and after[n] < len(ids):
                key = (ids[n], ids[after[n]])
                if key not in pair:
                    pair[key] = int(self.pairs.lookup(np.array([key[0]]), np.array([key[1]]))[0])
                if pair[key] != _NONE:
                    heapq.heappush(heap, (pair[key], n, *key))

        while heap:
            rank, n, left, right = heapq.heappop(heap)
            if ids[n] != left or after[n] >= len(ids) or ids[after[n]] != right:
                continue  # one side has been merged since
            gone = after[n]
            ids[n], ids[gone], after[n] = rank, -1, after[gone]
            if after[n] < len(ids):
                before[after[n]] = n
            push(n)
            push(before[n])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces, in matrices of like length, and remember them."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(lengths, kind="stable")
        lengths, start = lengths[order], 0
        while start < len(raw):
            if lengths[start] > WIDEST:
                self.known[pieces[order[start]]] = self.merge_long(raw[order[start]])
                start += 1
                continue
            bucket = min(WIDEST, 1 << int(lengths[start] - 1).bit_length())  # a power of two holds a bucket's longest
            stop = min(int(np.searchsorted(lengths, bucket, "right")), start + max(1, (1 << 18) // bucket))
            part = order[start:stop].tolist()
            width = max(2, int(lengths[stop - 1]))
            matrix = np.full((len(part), width), -1, np.int32)
            inside = np.arange(width)[None, :] < lengths[start:stop, None]
            matrix[inside] = self.single[np.frombuffer(b"".join([raw[n] for n in part]), np.uint8)]
            for n, ids in zip(part, self.merge_rows(matrix, lengths[start:stop]), strict=True):
                self.known[pieces[n]] = ids
            start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        out, part, chars = [], [], 0
        for n, text in enumerate(texts):
            part.append(self.pieces(text))
            chars += len(text)
            if chars >= CHUNK_CHARS or n + 1 == len(texts):
                if len(self.known) > KNOWN_PIECES:
                    self.known.clear()
                if fresh := [p for p in set().union(*part) if p not in self.known]:
                    self.learn(fresh)
                out += [b"".join(map(self.known.__getitem__, pieces)) for pieces in part]
                part, chars = [], 0
        return out


def encoder_of(shared, name: str, pattern: str) -> Encoder:
    """The worker's encoder; a worker builds one for each vocabulary."""
    encoders = worker_cache("encoders")
    if (name, pattern) not in encoders:
        encoders.clear()
        encoders[name, pattern] = Encoder(shared.value, pattern)
    return encoders[name, pattern]


def share_ranks(spark: SparkSession, path: str) -> tuple:
    """The vocabulary as a broadcast, and a name that stands for its content."""
    tokens = read_ranks(path)
    return spark.sparkContext.broadcast(tokens), hashlib.sha256(b"\n".join(map(base64.b64encode, tokens))).hexdigest()


def _packed(encoder: Encoder, texts: pd.Series) -> pd.Series:
    return pd.Series(encoder.encode(texts.fillna("").tolist()), dtype=object)


def _unpacked(tokens: list[bytes], values: pd.Series) -> pd.Series:
    return pd.Series([b"".join(map(tokens.__getitem__, np.frombuffer(v or b"", "<u4").tolist())) for v in values], dtype=object)


def encode_column(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """`docs` and the binary column `out`: the ids of `text`, packed as little-endian unsigned 32-bit integers.

    Each match of `pattern` is encoded separately, without special tokens. A null text is empty and has no ids.
    The driver reads the vocabulary (its size does not hang on the data) and broadcasts it. A column that is already
    called `out` is replaced; rows are independent, so order, ties and repeats do not matter.
    """
    short_batches(docs.sparkSession)
    shared, name = share_ranks(docs.sparkSession, ranks_path)

    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield _packed(encoder_of(shared, name, pattern), texts)

    return docs.withColumn(out, packed(F.col(text)))


def decode_column(docs: DataFrame, ranks_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """`docs` and the binary column `out`: the bytes that the packed ids stand for; null ids give no bytes."""
    short_batches(docs.sparkSession)
    shared, _ = share_ranks(docs.sparkSession, ranks_path)

    @F.pandas_udf("binary")
    def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield _unpacked(shared.value, values)

    return docs.withColumn(out, unpacked(F.col(ids)))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "token_ids",
               decoded: str = "decoded") -> DataFrame:
    """`docs` with both columns, encoded and decoded again in one pass: a task then needs one Python worker, not two.

    A null or empty text has no ids and empty bytes. Rows are independent of each other, repeated ones too, and other columns
    stay, save those called as the new ones. An empty table stays empty.
    """
    short_batches(docs.sparkSession)
    shared, name = share_ranks(docs.sparkSession, ranks_path)

    @F.pandas_udf("ids binary, octets binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            ids = _packed(encoder_of(shared, name, pattern), texts)
            yield pd.DataFrame({"ids": ids, "octets": _unpacked(shared.value, ids)})

    pair = unused(docs, "__both")
    made = docs.withColumn(pair, both(F.col(text)))
    return made.withColumns({out: F.col(f"{pair}.ids"), decoded: F.col(f"{pair}.octets")}).drop(pair)


def n_tokens(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")
