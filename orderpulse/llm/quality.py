"""Ordinal quality: a cumulative-link regression on hashed text, fitted on graded ratings.

One weight vector over hashed text features and ordered thresholds give P(grade > k) for every k, hence an expected
grade and a tail probability to select by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, short_batches, text_of, worker_cache
from orderpulse.llm.words import WordTable

#: Hashed features, and at most so many rated documents (those of least id hash) for a fit.
FEATURES, SAMPLE_ROWS = 1 << 16, 8_000
#: A document is selected if P(grade > 0) is at least this; below one half, as a good document lost costs more.
LEAST_TAIL = 0.3


def word_features(word: bytes) -> tuple[int, int, int]:
    """Hashed word, its shape (classes of characters, runs as one) and its last three bytes."""
    shape = bytearray()
    for octet in word:
        kind = (65 if 65 <= octet <= 90 else 97 if 97 <= octet <= 122 or octet >= 128 else 48 if 48 <= octet <= 57 else octet)
        if not shape or shape[-1] != kind:
            shape.append(kind)
    digest = xxhash.xxh3_64_intdigest
    return (digest(word) % FEATURES, digest(b"s" + bytes(shape)) % FEATURES, digest(b"e" + word[-3:]) % FEATURES)


#: Features of what stands beside what: a word like the one before it, like the one two before it, a text without words.
SAME, SAME_BUT_ONE, EMPTY = (xxhash.xxh3_64_intdigest(x) % FEATURES for x in (b"\x00same", b"\x00same2", b"\x00empty"))


def shares(text: str, table: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and the roots of their counts, scaled to length one."""
    words = text.encode("utf-8", "surrogatepass").split()
    if words:
        numbers = table.numbers(words)
        beside = [np.full(int((numbers[n:] == numbers[:-n]).sum()), f) for n, f in ((1, SAME), (2, SAME_BUT_ONE)) if len(words) > n]
        found, counts = np.unique(np.concatenate([table.rows[numbers].ravel(), *beside]), return_counts=True)
    else:
        found, counts = np.array([EMPTY]), np.ones(1)
    return found, np.sqrt(counts) / np.sqrt(counts.sum())


def word_table() -> WordTable:
    cache = worker_cache("quality")
    if not cache:
        cache["table"] = WordTable(word_features, 3, np.int64)
    return cache["table"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class OrdinalModel:
    """`weights` over features; `thresholds`, ascending: P(grade > k) = sigmoid(score - thresholds[k])."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, found: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[found] @ values)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        return _sigmoid(np.asarray(scores)[:, None] - self.thresholds[None, :])


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, *, rounds: int = 200,
                rate: float = 0.1, penalty: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood by full gradients with Adam. A grade without rows keeps its threshold beside its neighbour's."""
    owner = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    found, values = np.concatenate([f for f, _ in rows]), np.concatenate([v for _, v in rows])
    used, column = np.unique(found, return_inverse=True)
    above = (grades[:, None] > np.arange(levels - 1)[None, :]).mean(0)
    start = -np.log(np.clip(above, 1e-3, 1 - 1e-3) / np.clip(1 - above, 1e-3, 1 - 1e-3))
    # Thresholds are a first one and positive steps, so they stay in order.
    theta = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n, hit = len(rows), np.arange(len(rows))
    for step in range(1, rounds + 1):
        weights, cut = theta[:len(used)], theta[len(used):]
        thresholds = cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))])
        score = np.bincount(owner, weights[column] * values, n)
        tail = np.column_stack([np.ones(n), _sigmoid(score[:, None] - thresholds), np.zeros(n)])
        chance = np.maximum(tail[hit, grades] - tail[hit, grades + 1], 1e-12)
        slope = tail * (1 - tail)
        by_score = -(slope[hit, grades] - slope[hit, grades + 1]) / chance / n
        by_cut = np.zeros((n, levels + 1))
        by_cut[hit, grades] += slope[hit, grades] / chance / n
        by_cut[hit, grades + 1] -= slope[hit, grades + 1] / chance / n
        by_cut = by_cut[:, 1:levels].sum(0)
        gradient = np.concatenate([
            np.bincount(column, by_score[owner] * values, len(used)) + penalty * weights,
            [by_cut.sum()], [by_cut[k:].sum() * np.exp(cut[k]) for k in range(1, levels - 1)]])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(FEATURES)
    weights[used] = theta[:len(used)]
    cut = theta[len(used):]
    return OrdinalModel(weights.astype(np.float32), cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))]))


def fit_quality(docs: DataFrame, ratings: DataFrame, levels: int, key: str = "doc_id", text: str = "text",
                grade: str = "grade", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel | None:
    """The model for grades 0 to levels - 1, from at most `sample_rows` rated documents; None if there are none.

    Features are made where the documents are; only those of the sample come to the driver, never more than `sample_rows`.
    Ratings without grade or document are left out; a document rated twice counts twice, and so do documents of one id.
    """
    short_batches(docs.sparkSession)
    sample = (
        ratings.where(F.col(grade).between(0, levels - 1)).select(F.col(key).alias("__id"), F.col(grade).cast("int").alias("grade"))
        .orderBy(F.xxhash64("__id"), "__id", "grade").limit(sample_rows))
    rated = docs.select(F.col(key).alias("__id"), text_of(text).alias("text")).join(F.broadcast(sample), "__id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [shares(body, word_table()) for body in batch["text"]]
            yield pd.DataFrame({"id": batch["__id"], "grade": batch["grade"], "found": [f.astype("<i4").tobytes() for f, _ in made],
                                "parts": [v.astype("<f4").tobytes() for _, v in made]})

    made = rated.mapInPandas(features, "id long, grade int, found binary, parts binary")
    # The sample bounds ratings; documents that share a rated id are bounded here.
    rows = kept(made.orderBy(F.xxhash64("id"), "id", "grade", "found", "parts").limit(sample_rows)).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.id, r.grade, r.found))
    return fit_ordinal([(np.frombuffer(r.found, "<i4"), np.frombuffer(r.parts, "<f4")) for r in rows],
                       np.array([r.grade for r in rows]), levels)


def tails(model: OrdinalModel, text: str) -> Column:
    """P(grade > k) for each k, as an array."""
    @F.pandas_udf("array<double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bodies in batches:
            table = word_table()
            yield pd.Series(list(model.tails(np.array([model.score(*shares(body, table)) for body in bodies]))))

    return scored(text_of(text))


def grade_documents(docs: DataFrame, model: OrdinalModel | None, key: str = "doc_id", text: str = "text",
                    least_tail: float = LEAST_TAIL) -> DataFrame:
    """One row per row of `docs`: doc_id, expected_grade, tails (P(grade > k) for each k), selected.

    Whole texts are scored; a null or empty text has a feature of its own. Without a model (no ratings) grade and
    tails are null and all is selected. Rows are independent of each other and of other columns; null and repeated ids
    change nothing. An empty table gives no rows.
    """
    short_batches(docs.sparkSession)
    if model is None:
        return docs.select(F.col(key).alias("doc_id"), F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("array<double>").alias("tails"), F.lit(True).alias("selected"))
    scored = docs.select(F.col(key).alias("doc_id"), tails(model, text).alias("tails"))
    return scored.select("doc_id", F.aggregate("tails", F.lit(0.0), lambda a, p: a + p).alias("expected_grade"), "tails",
                         (F.col("tails")[0] >= least_tail).alias("selected"))


def keep_selected(docs: DataFrame, model: OrdinalModel | None, text: str = "text", least_tail: float = LEAST_TAIL) -> DataFrame:
    """`docs`, same columns, without the documents that are not selected."""
    short_batches(docs.sparkSession)
    return docs if model is None else docs.where(tails(model, text)[0] >= least_tail)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Labels as ratings: 0 for bad quality, 1 for good quality but toxic, 2 for good and not toxic."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(
        F.col("toxic") == 0, 2).alias("grade"))
