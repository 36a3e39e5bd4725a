"""From raw documents to token ids: quality, exact and near duplicates, benchmark items, byte-level BPE.

Each stage gets the documents that the one before it kept, with the columns of `documents`, and its
decisions take effect. The last one returns token ids.

Null texts count as empty. Rows without id and rows that repeat one are documents like others: the stages tell them apart by
text. Further columns go along up to the last stage. An empty table stays empty; without labels nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.llm import bpe, decontamination, exact_dedup, ngram_join, quality
from orderpulse.llm.common import load
from orderpulse.llm.queries import tokenizer
from orderpulse.session import fresh_folder, remove_folder


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    ratings = quality.grades_of_labels(load(spark, sf_dir, "labels"))
    return quality.keep_selected(docs, quality.fit_quality(docs, ratings, levels=3))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity of 0.8 or more connects, the one with the least id."""
    return ngram_join.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontamination.drop_leaking(docs, load(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids (packed) and the hash of the text decoded from them."""
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), **tokenizer()).select(
        "doc_id", "lang", "source", bpe.n_tokens(F.col("token_ids")).alias("n_tokens"), "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", select_quality),
    ("exact dedup", drop_exact),
    ("n-gram Jaccard join", drop_near),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokenize),
]

#: SQL can't express the fitted classifier; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written to the shared folder and read again.

    A stage's rows go once the next one's are written, so that the folder never holds more than two stages.
    """
    docs, folder = load(spark, sf_dir, "documents"), fresh_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove_folder(spark, f"{folder}/{number - 1}")
    return docs
