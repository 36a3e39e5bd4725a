"""Exact duplicates: a Bloom filter finds hashes that may repeat; only their rows are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm import bloom
from orderpulse.llm.common import kept, quoted, text_of, unused


def mark_suspects(docs: DataFrame, text: str = "text", *, bits_per_row: int = bloom.BITS_PER_ROW,
                  max_filter_bits: int = bloom.MAX_FILTER_BITS) -> DataFrame:
    """`docs` and a last column (called as no other is), true for every row whose text repeats and few others.

    The first pass counts how often each cell of the filter is hit and sets those hit twice; the second asks
    the filter. No row is shuffled, only cell numbers are.
    """
    bits, value = bloom.filter_bits(docs.count(), bits_per_row, max_filter_bits), F.xxhash64(text_of(text))
    return bloom.marked(docs, value, bloom.pages(docs, value, bits, twice=True), bits, unused(docs, "__suspect"))


def dedup_decisions(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per row of `docs`: its id, `keep_id`, `group_size`, `kept` and `text_sha256`.

    Of equal texts the row with the largest id stays. A null text equals an empty one. A null id is less than
    any other; in a group without ids `keep_id` is null and its rows are kept. Rows that repeat id and
    text share one decision. An empty table gives no rows; other columns are not looked at.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    marked = mark_suspects(docs, **limits)
    sha = F.sha2(text_of("text"), 256).alias("text_sha256")
    alone = marked.where(~F.col("__suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    suspects = kept(marked.where("__suspect").select("doc_id", sha))
    groups = kept(suspects.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # One row per text meets the rows of that text. Adaptive execution splits a text that many rows share, which it
    # can't do if the sums are made in the same stage as the join.
    decided = suspects.join(groups, "text_sha256").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return alone.unionByName(decided.select(alone.columns))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """`docs` with one row of each text, the one with the largest id; same columns, whatever they are called.

    Ties of the id go to the largest other columns, so rows that repeat entirely leave one; columns without an order (maps)
    decide nothing. Copies of a text meet on the map side first: a task passes on one row of each text. A null text equals
    an empty one, a null id is less than any other. An empty table gives no rows.
    """
    marked = mark_suspects(docs, text, **limits)
    suspect = F.col(marked.columns[-1])
    alone = marked.where(~suspect).drop(suspect)
    row = F.struct(quoted(key).alias("__key"), *[quoted(c).alias(f"c{n}") for n, c in enumerate(docs.columns)])
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    ordered = [c for c in docs.columns if "map<" not in kinds[c] and "variant" not in kinds[c]]
    largest = F.max(row) if ordered == docs.columns else F.max_by(
        row, F.struct(quoted(key), *[quoted(c) for c in ordered if c != text]))
    best = marked.where(suspect).groupBy(F.sha2(text_of(text), 256).alias("__sha")).agg(largest.alias("__row"))
    return alone.unionByName(best.select(*[F.col(f"__row.c{n}").alias(c) for n, c in enumerate(docs.columns)]))
