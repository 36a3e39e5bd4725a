"""Benchmark items inside documents: containment search by size-partitioned MinHash sketches, checked exactly.

Documents are far longer than items, so an item is sketched and the sketch is looked up among all
hashed shingles of a document. Items are partitioned by size, and a partition's sketch is long enough that a
document with the asked share of the item cannot miss all that must be found of it: no item is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.llm import bloom
from orderpulse.llm.common import bound, kept, quoted, small, text_of, unused

#: Words in a shingle, and the share of an item's distinct shingles that a document must hold.
WORDS, SHARE = 5, 0.8


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column, of, widths: Sequence[int] = (WORDS,)) -> Column:
    """`of(array of n words)` for each n consecutive words, for each of a few widths n; null if the text has fewer than any."""
    def of_width(all_words: Column, n: int) -> Column:
        return F.when(F.size(all_words) >= n, F.transform(
            F.sequence(F.lit(1), F.size(all_words) - n + 1), lambda at: of(F.slice(all_words, at, n))))

    def of_each(all_words: Column) -> Column:
        each = [of_width(all_words, n) for n in widths]
        return each[0] if len(each) == 1 else F.flatten(F.array_compact(F.array(*each)))

    return bound(words(text), of_each)


def _needed(count: Column, share: float) -> Column:
    return F.ceil(count * share - 1e-9)


def item_shingles(items: DataFrame, item: str, text: str, n: int, share: float) -> DataFrame:
    """(item_id, shingle, hash, width, n_item, needed): the distinct shingles of each item, of its widest row's width.

    A row of fewer than `n` words is one shingle of all of them.
    """
    rows = items.where(quoted(item).isNotNull()).select(quoted(item).alias("item_id"), words(text_of(text)).alias("words"))
    rows = rows.where(F.size("words") > 0).withColumn("width", F.least(F.lit(n), F.size("words")))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    rows = rows.select("item_id", "width", F.explode(F.transform(
        starts, lambda at: F.concat_ws(" ", F.slice("words", at, F.col("width"))))).alias("shingle")).distinct()
    total = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    return (
        rows.withColumn("hash", F.xxhash64(F.split("shingle", " "))).withColumn("n_item", total)
        .withColumn("needed", _needed(F.col("n_item"), share)))


def sketches(rows: DataFrame, share: float) -> DataFrame:
    """(item_id, hash, n_item, enough): each item's least hashes, as many as its partition asks for.

    Partition p holds items of 2^p to 2^(p+1) - 1 shingles; their sketch has twice the shingles that the largest of them
    may lack, and two more. A document that holds the share lacks `n_item - needed` at most, hence holds `enough`.
    """
    largest = F.pow(F.lit(2), F.floor(F.log2("n_item")) + 1) - 1
    length = F.least(F.col("n_item"), 2 * (largest - _needed(largest, share)) + 2)
    return (
        rows.withColumn("length", length)
        .withColumn("nth", F.row_number().over(Window.partitionBy("item_id").orderBy("hash", "shingle")))
        .where("nth <= length")
        .select("item_id", "hash", "n_item",
                F.greatest(F.lit(1), F.col("length") - (F.col("n_item") - F.col("needed"))).alias("enough")))


def leaked_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", *, n: int = WORDS, share: float = SHARE) -> DataFrame:
    """(doc_id, text_hash, item_id, n_item, n_found, containment) for each document that holds `share` of an item.

    Texts are whole; a null text is empty. An item of fewer than `n` words is found where all of them stand in a row;
    one without words is found nowhere. Rows of one item_id form one item, items without id are left out. Rows that repeat
    id and text give one result, other repeats of an id their own (`text_hash` tells them apart). Empty tables give no rows.
    """
    rows = docs.select(quoted(key).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"),
                       text_of(text).alias("text"))
    known = kept(item_shingles(items, item, item_text, n, share))
    widths = sorted(r.width for r in known.select("width").distinct().collect()) or [n]  # n of them at most
    sketch = kept(sketches(known, share))
    hashed = rows.select("doc_id", "text_hash", F.explode(shingles(F.col("text"), F.xxhash64, widths)).alias("hash"))
    few = small(sketch)
    if few is sketch:  # a filter spares nearly all of the documents' shingles the shuffle
        hashed = bloom.likely(hashed, F.col("hash"), sketch, F.col("hash"))
    candidates = kept(
        hashed.join(few, "hash").groupBy("doc_id", "text_hash", "item_id")
        .agg(F.count_distinct("hash").alias("hits"), F.first("enough").alias("enough"))
        .where("hits >= enough").select("doc_id", "text_hash", "item_id"))
    named = small(candidates).alias("c")
    pairs = rows.alias("d").join(named, F.expr("d.doc_id <=> c.doc_id AND d.text_hash = c.text_hash")).select(
        "d.doc_id", "d.text_hash", "c.item_id",
        F.explode(F.array_distinct(shingles(F.col("text"), lambda w: F.concat_ws(" ", w), widths))).alias("shingle"))
    found = pairs.distinct().join(small(known.select("item_id", "shingle", "n_item", "needed")), ["item_id", "shingle"])
    return (
        found.groupBy("doc_id", "text_hash", "item_id", "n_item", "needed")
        .agg(F.count(F.lit(1)).alias("n_found")).where("n_found >= needed")
        .select("doc_id", "text_hash", "item_id", "n_item", "n_found",
                (F.col("n_found") / F.col("n_item")).alias("containment")))


def drop_leaking(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """`docs`, same columns, without the documents that hold an item; of rows that repeat an id, those whose text holds one.

    Null and empty texts hold none. Without items, or with an empty table, `docs` stays as it is.
    """
    one, two = unused(docs, "__id"), unused(docs, "__hash")
    gone = kept(leaked_items(docs, items, key, text, **how).select(
        F.col("doc_id").alias(one), F.col("text_hash").alias(two)).distinct())
    return docs.join(small(gone), quoted(key).eqNullSafe(F.col(one)) & (F.xxhash64(text_of(text)) == F.col(two)), "left_anti")
