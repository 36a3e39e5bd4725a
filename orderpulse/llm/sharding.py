"""Rendezvous hashing over weighted shards, and a gapless slot for each row of a shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.llm.common import text_of

#: About so many rows share a group when slots are numbered.
SLOT_GROUP_ROWS = 20_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the least exponential draw, `-ln(u) / weight`, where `u` hangs on key and shard alone.

    Each shard gets rows in proportion to its weight. A further shard takes rows only into itself, and a weight
    that grows takes rows only into its own shard. Ties go to the lower shard; null keys share a shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one per shard")
    heavy = F.array(*[F.lit(float(w)) for w in weights])
    uniform = lambda n: (F.shiftrightunsigned(F.xxhash64(key, n), 11) + 0.5) / float(1 << 53)
    draws = F.transform(heavy, lambda w, n: F.struct((-F.log(uniform(n)) / w).alias("draw"), n.alias("shard")))
    return F.array_min(draws)["shard"].cast("int")


def assign_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
                  key: str = "doc_id", text: str = "text", group_rows: int = SLOT_GROUP_ROWS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `shard` and `grown_shard` follow from the key and the weights (`grown`: the weights after growth, null
    without). `size` is the UTF-8 length plus 16; a null text counts as empty. `slot` numbers a shard's rows from
    0 without gaps: rows are counted per shard and hash group, the counts add up to each group's first slot,
    and only a group is ever sorted. A row's group hangs on id, checksum and size, so rows that share an id or have none
    are spread too; only rows equal in all three meet, in one group. An empty table gives no rows; other columns are not
    looked at.
    """
    groups = max(1, -(-docs.count() // (len(weights) * group_rows)))
    body = text_of("__text")
    size, crc = (F.octet_length(body) + 16).cast("long"), F.crc32(body.cast("binary"))
    shard = rendezvous(F.col("__key"), weights)
    group = F.pmod(F.xxhash64(F.col("__key"), F.lit("slot"), crc, size), F.lit(groups))
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    firsts = (
        rows.groupBy(shard.alias("shard"), group.alias("group")).count()
        .withColumn("first", F.coalesce(F.sum("count").over(
            Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("count"))
    placed = rows.select(
        F.col("__key").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), F.lit("key").alias("law"),
        shard.alias("shard"), group.alias("group"),
        (rendezvous(F.col("__key"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    order = Window.partitionBy("shard", "group").orderBy("doc_id", "text_crc32", "size")
    return (
        placed.withColumn("nth", F.row_number().over(order)).join(firsts, ["shard", "group"])
        .select("doc_id", "size", "text_crc32", "law", "shard",
                (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard"))
