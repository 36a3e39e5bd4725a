"""Ranks over a whole result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.session import ensure_checkpoint_dir


def top_by(df: DataFrame, k: int, size: Column, tie_break: str) -> DataFrame:
    """The k rows of greatest `size` with their rank; only k rows per task meet in one task."""
    order = Window.orderBy(size.desc_nulls_last(), tie_break)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_all(df: DataFrame, size: Column, tie_break: str) -> DataFrame:
    """Rank (bigint) of every row by descending `size`, then `tie_break`.

    Rows are range-partitioned by the sort key and numbered within their range, after the rows of all earlier
    ranges. The ranges are kept with a checkpoint, so that every reader, and every repeated task, sees the same ones.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.withColumn("_size", size)
        .repartitionByRange(F.col("_size").desc_nulls_last(), F.col(tie_break).asc())
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    # One row per range: bounded by the number of shuffle partitions.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(F.col("_size").desc_nulls_last(), tie_break)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn("rank", F.row_number().over(within) + F.col("_offset"))
        .drop("_range", "_size", "_offset")
    )
