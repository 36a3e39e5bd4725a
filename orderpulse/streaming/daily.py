"""Running daily totals of a stream, the streamed form of the daily sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.functions.dates import utc_day
from orderpulse.functions.values import MONEY_SUM, as_money
from orderpulse.streaming.batches import stream_name


def day_sums(rows: DataFrame, entity: str, moment: str, amount: str) -> DataFrame:
    """(entity, date, total) of some rows, by UTC day; totals are decimal, so that they add up exactly."""
    return rows.groupBy(F.col(entity), utc_day(F.col(moment)).alias("date")).agg(
        F.sum(as_money(F.col(amount))).alias("total"))


def run_daily_totals(rows: DataFrame, entity: str, moment: str, amount: str, path: str, checkpoint: str,
                     available_now: bool = False) -> StreamingQuery:
    """Store each batch's sums per entity and day in a folder of its own, which a replay of the batch replaces.

    `read_daily_totals` adds them up: open days grow with every batch, and rows that come late, however late, count. No
    state is kept between batches. Streams that share a path, such as one after a new checkpoint, add to each other.
    """
    def store(batch: DataFrame, epoch: int) -> None:
        day_sums(batch, entity, moment, amount).write.mode("overwrite").parquet(
            f"{path}/stream_id={stream_name(batch)}/epoch={epoch}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_daily_totals(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """(entity, date, total) of all rows so far, as `operators.fluctuation.compare_day` takes them."""
    stored = spark.read.schema(f"`{entity}` STRING, date DATE, total {MONEY_SUM}, stream_id STRING, epoch BIGINT").parquet(path)
    return stored.groupBy(entity, "date").agg(F.sum("total").alias("total"))
