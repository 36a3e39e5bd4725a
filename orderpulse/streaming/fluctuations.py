"""The comparison as a stream: a day is ranked against the days before it as soon as the watermark closes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.functions.dates import LOOKBACK_DAYS, utc_day
from orderpulse.functions.values import MONEY_SUM, as_money
from orderpulse.model import ENTITY_DAYS, FLUCTUATIONS
from orderpulse.operators.fluctuation import TOP_K, rank_days
from orderpulse.operators.sinks import overwrite_partition, replace_days
from orderpulse.streaming.batches import stream_name, watermark_before

STREAM_TABLES = (ENTITY_DAYS, FLUCTUATIONS)


def closed_days(rows: DataFrame) -> DataFrame:
    """(industry, date, total) of watermarked rows (industry, moment, amount), each day once the watermark is beyond it.

    A row that comes later is not in it.
    """
    summed = rows.groupBy("industry", F.window("moment", "1 day")).agg(F.sum("amount").cast(MONEY_SUM).alias("total"))
    return summed.select("industry", utc_day(F.col("window.start")).alias("date"), "total")


def run_fluctuation_stream(rows: DataFrame, database: str, checkpoint: str, *, delay: str = "1 hour", k: int = TOP_K,
                           interval: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Rank each day of a stream of (industry, moment, amount) against the 31 days before it.

    A row may come `delay` behind the latest one; open days are kept as sums per industry in the state store. A
    closed day goes to ENTITY_DAYS, and its ranking to FLUCTUATIONS. Rows that come later still are told by the
    watermark that the checkpoint has for their batch, kept in ENTITY_DAYS marked as late, and added: the days whose
    value or average they change are ranked anew. A replayed batch replaces what it wrote.
    """
    timed = rows.select("industry", "moment", as_money(F.col("amount")).alias("amount")).withWatermark("moment", delay)
    # Both parts are of one query, so that a batch has one watermark for what is closed and what is late.
    arrived = timed.select("industry", utc_day(F.col("moment")).alias("date"), F.col("amount").cast(MONEY_SUM).alias("total"))
    both = closed_days(timed).withColumn("late", F.lit(False)).unionByName(arrived.withColumn("late", F.lit(True)))

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        limit = watermark_before(spark, checkpoint, epoch).date()
        in_time = F.col("late") & (F.col("date") >= F.lit(limit))  # still to be closed
        sums = batch.where(~in_time).groupBy("industry", "date", "late").agg(F.sum("total").cast(MONEY_SUM).alias("total"))
        writer = {"stream_id": stream_name(batch), "epoch": epoch}
        overwrite_partition(sums, ENTITY_DAYS, database, writer)
        store_rankings(spark, database, writer["stream_id"], epoch, k)

    writer = both.writeStream.outputMode("append").queryName("fluctuations").foreachBatch(store).option(
        "checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def read_entity_days(spark: SparkSession, database: str) -> DataFrame:
    """(industry, date, total) of all closed days, late rows added."""
    stored = spark.table(f"`{database}`.`{ENTITY_DAYS.name}`")
    return stored.groupBy("industry", "date").agg(F.sum("total").alias("total"))


def store_rankings(spark: SparkSession, database: str, stream: str, epoch: int, k: int = TOP_K) -> None:
    """Rank the days that one epoch closed or changed: its own, and those that have them in their average."""
    days = spark.table(f"`{database}`.`{ENTITY_DAYS.name}`")
    written = days.where((F.col("stream_id") == stream) & (F.col("epoch") == epoch))
    first, = written.agg(F.min("date")).first()
    if first is None:
        return
    last, = days.where(~F.col("late")).agg(F.max("date")).first()
    changed = written.select("date").distinct()  # of a calendar: few
    touched = changed.select(F.explode(F.sequence("date", F.date_add("date", LOOKBACK_DAYS))).alias("aggregation_date")).distinct()
    totals = read_entity_days(spark, database).where(F.col("date") >= F.date_sub(F.lit(first), LOOKBACK_DAYS))
    ranked = rank_days(totals, k=k, first=first).where(F.col("aggregation_date") <= F.lit(last))
    replace_days(ranked.join(touched, "aggregation_date", "left_semi"), FLUCTUATIONS, database)


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(industry, date, total) of the days that are not closed yet, read from the stream's state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.industry", utc_day(F.col("key.window.start")).alias("date"),
                        F.col("value.sum").cast(MONEY_SUM).alias("total"))
