"""Customer stream: new files are upserted into customers and added to the bridge."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderpulse.model import COMPANIES, CUSTOMERS, DELIVERIES, TableSpec
from orderpulse.operators.bridge import build_bridge
from orderpulse.operators.changelog import append_changes
from orderpulse.operators.deliveries import FILE, new_deliveries
from orderpulse.operators.upsert import merge_into, one_row_per_key
from orderpulse.streaming.batches import stream_name


STREAM_TABLES = (CUSTOMERS, COMPANIES, DELIVERIES)


def store_customers(batch: DataFrame, database: str, ingest_date: date | None = None, stream: str | None = None,
                    epoch: int = 0, customers: TableSpec = CUSTOMERS) -> None:
    """Apply one batch at the cost of its own rows; nothing stored is read or rewritten. The whole bridge gets its date.

    A replayed epoch of `stream` changes nothing. Without `stream`, rows without a customer id, which match nothing, are
    added each time. A table format that has MERGE gets the batch as that statement.
    """
    if batch.isEmpty():
        return
    spark = batch.sparkSession
    today = ingest_date or spark.range(1).select(F.current_date()).first()[0]
    batch = batch.persist()
    try:
        incoming = batch.select("customer_id", "company_name", F.lit(today).alias("ingest_date")).distinct()
        if customers.logged:
            keyed = one_row_per_key(incoming, "customer_id")
            append_changes(keyed.unionByName(incoming.where("customer_id IS NULL")), customers, database, stream, epoch)
        else:
            merge_into(incoming, customers, database)
        # A row without industry adds no pair; it brings the date of a batch that has none.
        pairs = build_bridge(batch).where("industry IS NOT NULL").unionByName(
            spark.createDataFrame([(None, None)], "company_name string, industry string"))
        append_changes(pairs.withColumn("ingest_date", F.lit(today)), COMPANIES, database, stream, epoch)
    finally:
        batch.unpersist()


def run_customer_stream(files: DataFrame, database: str, checkpoint: str,
                        ingest_date: date | None = None, interval: str = "60 seconds",
                        available_now: bool = False) -> StreamingQuery:
    def store(batch: DataFrame, epoch: int) -> None:
        if FILE in batch.columns:  # a file that came before, under whatever name, changes nothing
            batch = new_deliveries(batch, database, stream_name(batch), epoch)
        store_customers(batch, database, ingest_date, stream_name(batch), epoch)

    writer = (
        files.writeStream.outputMode("append").queryName("customers")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
