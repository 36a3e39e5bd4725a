"""Order stream: messages to orders and order_lines, and optionally a raw copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orderpulse.model import LOAD_CHECKS, ORDER_LINES, ORDER_REJECTS, ORDERS
from orderpulse.operators.checks import Counted, required_checks
from orderpulse.operators.documents import malformed, order_line_rows, order_rows, parse_orders, without_orphans, without_spare_text
from orderpulse.operators.sinks import overwrite_partition, store_raw

STREAM_TABLES = (ORDERS, ORDER_LINES, ORDER_REJECTS, LOAD_CHECKS)


def store_silver(batch: DataFrame, epoch: int, database: str, stream_id: str) -> None:
    """Write one epoch to both tables; running it again replaces what it wrote before."""
    spark, parsed = batch.sparkSession, without_spare_text(parse_orders(batch)).persist()
    try:
        written_by = {"stream_id": stream_id, "epoch": epoch}
        usable, orphans = without_orphans(parsed, spark.table(f"`{database}`.`{ORDERS.name}`"))
        # The first write reads every message, so that it counts what is wrong with them.
        counted = Counted(usable, required_checks(ORDERS, "amount"))
        overwrite_partition(order_rows(counted.rows), ORDERS, database, written_by)
        overwrite_partition(order_line_rows(usable), ORDER_LINES, database, written_by)
        counted.store(spark, database, ORDERS.read_name, stream_id, epoch)
        rejects = malformed(usable) if orphans is None else malformed(usable).unionByName(orphans)
        # Last: an epoch whose rejects are stored, if only as an empty partition, is stored whole.
        overwrite_partition(rejects.selectExpr("raw AS value"), ORDER_REJECTS, database, written_by)
    finally:
        parsed.unpersist()


def store_batch(batch: DataFrame, epoch: int, database: str, stream_id: str, raw_path: str) -> None:
    """Raw copy and tables from one read of the batch."""
    batch = batch.persist()
    try:
        store_raw(batch, raw_path, stream_id, epoch)
        store_silver(batch, epoch, database, stream_id)
    finally:
        batch.unpersist()


def run_order_stream(messages: DataFrame, database: str, stream_id: str, checkpoint: str,
                     raw_path: str | None = None, interval: str | None = None,
                     available_now: bool = False) -> StreamingQuery:
    """Start the stream.

    `stream_id` belongs to `checkpoint`: a new checkpoint counts epochs from 0 again and
    needs a new id, or it would replace what the old one wrote.
    """
    def store(batch: DataFrame, epoch: int) -> None:
        if raw_path:
            store_batch(batch, epoch, database, stream_id, raw_path)
        else:
            store_silver(batch, epoch, database, stream_id)

    writer = (
        messages.writeStream.outputMode("append").queryName(stream_id)
        .foreachBatch(store).option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
