"""What a batch of a stream knows about its query."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def stream_name(batch: DataFrame) -> str:
    """The id that Spark gives each checkpoint; it outlives restarts, and epochs count within it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def watermark_before(spark: SparkSession, checkpoint: str, epoch: int) -> datetime:
    """The watermark by which Spark tells late rows in batch `epoch`: that of the batch before, as the checkpoint has it.

    It is the same when the batch is replayed. Before a first watermark nothing is late.
    """
    start = datetime.fromtimestamp(0, timezone.utc)
    if epoch == 0:
        return start
    lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{epoch - 1}").collect()]
    known = next(json.loads(line) for line in lines if "batchWatermarkMs" in line)
    return datetime.fromtimestamp(known["batchWatermarkMs"] / 1000, timezone.utc)
