"""Files that come again under another name are told by their content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.model import DELIVERIES
from orderpulse.operators.sinks import overwrite_partition
from orderpulse.session import checkpointed

#: The column that names the file of a row.
FILE = "_file"


def fingerprints(batch: DataFrame) -> DataFrame:
    """(file, n_rows, print_1, print_2): each file's rows in any order, as their number and two sums of hashes."""
    values = [F.col(f"`{c}`") for c in batch.columns if c != FILE]
    total = lambda *seed: F.sum(F.xxhash64(*seed, *values).cast("decimal(38,0)"))
    return batch.groupBy(F.col(FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), total().alias("print_1"), total(F.lit(1)).alias("print_2"))


def new_deliveries(batch: DataFrame, database: str, stream: str, epoch: int) -> DataFrame:
    """The rows of files whose content came in no other epoch, of equal files in the batch those of one; without `FILE`.

    The files are kept in DELIVERIES, by epoch: a replay finds the same ones new. What meets here is a row a file.
    """
    spark, prints = batch.sparkSession, ["n_rows", "print_1", "print_2"]
    mine = (F.col("stream_id") == stream) & (F.col("epoch") == epoch)
    known = spark.table(f"`{database}`.`{DELIVERIES.name}`").where(~mine).select(prints)
    fresh = checkpointed(fingerprints(batch).groupBy(prints).agg(F.min("file").alias("file")).join(known, prints, "left_anti"))
    overwrite_partition(fresh, DELIVERIES, database, {"stream_id": stream, "epoch": epoch})
    files = fresh.select(F.col("file").alias(FILE))  # as many as a batch has
    return batch.join(F.broadcast(files), FILE, "left_semi").drop(FILE)
