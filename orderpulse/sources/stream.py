"""Stream sources. All message sources return the columns of `MESSAGE`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.model import CUSTOMERS_CSV, MESSAGE
from orderpulse.operators.deliveries import FILE

#: Files of one listing that are remembered for the next batches.
LISTED_FILES = 100_000


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscription to a topic. Needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(*MESSAGE.fieldNames())


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of messages in a folder, the stand-in for a topic."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def customer_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   archive: str | None = None) -> DataFrame:
    """New customer CSV files, each with a header, in a folder; `_file` names each row's file.

    A listing is kept until its files are used up, so that a folder of many files is listed once and not for every batch.
    Files that are done with move to `archive`, a folder outside `path`, so that the listing does not grow for ever.
    """
    reader = (
        spark.readStream.schema(CUSTOMERS_CSV).option("header", True)
        .option("maxCachedFiles", LISTED_FILES).option("discardCachedInputRatio", 0.0)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path).select(*CUSTOMERS_CSV.fieldNames(), F.col("_metadata.file_path").alias(FILE))
