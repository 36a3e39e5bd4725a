"""Writing results: appends, partition and whole-table overwrites, raw copies."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.model import TableSpec


def append_by_position(df: DataFrame, spec: TableSpec, database: str) -> None:
    rows = spec.conform(df)
    if spec.clustered:
        rows = rows.repartition(spec.clustered[1], spec.clustered[0])
    elif spec.partition:
        rows = by_partition(rows, list(spec.partition))
    rows.write.mode("append").insertInto(f"{database}.{spec.name}")


def append_by_name(df: DataFrame, table: str, partition: list[str], fmt: str = "parquet") -> None:
    by_partition(df, partition).write.mode("append").format(fmt).partitionBy(*partition).saveAsTable(table)


def by_partition(df: DataFrame, partition: list[str]) -> DataFrame:
    """Bring rows of one partition value together for few files; a large value is split again."""
    return df.hint("rebalance", *partition)


def sql_literal(value, kind: str) -> str:
    text = "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return {"STRING": text, "DATE": f"DATE {text}"}.get(kind) or str(int(value))


def overwrite_partition(df: DataFrame, spec: TableSpec, database: str, values: dict) -> None:
    """Replace exactly the partition named by `values`; an empty result clears it.

    `values` covers the first partition columns; the rest come from the rows. Naming the
    partition makes a rerun replace its own earlier output whatever the session's mode is.
    """
    assigned = spec.partition[: len(values)]
    if not values or list(values) != list(assigned):
        raise ValueError(f"{spec.name}: give values for {assigned} in this order")
    dynamic = list(spec.partition[len(values):])
    types = dict(spec.columns)
    clause = ", ".join([f"`{c}` = {sql_literal(values[c], types[c])}" for c in assigned] + [f"`{c}`" for c in dynamic])
    rows = spec.conform(df.withColumns({c: F.lit(v).cast(types[c]) for c, v in values.items()})).drop(*assigned)
    if spec.clustered:
        rows = rows.repartition(spec.clustered[1], spec.clustered[0])  # as the buckets are dealt: a task writes one file
    elif dynamic:
        rows = by_partition(rows, dynamic)
    # Static: all that the clause names is cleared. A replayed epoch with fewer days would else leave its earlier days behind.
    _overwrite(rows, spec, database, "static", f"PARTITION ({clause})")


def _overwrite(rows: DataFrame, spec: TableSpec, database: str, mode: str, partition: str) -> None:
    """The mode is the statement's own: the session's setting neither counts nor changes."""
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE `{database}`.`{spec.name}` WITH ('partitionOverwriteMode' = '{mode}') {partition} "
        "SELECT * FROM {rows}", rows=rows)


def replace_days(df: DataFrame, spec: TableSpec, database: str) -> None:
    """Replace the partitions that `df` has rows of and no others."""
    rows = by_partition(spec.conform(df), list(spec.partition))
    _overwrite(rows, spec, database, "dynamic", f"PARTITION ({', '.join(f'`{c}`' for c in spec.partition)})")


def view_properties(spark: SparkSession, database: str, view: str) -> dict[str, str]:
    if not spark.catalog.tableExists(f"`{database}`.`{view}`"):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{view}`").collect()}


def partitions(spark: SparkSession, database: str, table: str) -> list[dict[str, str]]:
    """The partitions of a table, by column. Names from the catalog: no file is listed or read."""
    listed = spark.sql(f"SHOW PARTITIONS `{database}`.`{table}`").collect()
    return [{unquote(k): unquote(v) for k, v in (part.split("=", 1) for part in r.partition.split("/"))} for r in listed]


@contextmanager
def staged(df: DataFrame, database: str, label: str) -> Iterator[DataFrame]:
    """`df` as a table for the time being, for several readers of an input that is costly to parse."""
    spark = df.sparkSession
    table = f"`{database}`.`{label}__staged{time.time_ns()}`"
    try:
        df.write.saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def store_raw(messages: DataFrame, path: str, stream_id: str, epoch: int) -> None:
    """Keep messages as compressed JSON by day of arrival; a replayed epoch replaces itself."""
    rows = messages.select(
        "offset", F.col("value").cast("string").alias("value"), F.to_date("timestamp").alias("ingest_date"))
    (
        by_partition(rows, ["ingest_date"])
        .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "gzip")
        .partitionBy("ingest_date")
        .json(f"{path}/stream_id={stream_id}/epoch={epoch}")
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """What `store_raw` kept, with its keys."""
    return spark.read.schema(
        "offset BIGINT, value STRING, stream_id STRING, epoch BIGINT, ingest_date DATE").json(path)
