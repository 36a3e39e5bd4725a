"""Helpers the text operators share."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators.sizing import fits
from orderpulse.session import ensure_checkpoint_dir

#: A side of a join is broadcast only if it was counted and has at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder; lineage ends there, and a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = BROADCAST_ROWS, octets: int = BROADCAST_BYTES) -> DataFrame:
    """A hint to broadcast `df`, which should be cheap to read, if it has at most so many rows and bytes."""
    return F.broadcast(df) if fits(df, rows, octets) else df


def short_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches small enough for long texts; the byte limit alone counts before pandas unpacks them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def quoted(column: str) -> Column:
    """The column of just that name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_of(column: str) -> Column:
    return F.coalesce(quoted(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z in lower case and all else as it is."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def bound(value: Column, body) -> Column:
    """`body(value)` with `value` computed once; Catalyst would copy an expression into a lambda."""
    return F.transform(F.array(value), body)[0]


def worker_cache(name: str) -> dict:
    """A dict that lives in the Python worker until another name is asked for, so that one operator's memory is free for the next.

    Functions that travel by value get new globals in each task, hence the place in `sys`.
    """
    caches = sys.__dict__.setdefault("_orderpulse_caches", {})
    if name not in caches:
        caches.clear()
        caches[name] = {}
    return caches[name]
