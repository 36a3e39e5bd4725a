"""Size checks before a broadcast, and joins that stay balanced beyond that size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_SPLIT = 5_000_000
MAX_HOT_KEYS = 10_000
#: Keys that a sketch of heavy hitters tracks, and tasks that merge the sketches of all others.
TRACKED_KEYS, MERGING_TASKS = 1 << 16, 256


def _bytes(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        length = F.octet_length(column)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        length = F.octet_length(F.to_json(F.struct(column)))
    else:
        return F.lit(16)
    return F.coalesce(length, F.lit(0))


def fits(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether `df` is small enough to be sent to every executor.

    One distributed count of rows and bytes; only two numbers come back.
    """
    size = sum((_bytes(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
    n_rows, n_bytes = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n_rows <= (BROADCAST_ROWS if max_rows is None else max_rows) and \
        n_bytes <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more rows than one task should get, with the number of splits each needs.

    A hot key holds more than 1/MAX_HOT_KEYS of all rows, so at most MAX_HOT_KEYS rows come out: a proven bound that
    makes this result safe to broadcast. One pass finds them, and no key is shuffled: each task sketches its heavy
    hitters in bounded memory, groups of tasks merge their sketches, and one task merges the groups. The sketch errs by
    half that share at most; a key it overlooks or adds is split otherwise, and joins the same rows.
    """
    parts = df.select(F.col(key).alias("_key"), F.pmod(F.spark_partition_id(), F.lit(MERGING_TASKS)).alias("_part"))
    sketches = parts.groupBy("_part").agg(
        F.expr(f"approx_top_k_accumulate(_key, {TRACKED_KEYS})").alias("_sketch"), F.count(F.lit(1)).alias("_rows"))
    merged = sketches.groupBy(F.lit(0).alias("_all")).agg(  # a group, so that no rows give no sketch
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {TRACKED_KEYS}), {MAX_HOT_KEYS})").alias("_top"),
        F.sum("_rows").alias("_total"))
    cut = F.greatest(F.lit(ROWS_PER_SPLIT), F.floor(F.col("_total") / MAX_HOT_KEYS))
    return (
        merged.select(F.explode("_top").alias("_hot"), cut.alias("_cut"))
        .filter((F.col("_hot.count") > F.col("_cut")) & F.col("_hot.item").isNotNull())
        .select(F.col("_hot.item").alias(key), F.ceil(F.col("_hot.count") / F.col("_cut")).cast("int").alias("_splits"))
    )


def salted_join(many: DataFrame, few: DataFrame, key: str, salt_by: Column | None = None) -> DataFrame:
    """Inner join in which a hot key of `many` is spread over several tasks.

    Rows of `few` are repeated only for hot keys, once per split. `salt_by` tells rows of
    one key apart: by default a hash of the whole row, which suits rows without copies. For
    rows straight from a scan pass `monotonically_increasing_id()`, which spreads copies too
    and, unlike after a shuffle, comes out the same when a lost task is run again.
    """
    hot = F.broadcast(hot_keys(many, key))
    salt_by = F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]) if salt_by is None else salt_by
    spread = many.withColumn("_spread", salt_by).join(hot, key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.col("_spread"), F.col("_splits")), F.lit(0)).cast("int")
    ).drop("_spread", "_splits")
    repeated = few.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    ).drop("_splits")
    return spread.join(repeated, [key, "_salt"]).drop("_salt")


def dimension_join(many: DataFrame, few: DataFrame, key: str, salt_by: Column | None = None) -> DataFrame:
    """Inner join: broadcast `few` if it is small, else shuffle with hot keys split."""
    if fits(few):
        return many.join(F.broadcast(few), key)
    return salted_join(many, few, key, salt_by)


def right_outer(left: DataFrame, right: DataFrame, key: str, salt_by: Column | None = None) -> DataFrame:
    """Keep every row of `right`.

    A shuffled right outer join cannot split a hot key of its left side, so beyond the
    broadcast size it is written as the inner join plus the rows of `right` without match;
    the second part only needs one row per key of `left`.
    """
    if fits(left):
        return F.broadcast(left).join(right, key, "right")
    matched = dimension_join(left, right, key, salt_by)
    missing = right.join(left.select(key).distinct(), key, "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)
