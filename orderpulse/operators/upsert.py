"""Upsert of an incoming batch into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.model import TableSpec
from orderpulse.operators.sizing import fits


def one_row_per_key(incoming: DataFrame, key: str) -> DataFrame:
    """`incoming`, failing when it runs if a key other than NULL occurs twice.

    The check is part of the plan: repeats meet in partial aggregation, never as a group.
    """
    values = [c for c in incoming.columns if c != key]
    checked = (
        incoming.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*values)).alias("_row"))
        .withColumn("_row", F.when(F.col("_rows") == 1, F.col("_row")).otherwise(
            F.raise_error(F.concat(F.lit(f"several incoming rows for {key} "), F.col(key).cast("string")))))
    )
    return checked.select(key, *[F.col(f"_row.{c}").alias(c) for c in values])


def merge_upsert(target: DataFrame, incoming: DataFrame, key: str, changed_by: str) -> DataFrame:
    """The target after the batch, columns as in `target`.

    A matched row takes the incoming values if `changed_by` differs (NULL differs from
    nothing); unmatched incoming rows, NULL keys among them, are added. A small batch is
    broadcast, so that the target is not shuffled. A large one meets the target by key; rows
    without a key match nothing and stay out of that shuffle.
    """
    columns = target.columns
    values = [c for c in columns if c != key]
    batch = one_row_per_key(incoming.select(columns), key)
    has_key = F.col(key).isNotNull()
    take = F.coalesce(F.col(changed_by) != F.col(f"_new.{changed_by}"), F.lit(False))
    update = [F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c != key else F.col(c) for c in columns]
    changes = batch.select(key, F.struct(*values).alias("_new"))
    if fits(incoming):
        kept = target.join(F.broadcast(changes), key, "left").select(update)
        # Only the target's keys that occur in the batch: no more rows than the batch has.
        matched = target.select(key).join(F.broadcast(batch.select(key)), key, "left_semi").distinct()
        added = batch.join(F.broadcast(matched), key, "left_anti")
    else:
        keyed = target.filter(has_key)
        kept = keyed.join(changes, key, "left").select(update).unionByName(target.filter(~has_key))
        added = batch.join(keyed.select(key).distinct(), key, "left_anti")
    without_key = incoming.filter(~has_key)
    return kept.unionByName(added.select(columns)).unionByName(without_key.select(columns))


def merge_sql(table: str, source_view: str, key: str, changed_by: str, columns: list[str]) -> str:
    """The same upsert as one statement, for table formats that can run it."""
    updates = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c != key)
    return (
        f"MERGE INTO {table} t USING {source_view} s ON t.`{key}` = s.`{key}`\n"
        f"WHEN MATCHED AND t.`{changed_by}` <> s.`{changed_by}` THEN UPDATE SET {updates}\n"
        f"WHEN NOT MATCHED THEN INSERT *"
    )


def merge_into(incoming: DataFrame, spec: TableSpec, database: str) -> None:
    """Run the upsert as a statement, on a table whose format has it."""
    key, changed_by = spec.upsert
    view = f"incoming_{spec.name}"
    spec.conform(incoming).createOrReplaceTempView(view)
    try:
        incoming.sparkSession.sql(merge_sql(f"`{database}`.`{spec.name}`", view, key, changed_by, spec.column_names))
    finally:
        incoming.sparkSession.catalog.dropTempView(view)
