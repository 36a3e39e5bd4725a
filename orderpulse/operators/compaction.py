"""Fold the partitions of closed epochs into one (for each day, where the table has days), while readers and the stream go on."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.model import TableSpec
from orderpulse.operators.sinks import by_partition, partitions, sql_literal, view_properties

#: How the catalog names a partition of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

#: Properties of the view, by stream: the last folded epoch, and when it was folded (nanoseconds).
_FOLDED, _MOMENT = "orderpulse.folded.", "orderpulse.folded_at."


def folded_epochs(spark: SparkSession, spec: TableSpec, database: str) -> dict[str, int]:
    """The last folded epoch of each stream that was ever folded; -1 where nothing is folded yet."""
    return {k.removeprefix(_FOLDED): int(v) for k, v in view_properties(spark, database, spec.read_name).items()
            if k.startswith(_FOLDED)}


def create_view(spark: SparkSession, spec: TableSpec, database: str, new: dict[str, str] | None = None) -> None:
    """(Re)create what readers see of a table stored by epoch: open epochs and folded ones, each row once.

    What epochs 0 to e of a stream held is stored once more as epoch -(e + 1). A fold that is not committed has an
    epoch below that of the last committed one, and is not seen.
    """
    kept = {k: v for k, v in view_properties(spark, database, spec.read_name).items() if k.startswith((_FOLDED, _MOMENT))}
    kept |= new or {}
    view, columns = spec.view
    sql = f"SELECT {', '.join(columns)} FROM `{database}`.`{spec.name}`"
    folded = {k.removeprefix(_FOLDED): int(v) for k, v in kept.items() if k.startswith(_FOLDED)}
    listed = ", ".join(f"{sql_literal(k, 'STRING')} = {sql_literal(v, 'STRING')}" for k, v in kept.items())
    names = {s: sql_literal(s, "STRING") for s in folded}
    open_epochs = "coalesce(epoch, 0) >= 0"  # rows without an epoch were never folded
    others = f"coalesce(stream_id, '') NOT IN ({', '.join(names.values())}) AND {open_epochs}" if folded else open_epochs
    seen = [f"({others})", *[f"(stream_id = {names[s]} AND (epoch > {last} OR epoch BETWEEN -({last} + 1) AND -1))"
                             for s, last in folded.items()]]
    sql += f" WHERE {' OR '.join(seen)}"
    properties = f" TBLPROPERTIES ({listed})" if kept else ""
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}`{properties} AS {sql}")


def _stored(spark: SparkSession, spec: TableSpec, database: str, stream: str) -> DataFrame:
    return spark.table(f"`{database}`.`{spec.name}`").where(F.col("stream_id") == stream)


def _drop(spark: SparkSession, spec: TableSpec, database: str, stream: str, first: int, last: int) -> None:
    """Drop the partitions of some epochs of a stream, found by name."""
    types, found = dict(spec.columns), []
    for part in partitions(spark, database, spec.name):
        if part["stream_id"] == stream and first <= int(part["epoch"]) <= last:
            named = ", ".join(f"`{c}` = " + ("NULL" if v == NO_VALUE else sql_literal(v, types[c])) for c, v in part.items())
            found.append(f"PARTITION ({named})")
    for at in range(0, len(found), 500):
        spark.sql(f"ALTER TABLE `{database}`.`{spec.name}` DROP IF EXISTS {', '.join(found[at:at + 500])}")


def last_closed(spark: SparkSession, spec: TableSpec, database: str, stream: str) -> int:
    """The epoch before the last one stored, which a restart could still replay; -1 if there is none."""
    epochs = [int(part["epoch"]) for part in partitions(spark, database, spec.name) if part["stream_id"] == stream]
    return max([-1, *(epoch - 1 for epoch in epochs)])


def fold_epochs(spark: SparkSession, spec: TableSpec, database: str, stream: str, through: int,
                min_age: timedelta = timedelta(hours=1)) -> None:
    """Fold the epochs of `stream` up to `through`, which must be closed: the stream never writes them again.

    Epochs since the last fold are written once more, a partition for each further partition column; the switch of the view is the
    commit. A failure before that leaves the table as it was, and a repeat clears what it left. What was folded
    `min_age` ago or earlier is dropped at the next call; give it the time of the longest query over the table.
    """
    done = folded_epochs(spark, spec, database).get(stream, -1)
    moment = int(view_properties(spark, database, spec.read_name).get(_MOMENT + stream, 0))
    if done >= 0 and time.time_ns() - moment >= min_age.total_seconds() * 1e9:
        _drop(spark, spec, database, stream, 0, done)
    if through <= done:
        return
    create_view(spark, spec, database, {_FOLDED + stream: str(done)})  # hides the fold until it is committed
    # Of folds, only uncommitted ones are numbered below the last committed.
    _drop(spark, spec, database, stream, -(1 << 62), -(done + 2))
    rows = _stored(spark, spec, database, stream).where(F.col("epoch").between(done + 1, through)).withColumn(
        "epoch", F.lit(-(through + 1)).cast("long"))
    by_partition(spec.conform(rows), list(spec.partition[2:])).write.insertInto(f"`{database}`.`{spec.name}`")
    create_view(spark, spec, database, {_FOLDED + stream: str(through), _MOMENT + stream: str(time.time_ns())})
