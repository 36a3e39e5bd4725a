"""Tables kept as a log of changes: a batch adds its own rows and nothing else, a view folds what each key went through.

A table `t` is stored as `t_log`, by writer and epoch. Now and then a job stores the folded rows as a new state, and the
view shows them in place of the epochs they came from.
"""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.model import TableSpec
from orderpulse.operators.sinks import overwrite_partition, partitions, sql_literal, view_properties

#: The writer of folded rows; no stream may have this name. Batches without a stream have the other one.
STATE, BATCHES = "_state", "_batch"
#: Properties of the view: the epoch of the folded rows, and the last folded epoch of each stream.
_VERSION, _FOLDED = "orderpulse.state", "orderpulse.folded."


def log_spec(spec: TableSpec) -> TableSpec:
    """The stored form of `spec`. `moment` orders batches; folded rows have 0."""
    return TableSpec(f"{spec.name}_log", (*spec.columns, ("moment", "BIGINT"), ("stream_id", "STRING"), ("epoch", "BIGINT")),
                     partition=("stream_id", "epoch"), format=spec.format)


def _columns(names) -> str:
    return ", ".join(f"`{n}`" for n in names)


def fold_sql(spec: TableSpec, seen: str) -> str:
    """SQL for the rows of `spec` after all changes in the relation `seen` (the columns, `moment` and `stream_id`).

    With `upsert` (key, changed_by) a key's first row stands until a later one differs in `changed_by`, where NULL differs
    from nothing; rows without a key all stay. Only keys that changed since the last fold are grouped, and a group
    has one row for each batch at most. With `union` its columns are distinct and not NULL in the last one; the
    others come from the latest batch, even if that brought no rows of its own.
    """
    columns = _columns(spec.column_names)
    if spec.union:
        rest = [c for c in spec.column_names if c not in spec.union]
        latest = ", ".join(f"(SELECT max_by(`{c}`, moment) FROM seen) AS `{c}`" for c in rest)
        made = f"SELECT DISTINCT {_columns(spec.union)}, {latest} FROM seen WHERE `{spec.union[-1]}` IS NOT NULL"
        return f"WITH seen AS ({seen}) SELECT {columns} FROM ({made})"
    key, changed_by = (f"`{c}`" for c in spec.upsert)
    values = [c for c in spec.column_names if c != spec.upsert[0]]
    folded = ", ".join(f"last.`{c}` AS `{c}`" for c in values)
    return f"""
WITH seen AS ({seen}),
changed AS (SELECT DISTINCT {key} FROM seen WHERE stream_id <> {sql_literal(STATE, "STRING")} AND {key} IS NOT NULL),
histories AS (
  SELECT {key}, array_sort(collect_list(struct(moment, {_columns(values)}))) AS history
  FROM seen LEFT SEMI JOIN changed USING ({key}) GROUP BY {key}),
folded AS (
  SELECT {key}, aggregate(slice(history, 2, size(history)), history[0],
                          (now, new) -> IF(now.{changed_by} <> new.{changed_by}, new, now)) AS last
  FROM histories)
SELECT {columns} FROM seen LEFT ANTI JOIN changed USING ({key})
UNION ALL
SELECT {columns} FROM (SELECT {key}, {folded} FROM folded)"""


def _state(spark: SparkSession, spec: TableSpec, database: str) -> tuple[int, dict[str, int]]:
    properties = view_properties(spark, database, spec.name)
    folded = {k.removeprefix(_FOLDED): int(v) for k, v in properties.items() if k.startswith(_FOLDED)}
    return int(properties.get(_VERSION, -1)), folded


def _show(spark: SparkSession, spec: TableSpec, database: str, version: int, folded: dict[str, int]) -> None:
    """(Re)create the view: the folded rows of `version` and all epochs that are not folded."""
    listed = {_VERSION: version} | {_FOLDED + stream: last for stream, last in folded.items()}
    properties = ", ".join(f"{sql_literal(k, 'STRING')} = {sql_literal(v, 'STRING')}" for k, v in listed.items())
    state = sql_literal(STATE, "STRING")
    later = "".join(f" AND NOT (stream_id = {sql_literal(s, 'STRING')} AND epoch <= {last})" for s, last in folded.items())
    seen = (f"SELECT {_columns(spec.column_names)}, moment, stream_id FROM `{database}`.`{log_spec(spec).name}` "
            f"WHERE (stream_id = {state} AND epoch = {version}) OR (stream_id <> {state}{later})")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{spec.name}` TBLPROPERTIES ({properties}) AS {fold_sql(spec, seen)}")


def refresh_view(spark: SparkSession, spec: TableSpec, database: str) -> None:
    """Make the view anew, after the stored columns changed."""
    _show(spark, spec, database, *_state(spark, spec, database))


def create_log(spark: SparkSession, spec: TableSpec, database: str) -> None:
    """The stored table and its view, if they are missing."""
    spark.sql(log_spec(spec).create_sql(database))
    if not spark.catalog.tableExists(f"`{database}`.`{spec.name}`"):
        _show(spark, spec, database, -1, {})


def append_changes(rows: DataFrame, spec: TableSpec, database: str, stream: str | None = None, epoch: int = 0) -> None:
    """Add a batch. It costs its own rows, whatever the table holds.

    A replayed epoch of `stream` replaces its rows and keeps its place in the order; one that is folded already changes
    nothing. Without `stream` each call adds a batch.
    """
    spark, log = rows.sparkSession, log_spec(spec)
    if stream == STATE:
        raise ValueError(f"no stream may be called {STATE}")
    moment = time.time_ns()
    writer = {"stream_id": BATCHES, "epoch": moment} if stream is None else {"stream_id": stream, "epoch": epoch}
    if stream is not None:
        if _state(spark, spec, database)[1].get(stream, -1) >= epoch:
            return
        before = spark.table(f"`{database}`.`{log.name}`").where((F.col("stream_id") == stream) & (F.col("epoch") == epoch))
        moment = before.agg(F.max("moment")).first()[0] or moment
    overwrite_partition(rows.withColumn("moment", F.lit(moment)).hint("rebalance"), log, database, writer)


def _epochs(spark: SparkSession, spec: TableSpec, database: str) -> dict[str, list[int]]:
    """Stored epochs by writer, in order. Names alone come back, one for each batch that is not folded and dropped yet."""
    found: dict[str, list[int]] = {}
    for part in partitions(spark, database, log_spec(spec).name):
        found.setdefault(part["stream_id"], []).append(int(part["epoch"]))
    return {stream: sorted(epochs) for stream, epochs in found.items()}


def versions(spark: SparkSession, spec: TableSpec, database: str) -> list[int]:
    """The stored states, oldest first."""
    return _epochs(spark, spec, database).get(STATE, [])


def replace_table(df: DataFrame, spec: TableSpec, database: str, keep: int = 3, min_age: timedelta = timedelta(hours=1),
                  replaced: dict[str, int] | None = None) -> None:
    """Replace the table by the rows of `df`, which may read it.

    They are stored as a state of their own; the switch of the view commits them, and a failure before that leaves the
    table as it was. `replaced` names the last epoch of each stream whose batches are in `df`; all that are stored when
    the call begins without it. The last `keep` states stay, and so does what was shown less than `min_age` ago: give it the
    time of the longest query that reads the table. One call at a time; batches may come in meanwhile.
    """
    spark, version = df.sparkSession, time.time_ns()
    create_log(spark, spec, database)
    if replaced is None:
        replaced = {stream: epochs[-1] for stream, epochs in _epochs(spark, spec, database).items() if stream != STATE}
    before = _state(spark, spec, database)[1]
    # Added, not overwritten: a version is new, and a table that is being read can't be overwritten.
    log = log_spec(spec)
    rows = df.withColumns({"moment": F.lit(0), "stream_id": F.lit(STATE), "epoch": F.lit(version)})
    log.conform(rows).hint("rebalance").write.insertInto(f"`{database}`.`{log.name}`")
    _show(spark, spec, database, version, before | replaced)
    _retire(spark, spec, database, version, before, keep, min_age)


def fold_log(spark: SparkSession, spec: TableSpec, database: str, min_age: timedelta = timedelta(hours=1)) -> bool:
    """Store the folded rows in place of the batches they came from; False if there are none. Run it daily, beside the stream."""
    folded = _state(spark, spec, database)[1]
    last = {stream: epochs[-1] for stream, epochs in _epochs(spark, spec, database).items() if stream != STATE}
    if all(folded.get(stream, -1) >= epoch for stream, epoch in last.items()):
        return False
    log = spark.table(f"`{database}`.`{log_spec(spec).name}`")
    version = _state(spark, spec, database)[0]
    seen = (F.col("stream_id") == STATE) & (F.col("epoch") == version)
    for stream, epoch in last.items():
        seen |= (F.col("stream_id") == stream) & F.col("epoch").between(folded.get(stream, -1) + 1, epoch)
    rows = log.where(seen).select(*spec.column_names, "moment", "stream_id")
    replace_table(spark.sql(fold_sql(spec, "SELECT * FROM {rows}"), rows=rows), spec, database, min_age=min_age, replaced=last)
    return True


def _retire(spark: SparkSession, spec: TableSpec, database: str, version: int, folded: dict[str, int], keep: int,
            min_age: timedelta) -> None:
    """Drop old states, and epochs that an earlier call had folded, once no query can be reading them."""
    stored, limit = _epochs(spark, spec, database), time.time_ns() - int(min_age.total_seconds() * 1e9)
    states = [v for v in stored.pop(STATE, []) if v <= version]
    # A state was shown until the next one came.
    old = [(STATE, v) for n, v in enumerate(states[:-keep]) if states[n + 1] <= limit]
    if len(states) > 1 and states[-2] <= limit:
        old += [(s, e) for s, epochs in stored.items() for e in epochs if e <= folded.get(s, -1)]
    for at in range(0, len(old), 500):
        parts = ", ".join(f"PARTITION (stream_id = {sql_literal(s, 'STRING')}, epoch = {e})" for s, e in old[at:at + 500])
        spark.sql(f"ALTER TABLE `{database}`.`{log_spec(spec).name}` DROP IF EXISTS {parts}")
