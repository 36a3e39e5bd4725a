"""Create tables from their specs, bring older ones up to date, and check rows against a spec."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.model import TableSpec
from orderpulse.operators.changelog import create_log, log_spec, refresh_view
from orderpulse.operators.checks import spec_checks
from orderpulse.operators.compaction import create_view

#: Types that hold all values of another one, which files of the other are read as.
WIDER = {
    T.ByteType(): (T.ShortType(), T.IntegerType(), T.LongType()),
    T.ShortType(): (T.IntegerType(), T.LongType()),
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}


class SchemaMismatch(ValueError):
    """A stored table differs from its spec in a way that no safe step mends."""


@dataclass(frozen=True)
class Step:
    """What brings a stored column to its spec: `add` it, or `widen` its type."""

    kind: str
    column: str
    wanted: str


def _is_wider(stored: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
    return wanted in WIDER.get(stored, ())


def schema_steps(stored: T.StructType, partition: Iterable[str], spec: TableSpec) -> list[Step]:
    """The steps from a stored schema to that of `spec`; `SchemaMismatch` with all reasons if there is no safe way.

    Safe are new columns behind the others, which read NULL in old rows and so can't be required ones, and wider
    types. Columns in another order are refused, as are unknown ones, narrower types and another partitioning: rows would
    end up in the wrong columns, or vanish.
    """
    wanted, found, reasons, steps = dict(spec.columns), {f.name: f.dataType for f in stored}, [], []
    if list(partition) != list(spec.partition):
        reasons.append(f"partitioned by {list(partition)}, not {list(spec.partition)}")
    if unknown := [n for n in found if n not in wanted]:
        reasons.append(f"unknown columns {unknown}")
    if [n for n in found if n in wanted] != [n for n in wanted if n in found]:
        reasons.append(f"columns in the order {list(found)}, not {list(wanted)}")
    data = [n for n in wanted if n not in spec.partition]
    if added := [n for n in wanted if n not in found]:
        if added != data[len(data) - len(added):]:
            reasons.append(f"new columns {added} must come behind all others")
        if required := [n for n in added if n in spec.required]:
            reasons.append(f"no value of the required columns {required} in stored rows")
        steps += [Step("add", n, wanted[n]) for n in added]
    types = {f.name: f.dataType for f in spec.schema}
    for name, kind in found.items():
        if name not in types or types[name] == kind:
            continue
        if name not in spec.partition and _is_wider(kind, types[name]):
            steps.append(Step("widen", name, wanted[name]))
        else:
            reasons.append(f"{name} is {kind.simpleString()}, not {wanted[name]}")
    if reasons:
        raise SchemaMismatch(f"{spec.name}: {'; '.join(reasons)}")
    return steps


def reconcile(spark: SparkSession, spec: TableSpec, database: str) -> list[Step]:
    """Bring a stored table to its spec by safe steps, and return them.

    A new column is an entry in the catalog. A wider type rewrites the table: its rows are copied, and only then is it
    made anew and filled from the copy. A copy that a failed call left behind is complete, so the next call goes on from it.
    """
    name, copy = f"`{database}`.`{spec.name}`", f"`{database}`.`{spec.name}__wider`"
    if not spark.catalog.tableExists(copy):
        columns = spark.catalog.listColumns(name)
        steps = schema_steps(spark.table(name).schema, [c.name for c in columns if c.isPartition], spec)
        if added := [f"`{s.column}` {s.wanted}" for s in steps if s.kind == "add"]:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
        if not any(s.kind == "widen" for s in steps):
            return steps
        spec.conform(spark.table(name)).write.format(spec.format).saveAsTable(copy)
    else:
        steps = [Step("widen", n, t) for n, t in spec.columns]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(spec.create_sql(database))
    spec.conform(spark.table(copy)).hint("rebalance", *spec.partition).write.insertInto(name)
    spark.sql(f"DROP TABLE {copy}")
    return steps


def ensure_tables(spark: SparkSession, database: str, root: str, specs: Iterable[TableSpec],
                  full_refresh: bool = False) -> None:
    """Create the database below `root` and each missing table; `full_refresh` drops first.

    A table that exists is brought to its spec, or refused (`SchemaMismatch`) before anything is written to it.
    """
    place = root.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{place}'")
    for spec in specs:
        stored = log_spec(spec) if spec.logged else spec
        name, view = f"`{database}`.`{stored.name}`", spec.name if spec.logged else spec.view and spec.view[0]
        if full_refresh:
            if view:
                spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{view}`")
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(stored.create_sql(database))
        steps = reconcile(spark, stored, database)
        if spec.logged:
            create_log(spark, spec, database)
            if steps:
                refresh_view(spark, spec, database)
        elif spec.view:
            create_view(spark, spec, database)
        if not spark.catalog.tableExists(f"`{database}`.`{spec.name}`"):
            raise RuntimeError(f"{name} was not created")


def schema_violations(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """(column_name, problem, n_rows) where raw text does not meet the spec.

    One aggregation for all columns. A column missing from `raw` counts as NULL.
    """
    checks = spec_checks(raw.columns, spec)
    counted = raw.agg(*[F.count_if(c.bad).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.column).alias("column_name"), F.lit(c.problem).alias("problem"), F.col(f"_{i}").alias("n_rows"))
        for i, c in enumerate(checks)])
    return counted.select(F.inline(rows)).filter("n_rows > 0")
