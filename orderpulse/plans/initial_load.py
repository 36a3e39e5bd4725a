"""Bulk load of raw files into the warehouse tables.

    spark-submit orderpulse/plans/initial_load.py --input DIR --root DIR [--database NAME]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse import model
from orderpulse.operators.bridge import build_bridge
from orderpulse.operators.changelog import replace_table
from orderpulse.operators.checks import Counted, required_checks, spec_checks
from orderpulse.operators.documents import malformed, order_line_rows, order_rows, without_orphans
from orderpulse.operators.sinks import append_by_position, overwrite_partition, staged
from orderpulse.operators.tables import ensure_tables
from orderpulse.session import build_session
from orderpulse.sources.batch import READERS

INITIAL = {"stream_id": "initial", "epoch": 0}


@dataclass(frozen=True)
class Target:
    database: str
    root: str
    ingest_date: date


def load_customers(df: DataFrame, to: Target) -> None:
    day = F.lit(to.ingest_date)
    replace_table(df.withColumn("ingest_date", day), model.CUSTOMERS, to.database)
    replace_table(build_bridge(df).withColumn("ingest_date", day), model.COMPANIES, to.database)


def load_industries(df: DataFrame, to: Target) -> None:
    append_by_position(df.withColumn("ingest_date", F.lit(to.ingest_date)), model.INDUSTRIES, to.database)


def load_products(df: DataFrame, to: Target) -> None:
    append_by_position(df.withColumn("ingest_date", F.lit(to.ingest_date)), model.PRODUCTS, to.database)


def load_orders(df: DataFrame, to: Target) -> None:
    """The text is parsed once; the tables then read only the columns they need."""
    fields = F.struct(*model.ORDER_DOCUMENT.fieldNames())
    with staged(df, to.database, "documents") as documents:
        usable, orphans = without_orphans(documents)
        overwrite_partition(order_rows(usable), model.ORDERS, to.database, INITIAL)
        overwrite_partition(order_line_rows(usable), model.ORDER_LINES, to.database, INITIAL)
        rejects = malformed(usable) if orphans is None else malformed(usable).unionByName(orphans)
        rejects = rejects.select(F.coalesce("_corrupt_record", F.to_json(fields)).alias("value"))
        overwrite_partition(rejects, model.ORDER_REJECTS, to.database, INITIAL)


@dataclass(frozen=True)
class SourceSpec:
    """A raw input: where it is, how it reads, which tables it fills and how."""

    path: str
    format: str
    schema: T.StructType
    tables: tuple[model.TableSpec, ...]
    load: Callable[[DataFrame, Target], None]


def standard_sources(base: str) -> list[SourceSpec]:
    return [
        SourceSpec(f"{base}/Customers", "csv", model.CUSTOMERS_CSV, (model.CUSTOMERS, model.COMPANIES), load_customers),
        SourceSpec(f"{base}/Industries", "csv", model.INDUSTRIES_CSV, (model.INDUSTRIES,), load_industries),
        SourceSpec(f"{base}/Orders", "json", model.ORDER_DOCUMENT,
                   (model.ORDERS, model.ORDER_LINES, model.ORDER_REJECTS), load_orders),
        SourceSpec(f"{base}/Products", "csv", model.PRODUCTS_CSV, (model.PRODUCTS,), load_products),
    ]


def read_counted(spark: SparkSession, source: SourceSpec) -> Counted:
    """The rows of a source, with what is wrong with them to be counted when they are first written.

    CSV is read as text and then cast, as a value that the reader can't parse would be NULL without a trace.
    """
    if source.format != "csv":
        return Counted(READERS[source.format](spark, source.path, source.schema), required_checks(model.ORDERS, "amount"))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in source.schema])
    raw = READERS["csv"](spark, source.path, text)
    required = tuple(n for n in source.tables[0].required if n in source.schema.names)
    spec = model.TableSpec(source.tables[0].name, tuple((f.name, f.dataType.simpleString().upper()) for f in source.schema), required=required)
    counted = Counted(raw, spec_checks(raw.columns, spec))
    counted.rows = counted.rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in source.schema])
    return counted


def load_all(spark: SparkSession, sources: list[SourceSpec], to: Target, full_refresh: bool = True) -> None:
    """Load each source into its tables, and what is wrong with it into LOAD_CHECKS. Appends only add up if the tables are
    not refreshed."""
    ensure_tables(spark, to.database, to.root, [model.LOAD_CHECKS])
    for source in sources:
        ensure_tables(spark, to.database, to.root, source.tables, full_refresh)
        counted = read_counted(spark, source)
        source.load(counted.rows, to)
        counted.store(spark, to.database, source.tables[0].read_name, INITIAL["stream_id"], INITIAL["epoch"])


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--database", default="orderpulse")
    args = parser.parse_args()
    spark = build_session("initial_load")
    load_all(spark, standard_sources(args.input), Target(args.database, args.root, date.today()))


if __name__ == "__main__":
    main()
