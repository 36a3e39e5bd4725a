"""Violations of a spec, counted by the job that writes the rows: no scan of their own."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.values import unfit
from orderpulse.model import LOAD_CHECKS, TableSpec
from orderpulse.operators.sinks import overwrite_partition, partitions


@dataclass(frozen=True)
class Check:
    """What is wrong with a column where `bad` is true."""

    column: str
    problem: str
    bad: Column


def spec_checks(present: list[str], spec: TableSpec) -> list[Check]:
    """Required values that are missing, and text that is not of the column's type. A column that is not present counts as NULL."""
    found = []
    for name, kind in spec.columns:
        column = F.col(f"`{name}`") if name in present else F.lit(None).cast("string")
        if name in spec.required:
            found.append(Check(name, "missing", column.isNull()))
        if kind != "STRING":
            found.append(Check(name, f"not {kind}", column.isNotNull() & column.try_cast(kind).isNull()))
    return found


def required_checks(spec: TableSpec, amount: str) -> list[Check]:
    """For rows that are typed already: required values that are missing, and an amount too large or small to be summed."""
    return [Check(n, "missing", F.col(f"`{n}`").isNull()) for n in spec.required] + [
        Check(amount, "no amount", unfit(F.col(f"`{amount}`")))]


def observed(observation: Observation) -> dict[str, int]:
    """What was counted; nothing where the plan left the rows out, as for a join with an empty side."""
    try:
        return observation.get
    except Py4JJavaError as failure:
        if "AssertionError" not in str(failure.java_exception):  # a row without schema
            raise
        return {}


class Counted:
    """Rows that count their violations as they are first written: `rows` to be written, then `counts` or `store`.

    A task that is run again after a lost executor may count its rows once more; rows themselves are written once.
    """

    def __init__(self, df: DataFrame, checks: list[Check]):
        self.checks, self.observation = checks, Observation()
        counts = [F.count_if(c.bad).alias(f"_{n}") for n, c in enumerate(checks)]
        self.rows = df.observe(self.observation, F.count(F.lit(1)).alias("_all"), *counts)

    def counts(self) -> list[tuple[str, str, int]]:
        """(column, problem, rows) of what was found, once the rows are written."""
        found = observed(self.observation)
        return [(c.column, c.problem, found[f"_{n}"]) for n, c in enumerate(self.checks) if found.get(f"_{n}")]

    def store(self, spark: SparkSession, database: str, table: str, stream_id: str, epoch: int) -> None:
        """Keep the counts of one epoch in LOAD_CHECKS; a replay replaces them. An epoch without violations leaves nothing."""
        writer, found = {"stream_id": stream_id, "epoch": epoch, "table_name": table}, self.counts()
        stored = [{k: str(v) for k, v in writer.items()} == part for part in partitions(spark, database, LOAD_CHECKS.name)]
        if found or any(stored):
            rows = spark.createDataFrame(found, "column_name string, problem string, n_rows long")
            overwrite_partition(rows, LOAD_CHECKS, database, writer)
