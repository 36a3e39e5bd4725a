"""The daily job: rank industries by fluctuation and store the day's result.

    spark-submit orderpulse/plans/daily_fluctuations.py --root DIR [--agg_date YYYY-MM-DD] [--maintained]
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.dates import in_days, parse_day, trailing_bounds
from orderpulse.functions.values import unfit
from orderpulse.model import COMPANIES, CUSTOMERS, FLUCTUATIONS, INDUSTRIES, ORDERS
from orderpulse.operators.bridge import entity_dim
from orderpulse.operators.checks import observed
from orderpulse.operators.fluctuation import TOP_K, Facts, compare_day, fill_days, report, top_fluctuations
from orderpulse.operators.maintained import MAINTAINED_TABLES, industry_days, member_industries, refresh
from orderpulse.operators.ranking import top_by
from orderpulse.operators.sinks import overwrite_partition
from orderpulse.operators.tables import ensure_tables
from orderpulse.session import build_session, checkpointed
from orderpulse.sources.batch import read_table

logger = logging.getLogger(__name__)

# `order_date` is a partition column, so a range of days prunes files.
WAREHOUSE_ORDERS = Facts(member="customer_id", moment="order_date", amount="amount")


def members(spark: SparkSession, database: str) -> DataFrame:
    """(customer_id, industry) of all customers of known industries."""
    return entity_dim(*[read_table(spark, database, t.name) for t in (CUSTOMERS, COMPANIES, INDUSTRIES)])


def dimension(spark: SparkSession, database: str) -> DataFrame:
    """The same, computed once for all that reads it."""
    return checkpointed(members(spark, database))


def compute(spark: SparkSession, database: str, as_of: date, k: int = TOP_K, zero_fill: bool = False,
            keep_missing: bool = False, left_out: Observation | None = None) -> DataFrame:
    """The day's ranking. `left_out` counts, as `n`, amounts of the days read that can't be summed."""
    cols = WAREHOUSE_ORDERS
    orders = read_table(spark, database, ORDERS.read_name).select(cols.member, cols.moment, cols.amount)
    if left_out is not None:
        days = in_days(F.col(cols.moment), trailing_bounds(as_of)[0], as_of)
        orders = orders.where(days).observe(left_out, F.count_if(unfit(F.col(cols.amount), cols.money)).alias("n"))
    return top_fluctuations(orders, dimension(spark, database), as_of, k=k, cols=cols, zero_fill=zero_fill, keep_missing=keep_missing)


def compute_maintained(spark: SparkSession, database: str, as_of: date, k: int = TOP_K, zero_fill: bool = False,
                       keep_missing: bool = False) -> DataFrame:
    """The same from daily sums that are kept: of the orders only those since the last run are read.

    The refresh stores the dimension, so that no other copy of it is made.
    """
    number = refresh(spark, database, members(spark, database))
    first, _ = trailing_bounds(as_of)
    days = industry_days(spark, database).where(in_days(F.col("date"), first, as_of))
    if zero_fill or keep_missing:
        industries = member_industries(spark, database, number).select("industry").distinct()
        days = fill_days(days, industries, first, as_of, zero=zero_fill)
    return top_by(compare_day(days, as_of, keep_missing=keep_missing), k, F.abs("diff"), "industry")


def run(spark: SparkSession, database: str, root: str, as_of: date, k: int = TOP_K, maintained: bool = False,
        zero_fill: bool = False, keep_missing: bool = False) -> list[str]:
    """Compute once, store the day, return the report's lines (at most k)."""
    ensure_tables(spark, database, root, [FLUCTUATIONS, *(MAINTAINED_TABLES if maintained else ())])
    left_out = None if maintained else Observation()  # kept sums are of orders that were checked when they were stored
    how = {} if maintained else {"left_out": left_out}
    top = (compute_maintained if maintained else compute)(spark, database, as_of, k, zero_fill, keep_missing, **how).persist()
    try:
        # At most k rows; computed before the stored day is touched.
        lines = [row.line for row in report(top).orderBy("rank").collect()]
        overwrite_partition(top, FLUCTUATIONS, database, {"aggregation_date": as_of})
    finally:
        top.unpersist()
    if left_out is not None and (n := observed(left_out).get("n")):
        logger.warning("%d amounts are too large, too small or no numbers, and not in the sums", n)
    for line in lines:
        logger.info(line)
    return lines


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--database", default="orderpulse")
    parser.add_argument("--agg_date", help="YYYY-MM-DD; yesterday if left out")
    parser.add_argument("--maintained", action="store_true", help="from daily sums that each run brings up to date")
    parser.add_argument("--zero_fill", action="store_true", help="a day without orders counts as 0 in the average")
    parser.add_argument("--keep_missing", action="store_true", help="rank industries without orders on the day or before it too")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    run(build_session("daily_fluctuations"), args.database, args.root, parse_day(args.agg_date), maintained=args.maintained,
        zero_fill=args.zero_fill, keep_missing=args.keep_missing)


if __name__ == "__main__":
    main()
