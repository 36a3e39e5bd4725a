"""Scans, projections, filters and the pieces of the daily comparison."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions import dates
from orderpulse.functions.dates import LOOKBACK_DAYS, in_days, trailing_bounds
from orderpulse.functions.values import as_money
from orderpulse.operators.fluctuation import daily_sums
from orderpulse.operators.sizing import dimension_join
from orderpulse.queries.inputs import AS_OF, ORDER_FACTS, SEGMENT_ROWS, load, segments
from orderpulse.queries.registry import query

FIRST, LAST = trailing_bounds(AS_OF)
TODAY = date(1998, 3, 4)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, extract(YEAR FROM o_orderdate)::INTEGER AS year,
       extract(MONTH FROM o_orderdate)::INTEGER AS month, extract(DAY FROM o_orderdate)::INTEGER AS day
FROM orders
""")
def project_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", *dates.date_parts(F.col("o_orderdate")))


@query("""
SELECT event_id, extract(YEAR FROM ts)::INTEGER AS year, extract(MONTH FROM ts)::INTEGER AS month,
       extract(DAY FROM ts)::INTEGER AS day, CAST(ts AS DATE) AS date
FROM events
""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", *dates.date_parts(F.col("ts")), F.to_date("ts").alias("date"))


@query(f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{AS_OF}'")
def filter_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").filter(in_days(F.col("o_orderdate"), AS_OF, AS_OF)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query(f"""
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
""")
def filter_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").filter(in_days(F.col("o_orderdate"), FIRST, LAST)).select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))


@query("SELECT o_orderkey, o_custkey, c_mktsegment AS industry, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def orders_with_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broadcast join while the dimension is small, else a join with frequent customers split."""
    return dimension_join(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), "o_custkey", F.monotonically_increasing_id(),
    ).select("o_orderkey", "o_custkey", "industry", "o_totalprice")


@query(f"""
WITH o AS ({SEGMENT_ROWS})
SELECT industry, CAST(sum(v) AS DOUBLE) AS value_24h FROM o WHERE d = DATE '{AS_OF}' GROUP BY industry
""")
def day_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sums(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), cols=ORDER_FACTS, first=AS_OF, last=AS_OF,
    ).select("industry", F.col("total").cast("double").alias("value_24h"))


@query(f"""
WITH o AS ({SEGMENT_ROWS})
SELECT industry, d AS date, CAST(sum(v) AS DOUBLE) AS total FROM o GROUP BY industry, d
""")
def daily_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_sums(load(spark, sf_dir, "orders"), segments(spark, sf_dir), cols=ORDER_FACTS).select(
        "industry", "date", F.col("total").cast("double").alias("total"))


@query(f"""
WITH o AS ({SEGMENT_ROWS}),
dd AS (SELECT industry, d, sum(v) AS s FROM o WHERE d BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY industry, d)
SELECT industry, CAST(sum(s) AS DOUBLE) / count(s) AS avg_30d FROM dd GROUP BY industry
""")
def trailing_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_sums(load(spark, sf_dir, "orders"), segments(spark, sf_dir), cols=ORDER_FACTS, first=FIRST, last=LAST)
    return daily.groupBy("industry").agg(
        F.try_divide(F.sum("total").cast("double"), F.count("total")).alias("avg_30d"))


@query(f"""
WITH t AS (SELECT CAST(DATE '{TODAY}' - INTERVAL 2 DAY AS DATE) AS end_date,
                  CAST(DATE '{TODAY}' - INTERVAL 32 DAY AS DATE) AS start_date)
SELECT o_orderkey, start_date, end_date FROM orders CROSS JOIN t
WHERE CAST(o_orderdate AS DATE) BETWEEN start_date AND end_date
""")
def param_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-row table of parameters, computed from the day; no join is needed to attach one row.

    The values are constants of the plan and fold into the scan's filter.
    """
    start_date, end_date = F.date_sub(F.lit(TODAY), LOOKBACK_DAYS + 1), F.date_sub(F.lit(TODAY), 2)
    moment = F.col("o_orderdate")
    return load(spark, sf_dir, "orders").filter(
        (moment >= start_date) & (moment < F.date_add(end_date, 1))
    ).select("o_orderkey", start_date.alias("start_date"), end_date.alias("end_date"))


@query("""
SELECT c_mktsegment AS industry, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
WHERE extract(YEAR FROM o_orderdate) = 1998 GROUP BY c_mktsegment
""")
def right_outer_null_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A right outer join whose filter on the left side lets the optimizer make it inner.

    Orders are summed per customer first, on the map side too, so the join shuffles a row per customer.
    """
    sums = (
        load(spark, sf_dir, "orders").filter(in_days(F.col("o_orderdate"), date(1998, 1, 1), date(1998, 12, 31)))
        .groupBy("o_custkey").agg(F.sum(as_money(F.col("o_totalprice"))).alias("amount"), F.count(F.lit(1)).alias("n_orders"))
    )
    return (
        sums.join(segments(spark, sf_dir), "o_custkey", "right").filter("n_orders IS NOT NULL")
        .groupBy("industry").agg(F.sum("amount").cast("double").alias("total"))
    )
