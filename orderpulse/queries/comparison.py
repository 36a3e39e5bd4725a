"""The fluctuation queries."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.dates import trailing_bounds
from orderpulse.functions.values import REPORT_LINE
from orderpulse.operators import fluctuation
from orderpulse.operators.ranking import rank_all as rank_everything
from orderpulse.plans.fluctuation_sql import top_fluctuations_in
from orderpulse.queries.inputs import (AS_OF, LINE_FACTS, ORDER_FACTS, SEGMENT_ROWS, WORD_ROWS, load, segments, words)
from orderpulse.queries.registry import query


def fluctuation_ctes(rows: str, as_of) -> str:
    """`ranked`: every entity of `rows` (industry, d, v), compared in two branches and ranked."""
    first, last = trailing_bounds(as_of)
    return f"""
o AS ({rows}),
h AS (SELECT industry, CAST(sum(v) AS DOUBLE) AS value_24h FROM o WHERE d = DATE '{as_of}' GROUP BY industry),
dd AS (SELECT industry, d, sum(v) AS s FROM o WHERE d BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY industry, d),
b AS (SELECT industry, CAST(sum(s) AS DOUBLE) / count(s) AS avg_30d FROM dd GROUP BY industry),
ranked AS (
  SELECT industry, value_24h, avg_30d, value_24h - avg_30d AS diff,
         CAST(row_number() OVER (ORDER BY abs(value_24h - avg_30d) DESC, industry) AS INTEGER) AS rank
  FROM h JOIN b USING (industry))
"""


TOP_SEGMENTS = f"WITH {fluctuation_ctes(SEGMENT_ROWS, AS_OF)} SELECT * FROM ranked WHERE rank <= 3"


@query(TOP_SEGMENTS)
def fluctuations_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fluctuation.top_fluctuations(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), AS_OF, cols=ORDER_FACTS)


@query(TOP_SEGMENTS)
def fluctuations_two_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fluctuation.two_branch_fluctuations(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), AS_OF, cols=ORDER_FACTS)


@query(f"""
WITH {fluctuation_ctes(WORD_ROWS, AS_OF)}
SELECT *, abs(diff) AS abs_diff, diff / avg_30d * 100 AS pct_diff FROM ranked WHERE rank <= 3
""")
def fluctuations_multi_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part counts in full for each word of its name."""
    return fluctuation.top_fluctuations(
        load(spark, sf_dir, "lineitem"), words(spark, sf_dir), AS_OF, cols=LINE_FACTS, with_percent=True)


REGION_ROWS = """
SELECT r_name AS industry, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS v
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query(f"""
WITH {fluctuation_ctes(REGION_ROWS, AS_OF)}
SELECT industry, value_24h, avg_30d, diff, abs(diff) AS abs_diff, diff / avg_30d * 100 AS pct_diff
FROM ranked WHERE rank <= 3
""")
def fluctuations_sql_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as industries and nations as companies, in one SQL statement over the views of a database.

    The database can go once the statement is analysed: its views stand for files.
    """
    database = f"orderpulse_{uuid.uuid4().hex[:12]}"
    file = lambda name: f"parquet.`{sf_dir}/{name}.parquet`"
    views = {
        "orders": f"SELECT o_custkey AS customer_id, o_orderdate AS moment, o_totalprice AS amount FROM {file('orders')}",
        "customers": f"SELECT c_custkey AS customer_id, c_nationkey AS company_name FROM {file('customer')}",
        "companies": f"SELECT n_nationkey AS company_name, r_name AS industry FROM {file('nation')} "
                     f"JOIN {file('region')} ON n_regionkey = r_regionkey",
        "industries": f"SELECT r_name AS industry FROM {file('region')}",
    }
    spark.sql(f"CREATE DATABASE `{database}`")
    try:
        for name, rows in views.items():
            spark.sql(f"CREATE VIEW `{database}`.`{name}` AS {rows}")
        return top_fluctuations_in(spark, database, AS_OF)
    finally:
        spark.sql(f"DROP DATABASE `{database}` CASCADE")


@query(f"""
WITH {fluctuation_ctes(SEGMENT_ROWS, AS_OF)}
SELECT rank, printf('{REPORT_LINE}', rank, industry, value_24h, avg_30d, diff, diff / avg_30d * 100) AS line
FROM ranked WHERE rank <= 3
""")
def fluctuations_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fluctuation.report(fluctuations_top3(spark, sf_dir))


NAME_ROWS = """
SELECT p_name AS industry, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


@query(f"WITH {fluctuation_ctes(NAME_ROWS, AS_OF)} SELECT * REPLACE (CAST(rank AS BIGINT) AS rank) FROM ranked")
def rank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS industry")
    compared = fluctuation.fluctuations(load(spark, sf_dir, "lineitem"), names, AS_OF, cols=LINE_FACTS)
    return rank_everything(compared, F.abs("diff"), "industry")


def backfill_sql(rows: str) -> str:
    """The ranking of every day of `rows` (industry, d, v)."""
    return f"""
WITH o AS ({rows}),
dd AS (SELECT industry, d, CAST(sum(v) AS DECIMAL(18,2)) AS v FROM o GROUP BY industry, d),
w AS (SELECT industry, d, v, sum(v) OVER f AS sv, count(*) OVER f AS n FROM dd
      WINDOW f AS (PARTITION BY industry ORDER BY date_diff('day', DATE '1970-01-01', d)
                   RANGE BETWEEN 31 PRECEDING AND 1 PRECEDING)),
x AS (SELECT industry, d, CAST(v AS DOUBLE) AS value_24h, CAST(sv AS DOUBLE) / n AS avg_30d FROM w WHERE n > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY abs(value_24h - avg_30d) DESC, industry) AS rk FROM x)
SELECT d AS aggregation_date, industry, CAST(rk AS INTEGER) AS rank, value_24h, avg_30d, value_24h - avg_30d AS diff
FROM r WHERE rk <= 3"""


BACKFILL = backfill_sql(SEGMENT_ROWS)


@query(BACKFILL)
def fluctuations_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fluctuation.backfill_fluctuations(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), cols=ORDER_FACTS)


def _window(as_of) -> str:
    first, _ = trailing_bounds(as_of)
    return f"d BETWEEN DATE '{first}' AND DATE '{as_of}'"


@query(f"""
WITH o AS ({NAME_ROWS}),
s AS (SELECT industry, coalesce(sum(v) FILTER (WHERE d = DATE '{AS_OF}'), 0) AS today,
             coalesce(sum(v) FILTER (WHERE d < DATE '{AS_OF}'), 0) AS before
      FROM o WHERE {_window(AS_OF)} GROUP BY industry)
SELECT industry, CAST(today AS DOUBLE) AS value_24h, CAST(before AS DOUBLE) / 31 AS avg_30d,
       CAST(today AS DOUBLE) - CAST(before AS DOUBLE) / 31 AS diff FROM s
""")
def fluctuations_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages over all 31 days; names with rows in the window only."""
    names = load(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS industry")
    return fluctuation.fluctuations(load(spark, sf_dir, "lineitem"), names, AS_OF, cols=LINE_FACTS, zero_fill=True)


@query(f"""
WITH {fluctuation_ctes(NAME_ROWS, AS_OF)}, e AS (SELECT DISTINCT p_name AS industry FROM part)
SELECT industry, coalesce(h.value_24h, 0) AS value_24h, b.avg_30d, coalesce(h.value_24h, 0) - b.avg_30d AS diff
FROM e LEFT JOIN h USING (industry) LEFT JOIN b USING (industry)
""")
def fluctuations_keep_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name, with 0 where it is silent on the day and NULL where it was silent before."""
    names = load(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS industry")
    return fluctuation.fluctuations(load(spark, sf_dir, "lineitem"), names, AS_OF, cols=LINE_FACTS, keep_missing=True)


@query(f"""
WITH o AS ({NAME_ROWS}),
e AS (SELECT DISTINCT p_name AS industry FROM part),
bounds AS (SELECT min(d) AS low, max(d) AS high FROM o),
spine AS (SELECT industry, CAST(unnest(generate_series(low - 31, high, INTERVAL 1 DAY)) AS DATE) AS d FROM e, bounds),
dd AS (SELECT industry, d, sum(v) AS v FROM o GROUP BY industry, d),
f AS (SELECT industry, d, coalesce(v, 0) AS v FROM spine LEFT JOIN dd USING (industry, d)),
w AS (SELECT industry, d, CAST(v AS DOUBLE) AS value_24h,
             CAST(sum(v) OVER (PARTITION BY industry ORDER BY d ROWS BETWEEN 31 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 31 AS avg_30d
      FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY abs(value_24h - avg_30d) DESC, industry) AS rk
      FROM w, bounds WHERE d >= low)
SELECT d AS aggregation_date, industry, CAST(rk AS INTEGER) AS rank, value_24h, avg_30d, value_24h - avg_30d AS diff
FROM r WHERE rk <= 3
""")
def fluctuations_backfill_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days with both options: every name on every day."""
    names = load(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS industry")
    return fluctuation.backfill_fluctuations(
        load(spark, sf_dir, "lineitem"), names, cols=LINE_FACTS, zero_fill=True, keep_missing=True)


@query(f"{BACKFILL} AND d BETWEEN DATE '{AS_OF - timedelta(days=400)}' AND DATE '{AS_OF}'")
def fluctuations_backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days asked for only; the first of them has its whole baseline."""
    return fluctuation.backfill_fluctuations(
        load(spark, sf_dir, "orders"), segments(spark, sf_dir), cols=ORDER_FACTS,
        first=AS_OF - timedelta(days=400), last=AS_OF)


@query("""
SELECT p_name AS industry, CAST(l_shipdate AS DATE) AS date,
       CAST(sum(CAST(l_extendedprice * l_discount AS DECIMAL(28,6))) AS DOUBLE) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
""")
def daily_sum_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of more than two decimals are summed as they are."""
    facts = load(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"))
    names = load(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_name AS industry")
    daily = fluctuation.daily_sums(facts, names, cols=fluctuation.Facts("l_partkey", "l_shipdate", "discount"))
    return daily.withColumn("total", F.col("total").cast("double"))
