"""The daily comparison as one SQL statement over customers, companies and industries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from orderpulse.functions.dates import trailing_bounds

# Industries without customers have no orders to compare, so inner joins lose nothing; unlike outer
# ones they can broadcast the few industries and split a company that many customers share.
# {orders}: customer_id, moment, amount; {customers}, {companies}, {industries} as in the model.
FLUCTUATION_SQL = """
WITH dims AS (
  SELECT DISTINCT customers.customer_id, industries.industry
  FROM {industries} AS industries
  JOIN {companies} AS companies ON companies.industry = industries.industry
  JOIN {customers} AS customers ON customers.company_name = companies.company_name
),
member_days AS (
  SELECT customer_id, CAST(moment AS DATE) AS date, SUM(TRY_CAST(amount AS DECIMAL(28,6))) AS amount
  FROM {orders}
  WHERE moment >= :first AND moment < :as_of + INTERVAL 1 DAY
  GROUP BY ALL
),
daily AS (
  SELECT dims.industry, member_days.date, SUM(member_days.amount) AS total
  FROM member_days JOIN dims ON member_days.customer_id = dims.customer_id
  GROUP BY ALL
),
compared AS (
  SELECT industry,
         CAST(SUM(total) FILTER (WHERE date = :as_of) AS DOUBLE) AS value_24h,
         try_divide(CAST(SUM(total) FILTER (WHERE date < :as_of) AS DOUBLE),
                    COUNT(total) FILTER (WHERE date < :as_of)) AS avg_30d
  FROM daily GROUP BY industry
  HAVING bool_or(date = :as_of) AND bool_or(date < :as_of)
)
SELECT industry, value_24h, avg_30d, value_24h - avg_30d AS diff,
       abs(value_24h - avg_30d) AS abs_diff,
       try_divide(value_24h - avg_30d, avg_30d) * 100 AS pct_diff
FROM compared
ORDER BY abs_diff DESC NULLS LAST, industry
LIMIT :k
"""


def top_fluctuations_sql(orders: DataFrame, customers: DataFrame, companies: DataFrame,
                         industries: DataFrame, as_of: date, k: int = 3) -> DataFrame:
    first, _ = trailing_bounds(as_of)
    return orders.sparkSession.sql(
        FLUCTUATION_SQL, args={"as_of": as_of, "first": first, "k": k},
        orders=orders, customers=customers, companies=companies, industries=industries)


def top_fluctuations_in(spark: SparkSession, database: str, as_of: date, k: int = 3) -> DataFrame:
    """The same statement over the tables (or views) of a database, by their plain names after `USE`."""
    first, _ = trailing_bounds(as_of)
    names = {name: name for name in ("orders", "customers", "companies", "industries")}
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE `{database}`")
    try:
        return spark.sql(FLUCTUATION_SQL.format(**names), args={"as_of": as_of, "first": first, "k": k})
    finally:
        spark.sql(f"USE `{before}`")
