"""Bridges, dimensions and the upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators import bridge
from orderpulse.operators.upsert import merge_upsert as upsert
from orderpulse.queries.inputs import (CHAIN, COMPANIES_RAW, DELIVERY, INCOMING_DAY, LATER_COMPANIES_RAW, MEMBERS,
                                       TARGET_DAY, chain_companies, chain_customers, chain_industries, companies_raw,
                                       delivery, later_companies_raw, members)
from orderpulse.queries.registry import query


@query(f"SELECT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM ({COMPANIES_RAW})")
def tags_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.explode_list(companies_raw(spark, sf_dir), "specialized_industries", "industry")


INITIAL_BRIDGE = f"""
WITH c AS ({COMPANIES_RAW}),
e AS (SELECT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM c),
n AS (SELECT company_name FROM c WHERE specialized_industries IS NULL)
SELECT DISTINCT coalesce(e.company_name, n.company_name) AS company_name, e.industry
FROM e FULL JOIN n ON e.company_name = n.company_name
"""


@query(INITIAL_BRIDGE)
def company_bridge_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.build_bridge(companies_raw(spark, sf_dir), keep_unclassified=True)


UNION_BRIDGE = f"""
SELECT DISTINCT company_name, industry FROM (
  SELECT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM ({COMPANIES_RAW})
  UNION ALL
  SELECT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM ({LATER_COMPANIES_RAW}))
WHERE industry IS NOT NULL
"""


@query(UNION_BRIDGE)
def bridge_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.merge_bridge(
        bridge.build_bridge(companies_raw(spark, sf_dir)), bridge.build_bridge(later_companies_raw(spark, sf_dir)))


@query(f"""
SELECT company_name, string_agg(industry, ';' ORDER BY industry) AS industries
FROM ({UNION_BRIDGE}) GROUP BY company_name
""")
def company_industry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.industry_lists(bridge_union_distinct(spark, sf_dir)).select(
        "company_name", F.array_join("industries", ";").alias("industries"))


@query(f"""
WITH {CHAIN}
SELECT co.company_name, ind.industry FROM co RIGHT JOIN ind ON co.industry = ind.industry
""")
def right_outer_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.valid_companies(chain_companies(spark, sf_dir), chain_industries(spark, sf_dir))


@query(f"""
WITH {CHAIN}
SELECT cu.customer_id, d.industry FROM cu
RIGHT JOIN (SELECT co.company_name, ind.industry FROM co RIGHT JOIN ind ON co.industry = ind.industry) d
ON cu.company_name = d.company_name
""")
def customer_industry_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.customer_industries(
        chain_customers(spark, sf_dir), chain_companies(spark, sf_dir), chain_industries(spark, sf_dir))


@query(f"""
WITH {CHAIN}
SELECT DISTINCT cu.customer_id, ind.industry FROM ind
LEFT JOIN co ON ind.industry = co.industry LEFT JOIN cu ON co.company_name = cu.company_name
""")
def customer_industry_dim_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins from the industries on, in SQL.

    Each is written as matches plus rows without match: a left join can neither broadcast the
    few industries nor split a company that many customers share, an inner join can do both.
    What an anti join looks for is made distinct first, as its right side can't be split.
    """
    return spark.sql(
        """
        WITH classified AS (
          SELECT companies.company_name, industries.industry
          FROM {industries} AS industries JOIN {companies} AS companies ON companies.industry = industries.industry
        )
        SELECT customers.customer_id, classified.industry
        FROM classified JOIN {customers} AS customers ON customers.company_name = classified.company_name
        UNION
        SELECT NULL, industry FROM classified
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT company_name FROM {customers}) AS served
                          WHERE served.company_name = classified.company_name)
        UNION
        SELECT NULL, industry FROM {industries} AS industries
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT industry FROM {companies}) AS active
                          WHERE active.industry = industries.industry)
        """,
        industries=chain_industries(spark, sf_dir), companies=chain_companies(spark, sf_dir),
        customers=chain_customers(spark, sf_dir))


@query(f"""
WITH {CHAIN}
SELECT DISTINCT cu.customer_id, co.industry FROM cu JOIN co USING (company_name) JOIN ind USING (industry)
""")
def distinct_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.entity_dim(
        chain_customers(spark, sf_dir), chain_companies(spark, sf_dir), chain_industries(spark, sf_dir))


MERGED_MEMBERS = f"""
WITH a AS ({MEMBERS}), b AS ({DELIVERY}),
j AS (SELECT a.customer_id AS aid, b.customer_id AS bid, a.company_name AS ac, b.company_name AS bc,
             a.customer_id IS NULL OR coalesce(a.company_name <> b.company_name, false) AS take_b
      FROM a FULL JOIN b ON a.customer_id = b.customer_id)
SELECT coalesce(aid, bid) AS customer_id, CASE WHEN take_b THEN bc ELSE ac END AS company_name,
       CASE WHEN take_b THEN DATE '{INCOMING_DAY}' ELSE DATE '{TARGET_DAY}' END AS ingest_date FROM j
"""


@query(MERGED_MEMBERS)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = members(spark, sf_dir).withColumn("ingest_date", F.lit(TARGET_DAY))
    incoming = delivery(spark, sf_dir).select("customer_id", "company_name", F.lit(INCOMING_DAY).alias("ingest_date"))
    return upsert(target, incoming, "customer_id", "company_name")
