"""Tables: scans through the catalog, DDL, appends, overwrites, the bulk load."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse import model
from orderpulse.operators import sinks
from orderpulse.operators.bridge import build_bridge, merge_bridge
from orderpulse.operators.changelog import replace_table
from orderpulse.operators.fluctuation import top_fluctuations
from orderpulse.operators.tables import ensure_tables
from orderpulse.operators.tables import schema_violations as violations
from orderpulse.plans import daily_fluctuations
from orderpulse.plans.initial_load import SourceSpec, Target, load_all, standard_sources
from orderpulse.queries.comparison import fluctuation_ctes
from orderpulse.queries.dimensions import UNION_BRIDGE
from orderpulse.queries.inputs import (AS_OF, CUSTOMERS_RAW, INCOMING_DAY, ORDER_FACTS, PRODUCTS_RAW, SEGMENT_ROWS, TARGET_DAY,
                                       companies_raw, customer_csv, industry_csv, later_companies_raw, load,
                                       order_files, product_csv, products_raw, segments)
from orderpulse.queries.registry import query
from orderpulse.session import fresh_folder
from orderpulse.sources.batch import read_csv, read_table


def new_database(spark: SparkSession, specs=()) -> Target:
    """An empty database in a folder of its own below the shared folder."""
    name = f"orderpulse_{uuid.uuid4().hex[:12]}"
    target = Target(name, fresh_folder(spark, name), TARGET_DAY)
    ensure_tables(spark, name, target.root, specs)
    return target


@query(CUSTOMERS_RAW)
def scan_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, customer_csv(spark, sf_dir), model.CUSTOMERS_CSV)


@query("SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given file as a table in the catalog; nothing is copied."""
    to = new_database(spark)
    spark.catalog.createTable(f"{to.database}.orders", path=f"{sf_dir}/orders.parquet", source="parquet")
    return read_table(spark, to.database, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_date"))


@query(PRODUCTS_RAW)
def ddl_create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables are made from their specs, twice; products is loaded in between."""
    to = new_database(spark, model.WAREHOUSE)
    sinks.append_by_position(products_raw(spark, sf_dir).withColumn("ingest_date", F.lit(TARGET_DAY)),
                             model.PRODUCTS, to.database)
    ensure_tables(spark, to.database, to.root, model.WAREHOUSE)
    return read_table(spark, to.database, "products").drop("ingest_date")


PLACED_ORDERS = model.TableSpec("placed_orders", (("customer", "BIGINT"), ("amount", "DOUBLE")), clustered=("customer", 8))
PLACED_CUSTOMERS = model.TableSpec("placed_customers", (("customer", "BIGINT"), ("segment", "STRING")), clustered=("customer", 8))


def placed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment, from tables that are stored by customer; neither side is moved."""
    to = new_database(spark, [PLACED_ORDERS, PLACED_CUSTOMERS])
    sinks.append_by_position(load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("amount")), PLACED_ORDERS, to.database)
    sinks.append_by_position(load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("segment")), PLACED_CUSTOMERS, to.database)
    orders, customers = (read_table(spark, to.database, t.name) for t in (PLACED_ORDERS, PLACED_CUSTOMERS))
    return orders.hint("merge").join(customers, "customer")


@query("""
SELECT c_mktsegment AS segment, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")
def join_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_join(spark, sf_dir).groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"))


SIZES_BEFORE = model.TableSpec("sizes", (("product_id", "STRING"), ("size", "INT"), ("ingest_date", "DATE")), ("ingest_date",),
                               ("product_id",))
SIZES_NOW = model.TableSpec("sizes", (("product_id", "STRING"), ("size", "BIGINT"), ("brand", "STRING"), ("ingest_date", "DATE")),
                            ("ingest_date",), ("product_id",))


@query(f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_size AS BIGINT) AS size, NULL AS brand, DATE '{TARGET_DAY}' AS ingest_date
FROM part UNION ALL
SELECT CAST(p_partkey AS VARCHAR), 10000000000 + p_size, p_brand, DATE '{INCOMING_DAY}' FROM part
""")
def ddl_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of an older spec gets a wider type and a new column, and then rows that need both."""
    to = new_database(spark, [SIZES_BEFORE])
    sizes = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    sinks.append_by_position(sizes.withColumn("ingest_date", F.lit(TARGET_DAY)), SIZES_BEFORE, to.database)
    ensure_tables(spark, to.database, to.root, [SIZES_NOW])
    later = sizes.withColumn("size", F.lit(10_000_000_000) + F.col("size")).withColumn("ingest_date", F.lit(INCOMING_DAY))
    sinks.append_by_position(later, SIZES_NOW, to.database)
    return read_table(spark, to.database, "sizes")


@query(f"SELECT *, DATE '{TARGET_DAY}' AS ingest_date FROM ({PRODUCTS_RAW}) UNION ALL "
       f"SELECT *, DATE '{TARGET_DAY + timedelta(days=1)}' AS ingest_date FROM ({PRODUCTS_RAW})")
def sink_append_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days' deliveries of the whole table, one after the other."""
    to = new_database(spark, [model.PRODUCTS])
    for day in (TARGET_DAY, TARGET_DAY + timedelta(days=1)):
        sinks.append_by_position(products_raw(spark, sf_dir).withColumn("ingest_date", F.lit(day)),
                                 model.PRODUCTS, to.database)
    return read_table(spark, to.database, "products")


@query("""
SELECT event_id, event_type, value, CAST(ts AS DATE) AS event_date, 'first' AS load FROM events
UNION ALL SELECT event_id, event_type, value, CAST(ts AS DATE), 'second' FROM events
""")
def sink_append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by name to a table partitioned by day; the second in another column order."""
    to = new_database(spark)
    rows = load(spark, sf_dir, "events").select("event_id", "event_type", "value", F.to_date("ts").alias("event_date"))
    table = f"{to.database}.events_by_day"
    sinks.append_by_name(rows.select("*", F.lit("first").alias("load")), table, ["event_date"])
    sinks.append_by_name(rows.select(F.lit("second").alias("load"), *reversed(rows.columns)), table, ["event_date"])
    return spark.table(table)


@query(UNION_BRIDGE)
def sink_full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge is replaced by a merge that reads it."""
    to = new_database(spark, [model.COMPANIES])
    day = F.lit(TARGET_DAY)
    replace_table(build_bridge(companies_raw(spark, sf_dir)).withColumn("ingest_date", day),
                        model.COMPANIES, to.database)
    merged = merge_bridge(read_table(spark, to.database, "companies"), build_bridge(later_companies_raw(spark, sf_dir)))
    replace_table(merged.withColumn("ingest_date", day), model.COMPANIES, to.database)
    return read_table(spark, to.database, "companies").select("company_name", "industry")


def _day(as_of: date) -> str:
    return (f"(WITH {fluctuation_ctes(SEGMENT_ROWS, as_of)} "
            f"SELECT DATE '{as_of}' AS aggregation_date, * FROM ranked WHERE rank <= 3)")


@query(" UNION ALL ".join(f"SELECT * FROM {_day(day)}" for day in (AS_OF, AS_OF + timedelta(days=1))))
def sink_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days are stored, the second one twice."""
    to = new_database(spark, [model.FLUCTUATIONS])
    next_day = AS_OF + timedelta(days=1)
    for as_of in (AS_OF, next_day, next_day):
        top = top_fluctuations(load(spark, sf_dir, "orders"), segments(spark, sf_dir), as_of, cols=ORDER_FACTS)
        sinks.overwrite_partition(top, model.FLUCTUATIONS, to.database, {"aggregation_date": as_of})
    return read_table(spark, to.database, "fluctuations")


@query("SELECT event_id AS \"offset\", event_type, value AS amount, CAST(ts AS DATE) AS ingest_date FROM events")
def sink_raw_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, kept as compressed JSON by day and read back."""
    path = fresh_folder(spark, "raw")
    messages = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("offset"), F.to_json(F.struct("event_type", "value")).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"))
    sinks.store_raw(messages, path, "events", 0)
    event = F.from_json("value", "event_type STRING, value DOUBLE").alias("event")
    return sinks.read_raw(spark, path).select("offset", "ingest_date", event).select(
        "offset", "event.event_type", F.col("event.value").alias("amount"), "ingest_date")


def raw_sources(spark: SparkSession, sf_dir: str, leave_out: tuple[model.TableSpec, ...] = ()) -> list[SourceSpec]:
    """The raw files, written for the sources that are asked for: `leave_out` names tables that another way fills."""
    paths = {"Customers": customer_csv, "Industries": industry_csv, "Orders": order_files, "Products": product_csv}
    wanted = [s for s in standard_sources("") if not any(t in leave_out for t in s.tables)]
    return [replace(s, path=paths[s.path.rsplit("/", 1)[1]](spark, sf_dir)) for s in wanted]


@query(f"""
WITH c AS ({CUSTOMERS_RAW})
SELECT 'customers' AS table_name, count(*) AS n_rows FROM c
UNION ALL SELECT 'companies', count(*) FROM (
  SELECT DISTINCT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM c)
UNION ALL SELECT 'industries', (SELECT count(DISTINCT c_mktsegment) FROM customer) + (SELECT count(*) FROM region)
UNION ALL SELECT 'orders', count(*) FROM events
UNION ALL SELECT 'order_lines', 2 * count(*) FROM events
UNION ALL SELECT 'products', count(*) FROM part
""")
def initial_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four raw inputs to six tables, with the number of rows in each."""
    to = new_database(spark)
    load_all(spark, raw_sources(spark, sf_dir), to, full_refresh=True)
    counts = [
        read_table(spark, to.database, name).agg(
            F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in ("customers", "companies", "industries", "orders", "order_lines", "products")
    ]
    return reduce(DataFrame.unionByName, counts)


LAST_DAY = date(2024, 1, 30)


@query(f"""
WITH c AS ({CUSTOMERS_RAW}),
bridge AS (SELECT DISTINCT company_name, unnest(string_split(specialized_industries, ';')) AS industry FROM c),
dims AS (SELECT DISTINCT customer_id, industry FROM c JOIN bridge USING (company_name)),
{fluctuation_ctes('''
SELECT dims.industry, CAST(ts AS DATE) AS d, CAST(value AS DECIMAL(18,2)) AS v
FROM events JOIN dims ON CAST(user_id AS VARCHAR) = dims.customer_id
''', LAST_DAY)}
SELECT DATE '{LAST_DAY}' AS aggregation_date, * FROM ranked WHERE rank <= 3
""")
def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to tables, tables to the customer-industry dimension, and the day's stored result."""
    to = new_database(spark)
    load_all(spark, raw_sources(spark, sf_dir), to)
    daily_fluctuations.run(spark, to.database, to.root, LAST_DAY)
    return read_table(spark, to.database, "fluctuations")


CHECKED_ORDERS = model.TableSpec(
    "checked_orders",
    (("o_orderkey", "BIGINT"), ("o_totalprice", "DOUBLE"), ("o_orderdate", "DATE"), ("o_orderpriority", "INT"),
     ("o_comment", "STRING")),
    required=("o_orderkey", "o_comment"),
)


@query("""
SELECT 'o_orderpriority' AS column_name, 'not INT' AS problem, count(*) AS n_rows FROM orders
WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL HAVING count(*) > 0
UNION ALL SELECT 'o_comment', 'missing', count(*) FROM orders HAVING count(*) > 0
""")
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text against a spec with a wrong type and a column they lack."""
    raw = load(spark, sf_dir, "orders")
    return violations(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]), CHECKED_ORDERS)
