"""The given tables as the model's inputs, each next to the same rows in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.operators.documents import nest_orders
from orderpulse.operators.fluctuation import Facts
from orderpulse.session import fresh_folder

AS_OF = date(1998, 3, 3)
TARGET_DAY = date(2024, 1, 1)
INCOMING_DAY = date(2024, 1, 2)

ORDER_FACTS = Facts(member="o_custkey", moment="o_orderdate", amount="o_totalprice")
LINE_FACTS = Facts(member="l_partkey", moment="l_shipdate", amount="l_extendedprice")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- single-valued entity: customer -> market segment -----------------------------------

def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("industry"))


SEGMENT_ROWS = """
SELECT c_mktsegment AS industry, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS v
FROM orders JOIN customer ON o_custkey = c_custkey
"""


# --- multi-valued entity: part -> the words of its name -----------------------------------

def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.explode(F.split("p_name", " ")).alias("industry")).distinct()


WORD_ROWS = """
SELECT w.industry, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
FROM lineitem
JOIN (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS industry FROM part) w ON l_partkey = w.p_partkey
"""


# --- companies with lists of industries, as they arrive ------------------------------------

def companies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies are brand and size; some rows have no list, some companies never do."""
    return load(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_brand", "p_size").alias("company_name"),
        F.when(F.col("p_type") != "ECONOMY", F.translate("p_name", " ", ";")).alias("specialized_industries"))


COMPANIES_RAW = """
SELECT p_brand || '/' || p_size AS company_name,
       CASE WHEN p_type <> 'ECONOMY' THEN replace(p_name, ' ', ';') END AS specialized_industries
FROM part
"""


def later_companies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery: the same companies, their lists now led by the part type."""
    return load(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_brand", "p_size").alias("company_name"),
        F.concat_ws(";", F.lower("p_type"), F.translate("p_name", " ", ";")).alias("specialized_industries"))


LATER_COMPANIES_RAW = """
SELECT p_brand || '/' || p_size AS company_name,
       lower(p_type) || ';' || replace(p_name, ' ', ';') AS specialized_industries
FROM part
"""


# --- customer -> company -> industry chain ---------------------------------------------------
# Companies are brands and work in the words of their parts' names; industries are the part
# types, so that some words are no industry and some industries have no company.

def chain_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.concat(F.lit("Brand#"), "c_nationkey").alias("company_name"))


def chain_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("company_name"), F.explode(F.split("p_name", " ")).alias("industry")).distinct()


def chain_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(F.lower("p_type").alias("industry")).distinct()


CHAIN = """
cu AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Brand#' || c_nationkey AS company_name FROM customer),
co AS (SELECT DISTINCT p_brand AS company_name, unnest(string_split(p_name, ' ')) AS industry FROM part),
ind AS (SELECT DISTINCT lower(p_type) AS industry FROM part)
"""


# --- customer master and a later delivery ------------------------------------------------------
# Master: customers and suppliers. Delivery: customers, some renamed, and parts as new members.

def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"), F.col("c_nationkey").alias("n_nationkey"),
        F.col("c_acctbal").alias("balance"))
    suppliers = load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("customer_id"), F.col("s_nationkey").alias("n_nationkey"),
        F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers).join(nation, "n_nationkey").select(
        "customer_id", F.when(F.col("balance") >= 0, F.col("n_name")).alias("company_name"))


MEMBERS = """
SELECT id AS customer_id, CASE WHEN balance >= 0 THEN n_name END AS company_name
FROM (SELECT 'C' || c_custkey AS id, c_nationkey AS nk, c_acctbal AS balance FROM customer
      UNION ALL SELECT 'S' || s_suppkey, s_nationkey, s_acctbal FROM supplier)
JOIN nation ON nk = n_nationkey
"""


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    segment = F.col("c_mktsegment")
    customers = load(spark, sf_dir, "customer").join(nation, "c_nationkey").select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"),
        F.when(segment == "BUILDING", F.concat("n_name", F.lit("_NEW")))
        .when(segment != "MACHINERY", F.col("n_name")).alias("company_name"),
        F.lower(segment).alias("specialized_industries"))
    parts = load(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("customer_id"), F.col("p_brand").alias("company_name"),
        F.when(F.col("p_type") != "ECONOMY", F.translate("p_name", " ", ";")).alias("specialized_industries"))
    return customers.unionByName(parts)


DELIVERY = """
SELECT 'C' || c_custkey AS customer_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN n_name || '_NEW' WHEN 'MACHINERY' THEN NULL ELSE n_name END AS company_name,
       lower(c_mktsegment) AS specialized_industries
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'P' || p_partkey, p_brand, CASE WHEN p_type <> 'ECONOMY' THEN replace(p_name, ' ', ';') END FROM part
"""


# --- order documents, messages and raw files ------------------------------------------------------

def orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))


def lines_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("volume"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_orders(orders_flat(spark, sf_dir), lines_flat(spark, sf_dir))


LINES = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS volume, CAST(o_orderdate AS DATE) AS order_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# --- the event stream as orders ---------------------------------------------------------------------
# An event is an order of its user with two lines: one for its type, one for its property.

def event_documents(events: DataFrame) -> DataFrame:
    events = events.withColumn("k", F.from_json("props", "k INT")["k"])
    by_type = F.struct(F.col("value").alias("price"), F.col("event_type").alias("product_id"), F.col("k").alias("volume"))
    by_property = F.struct(
        F.col("value").alias("price"), F.concat(F.lit("k"), "k").alias("product_id"), F.lit(1).alias("volume"))
    return events.select(
        F.col("event_id").cast("string").alias("order_id"), F.col("user_id").cast("string").alias("customer_id"),
        F.array(by_type, by_property).alias("order_lines"), F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def event_messages(events: DataFrame, files: int) -> DataFrame:
    """Messages in offset order in so many partitions. Events are dealt out, not their text, which is longer and would be
    made twice: once to find the ranges."""
    documents = event_documents(events.repartitionByRange(files, "event_id"))
    return documents.select(
        F.col("customer_id").cast("binary").alias("key"),
        F.to_json(F.struct(*documents.columns)).cast("binary").alias("value"),
        F.lit("orders").alias("topic"), F.lit(0).alias("partition"),
        F.col("order_id").cast("bigint").alias("offset"), "timestamp")


EVENT_ORDERS = """
SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id, value AS amount,
       CAST(ts AS DATE) AS order_date
FROM events
"""

EVENT_LINES = """
SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS product_id, value AS price,
       CAST(json_extract(props, '$.k') AS INTEGER) AS volume, CAST(ts AS DATE) AS order_date FROM events
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'k' || json_extract(props, '$.k'), value, 1, CAST(ts AS DATE) FROM events
"""


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer file: a company is a nation's segment, its list names segment and region."""
    places = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return load(spark, sf_dir, "customer").join(places, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("company_name"),
        F.when(F.col("c_acctbal") >= 0, F.concat_ws(";", "c_mktsegment", "r_name")).alias("specialized_industries"))


CUSTOMERS_RAW = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name || ' ' || c_mktsegment AS company_name,
       CASE WHEN c_acctbal >= 0 THEN c_mktsegment || ';' || r_name END AS specialized_industries
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def industries_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known industries: segments and regions."""
    return load(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("industry")).distinct().unionByName(
        load(spark, sf_dir, "region").select(F.col("r_name").alias("industry")))


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price"))


PRODUCTS_RAW = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_retailprice AS price FROM part
"""

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Write an input once per application; its readers share it."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = fresh_folder(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def document_files(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Documents", lambda path: order_documents(spark, sf_dir).write.json(path))


def order_files(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Orders", lambda path: event_documents(load(spark, sf_dir, "events")).write.json(path))


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Customers",
                 lambda path: customers_raw(spark, sf_dir).write.option("header", True).csv(path))


def industry_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Industries",
                 lambda path: industries_raw(spark, sf_dir).write.option("header", True).csv(path))


def product_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Products",
                 lambda path: products_raw(spark, sf_dir).write.option("header", True).csv(path))


def delivery_csv(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "Delivery",
                 lambda path: delivery(spark, sf_dir).write.option("header", True).csv(path))


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """Messages in offset order over several files, so that a stream can take several epochs."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _once(spark, sf_dir, "Messages",
                 lambda path: event_messages(load(spark, sf_dir, "events"), files).write.parquet(path))
