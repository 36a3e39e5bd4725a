"""JSON in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.model import ORDER_DOCUMENT
from orderpulse.operators.documents import order_line_rows, parse_orders
from orderpulse.queries.inputs import LINES, document_files, load, order_documents
from orderpulse.queries.registry import query
from orderpulse.sources.batch import read_json_lines

LINE_COLUMNS = ["order_id", "product_id", "price", "volume", "order_date"]


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS amount,
       CAST(o_orderdate AS DATE) AS order_date, count(l_orderkey) AS n_lines
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
""")
def scan_json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_json_lines(spark, document_files(spark, sf_dir), ORDER_DOCUMENT)
    return documents.select("order_id", "customer_id", "amount", F.to_date("timestamp").alias("order_date"),
                            F.size("order_lines").cast("bigint").alias("n_lines"))


@query(LINES)
def order_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as message text and back."""
    documents = order_documents(spark, sf_dir)
    messages = documents.select(F.to_json(F.struct(*documents.columns)).cast("binary").alias("value"))
    return order_line_rows(parse_orders(messages)).select(LINE_COLUMNS)


@query(LINES)
def order_lines_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_line_rows(order_documents(spark, sf_dir)).select(LINE_COLUMNS)


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def event_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k INT").alias("p")).select(
        "event_id", "event_type", "p.*")
