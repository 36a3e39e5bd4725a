"""Streams run to the end of their input, and what they left in their tables."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse import model
from orderpulse.operators.bridge import BRIDGE
from orderpulse.operators.changelog import replace_table
from orderpulse.operators.compaction import fold_epochs, last_closed
from orderpulse.operators.documents import order_rows, parse_orders
from orderpulse.operators.sinks import read_raw
from orderpulse.operators.fluctuation import rank_days
from orderpulse.plans import daily_fluctuations
from orderpulse.plans.initial_load import load_all
from orderpulse.queries.comparison import backfill_sql, fluctuation_ctes
from orderpulse.queries.dimensions import MERGED_MEMBERS
from orderpulse.queries.inputs import (CUSTOMERS_RAW, DELIVERY, EVENT_LINES, EVENT_ORDERS, INCOMING_DAY, TARGET_DAY, delivery_csv,
                                       load, members, message_files)
from orderpulse.queries.registry import query
from orderpulse.queries.writes import LAST_DAY, new_database, raw_sources
from orderpulse.session import fresh_folder
from orderpulse.sources.batch import read_table
from orderpulse.sources.stream import customer_files, file_messages
from orderpulse.streaming.customers import run_customer_stream, store_customers
from orderpulse.streaming import customers, fluctuations
from orderpulse.streaming.daily import read_daily_totals, run_daily_totals
from orderpulse.streaming.orders import STREAM_TABLES, run_order_stream, store_silver


@query(f"""
SELECT 'order' AS kind, order_id, customer_id AS party_id, amount, 0 AS volume, order_date FROM ({EVENT_ORDERS})
UNION ALL SELECT 'line', order_id, product_id, price, volume, order_date FROM ({EVENT_LINES})
""")
def stream_orders_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables after the stream."""
    to = new_database(spark, STREAM_TABLES)
    run_order_stream(file_messages(spark, message_files(spark, sf_dir)), to.database, "orders",
                     fresh_folder(spark, "checkpoint"), available_now=True).awaitTermination()
    orders = read_table(spark, to.database, "orders").select(
        F.lit("order").alias("kind"), "order_id", F.col("customer_id").alias("party_id"), "amount",
        F.lit(0).alias("volume"), "order_date")
    lines = read_table(spark, to.database, "order_lines").select(
        F.lit("line").alias("kind"), "order_id", F.col("product_id").alias("party_id"),
        F.col("price").alias("amount"), "volume", "order_date")
    return orders.unionByName(lines)


@query(f"""
SELECT 'raw' AS sink, order_id, amount, order_date FROM ({EVENT_ORDERS})
UNION ALL SELECT 'orders', order_id, amount, order_date FROM ({EVENT_ORDERS})
UNION ALL SELECT 'lines', order_id, price, order_date FROM ({EVENT_LINES})
""")
def stream_orders_multisink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw copy and both tables, all written from one batch."""
    to = new_database(spark, STREAM_TABLES)
    raw_path = fresh_folder(spark, "raw")
    run_order_stream(file_messages(spark, message_files(spark, sf_dir)), to.database, "orders",
                     fresh_folder(spark, "checkpoint"), raw_path=raw_path, available_now=True).awaitTermination()
    raw = order_rows(parse_orders(read_raw(spark, raw_path)))
    sinks = {"raw": raw, "orders": read_table(spark, to.database, "orders"),
             "lines": read_table(spark, to.database, "order_lines").withColumnRenamed("price", "amount")}
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("sink"), "order_id", "amount", "order_date") for name, df in sinks.items()])


@query(EVENT_LINES)
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several epochs, each stored twice as after a crash before its commit; then a restart."""
    to = new_database(spark, STREAM_TABLES)
    path = message_files(spark, sf_dir)
    checkpoint = fresh_folder(spark, "checkpoint")

    def store_twice(batch: DataFrame, epoch: int) -> None:
        for _ in range(2):
            store_silver(batch, epoch, to.database, "orders")

    files = spark.read.schema(model.MESSAGE).parquet(path).inputFiles()
    messages = file_messages(spark, path, max_files_per_trigger=max(1, len(files) // 2))
    (messages.writeStream.foreachBatch(store_twice).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    run_order_stream(file_messages(spark, path), to.database, "orders", checkpoint,
                     available_now=True).awaitTermination()
    return read_table(spark, to.database, "order_lines").select("order_id", "product_id", "price", "volume", "order_date")


@query(EVENT_LINES)
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several epochs, of which the closed ones are folded; then the stream starts again and the rest is folded."""
    to = new_database(spark, STREAM_TABLES)
    path, checkpoint = message_files(spark, sf_dir), fresh_folder(spark, "checkpoint")
    files = spark.read.schema(model.MESSAGE).parquet(path).inputFiles()
    run_order_stream(file_messages(spark, path, max(1, len(files) // 3)), to.database, "orders", checkpoint,
                     available_now=True).awaitTermination()
    for keep_open in (1, 0):
        last = last_closed(spark, model.ORDER_LINES, to.database, "orders") + 1
        fold_epochs(spark, model.ORDER_LINES, to.database, "orders", last - keep_open, min_age=timedelta(0))
        run_order_stream(file_messages(spark, path), to.database, "orders", checkpoint, available_now=True).awaitTermination()
    return read_table(spark, to.database, "order_lines").select("order_id", "product_id", "price", "volume", "order_date")


@query(f"""
SELECT 'customer' AS kind, customer_id AS id, company_name AS value, ingest_date FROM ({MERGED_MEMBERS})
UNION ALL SELECT DISTINCT 'company', company_name, unnest(string_split(specialized_industries, ';')),
                 DATE '{INCOMING_DAY}' FROM ({DELIVERY})
""")
def stream_customers_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and bridge after a delivery of files reached existing customers."""
    to = new_database(spark, customers.STREAM_TABLES)
    replace_table(members(spark, sf_dir).withColumn("ingest_date", F.lit(TARGET_DAY)),
                  model.CUSTOMERS, to.database)
    run_customer_stream(customer_files(spark, delivery_csv(spark, sf_dir)), to.database,
                        fresh_folder(spark, "checkpoint"), ingest_date=INCOMING_DAY,
                        available_now=True).awaitTermination()
    stored = read_table(spark, to.database, "customers").toDF("id", "value", "ingest_date")
    companies = read_table(spark, to.database, "companies").select(*BRIDGE, "ingest_date").toDF(
        "id", "value", "ingest_date")
    return stored.select(F.lit("customer").alias("kind"), "*").unionByName(
        companies.select(F.lit("company").alias("kind"), "*"))


@query("""
SELECT event_type AS industry, CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY ALL
""")
def stream_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all days, open ones too."""
    path = fresh_folder(spark, "daily")
    source = fresh_folder(spark, "events")
    load(spark, sf_dir, "events").select(
        F.col("event_type").alias("industry"), "value",
        F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00"))).alias("ts"),
    ).write.parquet(source)
    rows = spark.readStream.schema("industry STRING, value DOUBLE, ts TIMESTAMP").parquet(source)
    run_daily_totals(rows, "industry", "ts", "value", path, fresh_folder(spark, "checkpoint"),
                     available_now=True).awaitTermination()
    return read_daily_totals(spark, path, "industry").withColumn("total", F.col("total").cast("double"))


EVENT_ROWS = "SELECT event_type AS industry, CAST(ts AS DATE) AS d, CAST(value AS DECIMAL(18,2)) AS v FROM events"


@query(backfill_sql(EVENT_ROWS))
def stream_fluctuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's ranking by event type. A tenth of the events comes three days late, when most of their days are closed.

    Days that the watermark closed come from the table, those still open at the end from the stream's state.
    """
    source, checkpoint = fresh_folder(spark, "arrivals"), fresh_folder(spark, "checkpoint")
    moment = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))
    arrival = F.col("ts") + F.when(F.col("event_id") % 10 == 0, F.expr("INTERVAL 3 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    events = load(spark, sf_dir, "events").withColumn("arrival", arrival)
    events.select(F.col("event_type").alias("industry"), moment.alias("moment"), F.col("value").alias("amount"), "arrival") \
        .repartitionByRange(4, "arrival").write.parquet(source)
    to = new_database(spark, fluctuations.STREAM_TABLES)
    rows = spark.readStream.schema("industry STRING, moment TIMESTAMP, amount DOUBLE").option("maxFilesPerTrigger", 1).parquet(source)
    fluctuations.run_fluctuation_stream(rows, to.database, checkpoint, delay="1 day", available_now=True).awaitTermination()
    last, = spark.table(f"{to.database}.entity_days").where("NOT late").agg(F.max("date")).first()
    days = fluctuations.read_entity_days(spark, to.database).unionByName(fluctuations.open_days(spark, checkpoint))
    still_open = rank_days(days).where(F.lit(True) if last is None else F.col("aggregation_date") > F.lit(last))
    return read_table(spark, to.database, "fluctuations").unionByName(still_open)


MOVED = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, n_name || ' MOVED' AS company_name, r_name AS specialized_industries
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 3 = 0
"""


@query(f"""
WITH c AS ({CUSTOMERS_RAW}), m AS ({MOVED}),
bridge AS (SELECT DISTINCT company_name, unnest(string_split(specialized_industries, ';')) AS industry
           FROM (SELECT * FROM c UNION ALL SELECT * FROM m)),
members AS (SELECT customer_id, coalesce(m.company_name, c.company_name) AS company_name FROM c LEFT JOIN m USING (customer_id)),
known AS (SELECT c_mktsegment AS industry FROM customer UNION SELECT r_name FROM region),
dims AS (SELECT DISTINCT customer_id, industry FROM members JOIN bridge USING (company_name) JOIN known USING (industry)),
{fluctuation_ctes("""
SELECT dims.industry, CAST(ts AS DATE) AS d, CAST(value AS DECIMAL(18,2)) AS v
FROM events JOIN dims ON CAST(user_id AS VARCHAR) = dims.customer_id
""", LAST_DAY)}
SELECT DATE '{LAST_DAY}' AS aggregation_date, * FROM ranked WHERE rank <= 3
""")
def daily_job_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job from kept sums, run amid the order stream and again at its end, when a third of the customers has moved."""
    to = new_database(spark, STREAM_TABLES)
    load_all(spark, raw_sources(spark, sf_dir, leave_out=(model.ORDERS,)), to)
    path, checkpoint = message_files(spark, sf_dir), fresh_folder(spark, "checkpoint")
    files = spark.read.schema(model.MESSAGE).parquet(path).inputFiles()
    stream = run_order_stream(file_messages(spark, path, max(1, len(files) // 2)), to.database, "orders", checkpoint, available_now=True)
    for epoch in range(2):
        if epoch:
            stream.awaitTermination()
            store_customers(moved_customers(spark, sf_dir), to.database, INCOMING_DAY)
        daily_fluctuations.run(spark, to.database, to.root, LAST_DAY, maintained=True)
    return read_table(spark, to.database, "fluctuations")


def moved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = load(spark, sf_dir, "customer").where("c_custkey % 3 = 0")
    return customers.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.concat("n_name", F.lit(" MOVED")).alias("company_name"),
        F.col("r_name").alias("specialized_industries"))
