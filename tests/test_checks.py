"""Violations are counted by the writes themselves."""

import json
import logging
from datetime import date

from pyspark.sql import functions as F

from orderpulse import model
from orderpulse.operators.checks import Check, Counted
from orderpulse.operators.changelog import replace_table
from orderpulse.operators.sinks import append_by_position, overwrite_partition
from orderpulse.plans import daily_fluctuations
from orderpulse.plans.initial_load import load_all, standard_sources
from orderpulse.sources.batch import read_table
from orderpulse.streaming.orders import STREAM_TABLES, store_silver
from tests.conftest import rows

D1 = date(2024, 1, 2)


def violations(spark, to):
    return rows(read_table(spark, to.database, "load_checks").select("table_name", "column_name", "problem", "n_rows", "epoch"))


def test_rows_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    source = spark.range(100, numPartitions=3).mapInPandas(seen, "id long")
    counted = Counted(source, [Check("id", "odd", F.col("id") % 2 == 1), Check("id", "negative", F.col("id") < 0)])
    counted.rows.where("id < 10").write.parquet(str(tmp_path / "out"))
    assert counted.counts() == [("id", "odd", 50)] and read.value == 100
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_bulk_load_stores_its_violations(spark, target, tmp_path):
    base = tmp_path / "in"
    files = {
        "Customers/a.csv": "customer_id,company_name,specialized_industries\nc1,acme,P\n,bolt,R\nc3,,\n",
        "Industries/a.csv": "industry\nP\n",
        "Products/a.csv": "product_id,product_name,price\np1,one,1.5\np2,two,cheap\n,three,x\np4,four,\n",
        "Orders/a.json": "".join(json.dumps(o) + "\n" for o in [
            {"order_id": "1", "customer_id": "c1", "amount": 5.0, "timestamp": "2023-08-04T10:00:00Z"},
            {"order_id": "2", "customer_id": None, "amount": 1e30, "timestamp": "2023-08-04T10:00:00Z"},
            {"order_id": "3", "customer_id": "c1", "amount": 1e-9, "timestamp": "later"}]) + "junk\n"}
    for name, text in files.items():
        (base / name).parent.mkdir(parents=True)
        (base / name).write_text(text)
    to = target()
    expected = [("customers", "customer_id", "missing", 1, 0), ("orders", "amount", "no amount", 2, 0), ("orders", "customer_id", "missing", 2, 0),
                ("orders", "order_id", "missing", 1, 0), ("orders", "timestamp", "missing", 2, 0),
                ("products", "price", "not DOUBLE", 2, 0), ("products", "product_id", "missing", 1, 0)]
    for _ in range(2):
        load_all(spark, standard_sources(str(base)), to)
        assert violations(spark, to) == expected
    assert rows(read_table(spark, to.database, "products").select("product_id", "price")) == [
        (None, None), ("p1", 1.5), ("p2", None), ("p4", None)]
    assert read_table(spark, to.database, "orders").count() == 1 and read_table(spark, to.database, "order_rejects").count() == 3
    (base / "Products/a.csv").write_text("product_id,product_name,price\np1,one,1.5\n")
    load_all(spark, standard_sources(str(base)), to)
    assert violations(spark, to) == expected[:5]


def test_order_stream_stores_its_violations(spark, target):
    to = target(*STREAM_TABLES)
    good = {"order_id": "1", "customer_id": "c", "amount": 1.0, "timestamp": "2024-01-01T12:00:00Z", "order_lines": []}

    def store(epoch, *orders):
        values = [(o if isinstance(o, str) else json.dumps(o)).encode() for o in orders]
        store_silver(spark.createDataFrame([(v,) for v in values], "value binary"), epoch, to.database, "s")

    store(0, good)
    assert violations(spark, to) == []
    for _ in range(2):
        store(1, good, "junk", {**good, "amount": 1e40})
        assert violations(spark, to) == [("orders", "amount", "no amount", 1, 1), *(
            ("orders", c, "missing", 1, 1) for c in ("customer_id", "order_id", "timestamp"))]
    store(1, good)
    assert violations(spark, to) == []


def test_the_daily_job_tells_what_it_leaves_out(spark, target, caplog):
    """Orders that came another way than the loads may hold amounts that can't be summed."""
    to = target(*model.WAREHOUSE)
    data = [("c", 1e30, date(2024, 1, 1)), ("c", float("nan"), date(2024, 1, 2)), ("c", 5.0, date(2024, 1, 2)), ("c", 1e30, date(2020, 1, 1))]
    orders = spark.createDataFrame([(str(n), *d) for n, d in enumerate(data)], "order_id string, customer_id string, amount double, order_date date")
    overwrite_partition(orders.withColumn("timestamp", F.to_timestamp("order_date")), model.ORDERS, to.database, {"stream_id": "s", "epoch": 0})
    assert daily_fluctuations.run(spark, to.database, to.root, D1) == []  # nobody is known: no order is read
    replace_table(spark.createDataFrame([("c", "A", D1)], model.CUSTOMERS.schema), model.CUSTOMERS, to.database)
    replace_table(spark.createDataFrame([("A", "P", D1)], model.COMPANIES.schema), model.COMPANIES, to.database)
    append_by_position(spark.createDataFrame([("P", D1)], model.INDUSTRIES.schema), model.INDUSTRIES, to.database)
    with caplog.at_level(logging.INFO):
        assert len(daily_fluctuations.run(spark, to.database, to.root, D1)) == 1
    assert "2 amounts are too large" in caplog.text
