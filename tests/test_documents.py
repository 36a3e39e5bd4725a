import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderpulse.model import FRAGMENT, ORDER_DOCUMENT, TableSpec
from orderpulse.operators.documents import (lines_without_order, malformed, nest_orders, order_line_rows, order_rows,
                                            parse_orders, split_orders, without_orphans, without_spare_text)
from orderpulse.operators.tables import schema_violations
from orderpulse.sources.batch import read_csv, read_json_lines
from orderpulse.model import CUSTOMERS_CSV
from tests.conftest import rows

DOCUMENT = {"order_id": "o1", "customer_id": "c1", "amount": 12.5, "timestamp": "2024-02-29T23:30:00.000Z",
            "order_lines": [{"price": 1.5, "product_id": "p1", "volume": 2}, {"price": 9.5, "product_id": "p2", "volume": 1}]}


def messages(spark, *values):
    return spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")


def test_valid_document(spark):
    orders, lines = split_orders(parse_orders(messages(spark, json.dumps(DOCUMENT))))
    order = orders.first()
    assert (order.order_id, order.customer_id, order.amount) == ("o1", "c1", 12.5)
    assert (order.year, order.month, order.day, str(order.order_date)) == (2024, 2, 29, "2024-02-29")
    assert rows(lines.select("order_id", "product_id", "price", "volume", "day")) == [
        ("o1", "p1", 1.5, 2, 29), ("o1", "p2", 9.5, 1, 29)]


def test_bad_documents(spark):
    bad_amount = json.dumps({**DOCUMENT, "order_id": "o2", "amount": "oops"})
    no_lines = json.dumps({**DOCUMENT, "order_id": "o3", "order_lines": []})
    parsed = parse_orders(messages(spark, "garbage", None, bad_amount, no_lines)).cache()
    assert rows(malformed(parsed).select("raw")) == [(None,), ("garbage",)]
    assert rows(order_rows(parsed).select("order_id", "amount")) == [("o2", None), ("o3", 12.5)]
    assert rows(order_line_rows(parsed).select("order_id").distinct()) == [("o2",)]


def flat(spark):
    orders = spark.createDataFrame(
        [("1", "a", 10.0), ("2", "b", 20.0), ("3", "c", 30.0)], "order_id string, customer_id string, amount double",
    ).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000)))
    # Order 1 is long and full of equal lines; order 3 has none.
    lines = spark.createDataFrame([("1", 1.0, "p", 1)] * 40 + [("2", 2.0, "q", 2)],
                                  "order_id string, price double, product_id string, volume int")
    return orders, lines


def test_nesting_and_splitting_are_inverse(spark, tiny_limits):
    orders, lines = flat(spark)
    documents = nest_orders(orders, lines, max_lines=5).cache()
    sizes = {r.order_id: [] for r in documents.select("order_id").distinct().collect()}
    for r in documents.select("order_id", F.size("order_lines").alias("n")).collect():
        sizes[r.order_id].append(r.n)
    assert sizes["2"] == [1] and sizes["3"] == [0]
    assert sum(sizes["1"]) == 40 and len(sizes["1"]) > 3 and min(sizes["1"]) == 0
    text = documents.select(F.to_json(F.struct(*documents.columns)).alias("value"))
    back_orders, back_lines = split_orders(parse_orders(text))
    assert rows(back_lines.select(lines.columns)) == rows(lines)
    assert rows(back_orders.select("order_id", "customer_id", "amount")) == rows(orders.drop("timestamp"))


def test_short_orders_are_one_document(spark):
    orders, lines = flat(spark)
    assert nest_orders(orders, lines).count() == 3
    assert nest_orders(orders, lines).schema.fieldNames() == ORDER_DOCUMENT.fieldNames()


def test_a_long_order_counts_once(spark):
    orders, _ = flat(spark)
    lines = spark.createDataFrame([("1", 1.0, "p", 1)] * 2_500, "order_id string, price double, product_id string, volume int")
    documents = nest_orders(orders, lines)
    assert rows(order_rows(documents).select("order_id", "amount")) == [("1", 10.0), ("2", 20.0), ("3", 30.0)]
    assert order_line_rows(documents).count() == 2_500


def test_lines_without_order_are_told(spark):
    orders, lines = flat(spark)
    stray = spark.createDataFrame([("9", 1.0, "p", 1)], lines.schema)
    assert rows(lines_without_order(orders, lines.unionByName(stray)).select("order_id")) == [("9",)]


def test_a_producers_own_fragment_field_is_nothing_special(spark):
    parsed = parse_orders(messages(spark, json.dumps({**DOCUMENT, "fragment": 1}))).cache()
    assert rows(order_rows(parsed).select("order_id")) == [("o1",)] and order_line_rows(parsed).count() == 2


def test_fragments_of_unknown_orders_are_told(spark):
    part = {**DOCUMENT, "order_id": "o2", FRAGMENT: 1}
    known = {**DOCUMENT, "order_id": "o3", FRAGMENT: 2}
    stored_part = {**DOCUMENT, "order_id": "o4", FRAGMENT: 1}
    header = {**DOCUMENT, "order_id": "o3", "order_lines": []}
    parsed = parse_orders(messages(spark, *map(json.dumps, (DOCUMENT, part, part, known, header, stored_part)), "junk")).cache()
    stored = spark.createDataFrame([("o4", date(2024, 2, 29)), ("o2", date(2024, 1, 1))], "order_id string, order_date date")
    usable, orphans = without_orphans(parsed, stored)
    assert rows(orphans.select("order_id")) == [("o2",), ("o2",)] and orphans.columns == parsed.columns
    assert usable.count() == 5 and rows(malformed(usable).select("raw")) == [("junk",)]
    assert rows(order_rows(usable).select("order_id")) == [("o1",), ("o3",)]
    assert rows(order_line_rows(usable).select("order_id").distinct()) == [("o1",), ("o3",), ("o4",)]
    for some in (parse_orders(messages(spark, json.dumps(DOCUMENT))), parse_orders(messages(spark, json.dumps(known), json.dumps(header)))):
        same, none = without_orphans(some)
        assert same is some and none is None


def test_text_is_kept_of_what_may_be_rejected(spark):
    part, lost = json.dumps({**DOCUMENT, FRAGMENT: 1}), json.dumps({**DOCUMENT, "order_id": "o9", FRAGMENT: 1})
    no_customer = json.dumps({**DOCUMENT, "customer_id": None})
    parsed = parse_orders(messages(spark, json.dumps(DOCUMENT), part, lost, no_customer, "junk", None))
    spared = without_spare_text(parsed)
    assert spared.columns == parsed.columns and rows(spared.drop("raw")) == rows(parsed.drop("raw"))
    assert {r.raw for r in spared.collect()} == {None, part, lost, no_customer, "junk"}
    assert str(spared._jdf.queryExecution().optimizedPlan()).count("from_json") == 1
    usable, orphans = without_orphans(spared.cache())
    assert rows(malformed(usable).select("raw")) == rows(malformed(parsed).select("raw")) and rows(orphans.select("raw")) == [(lost,)]


@pytest.mark.parametrize("amount, fits", [(12.5, True), (0, True), (-0.000001, True), (4e-7, False), (1e22, False), (-1e23, False),
                                          ("NaN", False), ("Infinity", False), (None, True), (9.9e21, True)])
def test_amounts_that_sums_would_lose_are_rejected(spark, amount, fits):
    text = json.dumps({**DOCUMENT, "amount": amount}).replace('"NaN"', "NaN").replace('"Infinity"', "Infinity")
    parsed = parse_orders(messages(spark, text)).cache()
    assert (order_rows(parsed).count(), malformed(parsed).count()) == ((1, 0) if fits else (0, 1))


def test_orders_without_time_or_customer_are_rejected(spark):
    no_time = json.dumps({**DOCUMENT, "order_id": "o4", "timestamp": "soon"})
    no_customer = json.dumps({**DOCUMENT, "order_id": "o5", "customer_id": None})
    parsed = parse_orders(messages(spark, no_time, no_customer, json.dumps(DOCUMENT))).cache()
    assert rows(malformed(parsed).select("order_id")) == [("o4",), ("o5",)]
    assert rows(order_rows(parsed).select("order_id")) == [("o1",)]
    assert order_line_rows(parsed).count() == 2


def test_csv_headers_and_empty_fields(spark, tmp_path):
    for name, line in (("a.csv", "1,x,a;b"), ("b.csv", "2,y,")):
        (tmp_path / name).write_text(f"customer_id,company_name,specialized_industries\n{line}\n")
    assert rows(read_csv(spark, str(tmp_path), CUSTOMERS_CSV)) == [("1", "x", "a;b"), ("2", "y", None)]


def test_json_lines_keep_what_does_not_parse(spark, tmp_path):
    (tmp_path / "orders.json").write_text(json.dumps(DOCUMENT) + "\nnot json\n")
    df = read_json_lines(spark, str(tmp_path), ORDER_DOCUMENT).cache()
    assert rows(df.select("order_id", "_corrupt_record")) == [(None, "not json"), ("o1", None)]


def test_schema_violations(spark):
    spec = TableSpec("t", (("id", "BIGINT"), ("name", "STRING"), ("d", "DATE"), ("gone", "INT")), required=("id", "gone"))
    raw = spark.createDataFrame([("1", "a", "2024-01-01"), ("x", None, "soon"), (None, "c", None)],
                                "id string, name string, d string")
    assert rows(schema_violations(raw, spec)) == [
        ("d", "not DATE", 1), ("gone", "missing", 3), ("id", "missing", 1), ("id", "not BIGINT", 1)]
