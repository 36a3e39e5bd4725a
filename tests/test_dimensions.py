import re
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderpulse.operators.bridge import (build_bridge, customer_industries, entity_dim, explode_list, industry_lists,
                                         merge_bridge, valid_companies)
from orderpulse.operators.sizing import fits, hot_keys, right_outer, salted_join
from orderpulse.operators.upsert import merge_sql, merge_upsert
from tests.conftest import rows

RAW = "company_name string, specialized_industries string"
PAIRS = "company_name string, industry string"


def test_initial_bridge(spark):
    raw = spark.createDataFrame([("A", "x;y"), ("A", None), ("B", None), ("B", None)], RAW)
    assert rows(build_bridge(raw, keep_unclassified=True)) == [("A", "x"), ("A", "y"), ("B", None)]
    assert rows(build_bridge(raw)) == [("A", "x"), ("A", "y")]


def test_unclassified_row_of_a_company_without_name(spark):
    raw = spark.createDataFrame([(None, "x"), (None, None)], RAW)
    assert rows(build_bridge(raw, keep_unclassified=True)) == [(None, None), (None, "x")]


def test_incremental_bridge(spark):
    existing = spark.createDataFrame([("B", None), ("C", "z"), ("A", "x")], PAIRS)
    raw = spark.createDataFrame([("A", "x;y"), ("A", None), ("B", None)], RAW)
    merged = merge_bridge(existing, build_bridge(raw))
    assert rows(merged) == [("A", "x"), ("A", "y"), ("C", "z")]
    assert rows(merge_bridge(merged, build_bridge(raw))) == rows(merged)


@pytest.mark.parametrize("small", [True, False])
def test_merge_into_distinct_bridge_equals_union_distinct(spark, monkeypatch, small):
    from orderpulse.operators import sizing
    if not small:
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    existing = spark.createDataFrame([("A", "x"), ("A", "y"), (None, "x"), ("B", None)], PAIRS)
    incoming = spark.createDataFrame([("A", "y"), ("A", "z"), (None, "x"), (None, "w"), ("A", "z"), ("C", None)], PAIRS)
    expected = [(None, "w"), (None, "x"), ("A", "x"), ("A", "y"), ("A", "z")]
    assert rows(merge_bridge(existing, incoming, existing_distinct=True)) == expected
    assert rows(merge_bridge(existing, incoming)) == expected


def test_lists_and_their_explosion_are_inverse(spark):
    bridge = spark.createDataFrame([("A", "y"), ("A", "x"), ("A", "x"), ("B", None), ("C", "z")], PAIRS)
    lists = industry_lists(bridge)
    assert [(r[0], r[1]) for r in lists.orderBy("company_name").collect()] == [("A", ["x", "y"]), ("C", ["z"])]


def test_explode_list_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a;b"), (2, None), (3, "")], "id int, l string")
    assert rows(explode_list(df, "l", "item")) == [(1, "a"), (1, "b"), (3, "")]


CUSTOMERS = [("1", "A"), ("2", "A"), ("3", "C"), ("4", None), ("5", "nowhere"), ("1", "A")]
COMPANIES = [("A", "x"), ("A", "y"), ("C", "x"), ("D", "x"), ("A", "bogus"), (None, "x")]
INDUSTRIES = [("x",), ("y",), ("lonely",)]


def chain(spark):
    return (spark.createDataFrame(CUSTOMERS, "customer_id string, company_name string"),
            spark.createDataFrame(COMPANIES, PAIRS), spark.createDataFrame(INDUSTRIES, "industry string"))


def check_chain(spark):
    customers, companies, industries = chain(spark)
    assert rows(valid_companies(companies, industries)) == [
        (None, "lonely"), (None, "x"), ("A", "x"), ("A", "y"), ("C", "x"), ("D", "x")]
    plain = customers.join(companies.join(industries, "industry", "right"), "company_name", "right").select(
        "customer_id", "industry")
    assert rows(customer_industries(customers, companies, industries)) == rows(plain)
    assert rows(entity_dim(customers, companies, industries)) == [("1", "x"), ("1", "y"), ("2", "x"), ("2", "y"), ("3", "x")]


def test_chain_with_broadcasts(spark):
    check_chain(spark)


def test_chain_with_shuffles_and_salts(spark, tiny_limits):
    check_chain(spark)


keys = st.sampled_from(["hot", "hot", "hot", "k1", "k2", "k3", None])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(keys, st.integers(0, 3)), max_size=30), right=st.lists(st.tuples(keys, st.integers(0, 3)), max_size=8))
def test_salted_joins_equal_plain_joins(spark, tiny_limits, left, right):
    a = spark.createDataFrame(left, "k string, a int").cache()
    b = spark.createDataFrame(right, "k string, b int").cache()
    assert rows(salted_join(a, b, "k").select("k", "a", "b")) == rows(a.join(b, "k").select("k", "a", "b"))
    assert rows(right_outer(a, b, "k").select("k", "a", "b")) == rows(a.join(b, "k", "right").select("k", "a", "b"))


def test_hot_keys_are_bounded_by_their_share(spark, monkeypatch):
    from orderpulse.operators import sizing
    monkeypatch.setattr(sizing, "ROWS_PER_SPLIT", 1)
    monkeypatch.setattr(sizing, "MAX_HOT_KEYS", 4)
    df = spark.createDataFrame([("hot",)] * 50 + [(f"k{n}",) for n in range(50)], "k string")
    assert rows(hot_keys(df, "k")) == [("hot", 2)]


def test_hot_keys_come_from_one_pass_without_a_shuffle_of_keys(spark, monkeypatch):
    from orderpulse.operators import sizing
    monkeypatch.setattr(sizing, "ROWS_PER_SPLIT", 1_000)
    many = spark.range(0, 40_000, 1, 7).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 9000)) AS k", "id")
    found = hot_keys(many, "k")
    assert rows(found) == [("hot", 14)]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*key", text) and text.count("Range (") == 2  # in the final and the initial plan
    assert hot_keys(many.limit(0), "k").count() == 0
    assert rows(hot_keys(many.selectExpr("CAST(NULL AS BIGINT) AS k"), "k")) == []


@pytest.mark.parametrize("listed", [[], [("k1", 3), ("nobody", 2)], [("hot", 2)]])
def test_any_answer_of_the_sketch_joins_the_same_rows(spark, monkeypatch, listed):
    from orderpulse.operators import sizing
    monkeypatch.setattr(sizing, "hot_keys", lambda df, key: spark.createDataFrame(listed, "k string, _splits int"))
    many = spark.range(60).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 4)) AS k", "id AS a")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k9", 4)], "k string, b int")
    assert rows(sizing.salted_join(many, few, "k").select("k", "a", "b")) == rows(many.join(few, "k").select("k", "a", "b"))


def test_a_hot_key_is_spread(spark, monkeypatch):
    from orderpulse.operators import sizing
    monkeypatch.setattr(sizing, "ROWS_PER_SPLIT", 10)
    many = spark.range(100).selectExpr("'hot' AS k", "id")
    joined = salted_join(many, spark.createDataFrame([("hot", 1)], "k string, v int"), "k")
    plan = joined._jdf.queryExecution().toString()
    assert joined.count() == 100 and "_salt" in plan


def test_fits_counts_rows_and_text(spark):
    df = spark.createDataFrame([("abc",), (None,)], "s string")
    assert fits(df) and fits(df, max_rows=2, max_bytes=3)
    assert not fits(df, max_rows=1) and not fits(df, max_bytes=2)


MEMBER = "customer_id string, company_name string, ingest_date date"
D0, D1 = date(2024, 1, 1), date(2024, 1, 2)
TARGET = [("1", "A", D0), ("2", "B", D0), ("3", None, D0), ("4", "D", D0), (None, "old", D0)]
BATCH = [("2", "B2", D1), ("3", "C", D1), ("4", "D", D1), ("5", "E", D1), (None, "N", D1), (None, "N", D1)]
MERGED = [(None, "N", D1), (None, "N", D1), (None, "old", D0), ("1", "A", D0), ("2", "B2", D1), ("3", None, D0),
          ("4", "D", D0), ("5", "E", D1)]


def check_upsert(spark):
    target, batch = spark.createDataFrame(TARGET, MEMBER), spark.createDataFrame(BATCH, MEMBER)
    merged = merge_upsert(target, batch, "customer_id", "company_name")
    assert merged.columns == target.columns
    assert rows(merged) == MERGED
    keyed = batch.filter("customer_id IS NOT NULL")
    once = merge_upsert(target, keyed, "customer_id", "company_name")
    assert rows(merge_upsert(once, keyed, "customer_id", "company_name")) == rows(once)


def test_upsert_with_broadcast(spark):
    check_upsert(spark)


def test_upsert_with_shuffle(spark, tiny_limits):
    check_upsert(spark)


@pytest.mark.parametrize("key", ["2", "9"])
def test_upsert_rejects_repeated_keys(spark, key):
    target = spark.createDataFrame(TARGET, MEMBER)
    batch = spark.createDataFrame([(key, "X", D1), (key, "Y", D1)], MEMBER)
    with pytest.raises(Exception, match="several incoming rows"):
        merge_upsert(target, batch, "customer_id", "company_name").collect()


def test_merge_statement_parses(spark):
    sql = merge_sql("db.customers", "batch", "customer_id", "company_name", ["customer_id", "company_name", "ingest_date"])
    assert spark._jsparkSession.sessionState().sqlParser().parsePlan(sql) is not None
