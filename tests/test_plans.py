"""What the physical plans must look like to hold at scale."""

import re

import pytest

from orderpulse.operators import fluctuation
from orderpulse.queries import QUERIES
from orderpulse.queries.inputs import AS_OF, ORDER_FACTS, load, segments

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def inputs(spark):
    return load(spark, SF_DIR, "orders"), segments(spark, SF_DIR)


def test_daily_comparison_scans_facts_once_with_filter_and_columns_pushed(spark, inputs):
    text = plan(fluctuation.top_fluctuations(*inputs, AS_OF, cols=ORDER_FACTS))
    scans = [line for line in text.splitlines() if "FileScan" in line and "o_totalprice" in line]
    assert len(scans) == 1
    assert "GreaterThanOrEqual(o_orderdate,1998-01-31T00:00)" in scans[0]
    assert "LessThan(o_orderdate,1998-03-04T00:00)" in scans[0]
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>", scans[0])
    assert "TakeOrderedAndProject(limit=3" in text and "SinglePartition" not in text


def test_small_dimension_is_broadcast_and_facts_are_not_shuffled(spark, inputs, no_broadcast):
    text = plan(fluctuation.top_fluctuations(*inputs, AS_OF, cols=ORDER_FACTS))
    assert text.count("BroadcastHashJoin") == 1
    assert not re.search(r"Exchange hashpartitioning\(o_custkey", text)


def test_large_dimension_meets_sums_not_facts(spark, inputs, no_broadcast, tiny_limits):
    text = plan(fluctuation.top_fluctuations(*inputs, AS_OF, cols=ORDER_FACTS))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    below_join = text[text.index("SortMergeJoin"):]
    assert "partial_sum" in below_join


def test_backfill_ranks_with_a_limit_per_task(spark, inputs):
    text = plan(fluctuation.backfill_fluctuations(*inputs, cols=ORDER_FACTS))
    assert re.search(r"WindowGroupLimit \[date#\d+\].*Partial", text) and "SinglePartition" not in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_anywhere(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", ["customer_industry_dim_sql", "fluctuations_sql_top3"])
def test_sql_forms_have_no_outer_join_that_could_not_be_split(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Join .*(LeftOuter|RightOuter|FullOuter)", text) and "NestedLoop" not in text


def test_anti_joins_look_for_distinct_keys_only(spark, no_broadcast):
    text = plan(QUERIES["customer_industry_dim_sql"](spark, SF_DIR))
    lines = text.splitlines()
    for n, line in enumerate(lines):
        if "LeftAnti" in line:
            margin = line.index(re.search(r"[A-Z]", line.replace("(", " "))[0])
            below = [x for x in lines[n + 1:] if len(x) > margin]
            assert any("HashAggregate" in x for x in below)
    assert "LeftAnti" in text


def test_right_outer_query_sums_before_it_joins(spark, no_broadcast):
    text = plan(QUERIES["right_outer_null_rejected"](spark, SF_DIR))
    assert "partial_sum" in text[text.index("Join"):]


@pytest.mark.parametrize("name", ["orders_with_entity", "distinct_dim", "merge_upsert", "customer_industry_dim"])
def test_nothing_is_broadcast_unchecked(spark, no_broadcast, tiny_limits, name):
    """With every size check failing, only lists of hot keys are broadcast."""
    text = plan(QUERIES[name](spark, SF_DIR))
    for join in re.findall(r"BroadcastHashJoin \[[^\n]*", text):
        assert "LeftOuter" in join
    if name != "merge_upsert":
        assert "_splits" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_upsert_with_a_small_batch_does_not_shuffle_the_target(spark, no_broadcast):
    from pyspark.sql import functions as F

    from orderpulse.operators.upsert import merge_upsert
    target = load(spark, SF_DIR, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    batch = load(spark, SF_DIR, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    text = plan(merge_upsert(target, batch, "id", "name"))
    first_branch = text[:text.index("LeftAnti")]
    assert "LeftOuter" in first_branch and "SortMergeJoin" not in text


def test_tables_stored_by_their_join_key_stay_where_they_are(spark, no_broadcast):
    from orderpulse.queries.writes import placed_join
    text = plan(placed_join(spark, SF_DIR))
    assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2


def test_kept_sums_are_not_moved_to_meet_a_dimension(spark, target, no_broadcast, monkeypatch):
    """Beyond the broadcast size too: the few pairs are sent to the buckets, over all refreshes."""
    from orderpulse import model
    from orderpulse.operators import maintained
    from orderpulse.operators.sinks import overwrite_partition
    monkeypatch.setattr(maintained, "fits", lambda df: False)
    to = target(model.MEMBER_DAYS)
    for n in (1, 2):
        rows = spark.range(100).selectExpr("CAST(id AS STRING) AS customer_id", "DATE'2024-01-01' AS date", "1 AS total", "1 AS n_rows", "1 AS n_values")
        overwrite_partition(rows, model.MEMBER_DAYS, to.database, {"refresh": n})
    days = spark.table(f"{to.database}.member_days")
    pairs = spark.range(50).selectExpr("CAST(id AS STRING) AS customer_id", "'x' AS industry")
    joined = maintained._meet(days.where("refresh <= 2"), pairs)
    assert joined.count() == 100
    text = plan(joined)
    stored = text[text.index("SortMergeJoin"):text.index("Range")]
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in stored.split("FileScan")[0]
    assert len(days.where("refresh = 1").inputFiles()) <= model.MEMBER_DAYS.clustered[1]
