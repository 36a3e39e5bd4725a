import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderpulse.functions.dates import in_day_parts, in_days, parse_day, trailing_bounds
from orderpulse.functions.values import list_items, percent_change
from orderpulse.operators import fluctuation
from orderpulse.operators.fluctuation import (backfill_fluctuations, daily_sums, fluctuations, report, top_fluctuations,
                                              two_branch_fluctuations)
from orderpulse.operators.ranking import rank_all
from orderpulse.plans.fluctuation_sql import top_fluctuations_sql
from tests.conftest import rows

AS_OF = date(2023, 8, 4)
DIM = [("c1", "P"), ("c1", "Q"), ("c2", "R")]
FACT_SCHEMA = "customer_id string, amount double, timestamp timestamp"


def facts(spark, data):
    return spark.createDataFrame([(c, a, datetime.combine(d, datetime.min.time())) for c, a, d in data], FACT_SCHEMA)


def dim(spark, data=DIM):
    return spark.createDataFrame(data, "customer_id string, industry string")


def brute_force(data, pairs, as_of, lookback=31):
    """Per entity: day value, average of earlier daily sums; in plain Python."""
    daily = defaultdict(lambda: None)
    for customer, amount, day in data:
        for member, entity in set(pairs):
            if member == customer:
                old = daily[entity, day]
                if amount is None:
                    daily[entity, day] = old
                else:
                    daily[entity, day] = (old or Decimal(0)) + Decimal(str(amount))
    result = {}
    for entity in {e for _, e in pairs}:
        if (entity, as_of) not in daily:
            continue
        before = [v for (e, d), v in daily.items() if e == entity and as_of - timedelta(days=lookback) <= d < as_of]
        if not before:
            continue
        known = [v for v in before if v is not None]
        value = daily[entity, as_of]
        value = None if value is None else float(value)
        average = float(sum(known)) / len(known) if known else None
        result[entity] = (value, average, None if value is None or average is None else value - average)
    return result


SAMPLE = [("c1", 100.0, AS_OF), ("c1", 10.0, date(2023, 8, 1)), ("c1", 30.0, date(2023, 8, 2)),
          ("c2", 5.0, date(2023, 8, 3))]


@pytest.mark.parametrize("dim_fits", [True, False, None])
def test_top_on_sample(spark, dim_fits):
    top = top_fluctuations(facts(spark, SAMPLE), dim(spark), AS_OF, dim_fits=dim_fits)
    assert rows(top) == [("P", 100.0, 20.0, 80.0, 1), ("Q", 100.0, 20.0, 80.0, 2)]


def test_first_day_of_baseline_counts_and_the_day_before_does_not(spark):
    data = [("c2", 50.0, AS_OF), ("c2", 10.0, AS_OF - timedelta(days=31)), ("c2", 900.0, AS_OF - timedelta(days=32)),
            ("c2", 700.0, AS_OF + timedelta(days=1))]
    assert rows(fluctuations(facts(spark, data), dim(spark), AS_OF)) == [("R", 50.0, 10.0, 40.0)]


def test_late_hours_belong_to_their_day(spark):
    data = spark.createDataFrame(
        [("c2", 7.0, datetime(2023, 8, 4, 23, 59, 59)), ("c2", 3.0, datetime(2023, 8, 3, 23, 59, 59)),
         ("c2", 2.0, datetime(2023, 8, 5, 0, 0, 0))], FACT_SCHEMA)
    assert rows(fluctuations(data, dim(spark), AS_OF)) == [("R", 7.0, 3.0, 4.0)]


def test_entity_whose_amounts_are_null_keeps_a_row_ranked_last(spark):
    data = SAMPLE + [("c2", None, AS_OF)]
    for dim_fits in (True, False):
        top = top_fluctuations(facts(spark, data), dim(spark), AS_OF, dim_fits=dim_fits)
        assert rows(top)[2] == ("R", None, 5.0, None, 3)


def test_cents_add_up_exactly(spark):
    data = [("c2", 0.1, AS_OF)] * 10 + [("c2", 0.3, AS_OF - timedelta(days=1))]
    assert rows(fluctuations(facts(spark, data), dim(spark), AS_OF))[0][1] == 1.0


def test_k_and_percent(spark):
    top = top_fluctuations(facts(spark, SAMPLE), dim(spark), AS_OF, k=1, with_percent=True)
    assert rows(top) == [("P", 100.0, 20.0, 80.0, 1, 80.0, 400.0)]


def test_percent_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "d double, b double")
    assert rows(df.select(percent_change(F.col("d"), F.col("b")))) == [(None,), (25.0,)]


def test_report_lines(spark):
    lines = rows(report(top_fluctuations(facts(spark, SAMPLE), dim(spark), AS_OF)))
    assert lines[0] == (1, "Rank: 1 -> Industry: P               | 24h_value: 100.00          | 30d_avg: 20.00           "
                           "| Difference: 80.00           | % variation: 400.00%")


amounts = st.one_of(st.none(), st.integers(-50_000, 50_000).map(lambda c: c / 100))
orders = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), amounts,
                            st.integers(-40, 2).map(lambda n: AS_OF + timedelta(days=n))), max_size=40)
pairs = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "e"]), st.sampled_from(["X", "Y", "Z"])),
                 min_size=1, max_size=8, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=orders, members=pairs)
def test_both_join_orders_and_two_branches_equal_brute_force(spark, data, members):
    f, d = facts(spark, data).cache(), dim(spark, members).cache()
    expected = sorted((e, *v) for e, v in brute_force(data, members, AS_OF).items())
    for dim_fits in (True, False):
        assert sorted(tuple(r) for r in fluctuations(f, d, AS_OF, dim_fits=dim_fits).collect()) == expected
    one = [tuple(r) for r in top_fluctuations(f, d, AS_OF).orderBy("rank").collect()]
    two = [tuple(r) for r in two_branch_fluctuations(f, d, AS_OF).orderBy("rank").collect()]
    assert one == two


def test_sums_are_exact_and_one_large_amount_stops_nothing(spark):
    facts = spark.createDataFrame([("m", date(2023, 1, 1), 0.004)] * 1_000 + [("n", date(2023, 1, 1), 2e16), ("o", date(2023, 1, 1), 1e40)],
                                  "customer_id string, timestamp date, amount double")
    dim = spark.createDataFrame([("m", "x"), ("n", "y"), ("o", "z")], "customer_id string, industry string")
    got = {r.industry: r.total for r in daily_sums(facts, dim).collect()}
    assert float(got["x"]) == 4.0 and float(got["y"]) == 2e16 and got["z"] is None


def test_bounded_backfill_has_the_whole_baseline(spark):
    days = [date(2023, 1, 1) + timedelta(days=n) for n in range(60)]
    facts = spark.createDataFrame([("m", day, float(n + 1)) for n, day in enumerate(days)], "customer_id string, timestamp date, amount double")
    dim = spark.createDataFrame([("m", "x")], "customer_id string, industry string")
    first, last = days[45], days[50]
    got = {r.aggregation_date: (r.value_24h, r.avg_30d, r["diff"])
           for r in backfill_fluctuations(facts, dim, first=first, last=last).collect()}
    assert sorted(got) == days[45:51]
    for day, values in got.items():
        one = top_fluctuations(facts, dim, day).first()
        assert values == (one.value_24h, one.avg_30d, one["diff"])
    assert got[first] == (46.0, 30.0, 16.0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=orders, members=pairs)
def test_backfill_equals_one_job_per_day(spark, data, members):
    f, d = facts(spark, data).cache(), dim(spark, members).cache()
    filled = {}
    for r in backfill_fluctuations(f, d).collect():
        filled.setdefault(r.aggregation_date, []).append(tuple(r)[1:])
    for day in {x[2] for x in data}:
        expected = brute_force(data, members, day)
        ranked = sorted(expected.items(), key=lambda kv: (kv[1][2] is None, -abs(kv[1][2] or 0), kv[0]))[:3]
        assert sorted(filled.get(day, []), key=lambda r: r[1]) == [
            (e, i, *v) for i, (e, v) in enumerate(ranked, 1)]


def test_sql_form_equals_operator(spark):
    customers = spark.createDataFrame([("c1", "acme"), ("c2", "bolt"), ("c3", None)], "customer_id string, company_name string")
    companies = spark.createDataFrame([("acme", "P"), ("acme", "Q"), ("bolt", "R"), ("bolt", "unknown")],
                                      "company_name string, industry string")
    industries = spark.createDataFrame([("P",), ("Q",), ("R",), ("nobody",)], "industry string")
    data = SAMPLE + [("c2", 1.0, AS_OF), ("c3", 1000.0, AS_OF)]
    sql = top_fluctuations_sql(facts(spark, data).withColumnRenamed("timestamp", "moment"),
                               customers, companies, industries, AS_OF)
    ours = top_fluctuations(facts(spark, data), dim(spark), AS_OF, with_percent=True)
    columns = ["industry", "value_24h", "avg_30d", "diff", "abs_diff", "pct_diff"]
    assert rows(sql.select(columns)) == rows(ours.select(columns))


@pytest.mark.parametrize("year", [2023, 2024])
def test_trailing_window_for_every_day_of_a_year(spark, year):
    """Filters on day parts and on the plain column keep exactly the 31 days before."""
    first = date(year, 1, 1) - timedelta(days=40)
    days = [(first + timedelta(days=n),) for n in range(40 + 366)]
    df = spark.createDataFrame(days, "d date").select("d", F.year("d").alias("y"), F.month("d").alias("m"), F.day("d").alias("n")).cache()
    checks, expected = [], []
    as_of = date(year, 1, 1)
    while as_of.year == year:
        lo, hi = trailing_bounds(as_of)
        assert (hi - lo).days == 30 and hi == as_of - timedelta(days=1)
        if as_of.day in (1, 2, 3, 10, 20, 28, 31):
            checks += [F.count_if(in_days(F.col("d"), lo, hi)), F.count_if(in_day_parts(F.col("y"), F.col("m"), F.col("n"), lo, hi))]
            expected += [31, 31]
        as_of += timedelta(days=1)
    assert list(df.agg(*checks).first()) == expected


@pytest.mark.parametrize("as_of, first, last", [
    ("2023-03-03", "2023-01-31", "2023-03-02"), ("2023-04-20", "2023-03-20", "2023-04-19"),
    ("2023-08-04", "2023-07-04", "2023-08-03"), ("2023-01-10", "2022-12-10", "2023-01-09")])
def test_named_windows(as_of, first, last):
    assert trailing_bounds(parse_day(as_of)) == (parse_day(first), parse_day(last))


def test_default_day_is_yesterday():
    assert parse_day(None) == date.today() - timedelta(days=1)
    with pytest.raises(ValueError):
        parse_day("04/08/2023")


def test_list_items_are_neither_trimmed_nor_dropped(spark):
    df = spark.createDataFrame([("a; b;;c",), (None,)], "s string")
    assert rows(df.select(F.explode(list_items(F.col("s"))))) == [("",), (" b",), ("a",), ("c",)]


def test_distributed_rank_equals_single_sort(spark, tiny_limits):
    data = [(f"e{n}", float(n % 7 - 3) if n % 11 else None) for n in range(200)]
    df = spark.createDataFrame(data, "industry string, diff double")
    ranked = rank_all(df, F.abs("diff"), "industry").orderBy("rank").collect()
    expected = sorted(data, key=lambda r: (r[1] is None, -abs(r[1] or 0), r[0]))
    assert [(r.industry, r.diff) for r in ranked] == expected
    assert [r["rank"] for r in ranked] == list(range(1, 201))


# Days without rows, entities without days

def filled_plainly(facts, dim, as_of, zero_fill, keep_missing, lookback=31):
    totals = defaultdict(Decimal)
    for member, day, amount in facts:
        for m, entity in dim:
            if m == member and as_of - timedelta(days=lookback) <= day <= as_of:
                totals[entity, day] += Decimal(str(amount))
    out = []
    for entity in {e for _, e in dim}:
        own = {d: v for (e, d), v in totals.items() if e == entity}
        before = [v for d, v in own.items() if d < as_of]
        if not keep_missing and not own or not zero_fill and not keep_missing and (as_of not in own or not before):
            continue
        value = float(own.get(as_of, 0))
        average = float(sum(before)) / (lookback if zero_fill else len(before)) if zero_fill or before else None
        out.append((entity, value, average, None if average is None else value - average))
    return sorted(out)


@pytest.mark.parametrize("zero_fill", [False, True])
@pytest.mark.parametrize("keep_missing", [False, True])
def test_days_without_rows_and_entities_without_days(spark, zero_fill, keep_missing):
    rng = random.Random(7)
    dim = [("m1", "a"), ("m1", "b"), ("m2", "b"), ("m3", "c"), ("m4", "silent"), ("m5", "only day"), ("m6", "only before")]
    start = date(2024, 1, 1)
    facts = [(f"m{rng.randrange(1, 4)}", start + timedelta(days=rng.randrange(50)), rng.randrange(-20, 99)) for _ in range(60)]
    facts += [("m5", start + timedelta(days=40), 5), ("m6", start + timedelta(days=35), 7), ("unknown", start, 3)]
    rows_of = spark.createDataFrame(facts, "customer_id string, timestamp date, amount int")
    pairs = spark.createDataFrame(dim, "customer_id string, industry string")
    how = {"zero_fill": zero_fill, "keep_missing": keep_missing}
    backfill = fluctuation.backfill_fluctuations(rows_of, pairs, k=100, **how).collect()
    for n in (0, 1, 20, 35, 40, 49):
        as_of = start + timedelta(days=n)
        expected = filled_plainly(facts, dim, as_of, **how)
        got = fluctuation.fluctuations(rows_of, pairs, as_of, **how).collect()
        assert sorted(map(tuple, got)) == expected
        if as_of <= max(d for m, d, _ in facts):
            assert sorted((r.industry, r.value_24h, r.avg_30d, r["diff"]) for r in backfill if r.aggregation_date == as_of) == expected
    bounded = fluctuation.backfill_fluctuations(rows_of, pairs, k=100, first=start + timedelta(days=20), last=start + timedelta(days=22), **how)
    assert rows(bounded) == sorted([tuple(r) for r in backfill if 20 <= (r.aggregation_date - start).days <= 22],
                                   key=lambda r: [(v is not None, str(v)) for v in r])


def test_the_calendar_reads_no_facts(spark):
    facts = spark.createDataFrame([("m1", date(2024, 1, 1), 5)], "customer_id string, timestamp date, amount int")
    dim = spark.createDataFrame([("m1", "a")], "customer_id string, industry string")
    found = fluctuation.fluctuations(facts.select("*"), dim, date(2024, 1, 2), zero_fill=True, keep_missing=True, dim_fits=True)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("amount#") and len(re.findall(r"LogicalRDD \[customer_id#\d+, timestamp#\d+", text)) == 1
    empty = fluctuation.backfill_fluctuations(facts.limit(0), dim, zero_fill=True, keep_missing=True)
    assert empty.count() == 0
