"""Daily sums that are kept up to date against the job that reads all orders."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from orderpulse import model
from orderpulse.operators import maintained
from orderpulse.operators.changelog import replace_table
from orderpulse.operators.compaction import fold_epochs
from orderpulse.operators.sinks import append_by_position, overwrite_partition
from orderpulse.plans import daily_fluctuations
from orderpulse.streaming.customers import store_customers
from tests.conftest import rows

DAY = date(2024, 3, 10)
TABLES = (*model.WAREHOUSE, model.ORDER_REJECTS, *maintained.MAINTAINED_TABLES)


def store_orders(spark, to, stream, epoch, orders):
    """(customer, day, amount) as one epoch; rejects come last, as the stream writes them."""
    found = spark.createDataFrame([(f"{stream}{epoch}-{n}", c, a, d) for n, (c, d, a) in enumerate(orders)],
                                  "order_id string, customer_id string, amount double, order_date date")
    writer = {"stream_id": stream, "epoch": epoch}
    overwrite_partition(found.withColumn("timestamp", F.to_timestamp("order_date")), model.ORDERS, to.database, writer)
    overwrite_partition(spark.createDataFrame([], "value string"), model.ORDER_REJECTS, to.database, writer)


@pytest.fixture
def warehouse(spark, target):
    to = target(*TABLES)
    customers = [("c1", "A"), ("c2", "A"), ("c3", "B"), ("c4", "C"), ("c5", None)]
    replace_table(spark.createDataFrame([(*c, DAY) for c in customers], model.CUSTOMERS.schema), model.CUSTOMERS, to.database)
    pairs = [("A", "x"), ("A", "y"), ("B", "y"), ("C", "z"), ("D", "x"), ("D", "w"), ("E", "unknown")]
    replace_table(spark.createDataFrame([(*p, DAY) for p in pairs], model.COMPANIES.schema), model.COMPANIES, to.database)
    industries = spark.createDataFrame([(i, DAY) for i in "xyzw"], model.INDUSTRIES.schema)
    append_by_position(industries, model.INDUSTRIES, to.database)
    return to


def both(spark, to, day=DAY):
    columns = ["industry", "rank", "value_24h", "avg_30d", "diff"]
    return [rows(f(spark, to.database, day, 10).select(columns)) for f in (daily_fluctuations.compute_maintained, daily_fluctuations.compute)]


@pytest.mark.parametrize("seed", range(3))
def test_kept_sums_equal_all_orders(spark, warehouse, seed):
    """Late orders, customers that move, companies that join industries, in random rounds."""
    rng, to = random.Random(seed), warehouse
    epochs = {"s": 0, "t": 0}
    for n in range(4):
        for stream in rng.sample(["s", "t"], rng.randrange(1, 3)):
            orders = [(f"c{rng.randrange(1, 7)}", DAY - timedelta(days=rng.choice([0, 0, 1, 2, 31, 32, 60])),
                       rng.choice([None, round(rng.uniform(-9, 99), 2), 0.0])) for _ in range(rng.randrange(0, 15))]
            store_orders(spark, to, stream, epochs[stream], orders)
            epochs[stream] += 1
        moved = {f"c{rng.randrange(1, 7)}": rng.choice("ABCDE") for _ in range(rng.randrange(0, 3))}
        if moved:
            batch = [(c, company, rng.choice([None, "z", "w;x"])) for c, company in moved.items()]
            store_customers(spark.createDataFrame(batch, "customer_id string, company_name string, specialized_industries string"),
                            to.database, DAY, "s", n)
        ours, theirs = both(spark, to)
        assert ours == theirs
    assert both(spark, to, DAY - timedelta(days=1))[0] == both(spark, to, DAY - timedelta(days=1))[1]


def test_a_refresh_reads_new_epochs_only(spark, warehouse):
    to = warehouse
    for epoch in range(3):
        store_orders(spark, to, "s", epoch, [("c1", DAY - timedelta(days=epoch), 5.0), ("c4", DAY, 1.0)])
        number = maintained.refresh(spark, to.database, daily_fluctuations.dimension(spark, to.database))
        kept = spark.table(f"{to.database}.member_days").where(F.col("refresh") == number)
        assert kept.agg(F.sum("n_rows")).first()[0] == 2
    number, applied = maintained.last_refresh(spark, to.database)
    assert (number, applied) == (3, {"s": 2})
    found = maintained._new_orders(spark, to.database, applied, {"s": 3, "t": 0})
    assert found.count() == 0
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "stream_id" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    maintained.refresh(spark, to.database, daily_fluctuations.dimension(spark, to.database))
    assert spark.table(f"{to.database}.industry_days").where("refresh = 4").count() == 0
    assert [p["refresh"] for p in maintained.partitions(spark, to.database, "member_industries")] == ["4"]


def test_a_refresh_that_failed_is_not_seen_and_written_again(spark, warehouse, monkeypatch):
    to = warehouse
    store_orders(spark, to, "s", 0, [("c1", DAY, 5.0), ("c1", DAY - timedelta(days=1), 1.0)])
    plain, written = maintained.overwrite_partition, []

    def until_the_commit(df, spec, database, values):
        if spec.name == model.REFRESHES.name:
            raise OSError("lost")
        written.append(spec.name)
        plain(df, spec, database, values)

    monkeypatch.setattr(maintained, "overwrite_partition", until_the_commit)
    with pytest.raises(OSError):
        maintained.refresh(spark, to.database, daily_fluctuations.dimension(spark, to.database))
    assert written and maintained.industry_days(spark, to.database).count() == 0
    monkeypatch.setattr(maintained, "overwrite_partition", plain)
    store_orders(spark, to, "s", 1, [("c3", DAY, 2.0)])
    ours, theirs = both(spark, to)
    assert ours == theirs and ours


def test_an_epoch_counts_once_it_is_whole(spark, warehouse):
    to = warehouse
    store_orders(spark, to, "s", 0, [("c1", DAY, 5.0)])
    spark.sql(f"ALTER TABLE {to.database}.order_rejects_stored DROP PARTITION (stream_id = 's', epoch = 0)")
    assert maintained.stored_epochs(spark, to.database, {}) == {}
    store_orders(spark, to, "s", 0, [("c1", DAY, 5.0)])
    assert maintained.stored_epochs(spark, to.database, {"t": 4}) == {"s": 0, "t": 4}


def test_epochs_folded_too_early_are_told(spark, warehouse):
    to = warehouse
    for epoch in range(3):
        store_orders(spark, to, "s", epoch, [("c1", DAY, 5.0)])
    fold_epochs(spark, model.ORDERS, to.database, "s", 1)
    with pytest.raises(RuntimeError, match="folded before"):
        maintained.refresh(spark, to.database, daily_fluctuations.dimension(spark, to.database))


def test_days_without_values_count_as_the_job_counts_them(spark, warehouse):
    """A day whose amounts are all NULL has rows and no value; a day whose only member moved away has neither."""
    to = warehouse
    store_orders(spark, to, "s", 0, [("c4", DAY - timedelta(days=2), None), ("c4", DAY - timedelta(days=1), 4.0), ("c4", DAY, 10.0)])
    assert both(spark, to)[0] == both(spark, to)[1] == [("z", 1, 10.0, 4.0, 6.0)]
    schema = "customer_id string, company_name string, specialized_industries string"
    store_customers(spark.createDataFrame([("c4", "D", None)], schema), to.database, DAY)
    ours, theirs = both(spark, to)
    assert ours == theirs and [r[0] for r in ours] == ["w", "x"]


def test_the_job_from_kept_sums(spark, warehouse):
    to = warehouse
    store_orders(spark, to, "s", 0, [("c1", DAY - timedelta(days=1), 4.0), ("c1", DAY, 10.0)])
    lines = [daily_fluctuations.run(spark, to.database, to.root, DAY, maintained=m) for m in (True, False, True)]
    assert lines[0] == lines[1] == lines[2] and len(lines[0]) == 2
    assert spark.table(f"{to.database}.fluctuations").count() == 2


@pytest.mark.parametrize("how", [{"zero_fill": True}, {"keep_missing": True}])
def test_kept_sums_keep_one_copy_of_the_dimension(spark, warehouse, monkeypatch, how):
    """The stored pairs serve filled days too."""
    to = warehouse
    store_orders(spark, to, "s", 0, [("c1", DAY - timedelta(days=3), 4.0), ("c1", DAY, 10.0), ("c4", DAY, 2.0)])
    theirs = rows(daily_fluctuations.compute(spark, to.database, DAY, 10, **how))

    def copied(df):
        raise AssertionError("the dimension is copied")

    monkeypatch.setattr(daily_fluctuations, "checkpointed", copied)
    assert rows(daily_fluctuations.compute_maintained(spark, to.database, DAY, 10, **how)) == theirs and theirs
