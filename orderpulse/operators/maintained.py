"""Daily sums that are kept up to date: a refresh adds what came since the last one and moves what changed sides.

A refresh has a number. It writes partitions of that number and is committed by the last of them, in REFRESHES; a
refresh that failed is written again. Readers see committed refreshes alone and add them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.functions.values import MONEY_SUM, as_money
from orderpulse.model import INDUSTRY_DAYS, MEMBER_DAYS, MEMBER_INDUSTRIES, ORDER_REJECTS, ORDERS, REFRESHES
from orderpulse.operators.compaction import folded_epochs
from orderpulse.operators.sinks import overwrite_partition, partitions
from orderpulse.operators.sizing import fits
from orderpulse.session import checkpointed

SUMS = ("total", "n_rows", "n_values")
MAINTAINED_TABLES = (MEMBER_DAYS, INDUSTRY_DAYS, MEMBER_INDUSTRIES, REFRESHES)


def last_refresh(spark: SparkSession, database: str) -> tuple[int, dict[str, int]]:
    """The number of the last committed refresh, 0 if there is none, and the last order epoch of each stream in it."""
    done = spark.table(f"`{database}`.`{REFRESHES.name}`")
    number = done.agg(F.max("refresh")).first()[0] or 0
    rows = done.where((F.col("refresh") == number) & (F.col("epoch") >= 0)).collect()  # one for each stream
    return number, {r.stream_id: r.epoch for r in rows}


def stored_epochs(spark: SparkSession, database: str, applied: dict[str, int]) -> dict[str, int]:
    """The last epoch of each order stream that is stored whole: rejects are written last, if only as an empty partition."""
    last = dict(applied)
    for part in partitions(spark, database, ORDER_REJECTS.name):
        last[part["stream_id"]] = max(last.get(part["stream_id"], -1), int(part["epoch"]))
    for stream, epoch in folded_epochs(spark, ORDERS, database).items():
        if epoch > applied.get(stream, -1):
            raise RuntimeError(f"epochs of {stream} up to {epoch} were folded before they were added: fold only what a refresh has")
    return last


def _new_orders(spark: SparkSession, database: str, applied: dict[str, int], last: dict[str, int]) -> DataFrame:
    """Orders of the epochs that came since; the others' partitions are not read."""
    wanted = F.lit(False)
    for stream, epoch in last.items():
        wanted |= (F.col("stream_id") == stream) & F.col("epoch").between(applied.get(stream, -1) + 1, epoch)
    return spark.table(f"`{database}`.`{ORDERS.name}`").where(wanted)


def member_industries(spark: SparkSession, database: str, number: int) -> DataFrame:
    """The distinct (customer_id, industry) that a refresh was given; those of the last one are kept."""
    return spark.table(f"`{database}`.`{MEMBER_INDUSTRIES.name}`").where(F.col("refresh") == number).drop("refresh")


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums, numbers of rows and of values per key of rows that have them already."""
    return rows.groupBy(*keys).agg(F.sum("total").cast(MONEY_SUM).alias("total"), F.sum("n_rows").alias("n_rows"),
                                   F.sum("n_values").alias("n_values"))


def _meet(days: DataFrame, pairs: DataFrame) -> DataFrame:
    """Member days with the member's industries. A member has a row a day, so that none is hot."""
    return days.drop("refresh").join(F.broadcast(pairs) if fits(pairs) else pairs, "customer_id")


def refresh(spark: SparkSession, database: str, dim: DataFrame) -> int:
    """Bring the daily sums up to date with the orders that came and with `dim`, distinct (customer_id, industry); its number.

    New orders are summed per member and day and added to each industry of the member, however late they are. A
    member that left an industry takes all past sums along, and brings them to the one it joined: they are added there and
    subtracted here. What is stored is read for such members only, beside the pairs of both dimensions.
    """
    number, applied = last_refresh(spark, database)
    last, this = stored_epochs(spark, database, applied), {"refresh": number + 1}

    overwrite_partition(dim.select("customer_id", "industry"), MEMBER_INDUSTRIES, database, this)
    now, before = (member_industries(spark, database, n) for n in (number + 1, number))

    amount = as_money(F.col("amount"))
    came = _new_orders(spark, database, applied, last).groupBy("customer_id", F.col("order_date").alias("date")).agg(
        F.sum(amount).cast(MONEY_SUM).alias("total"), F.count(F.lit(1)).alias("n_rows"), F.count(amount).alias("n_values"))
    overwrite_partition(came, MEMBER_DAYS, database, this)
    days = spark.table(f"`{database}`.`{MEMBER_DAYS.name}`")
    added = _meet(days.where(F.col("refresh") == number + 1), now)

    both = now.withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1)))
    changes = checkpointed(both.groupBy("customer_id", "industry").agg(F.sum("sign").alias("sign")).where("sign <> 0"))
    moved = _meet(days.where(F.col("refresh") <= number), changes)
    moved = moved.select("industry", "date", *[F.when(F.col("sign") < 0, -F.col(c)).otherwise(F.col(c)).alias(c) for c in SUMS])

    sums = _totals(added.select("industry", "date", *SUMS).unionByName(moved), ["industry", "date"])
    overwrite_partition(sums, INDUSTRY_DAYS, database, this)
    epochs = spark.createDataFrame([("", -1), *last.items()], "stream_id string, epoch long")  # a row at least: it is the commit
    overwrite_partition(epochs, REFRESHES, database, this)
    spark.sql(f"ALTER TABLE `{database}`.`{MEMBER_INDUSTRIES.name}` DROP IF EXISTS PARTITION (refresh = {number})")
    return number + 1


def industry_days(spark: SparkSession, database: str) -> DataFrame:
    """(industry, date, total) as `fluctuation.daily_sums` gives it, from the committed refreshes."""
    number, _ = last_refresh(spark, database)
    rows = spark.table(f"`{database}`.`{INDUSTRY_DAYS.name}`").where(F.col("refresh") <= number)
    sums = _totals(rows, ["industry", "date"]).where("n_rows > 0")
    return sums.select("industry", "date", F.when(F.col("n_values") > 0, F.col("total")).alias("total"))
