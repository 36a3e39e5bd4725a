"""How far each entity's day lies from its trailing daily average."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderpulse.functions.dates import LOOKBACK_DAYS, in_days, trailing_bounds
from orderpulse.functions.values import MONEY, as_money, percent_change, report_line
from orderpulse.operators.ranking import top_by
from orderpulse.operators.sizing import fits

TOP_K = 3


@dataclass(frozen=True)
class Facts:
    """Which columns of a fact table hold the member, the moment and the amount, and the decimal type to sum in."""

    member: str = "customer_id"
    moment: str = "timestamp"
    amount: str = "amount"
    money: str = MONEY


def _day_amounts(facts: DataFrame, cols: Facts, first: date | None, last: date | None) -> DataFrame:
    facts = facts.filter(in_days(F.col(cols.moment), first, last))
    return facts.select(
        F.col(cols.member),
        F.to_date(cols.moment).alias("date"),
        as_money(F.col(cols.amount), cols.money).alias("amount"),
    )


def daily_sums(facts: DataFrame, dim: DataFrame, *, cols: Facts = Facts(), entity: str = "industry",
               first: date | None = None, last: date | None = None,
               dim_fits: bool | None = None) -> DataFrame:
    """(entity, date, total). A member's amount counts in full for each of its entities.

    `dim` holds distinct (member, entity) pairs. If it is small it is broadcast and facts
    are never shuffled, only the sums per entity and day. Otherwise facts are first summed
    per member and day, on the map side too, so what the join shuffles is at most one row
    per member and day however many rows a member has. Decimal sums make both forms equal.
    """
    rows = _day_amounts(facts, cols, first, last)
    dim = dim.select(cols.member, entity)
    if fits(dim) if dim_fits is None else dim_fits:
        joined = rows.join(F.broadcast(dim), cols.member)
    else:
        joined = rows.groupBy(cols.member, "date").agg(F.sum("amount").alias("amount")).join(dim, cols.member)
    return joined.groupBy(entity, "date").agg(F.sum("amount").alias("total"))


def fill_days(daily: DataFrame, entities: DataFrame, first: date, last: date, entity: str = "industry",
              zero: bool = True) -> DataFrame:
    """(entity, date, total, real): every entity on every day from `first` to `last`, beside what `daily` has.

    A day without rows gets 0, or NULL without `zero`, and is not `real`. The calendar is made per entity, from
    `entities` (distinct), so that neither facts nor sums are read for it; it meets the sums in one aggregation.
    """
    calendar = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date")
    kind = daily.schema["total"].dataType
    spine = entities.select(entity, calendar, F.lit(None).cast(kind).alias("total"), F.lit(False).alias("real"))
    both = daily.select(entity, "date", "total", F.lit(True).alias("real")).unionByName(spine)
    total = F.coalesce(F.sum("total"), F.lit(0)) if zero else F.sum("total")
    return both.groupBy(entity, "date").agg(total.alias("total"), F.bool_or("real").alias("real"))


def compare_day(daily: DataFrame, as_of: date, entity: str = "industry", keep_missing: bool = False) -> DataFrame:
    """Day value, average over the earlier days that have data, and their difference.

    One aggregation over one scan; entities without rows on the day or before it drop out. After `fill_days` all days
    count as they were filled, and an entity drops out if none of its days is real. With `keep_missing` none does: without
    rows on the day its value is 0, without a value before it its average and difference are NULL.
    """
    on_day = F.col("date") == F.lit(as_of)
    earlier = F.when(~on_day, F.col("total"))
    filled = "real" in daily.columns
    value = F.sum(F.when(on_day, F.col("total"))).cast("double")
    compared = daily.groupBy(entity).agg(
        (F.coalesce(value, F.lit(0.0)) if keep_missing else value).alias("value_24h"),
        F.try_divide(F.sum(earlier).cast("double"), F.count(earlier)).alias("avg_30d"),
        F.bool_or(on_day).alias("_day"),
        F.bool_or(~on_day).alias("_before"),
        F.bool_or(F.col("real") if filled else F.lit(True)).alias("_real"),
    )
    wanted = F.lit(True) if keep_missing else F.col("_day") & F.col("_before") & F.col("_real")
    return compared.filter(wanted).select(
        entity, "value_24h", "avg_30d", (F.col("value_24h") - F.col("avg_30d")).alias("diff"))


def fluctuations(facts: DataFrame, dim: DataFrame, as_of: date, *, cols: Facts = Facts(),
                 entity: str = "industry", lookback_days: int = LOOKBACK_DAYS, dim_fits: bool | None = None,
                 zero_fill: bool = False, keep_missing: bool = False) -> DataFrame:
    """`zero_fill` counts a day without rows as 0, so that averages are over all days; `keep_missing` keeps entities
    of `dim` that were silent on the day or before it."""
    first, _ = trailing_bounds(as_of, lookback_days)
    daily = daily_sums(facts, dim, cols=cols, entity=entity, first=first, last=as_of, dim_fits=dim_fits)
    if zero_fill or keep_missing:
        daily = fill_days(daily, dim.select(entity).distinct(), first, as_of, entity, zero=zero_fill)
    return compare_day(daily, as_of, entity, keep_missing)


def top_fluctuations(facts: DataFrame, dim: DataFrame, as_of: date, *, k: int = TOP_K,
                     cols: Facts = Facts(), entity: str = "industry",
                     lookback_days: int = LOOKBACK_DAYS, with_percent: bool = False, dim_fits: bool | None = None,
                     zero_fill: bool = False, keep_missing: bool = False) -> DataFrame:
    """The k entities whose day differs most, up or down, from their trailing average."""
    compared = fluctuations(facts, dim, as_of, cols=cols, entity=entity, lookback_days=lookback_days, dim_fits=dim_fits,
                            zero_fill=zero_fill, keep_missing=keep_missing)
    top = top_by(compared, k, F.abs("diff"), entity)
    if with_percent:
        top = top.withColumns({
            "abs_diff": F.abs("diff"),
            "pct_diff": percent_change(F.col("diff"), F.col("avg_30d")),
        })
    return top


def two_branch_fluctuations(facts: DataFrame, dim: DataFrame, as_of: date, *, k: int = TOP_K,
                            cols: Facts = Facts(), entity: str = "industry",
                            lookback_days: int = LOOKBACK_DAYS,
                            dim_fits: bool | None = None) -> DataFrame:
    """The same answer from two scans joined on the entity; kept to check the one-scan form."""
    if dim_fits is None:
        dim_fits = fits(dim)
    first, last = trailing_bounds(as_of, lookback_days)
    shared = {"cols": cols, "entity": entity, "dim_fits": dim_fits}
    day = daily_sums(facts, dim, first=as_of, last=as_of, **shared).select(
        entity, F.col("total").cast("double").alias("value_24h"))
    before = daily_sums(facts, dim, first=first, last=last, **shared).groupBy(entity).agg(
        F.try_divide(F.sum("total").cast("double"), F.count("total")).alias("avg_30d"))
    compared = day.join(before, entity).withColumn("diff", F.col("value_24h") - F.col("avg_30d"))
    return top_by(compared, k, F.abs("diff"), entity)


def backfill_fluctuations(facts: DataFrame, dim: DataFrame, *, k: int = TOP_K, cols: Facts = Facts(),
                          entity: str = "industry", lookback_days: int = LOOKBACK_DAYS,
                          first: date | None = None, last: date | None = None, dim_fits: bool | None = None,
                          zero_fill: bool = False, keep_missing: bool = False) -> DataFrame:
    """`top_fluctuations` for every day from `first` to `last` at once (all days without), from one scan.

    The scan begins with the baseline of the first day. With `zero_fill` or `keep_missing` and without one of the
    bounds the facts' own first or last day is looked up beforehand.
    """
    filled = zero_fill or keep_missing
    if filled and (first is None or last is None):
        day = F.to_date(cols.moment)
        known = facts.join(F.broadcast(dim.select(cols.member).distinct()), cols.member, "left_semi") if fits(dim) else facts
        low, high = known.agg(F.min(day), F.max(day)).first()
        first, last = first or low, last or high
        if first is None or last is None:
            first, last, filled = None, None, False
    start = first and trailing_bounds(first, lookback_days)[0]
    daily = daily_sums(facts, dim, cols=cols, entity=entity, first=start, last=last, dim_fits=dim_fits)
    if filled:
        daily = fill_days(daily, dim.select(entity).distinct(), start, last, entity, zero=zero_fill)
    return rank_days(daily, k=k, entity=entity, lookback_days=lookback_days, first=first, keep_missing=keep_missing)


def rank_days(daily: DataFrame, *, k: int = TOP_K, entity: str = "industry", lookback_days: int = LOOKBACK_DAYS,
              first: date | None = None, keep_missing: bool = False) -> DataFrame:
    """The k entities that fluctuated most, for every day of (entity, date, total) from `first` on.

    An entity's window holds one row per calendar day; the ranking per day keeps k rows per task before it shuffles.
    Days that `fill_days` added count as in `compare_day`.
    """
    days = Window.partitionBy(entity).orderBy(F.unix_date("date"))
    earlier, so_far = days.rangeBetween(-lookback_days, -1), days.rangeBetween(-lookback_days, 0)
    by_size = Window.partitionBy("date").orderBy(F.abs("diff").desc_nulls_last(), entity)
    value = F.col("total").cast("double")
    real = F.bool_or("real").over(so_far) if "real" in daily.columns else F.lit(True)
    wanted = F.lit(True) if keep_missing else (F.col("_days") > 0) & F.col("_real")
    return (
        daily.select(
            entity, "date",
            (F.coalesce(value, F.lit(0.0)) if keep_missing else value).alias("value_24h"),
            F.try_divide(F.sum("total").over(earlier).cast("double"), F.count("total").over(earlier)).alias("avg_30d"),
            F.count(F.lit(1)).over(earlier).alias("_days"), real.alias("_real"),
        )
        .filter(wanted & (F.lit(True) if first is None else F.col("date") >= F.lit(first)))
        .withColumn("diff", F.col("value_24h") - F.col("avg_30d"))
        .withColumn("rank", F.row_number().over(by_size))
        .filter(F.col("rank") <= k)
        .select(F.col("date").alias("aggregation_date"), entity, "rank", "value_24h", "avg_30d", "diff")
    )


def report(top: DataFrame, entity: str = "industry") -> DataFrame:
    """One printable line per ranked row."""
    return top.select(
        "rank",
        report_line(F.col("rank"), F.col(entity), F.col("value_24h"), F.col("avg_30d"), F.col("diff")).alias("line"),
    )
