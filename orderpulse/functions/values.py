"""Scalar expressions: money, percentages, lists in strings, report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wide enough for 22 digits before the point and millionths; sums have 32 digits before the point.
MONEY = "DECIMAL(28,6)"
MONEY_SUM = "DECIMAL(38,6)"
LIST_SEPARATOR = ";"

# Fixed value: the layout of a report line.
REPORT_LINE = (
    "Rank: %d -> Industry: %-15s | 24h_value: %-15.2f | 30d_avg: %-15.2f"
    " | Difference: %-15.2f | %% variation: %.2f%%"
)


def as_money(amount: Column, kind: str = MONEY) -> Column:
    """Exact amounts: decimal sums do not depend on the order in which rows arrive. NULL for what `kind` can't hold."""
    return amount.try_cast(kind)


def unfit(amount: Column, kind: str = MONEY) -> Column:
    """Whether an amount is too large, too small or no number, so that `as_money` would leave it out or make it 0."""
    money = as_money(amount, kind)
    return amount.isNotNull() & (money.isNull() | ((money == 0) & (amount != 0)))


def percent_change(diff: Column, base: Column) -> Column:
    """NULL where the base is zero."""
    return F.try_divide(diff, base) * 100


def list_items(text: Column, separator: str = LIST_SEPARATOR) -> Column:
    """Items of a separated list: not trimmed, empty items kept, NULL for NULL."""
    return F.split(text, "\\Q" + separator + "\\E")


def report_line(rank: Column, entity: Column, value: Column, average: Column, diff: Column) -> Column:
    return F.format_string(REPORT_LINE, rank, entity, value, average, diff, percent_change(diff, average))
