"""Order documents: nested JSON to and from the orders and order_lines tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.dates import date_parts
from orderpulse.functions.values import unfit
from orderpulse.model import FRAGMENT, ORDER_DOCUMENT, ORDERS
from orderpulse.operators.sizing import fits, salted_join
from orderpulse.session import checkpointed

MAX_LINES = 1_000


def parse_orders(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes to order columns, with the text they came from as `raw`.

    Text that is no document gives NULL columns, and so does a single bad field.
    """
    return messages.select(F.col(value).cast("string").alias("raw")).select(
        "raw", F.from_json("raw", ORDER_DOCUMENT).alias("document")).select("raw", "document.*")


def _complete() -> Column:
    """Whether a document has what an order must have: an unreadable time would put it in a day that no query reads, and
    an amount that can't be summed would be missing from the sums."""
    return reduce(and_, [F.col(c).isNotNull() for c in ORDERS.required]) & ~unfit(F.col("amount"))


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~_complete())


def without_spare_text(parsed: DataFrame) -> DataFrame:
    """`parsed` with `raw` only where a row may be rejected, malformed or a fragment: the text of all others is most of
    what would be kept for several readers."""
    return parsed.withColumn("raw", F.when(~_complete() | F.col(FRAGMENT).isNotNull(), F.col("raw")))


def order_rows(parsed: DataFrame) -> DataFrame:
    """One row per order; documents that only go on with an order's lines add none."""
    return parsed.filter(_complete() & F.col(FRAGMENT).isNull()).select(
        "order_id", "customer_id", "amount", "timestamp", *date_parts(F.col("timestamp")),
        F.to_date("timestamp").alias("order_date"),
    )


def order_line_rows(parsed: DataFrame) -> DataFrame:
    """One row per line of each document; none for a document without lines.

    Conditions on the document itself would be pushed below the parser and parse the text
    once more for each, so they are put as one on the position, which only exists afterwards.
    """
    lines = F.when(_complete(), F.col("order_lines"))
    return (
        parsed.select("order_id", "timestamp", F.posexplode_outer(lines).alias("position", "line"))
        .filter(F.col("position").isNotNull())
        .select(
            "order_id", "line.product_id", "line.price", "line.volume", "timestamp", *date_parts(F.col("timestamp")),
            F.to_date("timestamp").alias("order_date"),
        )
    )


def without_orphans(parsed: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """`parsed` without fragments whose order is unknown, and these (None if there are none): they belong with the rejects.

    An order is known if it is among `parsed` or in `stored` on the fragment's day. Most batches have no fragments,
    and cost one look at `parsed`, which should be cheap to read again.
    """
    fragments = parsed.filter(_complete() & F.col(FRAGMENT).isNotNull())
    if fragments.isEmpty():
        return parsed, None
    known = order_rows(parsed).select("order_id")
    if stored is not None:
        day = F.to_date("timestamp")
        first, last = fragments.agg(F.min(day), F.max(day)).first()
        known = known.unionByName(stored.where(F.col("order_date").between(first, last)).select("order_id"))
    lost = checkpointed(fragments.select("order_id").distinct().join(known, "order_id", "left_anti"))
    if lost.isEmpty():
        return parsed, None
    marked = parsed.join((F.broadcast(lost) if fits(lost) else lost).withColumn("_lost", F.lit(True)), "order_id", "left")
    orphan = _complete() & F.col(FRAGMENT).isNotNull() & F.coalesce("_lost", F.lit(False))
    return marked.filter(~orphan).select(parsed.columns), marked.filter(orphan).select(parsed.columns)


def split_orders(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return order_rows(parsed), order_line_rows(parsed)


def nest_orders(orders: DataFrame, lines: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """Order documents from flat tables; the inverse of `split_orders` for lines that have an order.

    `orders` has the document's scalar fields, `lines` order_id and the line fields. An order
    of more than `max_lines` lines becomes a document without lines and numbered fragments that
    hold them, so no array grows beyond a fixed expected size and the order itself stands once.
    `lines_without_order` has the other lines.
    """
    # Positions come straight from the scan of `lines`: they tell equal lines apart.
    placed = lines.select("order_id", "price", "product_id", "volume", F.monotonically_increasing_id().alias("_at"))
    counted = placed.groupBy("order_id").agg(F.count(F.lit(1)).alias("_lines"))
    headers = orders.select("order_id", "customer_id", "amount", "timestamp").join(counted, "order_id", "left")
    # Headers travel with the lines, so that the documents of a long order stay apart.
    long = F.col("_lines") > max_lines
    part = F.when(long, F.pmod(F.xxhash64("_at"), F.ceil(F.col("_lines") / max_lines)) + 1).cast("int")
    nested = (
        salted_join(placed, headers.filter(F.col("_lines").isNotNull()), "order_id", salt_by=F.col("_at"))
        .groupBy("order_id", "customer_id", "amount", "timestamp", part.alias(FRAGMENT))
        .agg(F.collect_list(F.struct("price", "product_id", "volume")).alias("order_lines"))
    )
    without = headers.filter(F.col("_lines").isNull() | long).withColumns({
        "order_lines": F.array().cast(nested.schema["order_lines"].dataType), FRAGMENT: F.lit(None).cast("int")})
    fields = ORDER_DOCUMENT.fieldNames()
    return nested.select(fields).unionByName(without.select(fields))


def lines_without_order(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines that no document can hold; they belong with the rejects."""
    return lines.join(orders.select("order_id").distinct(), "order_id", "left_anti")
