"""Fold closed epochs of an order stream into one partition for each day; run it daily, beside the stream.

    spark-submit orderpulse/plans/compact_orders.py --stream_id NAME [--min_age_hours 1]
"""

from __future__ import annotations

import argparse
from datetime import timedelta

from orderpulse.model import ORDER_LINES, ORDER_REJECTS, ORDERS, REFRESHES
from orderpulse.operators.compaction import fold_epochs, last_closed
from orderpulse.operators.maintained import last_refresh
from orderpulse.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--stream_id", required=True)
    parser.add_argument("--min_age_hours", type=float, default=1, help="the longest query over the tables")
    parser.add_argument("--database", default="orderpulse")
    args = parser.parse_args()
    spark = build_session("compact_orders")
    for spec in (ORDERS, ORDER_LINES, ORDER_REJECTS):
        through = last_closed(spark, spec, args.database, args.stream_id)
        if spark.catalog.tableExists(f"{args.database}.{REFRESHES.name}"):  # the kept sums read epochs that are not folded
            through = min(through, last_refresh(spark, args.database)[1].get(args.stream_id, -1))
        fold_epochs(spark, spec, args.database, args.stream_id, through, timedelta(hours=args.min_age_hours))


if __name__ == "__main__":
    main()
