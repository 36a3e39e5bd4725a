"""Watch a folder for customer files until stopped.

    spark-submit orderpulse/plans/consume_customers.py --root DIR --checkpoint DIR --folder DIR
"""

from __future__ import annotations

import argparse

from orderpulse.operators.tables import ensure_tables
from orderpulse.session import build_session
from orderpulse.sources.stream import customer_files
from orderpulse.streaming.customers import STREAM_TABLES, run_customer_stream


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--folder", required=True)
    parser.add_argument("--archive", help="folder that files move to when they are done with, outside --folder")
    parser.add_argument("--max_per_trigger", type=int, help="most files per epoch")
    parser.add_argument("--interval", default="60 seconds")
    parser.add_argument("--database", default="orderpulse")
    args = parser.parse_args()
    spark = build_session("consume_customers")
    ensure_tables(spark, args.database, args.root, STREAM_TABLES)
    run_customer_stream(customer_files(spark, args.folder, args.max_per_trigger, args.archive), args.database, args.checkpoint,
                        interval=args.interval).awaitTermination()


if __name__ == "__main__":
    main()
