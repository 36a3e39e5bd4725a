"""Fold the change logs of customers and companies into stored states; run it daily, beside the stream.

    spark-submit orderpulse/plans/compact_customers.py [--min_age_hours 1]
"""

from __future__ import annotations

import argparse
from datetime import timedelta

from orderpulse.model import COMPANIES, CUSTOMERS
from orderpulse.operators.changelog import fold_log
from orderpulse.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--min_age_hours", type=float, default=1, help="the longest query over the tables")
    parser.add_argument("--database", default="orderpulse")
    args = parser.parse_args()
    spark = build_session("compact_customers")
    for spec in (CUSTOMERS, COMPANIES):
        fold_log(spark, spec, args.database, timedelta(hours=args.min_age_hours))


if __name__ == "__main__":
    main()
