"""Consume order messages until stopped.

    spark-submit --packages <Kafka package of your Spark> orderpulse/plans/consume_orders.py \\
        --root DIR --checkpoint DIR --stream_id NAME --servers HOST:PORT [--topic orders]
"""

from __future__ import annotations

import argparse

from orderpulse.operators.tables import ensure_tables
from orderpulse.session import build_session
from orderpulse.sources.stream import file_messages, kafka_messages
from orderpulse.streaming.orders import STREAM_TABLES, run_order_stream


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--stream_id", required=True)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder that receives parquet files of messages")
    parser.add_argument("--topic", default="orders")
    parser.add_argument("--raw", help="folder for the raw copy")
    parser.add_argument("--interval", help="for example '1 minute'; as fast as possible if left out")
    parser.add_argument("--max_per_trigger", type=int, help="most offsets, or files, per epoch")
    parser.add_argument("--database", default="orderpulse")
    args = parser.parse_args()
    spark = build_session("consume_orders")
    ensure_tables(spark, args.database, args.root, STREAM_TABLES)
    if args.servers:
        messages = kafka_messages(spark, args.servers, args.topic, max_offsets_per_trigger=args.max_per_trigger)
    else:
        messages = file_messages(spark, args.folder, args.max_per_trigger)
    run_order_stream(messages, args.database, args.stream_id, args.checkpoint, args.raw, args.interval).awaitTermination()


if __name__ == "__main__":
    main()
