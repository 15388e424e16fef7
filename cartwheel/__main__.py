"""Command line: ``python -m cartwheel {list,query,daily} …``.

  list                               the named queries
  query NAME --warehouse ROOT        run a query on the warehouse fact tables
  query NAME --tables SF_DIR         run it on the test tables (built on the fly)
  daily --payloads P --landing L --warehouse W [--archive A] [--lines] [--buckets N]
  validate --warehouse W             run the load gate on the warehouse
                                     land, load and validate
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cartwheel")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    src = q.add_mutually_exclusive_group(required=True)
    src.add_argument("--warehouse")
    src.add_argument("--tables")
    q.add_argument("--rows", type=int, default=50)
    d = sub.add_parser("daily")
    d.add_argument("--payloads")
    d.add_argument("--landing", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--archive")
    d.add_argument("--checkpoint")
    d.add_argument("--lines", action="store_true", help="payloads are JSON Lines")
    d.add_argument("--buckets", type=int, help="bucket a new warehouse by order_id")
    v = sub.add_parser("validate")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--recount", action="store_true", help="count the whole tables, and compare with the totals kept")
    args = parser.parse_args(argv)

    from cartwheel.plans.registry import FACT_QUERIES, QUERIES
    if args.cmd == "list":
        print("\n".join(QUERIES))
        return 0

    from pyspark.sql import SparkSession
    from cartwheel.session import configure
    spark = configure(SparkSession.builder.appName("cartwheel").getOrCreate())
    if args.cmd == "query":
        if args.tables:
            df = QUERIES[args.name](spark, args.tables)
        else:
            from cartwheel.plans.registry import run_on_facts
            from cartwheel.sources import warehouse
            if args.name not in FACT_QUERIES:
                parser.error(f"{args.name} runs on the test tables only")
            df = run_on_facts(
                args.name,
                warehouse.read_table(spark, args.warehouse, warehouse.FACT_ORDERS_TABLE),
                warehouse.read_table(spark, args.warehouse, warehouse.FACT_ORDER_PRODUCTS_TABLE))
        df.show(args.rows, truncate=False)
        return 0
    if args.cmd == "validate":
        from cartwheel.sources.gate import validate_warehouse
        report = validate_warehouse(spark, args.warehouse, args.recount)
        print(json.dumps(report.__dict__))
        return 0
    from cartwheel.daily import run_daily_load
    stats = run_daily_load(spark, args.payloads, args.landing, args.warehouse,
                           args.checkpoint, args.archive, lines=args.lines,
                           buckets=args.buckets)
    print(json.dumps(stats, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
