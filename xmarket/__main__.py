"""Command line (API3): python -m xmarket list | run NAME SF_DIR OUT | candidates ROWS OUT | outcomes PAIRS OUT."""

from __future__ import annotations

import argparse
import json

from xmarket.session import SETTINGS


def _session():
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("xmarket")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="xmarket", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of all queries")
    run = sub.add_parser("run", help="run a query and write its rows as Parquet")
    for name in ("name", "sf_dir", "out"):
        run.add_argument(name)
    cand = sub.add_parser("candidates", help="candidate pairs of a table of market rows")
    for name in ("rows", "out"):
        cand.add_argument(name)
    bundle = sub.add_parser("bundles", help="bundles of a table of outcome pairs")
    for name in ("pairs", "out"):
        bundle.add_argument(name)
    args = parser.parse_args(argv)
    from xmarket import catalogue

    if args.command == "list":
        print("\n".join(sorted(catalogue.queries())))
        return 0
    spark = _session()
    if args.command == "run":
        catalogue.queries()[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
    elif args.command == "candidates":
        from xmarket.plans.engine import Engine

        engine = Engine(spark)
        pruned = engine.candidates(engine.index(spark.read.parquet(args.rows)))
        pruned.write.mode("overwrite").parquet(args.out)
        print(json.dumps(engine.report(spark.read.parquet(args.out))))
    else:
        from xmarket.operators.outcomes import bundles

        bundles(spark.read.parquet(args.pairs), ["k_bet", "p_bet"]).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
