"""Command line of the three batch jobs, for ``spark-submit``:

    spark-submit tidewater/cli.py parse --input IN --output OUT --run-id ID [--mode recovery] [--services a,b]
    spark-submit tidewater/cli.py join --input OUT --output JOINED --run-id ID --services a,b
    spark-submit tidewater/cli.py metrics --input JOINED --output METRICS --run-id ID [--window 30m]

The session takes its master, memory and partitions from spark-submit.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans import jobs  # noqa: E402
from tidewater.session import build_session  # noqa: E402


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater")
    commands = p.add_subparsers(dest="job", required=True)

    def job(name: str, help: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=help)
        for flag in ("--input", "--output", "--run-id"):
            c.add_argument(flag, required=True)
        return c

    modes = dict(default="normal", choices=("normal", "recovery"))
    c = job("parse", "scan, de-duplicate and validate the service events")
    c.add_argument("--mode", **modes)
    c.add_argument("--services", default="all")
    c.add_argument("--format", default="json", choices=("json", "csv", "parquet"))
    c.add_argument("--layout", default="files", choices=tuple(jobs.LAYOUTS))
    c.add_argument("--as-of", help="the time that counts as now (default: the clock)")
    c = job("join", "order timeline and running stock")
    c.add_argument("--services", required=True)
    c = job("metrics", "KPI tables and the run summary")
    c.add_argument("--window", default="30m")
    c.add_argument("--mode", **modes)
    return p


def run(spark, args: argparse.Namespace) -> dict:
    where = dict(input=args.input, output=args.output, run_id=args.run_id)
    if args.job == "parse":
        quality = jobs.parse_events(spark, **where, mode=args.mode, services=args.services, fmt=args.format, as_of=args.as_of,
                                    input_layout=jobs.LAYOUTS[args.layout])
        return {"run_id": args.run_id, "services": [r.asDict() for r in quality.collect()]}  # a row a service
    if args.job == "join":
        return {"run_id": args.run_id, "orders_enriched": jobs.cross_service_join(spark, **where, services=args.services)}
    return jobs.aggregate_metrics(spark, **where, window=args.window, mode=args.mode)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(app=f"tidewater-{args.job}")
    try:
        print(json.dumps(run(spark, args)))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
