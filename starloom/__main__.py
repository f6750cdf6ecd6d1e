"""Command line: python -m starloom --source PATH --target PATH [options]."""

from __future__ import annotations

import argparse
import json

from .plans.job import run
from .session import get_session


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="starloom", description=__doc__)
    p.add_argument("--source", required=True, help="extract path or database.table")
    p.add_argument("--source-format", default="csv", choices=["csv", "parquet", "table"])
    p.add_argument("--target", required=True, help="output root (ignored for tables)")
    p.add_argument("--target-format", default="parquet",
                   choices=["parquet", "csv", "both", "table", "snapshot"],
                   help="snapshot: all tables change in one step")
    p.add_argument("--database", default=None)
    p.add_argument("--master", default=None, help="leave unset under spark-submit")
    p.add_argument("--no-reports", action="store_true")
    p.add_argument("--fact-by-year", action="store_true",
                   help="one fact directory per order year (partition pruning)")
    p.add_argument("--week-start", default="monday", choices=["monday", "sunday"])
    p.add_argument("--product-match", default="triple", choices=["triple", "last_wins", "name"])
    p.add_argument("--allow-fan-out", action="store_true",
                   help="accept that --product-match name multiplies fact rows")
    p.add_argument("--csv-mode", default="PERMISSIVE", choices=["PERMISSIVE", "FAILFAST"])
    p.add_argument("--multi-line", action="store_true", help="CSV fields may hold line breaks")
    p.add_argument("--key-order", default="sorted", choices=["sorted", "first_seen"])
    a = p.parse_args(argv)
    spark = get_session(a.master)
    result = run(spark, a.source, a.target, source_format=a.source_format,
                 target_format=a.target_format, database=a.database,
                 reports=not a.no_reports, fact_by_year=a.fact_by_year,
                 week_start=a.week_start,
                 product_match=a.product_match, allow_fan_out=a.allow_fan_out,
                 csv_mode=a.csv_mode, multi_line=a.multi_line, person_key_order=a.key_order)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
