"""Run one refresh: ``python -m ordermill RAW_URI DATABASE [--location URI]``.

Prints the rule report; exits with 1 if a rule fails.
"""

from __future__ import annotations

import argparse
import json
import sys

from .operators.quality import QualityError
from .plans.refresh import run_refresh
from .session import build_session
from .sources.publish import ensure_database


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ordermill")
    parser.add_argument("raw_uri", help="folder of the CSV extracts, on any file system")
    parser.add_argument("database", help="database for staging, dimension and fact tables")
    parser.add_argument("--location", help="folder of the database, if it is to be made")
    options = parser.parse_args(arguments)

    spark = build_session()
    ensure_database(spark, options.database, options.location)
    try:
        published = run_refresh(spark, options.raw_uri, options.database)
        report = [line for p in published for line in p.report]
    except QualityError as error:
        published, report = [], error.report
        print(error, file=sys.stderr)
    for line in report:
        print(json.dumps(line))
    for table in published:
        print(f"published {table.name}")
    return 0 if published else 1


if __name__ == "__main__":
    sys.exit(main())
