"""Command line: compare registered queries with their SQL answers.

python tests/check_queries.py [--dir FOLDER] [--hot] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import tempfile
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import compare, connect  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--hot", action="store_true", help="treat most keys as hot")
    options = parser.parse_args()
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
        "spark.driver.memory": "8g",
    }
    if options.hot:
        settings["spark.tidemark.hot.minRows"] = "1"
        settings["spark.tidemark.hot.buckets"] = "8"
    spark = build_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.queries import ORACLES, QUERIES

    con = connect(options.dir)
    bad = []
    for name, function in QUERIES.items():
        if options.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in options.names):
            continue
        try:
            rows, took, problem = compare(
                spark, con, options.dir, name, function, ORACLES.get(name)
            )
        except Exception as error:
            rows, took, problem = 0, 0.0, "".join(
                traceback.format_exception_only(type(error), error)
            )[:900]
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'BAD ' if problem else 'ok  '} {name:28s} {kind:4s} {rows:8d} rows {took:6.2f}s"
              + (f"\n     {problem}" if problem else ""), flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
