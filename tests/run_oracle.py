"""Command line: python tests/run_oracle.py [--dir DIR] [name ...]"""

from __future__ import annotations

import argparse
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.catalog import ORACLES, QUERIES
from riskloom.session import local_session
from tests.oracle import connect, differences


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.dir)
    failed = 0
    for name in args.names or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, args.dir)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
                kind = "ok"
            else:
                kind, problems = f"rows={df.count()}", []
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += bool(problems)
        status = "DIFF" if problems else kind
        print(f"{name:32s} {time.time() - begin:6.2f}s {status}", flush=True)
        for line in problems:
            print("    ", line)
    print("failed:", failed)


if __name__ == "__main__":
    main()
