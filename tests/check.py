"""Run registered queries against their SQL: python tests/check.py [sf_dir] [name ...]."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from echoloom.registry import ORACLES, QUERIES  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
            else:
                rows = QUERIES[name](spark, sf_dir).count()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
