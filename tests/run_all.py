"""Compare every registered query with its oracle: ``python tests/run_all.py [sf_dir] [name part]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
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
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if part not in name:
            continue
        started = time.perf_counter()
        try:
            df = fn(spark, folder)
            if name in oracles:
                verdict = differences(df, con, oracles[name]) or "equal"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {str(error)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += not (verdict == "equal" or verdict.startswith("rows only"))
        print(f"{time.perf_counter() - started:6.2f}s  {name}: {verdict}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
