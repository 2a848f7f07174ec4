"""Run registered queries against their check statements: check.py [sf_dir] [name-part ...]"""

import sys
import time

from emberlog.session import build_session
from emberlog.workload.registry import oracle_sql, queries
from tests.compare import connect, differences


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = differences(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem) and name in sql
        took = time.time() - start
        print(f"{'ok  ' if not problem else '--  '} {name} {took:.1f}s {problem or ''}", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
