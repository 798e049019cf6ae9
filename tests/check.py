"""Run registered queries against DuckDB: python -m tests.check [sf_dir] [name ...]"""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from catkeep.session import build_session
from tests.compare import connect, differences


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    every, sql = queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or sql:
        start = time.time()
        try:
            extra, missing, rows = differences(every[name](spark, sf_dir), con, sql[name])
            problem = f"extra {extra} missing {missing}" if extra or missing else ""
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:32} rows={rows:6} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{bad} of {len(sys.argv[2:]) or len(sql)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
