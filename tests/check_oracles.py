"""Compare every registered query with its SQL on the provided tables.

Run by hand: ``python tests/check_oracles.py [folder] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tests.oracle import differences  # noqa: E402
from tripflow.queries import ORACLES, QUERIES  # noqa: E402
from tripflow.session import init_spark  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = init_spark("oracles", {
        "spark.master": "local[8]", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": 8})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in sorted(os.listdir(folder)):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    failed = 0
    for name in names:
        begun = time.time()
        try:
            result = QUERIES[name](spark, folder).toPandas()
            took = time.time() - begun
            problem = differences(result, con.execute(ORACLES[name]).df()) if name in ORACLES else ""
        except Exception as e:  # noqa: BLE001
            took, problem, result = time.time() - begun, f"{type(e).__name__}: {str(e)[:600]}", []
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{len(result):8} rows {took:6.2f}s {problem}",
              flush=True)
    spark.stop()
    sys.exit(1 if failed else 0)
