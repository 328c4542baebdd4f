"""python tests/run_oracle.py [sf_dir] [name ...]: compare queries with their SQL."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402

from rateloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        sql = entry.oracle_sql().get(name)
        try:
            result = compare(spark, sf_dir, query, sql, con)
        except Exception as error:  # noqa: BLE001
            result = {"ok": False, "error": str(error)[:1500]}
        print("ok  " if result["ok"] else "FAIL", name, result if not result["ok"] else (result["rows"][0], result["seconds"]), flush=True)
        if not result["ok"]:
            bad.append(name)
    print("failed:", bad)
