"""Run every registered query against its statement: python tests/check_all.py SF-or-folder [key ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from millrace.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(sf: str, *keys: str) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": os.environ.get("PARTITIONS", "8"), "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sf if os.path.isdir(sf) else f"/root/testdata/sf{sf}"
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    runs = queries()
    for key in [k for k in runs if not keys or any(k.startswith(x) for x in keys)]:
        start = time.time()
        try:
            df = runs[key](spark, sf_dir)
            verdict = compare(df, con, sql[key]) if key in sql else f"rows-only {df.count()}"
        except Exception as e:  # noqa: BLE001
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        good = verdict is None or verdict.startswith("rows-only")
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {key} {time.time() - start:.2f}s {verdict or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
