"""Run registered queries and compare with SQL: ``python tests/check_queries.py SF_DIR [name-part ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from brightloom.session import drop_scratch, get_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = get_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = oracle.connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        begin = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in checks:
                found = oracle.differences(df, con, checks[name])
                state = "ok" if not found else "DIFF " + " | ".join(found)[:1500]
            else:
                state = f"rows {len(df.collect())}"
            bad += state.startswith("DIFF")
        except Exception as error:
            bad += 1
            state = "FAIL " + str(error)[:1200]
            if "-v" in wanted:
                traceback.print_exc()
        print(f"{name:45s} {time.time() - begin:6.2f}s  {state}", flush=True)
    drop_scratch(spark)
    print("bad", bad)
