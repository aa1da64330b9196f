"""Check registered queries against DuckDB: python tests/check.py <folder> [name part ...]."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from meterlane.session import build_session  # noqa: E402
from oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    folder, parts = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    names = [n for n in queries() if not parts or any(p in n for p in parts)]
    for name in names:
        began = time.time()
        try:
            frame = queries()[name](spark, folder)
            problem = compare(frame, con, sqls[name]) if name in sqls else f"(rows only) {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if len(parts) == 1:
                traceback.print_exc()
        took = time.time() - began
        if problem and not problem.startswith("(rows only)"):
            bad += 1
            print(f"BAD {name} {took:.1f}s {problem[:900]}", flush=True)
        else:
            print(f"ok  {name} {took:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
