"""Run every catalogue query against its DuckDB oracle.

    python -m tests.run_oracle [sf_dir] [names...]
    ORACLE_JSON=out.json python -m tests.run_oracle ...   # also write a per-query summary
"""

from __future__ import annotations

import json
import os
import sys
import time

import __spark_entry__ as entry
from tests.harness import compare, duck, local_spark


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_spark()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    summary = {}
    for name, q in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = q(spark, sf_dir)
        if name in sqls:
            ok, msg = compare(df, sqls[name], con)
        else:
            ok, msg = True, f"rows-only: {df.count()} rows"
        bad += not ok
        summary[name] = {"ok": ok, "detail": msg, "sec": round(time.time() - t0, 2)}
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    print("failures:", bad)
    if os.environ.get("ORACLE_JSON"):
        with open(os.environ["ORACLE_JSON"], "w") as f:
            json.dump({"sf_dir": sf_dir, "failures": bad, "queries": summary}, f, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
