"""Check every registered query against its DuckDB oracle (script form of tests/test_oracle.py).

usage: python tests/check_all.py [sf_dir] [name ...]
"""
import os
import sys
import time
import traceback

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import oracle_harness as H  # noqa: E402
from commentguard.session import local_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = local_session()
    con = H.duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sqls:
                n, diff = H.compare(df, con, sqls[name])
                status = "OK" if not diff else f"DIFF {len(diff)}: {str(diff[0])[:300]}"
            else:
                n, status = df.count(), "ROWS"
        except Exception as e:  # report and continue
            n, status = -1, "ERR " + (str(e).splitlines() or ["?"])[0][:300]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += not (status.startswith("OK") or status.startswith("ROWS"))
        print(f"{name:24s} {n:7d} {time.time() - t:6.1f}s {status}", flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main()
