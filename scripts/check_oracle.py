"""Run registered queries against their DuckDB oracle SQL.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from roadflow.registry import oracle_sql, queries  # noqa: E402
from roadflow.session import local_session  # noqa: E402
from roadflow.testing import compare, duck_connect  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck_connect(sf)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sqls:
                ok, msg = compare(df, con, sqls[name])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc()
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:34s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{bad} failing of {len(names or qs)}")


if __name__ == "__main__":
    main()
