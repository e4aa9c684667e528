"""Command line: check queries against their SQL.  ``run_oracle.py [folder] [name-part ...]``"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, oracle  # noqa: E402

from kinloom.session import build_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
spark.sparkContext.setLogLevel("ERROR")
con = oracle(folder)
sql = entry.oracle_sql()
bad = 0
for name, fn in entry.queries().items():
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        if name in sql:
            ok, note = compare(fn, sql[name], spark, con, folder)
        else:
            ok, note = True, f"{fn(spark, folder).count()} rows, no SQL"
    except Exception as err:  # report and go on with the next query
        ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
    bad += not ok
    print(f"{'ok  ' if ok else 'BAD '} {name:34s} {time.time() - start:6.2f}s  {note}", flush=True)
print("failed:", bad)
