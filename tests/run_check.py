"""Run queries against the oracle: ``python tests/run_check.py [sf] [name …]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tidespan.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
folder = f"/root/testdata/sf{sf}"
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
sql = entry.oracle_sql()
bad = 0
for name, query in entry.queries().items():
    if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
        continue
    t = time.time()
    try:
        df = query(spark, folder)
        n = df.toArrow().num_rows
        took = time.time() - t
        problems = differences(df, con, sql[name]) if name in sql else ["no oracle"]
    except Exception as e:
        took, n = time.time() - t, -1
        problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        if not isinstance(e, Exception) or os.environ.get("TRACE"):
            traceback.print_exc()
    bad += bool(problems)
    print(f"{'FAIL' if problems else 'ok  '} {name:28s} rows={n:7d} {took:6.2f}s", *problems, sep="\n       " if problems else " ", flush=True)
print("failures:", bad)
spark.stop()
