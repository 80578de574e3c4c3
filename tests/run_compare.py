"""python tests/run_compare.py [sf_dir] [query ...]: compare and time."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import difference, duck, duck_rows, spark_rows  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from opslens.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(entry.queries())
spark = local_session(8)
con = duck(sf)
failed = 0
for name in names:
    t0 = time.time()
    try:
        got = spark_rows(entry.queries()[name](spark, sf))
        t1 = time.time()
        sql = entry.oracle_sql().get(name)
        text = "no SQL" if sql is None else difference(got, duck_rows(con, sql))
    except Exception as error:  # noqa: BLE001
        t1, text = time.time(), f"{type(error).__name__}: {str(error)[:600]}"
    failed += text not in (None, "no SQL")
    print(f"{name:22s} {t1 - t0:6.2f}s {'ok ' + str(len(got[1])) if text is None else text}", flush=True)
print("failed", failed)
