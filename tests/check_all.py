"""Run all queries against DuckDB: python tests/check_all.py [folder] [name ...]"""

import pathlib
import sys
import traceback

root = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(root), str(root / "tests")]

import __spark_entry__ as entry  # noqa: E402
from oracle import compare  # noqa: E402

from roomledger.session import local_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
names = sys.argv[2:] or list(entry.queries())
spark = local_session(8)
bad = 0
for name in names:
    try:
        seconds, rows, problem = compare(
            spark, entry.queries()[name], entry.oracle_sql().get(name), folder
        )
    except Exception as error:
        traceback.print_exc(limit=3)
        seconds, rows, problem = 0, 0, f"{type(error).__name__}: {str(error)[:600]}"
    bad += problem is not None
    print(f"{'ok ' if problem is None else 'BAD'} {name:28} {rows:8} rows {seconds:6.2f} s  {problem or ''}", flush=True)
print(f"{len(names)} queries, {bad} bad")
