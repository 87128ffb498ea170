"""The entry module without a library that only the training-data operators need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_other_queries_stay_without_a_library():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr[-500:]
    queries, sql = (line.split() for line in said.stdout.strip().splitlines()[-2:])
    assert len(queries) >= 68 and set(sql) <= set(queries) and not any(q.startswith("op") for q in queries)
