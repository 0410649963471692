"""Strict comparison as a naive client would do it: pandas frames from both
engines, exact dtypes, exact ``str()`` of every value, no float rounding.

    python tests/strict_compare.py /root/testdata/sf0.01 [key ...]

Prints, per key, dtype differences and the number of rows whose exact text
differs.  Timestamp resolution (Spark ns, DuckDB us) is the one expected
dtype difference; values must still print identically.
"""

from __future__ import annotations

import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if p not in sys.path:
        sys.path.insert(0, p)

from oracle_check import duck  # noqa: E402


def main(argv):
    import __spark_entry__ as entry
    from ledgerlight.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for key in argv[2:] or sorted(sql):
        p1 = entry.queries()[key](spark, sf_dir).toPandas()
        p2 = con.execute(sql[key]).df()
        p1, p2 = p1[sorted(p1.columns)], p2[sorted(p2.columns)]
        dtypes = [(c, str(p1[c].dtype), str(p2[c].dtype)) for c in p1.columns
                  if str(p1[c].dtype) != str(p2[c].dtype)
                  and not (str(p1[c].dtype).startswith("datetime64") and str(p2[c].dtype).startswith("datetime64"))]
        r1 = Counter(tuple(str(v) for v in row) for row in p1.itertuples(index=False))
        r2 = Counter(tuple(str(v) for v in row) for row in p2.itertuples(index=False))
        diff = sum((r1 - r2).values())
        bad += bool(dtypes or diff)
        print(f"{key:26s} dtype-diffs={dtypes} text-mismatch-rows={diff}/{len(p1)}")
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
