"""Runs registered queries beside their SQL and compares the results.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(lambda d: d.notna(), None)
    return df.sort_values(list(df.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for c in got.columns:
        a, b = got[c].dtype.kind, want[c].dtype.kind
        if a != b and "O" not in (a, b):
            return f"column {c}: type {got[c].dtype} against {want[c].dtype}"
    a, b = tidy(got), tidy(want)
    for c in a.columns:
        bad = [(x, y) for x, y in zip(a[c], b[c], strict=True) if x != y]
        if bad:
            return f"column {c}: {len(bad)} differ, first {str(bad[0])[:300]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from docketry.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark, con, sql = local_session(), duck(sf_dir), oracle_sql()
    wanted = sys.argv[2:] or list(queries())
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            got = queries()[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            found = difference(got, con.sql(sql[name]).df()) if name in sql else "no sql"
        except Exception as error:  # noqa: BLE001
            spent, found, got = time.time() - start, f"{type(error).__name__}: {str(error)[:700]}", []
        good = found is None or (found == "no sql" and len(got))
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:34} {spent:6.2f}s {len(got):7} rows  {found or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
