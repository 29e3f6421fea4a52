"""Compare each query with its SQL twin: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from cabgrid.session import local_session
from checks.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    expected = dict(zip(relation.columns, map(str, relation.types)))
    if kinds != expected:
        return f"schema {kinds} against {expected}"
    names = sorted(kinds)
    got = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    want = Counter(relation.select(*[f'"{n}"' for n in names]).fetchall())
    if got != want:
        more, less = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(want.values())}; only Spark {more}; only SQL {less}"
    return None


def main(sf: str, names: list[str]) -> int:
    spark = local_session("compare")
    con = duck(sf)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
                note = "equal"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
