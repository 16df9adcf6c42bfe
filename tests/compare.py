"""Exact comparison of a Spark result with its oracle SQL.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def _kind(kind: pa.DataType) -> str:
    return "string" if pa.types.is_large_string(kind) else str(kind)


def differences(spark_table: pa.Table, oracle_table: pa.Table) -> str | None:
    ours = {f.name: _kind(f.type) for f in spark_table.schema}
    theirs = {f.name: _kind(f.type) for f in oracle_table.schema}
    if set(ours) != set(theirs):
        return f"columns differ: {sorted(set(ours) ^ set(theirs))}"
    kinds = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
    if kinds:
        return f"types differ: {kinds}"
    left, right = _rows(spark_table), _rows(oracle_table)
    if len(left) != len(right):
        return f"{len(left)} rows, oracle has {len(right)}"
    names = sorted(ours)
    wrong = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    if wrong:
        a, b = wrong[0]
        cells = {n: (x, y) for n, x, y in zip(names, a, b) if repr(x) != repr(y)}
        return f"{len(wrong)} of {len(left)} rows differ, first: {cells}"
    return None


def check(spark, con, name: str, sf_dir: str, queries, oracles) -> str | None:
    result = queries[name](spark, sf_dir).toArrow()
    return differences(result, con.sql(oracles[name]).to_arrow_table())


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from staywise.session import local_session

    sf_dir = str(TESTDATA / (argv[0] if argv else "sf0.01"))
    spark, con = local_session(), connect(sf_dir)
    built, oracles = queries(), oracle_sql()
    bad = 0
    for name in argv[1:] or built:
        start = time.time()
        if name in oracles:
            try:
                problem = check(spark, con, name, sf_dir, built, oracles)
            except Exception as error:  # report and go on with the next query
                problem = f"{type(error).__name__}: {str(error)[:600]}"
            verdict = problem or "ok"
            bad += problem is not None
        else:
            verdict = f"rows only: {built[name](spark, sf_dir).count()}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
