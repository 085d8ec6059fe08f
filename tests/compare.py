"""Compare registered queries with their SQL twins: `python -m tests.compare [folder] [name ...]`."""

from __future__ import annotations

import decimal
import re
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def same_type(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal"):
        return duck_type == spark_type.upper()
    return SAME.get(spark_type) == duck_type


def check(df, con, sql: str) -> list[str]:
    """Differences in columns, types or values; empty when both agree."""
    wanted = con.execute(sql)
    names = [d[0] for d in wanted.description]
    rows = wanted.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if not same_type(kind, types[name]):
            out.append(f"type of {name}: {kind} vs {types[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    expected = sorted(tuple(cell(r[i]) for i in at) for r in rows)
    got = sorted(tuple(cell(r[n]) for n in order) for r in df.select(*order).collect())
    if len(expected) != len(got):
        out.append(f"rows {len(got)} != {len(expected)}")
    if expected != got:
        missing, extra = set(expected) - set(got), set(got) - set(expected)
        out.append(f"{order}: missing {sorted(missing)[:3]} extra {sorted(extra)[:3]} ({len(missing)}/{len(extra)})")
    return out


def main(argv: list[str]) -> int:
    from quotemill.plans import ORACLES, QUERIES, run
    from quotemill.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    patterns = argv[1:] or [""]
    spark, con, bad = local_session(8), engine(folder), 0
    for name in QUERIES:
        if not any(re.match(p, name) for p in patterns):
            continue
        began = time.time()
        try:
            if name in ORACLES:
                problems = check(run(name, spark, folder), con, ORACLES[name])
                size = ""
            else:
                problems, size = [], f" rows={run(name, spark, folder).count()} (no sql)"
        except Exception as error:  # report and go on with the next query
            problems, size = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.1f}s{size}", *problems, sep="\n     " if problems else " ")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
