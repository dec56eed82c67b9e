"""Runs registered queries against their SQL counterparts.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN",
}


def _order(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    return 0.0 if isinstance(value, float) and value == 0 else value


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when they agree."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    problems = []
    if sorted(relation.columns) != names:
        return [f"columns {sorted(set(names) ^ set(relation.columns))}"]
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema.fields:
        kind = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != types[field.name]:
            problems.append(f"type {field.name}: {kind} / {types[field.name]}")
    spark_rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    picked = ", ".join(f'"{n}"' for n in names)
    duck_rows = [tuple(map(_plain, r)) for r in con.execute(f"SELECT {picked} FROM ({sql})").fetchall()]
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} / {len(duck_rows)}")
    if not spark_rows:
        problems.append("no rows")
    a, b = sorted(spark_rows, key=_order), sorted(duck_rows, key=_order)
    if a != b:
        only_a, only_b = list(set(a) - set(b)), list(set(b) - set(a))
        problems.append(f"values: {len(only_a)} only in Spark, {len(only_b)} only in SQL")
        if only_a and only_b:
            x = sorted(only_a, key=_order)[0]
            y = max(only_b, key=lambda row: sum(p == q for p, q in zip(row, x)))
            problems.append("; ".join(f"{n}: {p!r} / {q!r}" for n, p, q in zip(names, x, y) if p != q))
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from lapak.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(cores=8), connection(folder)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                problems = compare(df, con, sqls[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(problems)
        note = "" if name in sqls else " (rows only)"
        print(f"{'BAD' if problems else 'ok '} {name}{note} {time.time() - start:.1f}s", *problems, sep="\n    " if problems else " ", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
