"""Compare every query with its SQL. Run: python -m tests.oracle FOLDER [names...]"""

from __future__ import annotations

import sys
import time

import duckdb

from tabwright.catalog.base import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def _rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in records)


def _family(name: str) -> str:
    name = name.lower()
    if name in ("tinyint", "smallint", "int", "integer"):
        return "integer"
    return {"varchar": "string", "float": "float"}.get(name, name)


def differences(spark, con, folder: str, query, sql: str) -> list[str]:
    """What differs between the query and its SQL; empty when nothing does."""
    df = query(spark, folder)
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: _family(str(d[1])) for d in cursor.description}
    want = _rows(names, cursor.fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        mine = _family(field.dataType.simpleString())
        if mine != types[field.name]:
            found.append(f"type of {field.name}: {mine} != {types[field.name]}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    if not got:
        found.append("no rows")
    extra, lost = set(got) - set(want), set(want) - set(got)
    if got != want:
        found.append(f"values differ: {sorted(extra)[:2]} != {sorted(lost)[:2]} ({len(extra)}/{len(lost)})")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tabwright.session import build_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = differences(spark, con, folder, query, sqls[name]) if name in sqls else ["no SQL"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name:28s} {time.time() - start:6.2f}s", *found, sep="\n     " if found else " ")
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
