"""Runs registered queries next to their SQL and compares the rows.

``python -m tests.oracle [sf_dir] [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{round(value, 6):.6f}"
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
}


def compare(spark, con, sf_dir: str, build, sql: str | None) -> tuple[bool, str]:
    df = build(spark, sf_dir)
    names = df.columns
    ours = _rows(names, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(ours) >= 0, f"rows only: {len(ours)}"
    relation = con.sql(sql)
    theirs = _rows(relation.columns, relation.fetchall())
    if sorted(names) != sorted(relation.columns):
        return False, f"columns {sorted(names)} != {sorted(relation.columns)}"
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    odd = {n: (t, kinds[n]) for n, t in df.dtypes if kinds[n] not in KINDS.get(t, set())}
    if odd:
        return False, f"types differ {odd}"
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        return False, f"{len(ours)} rows against {len(theirs)}\n   ours   {str(extra)[:1500]}\n   theirs {str(missing)[:1500]}"
    return True, f"{len(ours)} rows"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from touchpoint.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, build, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
