"""Compare catalogue queries with their SQL: ``python tests/oracle.py FOLDER [QUERY …]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, name, query, sql, folder) -> str | None:
    """What differs between the query's rows and the SQL's, or None."""
    frame = query(spark, folder)
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if mine != theirs:
        extra, missing = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
        return (
            f"{sum(mine.values())} and {sum(theirs.values())} rows\n"
            f"  only here: {str(extra)[:900]}\n  only in SQL: {str(missing)[:900]}"
        )
    if not mine:
        return "both are empty"
    return None


def main(folder: str, wanted: list[str]) -> int:
    from catalog import ORACLE, QUERIES

    from askmill.session import session_builder

    spark = session_builder(shuffle_partitions=8).master("local[8]").config(
        "spark.ui.enabled", "false"
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in ORACLE:
                found = difference(spark, connection, name, query, ORACLE[name], folder)
            else:
                found = None if query(spark, folder).count() else "empty"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - begin:.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
