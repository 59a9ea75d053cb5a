"""Runs registered queries and their SQL side by side and compares the rows."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

from tidelog.plans.fixtures import BASE_TABLES

TYPE_NAMES = {
    "bigint": {"BIGINT", "HUGEINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def differences(spark_df, con, sql: str) -> list[str]:
    names = sorted(spark_df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in spark_df.collect()]
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != names:
        return [f"columns {names} against {sorted(rel.columns)}"]
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for field in spark_df.schema.fields:
        allowed = TYPE_NAMES.get(field.dataType.simpleString(), set())
        if types[field.name] not in allowed:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    expected = [
        tuple(_plain(v) for v in r) for r in rel.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    ]
    ours, theirs = Counter(rows), Counter(expected)
    if ours != theirs:
        extra, lacking = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        problems.append(f"{len(rows)} rows against {len(expected)}; extra {extra}; lacking {lacking}")
    return problems


def main(argv: list[str]) -> int:
    """``python -m tests.compare [sf_dir] [name ...]``"""
    import __spark_entry__ as entry_points
    from tidelog.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    texts = entry_points.oracle_sql()
    bad = 0
    for name, run in entry_points.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problems = differences(df, con, texts[name]) if name in texts else [f"(no SQL) {df.count()} rows"]
            soft = name not in texts
        except Exception as error:  # noqa: BLE001
            problems, soft = [f"{type(error).__name__}: {str(error)[:1500]}"], False
        bad += bool(problems) and not soft
        print(f"{'ok ' if not problems or soft else 'BAD'} {name} {time.time() - start:.2f}s", *problems, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    os.environ.setdefault("PYTHONHASHSEED", "0")
    sys.exit(main(sys.argv[1:]))
