"""Run queries against their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

import checks.streams  # noqa: F401  (registers the streaming queries)
from checks.oracle import ORACLE
from checks.queries import QUERIES
from parcelflow.session import build_session

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime):
        return value.isoformat()
    return value if value is None or isinstance(value, (str, int, bool, Decimal, date)) else str(value)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    took = time.time() - start
    if name not in ORACLE:
        return True, f"{sum(got.values())} rows, no SQL, {took:.1f}s"
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return False, f"columns {columns} against {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[i]) for i in at) for row in result.fetchall())
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return False, f"{sum(got.values())} rows against {sum(want.values())}\n  {columns}\n  spark {extra}\n  sql   {missing}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    sql_kinds = {d[0]: str(d[1]) for d in result.description}
    odd = [f"{c}: {kinds[c]} / {sql_kinds[c]}" for c in columns if not _same_kind(kinds[c], sql_kinds[c])]
    return not odd, f"{sum(got.values())} rows, {took:.1f}s" + (f", types {odd}" if odd else "")


def _same_kind(spark_kind: str, sql_kind: str) -> bool:
    fixed = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE"}
    return fixed.get(spark_kind, spark_kind.upper()) == sql_kind.replace(" ", "")


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    failed = []
    for name in argv[1:] or QUERIES:
        try:
            good, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if good else "FAIL", name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
