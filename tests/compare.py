"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    result = query(spark, sf_dir)
    ours = rows_of(result.columns, result.collect())
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    theirs = rows_of(names, answer.fetchall())
    kinds = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    for column in answer.description:
        wide = str(column[1])
        if wide in ("HUGEINT", "INTEGER") or (wide == "BIGINT" and kinds[column[0]] == "int"):
            if not (wide == "INTEGER" and kinds[column[0]] == "int"):
                return f"type of {column[0]}: {kinds[column[0]]} != {wide}"
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows, expected {sum(theirs.values())}; "
        f"{sum(more.values())} unexpected such as {next(iter(more), None)}; "
        f"{sum(less.values())} missing such as {next(iter(less), None)}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from maskline.sources.staging import staging

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            with staging(spark):
                problem = (
                    compare(spark, con, sf_dir, query, sql[name])
                    if name in sql
                    else f"no SQL; {query(spark, sf_dir).count()} rows"
                )
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
