"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df, sql, con):
    """Empty text when both sides agree, otherwise what differs."""
    collected = df.collect()
    relation = con.sql(sql)
    names = relation.columns
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(collected)
    spark_rows, sql_rows = rows_of(df.columns, collected), rows_of(names, relation.fetchall())
    if spark_rows == sql_rows:
        return "", len(collected)
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    return (
        f"{len(collected)} rows vs {sum(sql_rows.values())}; {sorted(names)}; "
        f"only spark {list(only_spark.items())[:2]}; only sql {list(only_sql.items())[:2]}"
    ), len(collected)


def main(argv):
    import __spark_entry__ as entry
    from coinfold.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    wanted = argv[2:]
    spark = build_session(
        "compare", "local[8]",
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
         "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                problem, rows = compare(df, oracle[name], con)
            else:
                problem, rows = "", len(df.collect())
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += bool(problem)
        state = "FAIL " + problem if problem else ("ok" if name in oracle else "rows only")
        print(f"@ {name} {rows} rows {time.time() - began:.1f}s {state}", flush=True)
    print(f"@ {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
