"""Runs named queries in Spark and their SQL in DuckDB and compares count, columns and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("gripelode-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        # Call-site capture costs several JVM calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


SECONDS = {"spark": 0.0, "sql": 0.0}


def _value(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return str(v) if type(v).__name__ in ("datetime", "date", "Timestamp", "Decimal") else v


def canonical(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(_value(r[i])).__name__, _value(r[i])) for i in order) for r in rows)


def mismatch(spark, con, fn, sql: str | None, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    start = time.time()
    df = fn(spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    SECONDS["spark"], start = time.time() - start, time.time()
    if sql is None:
        return None if mine else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = canonical(names, cur.fetchall())
    SECONDS["sql"] = time.time() - start
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if not theirs:
        return "check returned no rows"
    if mine != theirs:
        left, right = list((mine - theirs).elements()), list((theirs - mine).elements())
        key = lambda r: [str(x) for x in r]
        return f"rows {sum(mine.values())} against {sum(theirs.values())}; only spark {len(left)} {sorted(left, key=key)[:2]}; only sql {len(right)} {sorted(right, key=key)[:2]}"
    return None


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(sf_dir)
    todo, oracle, bad = entry.queries(), entry.oracle_sql(), 0
    for name in names or todo:
        try:
            problem = mismatch(spark, con, todo[name], oracle.get(name), sf_dir)
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        print(f"{name:28s} {SECONDS['spark']:6.2f}s {SECONDS['sql']:6.2f}s {'ok' if problem is None else problem}{'' if name in oracle else ' (rows only)'}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
