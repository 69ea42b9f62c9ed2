"""Run registered queries against their SQL counterparts: python -m workload.compare [sf_dir] [names]."""

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES
from workload.session import set_folder
from workload.views import _TABLES


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def rows_of(records, columns: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in _TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN"}


def compare(spark: SparkSession, con, sf_dir: str, name: str, forbidden: tuple[str, ...] = ()) -> str:
    """Empty when both sides agree and the plan has no forbidden node, otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if found := [node for node in forbidden if node in plan]:
        return f"plan has {found}"
    got_columns, got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        return ""
    cursor = con.execute(ORACLES[name])
    want_columns, want = rows_of(cursor.fetchall(), [d[0] for d in cursor.description])
    if got_columns != want_columns:
        return f"columns {got_columns} / {want_columns}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    off = {c: (t, types[c]) for c, t in df.dtypes if _TYPES.get(t) != types[c]}
    if off:
        return f"types {off}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return f"{len(differing)} rows differ, e.g. {differing[0]}" if differing else ""


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    set_folder(spark)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    bad = 0
    for name in names or QUERIES:
        started = time.perf_counter()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {time.perf_counter() - started:6.2f}s {name} {problem}",
              flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
