"""Run registered queries in Spark and their SQL in DuckDB, and compare the answers.

    python -m tests.oracle [key ...]        (environment: SF_DIR)
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from strata.cluster import RECOMMENDED_CONF, clear_scratch
from strata.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


def session(cores: str = "8") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("strata-check")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _kind(dtype: str) -> str:
    d = str(dtype).lower()
    if "int" in d or d in ("long", "bigint", "short", "byte", "hugeint"):
        return "integer"
    if d.startswith(("double", "float", "real")):
        return "double"
    if d.startswith("timestamp"):
        return "timestamp"
    if d.startswith(("string", "varchar")):
        return "string"
    return d.split("(")[0]


def _width(dtype: str) -> str:
    d = str(dtype).lower()
    return {"integer": "int", "long": "bigint"}.get(d, d)


def _value(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (3, v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat())
    return (4, str(v))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, key: str, sf_dir: str = SF_DIR) -> list[str]:
    """Every way in which the two answers differ; empty when they agree."""
    df = QUERIES[key](spark, sf_dir)
    spark_types = dict(df.dtypes)
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    if key not in ORACLES:
        return [] if got else ["no rows"]
    rel = con.sql(ORACLES[key])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(duck_types) != names:
        return [f"columns {names} != {sorted(duck_types)}"]
    problems = [
        f"type of {n}: {spark_types[n]} != {duck_types[n]}"
        for n in names if _kind(spark_types[n]) != _kind(duck_types[n])
        or (_kind(spark_types[n]) == "integer" and _width(spark_types[n]) != _width(duck_types[n]))
    ]
    order = [list(duck_types).index(n) for n in names]
    want = [tuple(row[i] for i in order) for row in rel.fetchall()]
    a = sorted(tuple(_value(v) for v in row) for row in got)
    b = sorted(tuple(_value(v) for v in row) for row in want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [x for x in a if x not in in_b][:2], [x for x in b if x not in in_a][:2]
        problems.append(f"values differ\n   spark {only_a}\n   duck  {only_b}")
    if not a:
        problems.append("no rows")
    return problems


def main(keys: list[str]) -> int:
    spark, con, failed = session(), duck(SF_DIR), 0
    for key in keys or list(QUERIES):
        started = time.time()
        try:
            problems = compare(spark, con, key)
        except Exception as error:  # report and go on with the next key
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok" if key in ORACLES else "ok (rows only)")
        print(f"{mark:5} {key:28} {time.time() - started:6.2f}s", *problems, sep="  ", flush=True)
    clear_scratch(spark)
    print(f"{len(keys or QUERIES) - failed} ok, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
