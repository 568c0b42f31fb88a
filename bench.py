"""Seconds per registered query, as one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_KEYS, BENCH_SECONDS."""

from __future__ import annotations

import json
import os
import signal
import sys
import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.cluster import RECOMMENDED_CONF, checkpointed, clear_scratch, scratch_path  # noqa: E402
from strata.operators import bronze, messages, vector_index  # noqa: E402
from strata.operators.vectors import search, search_many, upsert  # noqa: E402
from strata.plans import QUERIES  # noqa: E402
from strata.plans.inputs import log_of  # noqa: E402
from strata.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# No query is begun later than this many seconds after the first; what was left out shows in ``of``.
LONGEST = float(os.environ.get("BENCH_SECONDS", "900"))


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("strata-bench")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = (builder.config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, key: str) -> float:
    """Build the query and compute every row and column of its result, without keeping them."""
    started = time.perf_counter()
    QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def measure_rates(spark: SparkSession, times: dict[str, float]) -> dict[str, float]:
    """Figures to set beside the published claims: rows per second of whole jobs, best of three runs."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    def rate(rows: int, job: Callable[[], None]) -> int:
        seconds = []
        for _ in range(3):
            started = time.perf_counter()
            job()
            seconds.append(time.perf_counter() - started)
        return round(rows / min(seconds))

    def drop(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def spread(df: DataFrame) -> DataFrame:
        """Input in as many partitions as there are cores, as a topic or a directory of files would come."""
        return checkpointed(df.repartition(int(CPUS)))

    lines, events, vectors = spread(read("lineitem")), spread(read("events")), spread(read("embeddings"))
    landed = datetime(2024, 1, 1)
    stored = scratch_path(spark, "bench")
    messages_in = checkpointed(log_of(events))
    query = vectors.limit(1).first()["embedding"]
    collection = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    n_lines, n_events, n_vectors = lines.count(), events.count(), vectors.count()
    sql = sorted(run(spark, k) for k in times if k.startswith("sql_"))
    index = scratch_path(spark, "index")
    vector_index.build(collection, index)
    asked = collection.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    return {
        "bronze_write_rows_per_sec": rate(n_lines, lambda: bronze.ingest(lines, landed)[0].write.mode("overwrite").parquet(
            scratch_path(spark, "bronze"))),
        "table_append_rows_per_sec": rate(n_lines, lambda: tables.write(lines, stored)),
        "messages_encoded_per_sec": rate(n_events, lambda: drop(
            messages.encode(events, ["event_id", "event_type", "value"], "user_id", ["event_type"]))),
        "messages_decoded_per_sec": rate(n_events, lambda: drop(messages.decode(messages_in))),
        "vectors_upserted_per_sec": rate(n_vectors, lambda: drop(
            upsert(collection, collection, 64))),
        "vector_search_sec": round(n_vectors / rate(n_vectors, lambda: drop(search(collection, query))), 3),
        "batch_search_sec": round(1e6 / rate(10 ** 6, lambda: drop(search_many(collection, asked))), 3),
        "batch_search_index_sec": round(1e6 / rate(10 ** 6, lambda: drop(vector_index.Index(spark, index).search_many(asked))), 3),
        "vectors_scored_per_sec": rate(n_vectors * n_vectors, lambda: drop(search_many(
            collection, collection.withColumnRenamed("id", "query_id")))),
        "sql_warm_median_sec": sql[len(sql) // 2],
        "sql_warm_worst_sec": sql[-1],
    }


def main() -> None:
    """Prints one JSON line at the end, or when the run is asked to stop: a run that is cut short leaves the figures it has."""
    spark = session()
    keys = os.environ.get("BENCH_KEYS", "").split() or list(QUERIES)
    began = time.perf_counter()
    # Starts the JVM's compilers and the Python workers; not part of any figure.
    for key in ("three_layers", "vector_search_cosine"):
        run(spark, key)
    times: dict[str, float] = {}

    def report(**more: float) -> None:
        print(json.dumps({
            "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
            "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS), "of": len(keys), **more}), flush=True)

    def stopped(*_) -> None:
        report()
        os._exit(0)

    signal.signal(signal.SIGTERM, stopped)
    for key in keys:
        if time.perf_counter() - began > LONGEST:
            print(f"{key} left out: {LONGEST} s are over", file=sys.stderr, flush=True)
            continue
        times[key] = round(run(spark, key), 3)
        print(f"{key} {times[key]}", file=sys.stderr, flush=True)
    late = time.perf_counter() - began > LONGEST
    report(**({} if late or os.environ.get("BENCH_KEYS") else measure_rates(spark, times)))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
