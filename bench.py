"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. A query's time is the best of
``BENCH_RUNS`` runs after one that is not counted, from building the frame to its last row.

The ``_15m`` entries stand beside the published count over 14,999,999 trips: the trips of ``events``,
repeated over a year until there are that many, are written as CSV (not timed), dumped into the table
(timed once), and then counted and charted. The table is then processed into documents (timed once),
which are charted as well, and dumped again with a report of one bad row (timed once).
"""

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.trips import enrich
from tripmill.plans import jobs
from tripmill.plans.dashboards import average_duration_by_weekday, trips_per_hour
from tripmill.operators.documents import document_schema
from tripmill.plans.queries import QUERIES, derive_trips
from tripmill.schema import ENRICHED, TRIP
from tripmill.session import scratch_path
from tripmill.sources.documents import read_documents

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
TRIPS = int(os.environ.get("BENCH_TRIPS", "14999999"))

HEADLINES = [
    "csv_scan",
    "csv_quarantine",
    "enrich",
    "filter_weekday",
    "hour_count",
    "week_day_avg_duration",
    "table_create_write",
    "table_partial_reload",
    "table_add_column",
    "table_partition_list",
    "trip_count",
    "doc_exclude",
    "doc_pattern_read",
    "job_dump",
    "job_process",
    "csv_many_files",
    "csv_long_rows",
    "table_reopened",
    "job_dump_rejects",
    "job_process_days",
]


def timed(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def best(build: Callable[[], DataFrame]) -> float:
    return min([timed(build) for _ in range(RUNS + 1)][1:])


def many_trips(spark: SparkSession) -> DataFrame:
    """``TRIPS`` trips: copies of the derived ones, each copy moved by some months of 30 days."""
    trips = derive_trips(spark, SF_DIR)
    given = trips.count()
    last = (TRIPS - 1) // given
    trips = trips.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(last))))
    moved = F.make_dt_interval(F.col("copy") % 12 * 30)
    return trips.where(F.col("copy") * given + F.col("trip_id") < TRIPS).withColumns(
        {name: F.col(name) + moved for name in ("pickup_datetime", "dropoff_datetime")}
    )


def large(spark: SparkSession) -> dict[str, float]:
    csv, name = scratch_path(spark, "csv"), "default.bench_trips"
    trips = many_trips(spark).select(*TRIP.names).repartition(4 * int(CPUS))
    trips.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(csv)
    start = time.perf_counter()
    dumped = jobs.dump(spark, csv, name, location=scratch_path(spark, "table"))
    times = {"dump_15m": round(time.perf_counter() - start, 3)}
    assert dumped.written.rows == TRIPS, dumped
    enriched = spark.table(name).transform(enrich)
    times["count_15m"] = best(lambda: spark.sql(f"select count(*) as n from {name}"))
    times["one_day_15m"] = best(lambda: spark.table(name).where("date = '2024-06-15'"))
    times["hour_count_15m"] = best(lambda: trips_per_hour(enriched))
    times["week_day_avg_duration_15m"] = best(lambda: average_duration_by_weekday(enriched))
    root, start = scratch_path(spark, "documents"), time.perf_counter()
    processed = jobs.process(spark, root, name)
    times["process_15m"] = round(time.perf_counter() - start, 3)
    assert processed.rows == TRIPS, processed
    stored = read_documents(spark, root, document_schema(ENRICHED, ["date"]))
    times["documents_hour_count_15m"] = best(lambda: trips_per_hour(stored))
    # One bad cell costs a second read of all text, for the report.
    bad = scratch_path(spark, "bad")
    trips.limit(1).select("vendor_id", F.lit("n/a").alias("pickup_datetime")).write.option("header", True).csv(bad)
    start = time.perf_counter()
    checked = jobs.dump(spark, [csv, bad], f"{name}_checked", location=scratch_path(spark, "table"), rejects_path=scratch_path(spark, "r"))
    times["dump_with_rejects_15m"] = round(time.perf_counter() - start, 3)
    assert checked.written.rows == TRIPS + 1 and checked.rejects == 1, checked
    return times


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: best(lambda run=QUERIES[name].run: run(spark, SF_DIR)) for name in HEADLINES}
    if TRIPS:
        queries |= large(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(Path(SF_DIR).name.removeprefix("sf")),
                "cpus": int(CPUS),
                "rows_per_second_count_15m": round(TRIPS / queries["count_15m"]) if TRIPS else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
