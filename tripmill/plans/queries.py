"""One query per piece of the library, each with the SQL that must give the same rows.

The given tables hold no trips, so trips are derived row by row from ``events``: the event time is the
pickup, the drop-off lies ``value`` minutes later, and the remaining columns follow from the event.
"""

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.functions.trips import enrich, with_date
from tripmill.operators import documents, ledger, table
from tripmill.operators.align import align
from tripmill.operators.documents import document_schema
from tripmill.plans import jobs
from tripmill.plans.dashboards import average_duration_by_weekday, trips_per_hour
from tripmill.schema import INDEX_TEMPLATE, TRIP
from tripmill.session import scratch_path, use_zone
from tripmill.sources.csv import read_checked_csv, read_csv, rejects_of, rows_of
from tripmill.sources.documents import read_documents
from tripmill.sources.tables import read_table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


QUERIES: dict[str, Query] = {}

# The trips, and what is derived from them, as SQL.
_TRIPS = """
with t as (
  select event_id as trip_id, event_type as vendor_id, ts as pickup_datetime,
         ts + to_milliseconds(cast(floor(value * 60000) as bigint)) as dropoff_datetime,
         cast(length(event_type) as integer) as passenger_count, value / 10 as trip_distance,
         case when event_type = 'error' then 'Y' end as store_and_fwd_flag, props as payment_type,
         value as fare_amount, value as total_amount, strftime(ts, '%Y-%m-%d') as date,
         dayname(ts) in ('Saturday', 'Sunday') as weekend
  from events)
"""
_DURATION = (
    "(cast(floor(epoch(dropoff_datetime)) as bigint) - cast(floor(epoch(pickup_datetime)) as bigint)) / 60"
)
_WEEKDAY_AVERAGES = (
    _TRIPS + f"select dayname(pickup_datetime) as pickup_week_day, round(avg({_DURATION}), 6) as avg_duration "
    "from t group by 1"
)
_HOURS = _TRIPS + "select cast(hour(pickup_datetime) as integer) as pickup_hour, count(*) as n from t group by 1"
_STORED = _TRIPS + "select trip_id, vendor_id, total_amount, date from t"

_TRIP_WITH_ID = StructType([StructField("trip_id", LongType()), *TRIP])


def register(sql: str, name: str | None = None) -> Callable[[Run], Run]:
    def keep(run: Run) -> Run:
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return keep


def derive_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trip_id`` and the 18 trip columns, from ``events``."""
    use_zone(spark)
    pickup = F.col("ts").cast("timestamp")
    given = {
        "trip_id": F.col("event_id"),
        "vendor_id": F.col("event_type"),
        "pickup_datetime": pickup,
        "dropoff_datetime": F.timestamp_add("MILLISECOND", F.floor(F.col("value") * 60000).cast("int"), pickup),
        "passenger_count": F.length("event_type"),
        "trip_distance": F.col("value") / 10,
        "store_and_fwd_flag": F.when(F.col("event_type") == "error", F.lit("Y")),
        "payment_type": F.col("props"),
        "fare_amount": F.col("value"),
        "total_amount": F.col("value"),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return align(events.select(*[value.alias(name) for name, value in given.items()]), _TRIP_WITH_ID)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four columns of every trip, ``date`` among them."""
    return with_date(derive_trips(spark, sf_dir)).select("trip_id", "vendor_id", "total_amount", "date")


def _weekends(df: DataFrame) -> DataFrame:
    return df.where(F.date_format(F.to_date("date"), "EEEE").isin("Saturday", "Sunday"))


def _new_table(spark: SparkSession) -> tuple[str, str]:
    return f"default.trips_{uuid.uuid4().hex}", scratch_path(spark, "table")


def _written(*frames: DataFrame, partition_by=("date",)) -> DataFrame:
    """A new table after these writes, one upon the other."""
    spark = frames[0].sparkSession
    name, location = _new_table(spark)
    for frame in frames:
        table.write(frame, name, partition_by, location=location)
    return spark.table(name)


def _as_csv(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "csv")
    df.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


def _with_bad_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checked read of trips whose total is no number where the vendor is ``error``."""
    trips = derive_trips(spark, sf_dir)
    total = F.when(F.col("vendor_id") == "error", F.lit("n/a")).otherwise(F.col("total_amount").cast("string"))
    return read_checked_csv(spark, _as_csv(trips.withColumn("total_amount", total)), _TRIP_WITH_ID)


def _documented(df: DataFrame, *more: tuple[DataFrame, str], pattern: str = "*") -> DataFrame:
    """The documents after appending ``df`` and then doing ``more`` writes, each in its mode."""
    spark = df.sparkSession
    root = scratch_path(spark, "documents")
    for frame, mode in [(df, "append"), *more]:
        documents.write(frame, root, INDEX_TEMPLATE, exclude=["date"], mode=mode)
    return read_documents(spark, root, document_schema(df.schema, ["date"]), pattern)


# --- CSV ---------------------------------------------------------------------------------------


@register(
    _TRIPS + "select trip_id, vendor_id, epoch_us(pickup_datetime) as pickup_us, "
    "epoch_us(dropoff_datetime) as dropoff_us, passenger_count, trip_distance, store_and_fwd_flag, "
    "payment_type, total_amount from t"
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = read_csv(spark, _as_csv(derive_trips(spark, sf_dir)), _TRIP_WITH_ID, check_header=True)
    return trips.select(
        "trip_id",
        "vendor_id",
        F.unix_micros("pickup_datetime").alias("pickup_us"),
        F.unix_micros("dropoff_datetime").alias("dropoff_us"),
        "passenger_count",
        "trip_distance",
        "store_and_fwd_flag",
        "payment_type",
        "total_amount",
    )


@register(
    _TRIPS + "select cast(trip_id as varchar) as trip_id, 'n/a' as total_amount, 'total_amount' as bad_cells "
    "from t where vendor_id = 'error'"
)
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = rejects_of(_with_bad_totals(spark, sf_dir))
    return rejects.select("trip_id", "total_amount", F.array_join("bad_cells", ",").alias("bad_cells"))


@register(
    _TRIPS + "select trip_id, vendor_id, passenger_count, fare_amount, "
    "case when vendor_id <> 'error' then total_amount end as total_amount from t"
)
def csv_bad_cells_are_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of(_with_bad_totals(spark, sf_dir))
    return rows.select("trip_id", "vendor_id", "passenger_count", "fare_amount", "total_amount")


@register(_TRIPS + "select trip_id, vendor_id, total_amount from t")
def csv_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of several files, of different sizes, are all compared with the declared names."""
    trips = derive_trips(spark, sf_dir)
    paths = [_as_csv(trips.where(F.pmod("trip_id", F.lit(7)).isin(part))) for part in ([0], [1, 2], [3, 4, 5, 6])]
    read = read_csv(spark, paths, _TRIP_WITH_ID, check_header=True)
    return read.select("trip_id", "vendor_id", "total_amount")


@register(
    "select cast(event_id as varchar) as trip_id, event_id || ',' || event_type || ',a,,b c,d,' || event_id as line, "
    "'line' as bad_cells from events where event_type = 'error'"
)
def csv_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with five cells too many keep all of them in the report."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.concat_ws(",", "event_id", "event_type")
    surplus = F.when(F.col("event_type") == "error", F.concat(F.lit(",a,,b c,d,"), "event_id")).otherwise(F.lit(""))
    # Written as one column under the header of two, so no cell is quoted for its commas.
    path = scratch_path(spark, "lines")
    lines = events.select(F.concat(text, surplus).alias("trip_id,vendor_id"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    schema = StructType().add("trip_id", "string").add("vendor_id", "string")
    rejects = rejects_of(read_checked_csv(spark, path, schema, check_header=True))
    return rejects.select("trip_id", "line", F.array_join("bad_cells", ",").alias("bad_cells"))


# --- derived columns and aggregates ------------------------------------------------------------


@register(_TRIPS + "select trip_id, date from t")
def derive_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_date(derive_trips(spark, sf_dir)).select("trip_id", "date")


@register(
    _TRIPS + """select trip_id, strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%g+0000') as "timestamp",
    dayname(pickup_datetime) as pickup_week_day, cast(hour(pickup_datetime) as integer) as pickup_hour, """
    f"{_DURATION} as duration from t",
    name="enrich",
)
def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = derive_trips(spark, sf_dir).transform(enrich)
    return trips.select("trip_id", "timestamp", "pickup_week_day", "pickup_hour", "duration")


@register(_TRIPS + "select count(*) as n from t where dayname(pickup_datetime) = 'Friday'")
def filter_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = derive_trips(spark, sf_dir).transform(enrich)
    return trips.where(F.col("pickup_week_day") == "Friday").agg(F.count(F.lit(1)).alias("n"))


@register(_HOURS)
def hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_per_hour(derive_trips(spark, sf_dir).transform(enrich))


@register(_WEEKDAY_AVERAGES)
def week_day_avg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(average_duration_by_weekday(derive_trips(spark, sf_dir).transform(enrich)))


def _rounded(averages: DataFrame) -> DataFrame:
    return averages.withColumn("avg_duration", F.round("avg_duration", 6))


# --- the table ---------------------------------------------------------------------------------


@register(_STORED)
def table_create_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(_dated(spark, sf_dir))


@register(_STORED)
def table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, trips)


@register(
    _TRIPS + "select trip_id, vendor_id, case when weekend then total_amount * 2 else total_amount end "
    "as total_amount, date from t"
)
def table_partial_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, _weekends(trips).withColumn("total_amount", F.col("total_amount") * 2))


@register(
    _TRIPS + "select trip_id, vendor_id, total_amount, "
    "case when weekend then cast(0.5 as double) end as surcharge, date from t"
)
def table_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, _weekends(trips).withColumn("surcharge", F.lit(0.5)))


@register(
    _TRIPS + "select trip_id, case when weekend then null else vendor_id end as vendor_id, total_amount, date from t"
)
def table_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, _weekends(trips).drop("vendor_id"))


@register(_STORED)
def table_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, trips.toDF(*[name.upper() for name in trips.columns]))


@register(_STORED)
def table_empty_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _written(trips, trips.where("total_amount < 0"))


@register(
    _TRIPS + "select trip_id, vendor_id, total_amount, case when vendor_id <> 'error' then date end as date from t"
)
def table_null_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = F.when(F.col("vendor_id") != "error", F.col("pickup_datetime"))
    trips = with_date(derive_trips(spark, sf_dir).withColumn("pickup_datetime", pickup))
    return _written(trips.select("trip_id", "vendor_id", "total_amount", "date"))


@register(_TRIPS + "select trip_id, total_amount from t where date = '2024-01-15'")
def table_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _new_table(spark)
    table.write(_dated(spark, sf_dir), name, location=location)
    return read_table(spark, name, dates=["2024-01-15"], columns=["trip_id", "total_amount"])


@register("select count(*) as n from events")
def trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _new_table(spark)
    table.write(_dated(spark, sf_dir), name, location=location)
    return spark.sql(f"select count(*) as n from {name}")


@register("select count(*) as n, true as created from events")
def table_write_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = _new_table(spark)
    result = table.write(_dated(spark, sf_dir), name, location=location)
    return spark.range(1).select(
        F.lit(result.rows).cast("bigint").alias("n"), F.lit(result.created).alias("created")
    )


@register(
    "select l_orderkey, l_linenumber, l_extendedprice, l_returnflag, strftime(l_shipdate, '%Y-%m') as ship_month "
    "from lineitem"
)
def table_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_zone(spark)
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
    )
    return _written(items, partition_by=["l_returnflag", "ship_month"])


@register(
    _TRIPS + "select trip_id, cast(cast(total_amount as decimal(12, 2)) as varchar) as amount, "
    "vendor_id as first_name, total_amount as by_key, passenger_count as inner_count, date from t"
)
def table_wide_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = with_date(derive_trips(spark, sf_dir)).select(
        "trip_id",
        F.col("total_amount").cast("decimal(12, 2)").alias("amount"),
        F.array("vendor_id", "payment_type").alias("names"),
        F.create_map("vendor_id", "total_amount").alias("totals"),
        F.struct(F.col("passenger_count").alias("the count"), "vendor_id").alias("nested"),
        "date",
    )
    return _written(trips).select(
        "trip_id",
        F.col("amount").cast("string").alias("amount"),
        F.col("names")[0].alias("first_name"),
        F.element_at("totals", F.col("nested.vendor_id")).alias("by_key"),
        F.col("nested.`the count`").alias("inner_count"),
        "date",
    )


@register(
    _TRIPS + "select trip_id, cast(passenger_count as bigint) as n, "
    "case when weekend then cast(passenger_count as double) else total_amount end as amount, "
    "case when weekend then '2024-02-03 00:00:00' else '2024-02-03 04:05:06' end as at, date from t"
)
def table_widening_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of narrower types into a table of wider ones."""
    trips = with_date(derive_trips(spark, sf_dir))
    n, amount = F.col("passenger_count").alias("n"), F.col("total_amount").alias("amount")
    at = F.lit("2024-02-03 04:05:06").cast("timestamp").alias("at")
    wide = trips.select("trip_id", n.cast("bigint").alias("n"), amount, at, "date")
    whole, day = F.col("passenger_count").alias("amount"), F.lit("2024-02-03").cast("date").alias("at")
    narrow = _weekends(trips.select("trip_id", n, whole, day, "date"))
    stored = _written(wide, narrow)
    return stored.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@register(_TRIPS + "select trip_id, vendor_id, total_amount, cast(null as double) as surcharge, date from t")
def table_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose catalog entry is gone, entered again from its location with a column that no file has."""
    trips = _dated(spark, sf_dir)
    name, location = _new_table(spark)
    table.write(trips, name, location=location)
    table.write(trips.where("total_amount < 0").withColumn("surcharge", F.lit(0.5)), name)
    spark.sql(f"drop table {name}")
    table.attach(spark, name, location)
    return spark.table(name)


@register(
    _TRIPS + "select trip_id, vendor_id as \"Location\", total_amount as \"Provider\", cast(null as integer) as surcharge, date from t"
)
def table_location_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with columns named like properties of tables, entered again from where it lies."""
    trips = _dated(spark, sf_dir).withColumnsRenamed({"vendor_id": "Location", "total_amount": "Provider"})
    name, location = _new_table(spark)
    table.write(trips, name, location=location)
    table.write(trips.where("Provider < 0").withColumn("surcharge", F.lit(1)), name)
    spark.sql(f"drop table {name}")
    table.attach(spark, name, location)
    return spark.table(name)


def _doubled(trips: DataFrame) -> DataFrame:
    return trips.withColumn("total_amount", F.col("total_amount") * 2)


@register(
    _TRIPS + "select trip_id, vendor_id, case when weekend then total_amount * 2 else total_amount end "
    "as total_amount, date from t"
)
def table_all_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days replaced together, beside others that stay, in a table that is then entered again."""
    trips = _dated(spark, sf_dir)
    name, location = _new_table(spark)
    table.write(trips, name, location=location)
    table.write(_doubled(_weekends(trips)), name, all_or_none=True)
    spark.sql(f"drop table {name}")
    table.attach(spark, name, location)
    return spark.table(name)


@register(
    _TRIPS + "select trip_id, vendor_id, case when weekend then total_amount * 4 else total_amount * 2 end "
    "as total_amount, date from t"
)
def table_loads_of_both_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days replaced together, then day by day, then together again."""
    trips = _dated(spark, sf_dir)
    name, location = _new_table(spark)
    doubled = _doubled(trips)
    table.write(trips, name, location=location, all_or_none=True)
    table.write(doubled, name)
    table.write(_doubled(_weekends(doubled)), name, all_or_none=True)
    return spark.table(name)


@register(
    _TRIPS + "select trip_id, vendor_id, total_amount, case when weekend then 1 else 2 end as load_no, "
    "case when weekend then 1 end as weekend_load, case when not weekend then 2 end as other_load, date from t"
)
def table_concurrent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads at once that both add a column, and each one of its own."""
    trips = _dated(spark, sf_dir)
    name, location = _new_table(spark)
    table.write(trips.where("total_amount < 0"), name, location=location)
    weekends = _weekends(trips)
    others = trips.join(weekends.select("date").distinct(), "date", "left_anti").select(trips.columns)
    loads = [
        weekends.withColumn("load_no", F.lit(1)).withColumn("weekend_load", F.lit(1)),
        others.withColumn("load_no", F.lit(2)).withColumn("other_load", F.lit(2)),
    ]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda load: table.write(load, name), loads))
    return spark.table(name).select("trip_id", "vendor_id", "total_amount", "load_no", "weekend_load", "other_load", "date")


@register(
    "select l_returnflag, strftime(l_shipdate, '%Y-%m') as ship_month, count(*) as n from lineitem group by all"
)
def table_rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the result of a load says of its partitions, counted by the pass that wrote them."""
    use_zone(spark)
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_returnflag", F.date_format("l_shipdate", "yyyy-MM").alias("ship_month")
    )
    name, location = _new_table(spark)
    written = table.write(items, name, ["l_returnflag", "ship_month"], location=location)
    # A row for each partition of the load.
    rows = [(*key, n) for key, n in written.partitions.items()]
    return spark.createDataFrame(rows, "l_returnflag string, ship_month string, n bigint")


@register(
    _TRIPS + "select date, count(*) as n, count(*) filter (weekend) as n_weekend from t group by date"
)
def table_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger of a table says of its loads: one of all days, then one of some."""
    trips = _dated(spark, sf_dir)
    name, location = _new_table(spark)
    for frame, together in [(trips, False), (trips.where("total_amount < 0"), False), (_weekends(trips), True)]:
        table.write(frame, name, location=location, all_or_none=together)
    # A row for each day of a load.
    first, second = ledger.loads(spark, table.location_of(spark, name)).values()
    rows = [(day, n, second.get((day,), 0)) for (day,), n in first.items()]
    return spark.createDataFrame(rows, "date string, n bigint, n_weekend bigint")


@register(
    _TRIPS + "select total_amount, cast(null as integer) as rate_code, trip_id, cast(null as varchar) as note from t"
)
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = (
        StructType().add("total_amount", "double").add("rate_code", "integer").add("TRIP_ID", "long").add("note", "string")
    )
    trips = align(_dated(spark, sf_dir), want)
    return trips.withColumnRenamed("TRIP_ID", "trip_id")


# --- documents ---------------------------------------------------------------------------------


@register(_TRIPS + """select 'taxi-' || date as "index", count(*) as n from t group by 1""")
def doc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documented(_dated(spark, sf_dir)).groupBy("index").agg(F.count(F.lit(1)).alias("n"))


@register(_TRIPS + """select trip_id, vendor_id, total_amount, 'taxi-' || date as "index" from t""")
def doc_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documented(_dated(spark, sf_dir))


@register("select 2 * count(*) as n from events")
def doc_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    return _documented(trips, (trips, "append")).agg(F.count(F.lit(1)).alias("n"))


@register(
    _TRIPS + "select trip_id, vendor_id, case when weekend then total_amount * 2 else total_amount end "
    """as total_amount, 'taxi-' || date as "index" from t"""
)
def doc_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated(spark, sf_dir)
    doubled = _weekends(trips).withColumn("total_amount", F.col("total_amount") * 2)
    return _documented(trips, (doubled, "replace"))


@register(_TRIPS + """select trip_id, total_amount, 'taxi-' || date as "index" from t where date like '2024-01-1%'""")
def doc_pattern_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _documented(_dated(spark, sf_dir), pattern="taxi-2024-01-1*")
    return found.select("trip_id", "total_amount", "index")


@register(
    _TRIPS + """select trip_id, total_amount, vendor_id || '.' || passenger_count || '-' || date as "index" from t"""
)
def doc_route_by_many_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = with_date(derive_trips(spark, sf_dir))
    trips = trips.select("trip_id", "total_amount", "vendor_id", "passenger_count", "date")
    root, hidden = scratch_path(spark, "documents"), ["vendor_id", "passenger_count", "date"]
    documents.write(trips, root, "{vendor_id}.{passenger_count}-{date}", exclude=hidden)
    return read_documents(spark, root, document_schema(trips.schema, hidden))


@register(
    _TRIPS + """select trip_id, coalesce('flag-' || store_and_fwd_flag, 'flag-none') as "index" from t"""
)
def doc_null_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = derive_trips(spark, sf_dir).select("trip_id", "store_and_fwd_flag")
    root, hidden = scratch_path(spark, "documents"), ["store_and_fwd_flag"]
    documents.write(trips, root, "flag-{store_and_fwd_flag}", exclude=hidden, null_index="flag-none")
    return read_documents(spark, root, document_schema(trips.schema, hidden))


@register(_TRIPS + """select trip_id, case when vendor_id = 'error' then 'none' else vendor_id end as "index" from t""")
def doc_empty_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose index name is empty go where those without one go."""
    vendor = F.when(F.col("vendor_id") == "error", F.lit("")).otherwise(F.col("vendor_id"))
    trips = derive_trips(spark, sf_dir).select("trip_id", vendor.alias("vendor"))
    root = scratch_path(spark, "documents")
    documents.write(trips, root, "{vendor}", exclude="vendor", null_index="none")
    return read_documents(spark, root, document_schema(trips.schema, "vendor"))


# --- jobs --------------------------------------------------------------------------------------


def _dumped(spark: SparkSession, sf_dir: str) -> str:
    name, location = _new_table(spark)
    jobs.dump(spark, _as_csv(derive_trips(spark, sf_dir).drop("trip_id")), name, location=location)
    return name


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = _dumped(spark, sf_dir), scratch_path(spark, "documents")
    jobs.process(spark, root, name)
    return read_documents(
        spark, root, document_schema(enrich(spark.table(name)).schema, ["date"]), "taxi-*"
    )


@register(
    _TRIPS + "select vendor_id, epoch_us(pickup_datetime) as pickup_us, epoch_us(dropoff_datetime) as dropoff_us, "
    "passenger_count, trip_distance, store_and_fwd_flag, payment_type, cast(null as double) as tolls_amount, "
    "total_amount, date from t"
)
def job_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_dumped(spark, sf_dir)).select(
        "vendor_id",
        F.unix_micros("pickup_datetime").alias("pickup_us"),
        F.unix_micros("dropoff_datetime").alias("dropoff_us"),
        "passenger_count",
        "trip_distance",
        "store_and_fwd_flag",
        "payment_type",
        "tolls_amount",
        "total_amount",
        "date",
    )


@register(
    _TRIPS + """select vendor_id, strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%g+0000') as "timestamp",
    epoch_us(pickup_datetime) as pickup_us, dayname(pickup_datetime) as pickup_week_day,
    cast(hour(pickup_datetime) as integer) as pickup_hour, """
    f"""{_DURATION} as duration, payment_type, total_amount, 'taxi-' || date as "index" from t"""
)
def job_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _processed(spark, sf_dir).select(
        "vendor_id",
        "timestamp",
        F.unix_micros("pickup_datetime").alias("pickup_us"),
        "pickup_week_day",
        "pickup_hour",
        "duration",
        "payment_type",
        "total_amount",
        "index",
    )


@register(_WEEKDAY_AVERAGES)
def documents_week_day_avg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(average_duration_by_weekday(_processed(spark, sf_dir)))


@register(_HOURS)
def documents_hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_per_hour(_processed(spark, sf_dir))


@register(
    _TRIPS + "select date, 'n/a' as total_amount, 'total_amount' as bad_cells, count(*) as n from t "
    "where vendor_id = 'error' group by date"
)
def job_dump_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a load with bad cells, in place of that of an earlier one."""
    trips = derive_trips(spark, sf_dir).drop("trip_id")
    total = F.when(F.col("vendor_id") == "error", F.lit("n/a")).otherwise(F.col("total_amount").cast("string"))
    bad = _as_csv(trips.withColumn("total_amount", total))
    worse = _as_csv(trips.withColumn("total_amount", F.lit("n/a")))
    name, location = _new_table(spark)
    report = scratch_path(spark, "rejects")
    for csv in (worse, bad):
        jobs.dump(spark, csv, name, location=location, rejects_path=report)
    found = spark.read.schema("pickup_datetime string, total_amount string, bad_cells array<string>").json(report)
    day = F.substring("pickup_datetime", 1, 10).alias("date")
    rows = found.select(day, "total_amount", F.array_join("bad_cells", ",").alias("bad_cells"))
    return rows.groupBy("date", "total_amount", "bad_cells").agg(F.count(F.lit(1)).alias("n"))


@register(
    _TRIPS + """select vendor_id, total_amount, 'taxi-' || date as "index" from t
    where date between '2024-01-10' and '2024-01-12'"""
)
def job_process_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = _dumped(spark, sf_dir), scratch_path(spark, "documents")
    jobs.process(spark, root, name, since="2024-01-10", until="2024-01-12")
    schema = document_schema(enrich(spark.table(name)).schema, ["date"])
    return read_documents(spark, root, schema).select("vendor_id", "total_amount", "index")


def _as_one_gzip(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "csv")
    whole = df.coalesce(1).write.option("header", True).option("compression", "gzip")
    whole.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


@register(
    _TRIPS + "select vendor_id, epoch_us(pickup_datetime) as pickup_us, total_amount, payment_type, date from t"
)
def job_dump_one_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file that does not split; what it holds for a day is dealt out a hundred rows at a time."""
    name, location = _new_table(spark)
    csv = _as_one_gzip(derive_trips(spark, sf_dir).drop("trip_id"))
    jobs.dump(spark, csv, name, location=location, rows_per_task=100)
    pickup = F.unix_micros("pickup_datetime").alias("pickup_us")
    return spark.table(name).select("vendor_id", pickup, "total_amount", "payment_type", "date")


@register(
    _TRIPS + "select date, 'total_amount' as bad_cells, count(*) as n from t "
    "where vendor_id = 'error' and trip_id % 16 = 3 group by date"
)
def job_dump_few_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen files, one of them with bad cells: only that one is read for the report."""
    trips = derive_trips(spark, sf_dir)
    bad = (F.col("vendor_id") == "error") & (F.col("trip_id") % 16 == 3)
    total = F.when(bad, F.lit("n/a")).otherwise(F.col("total_amount").cast("string"))
    csv, report = scratch_path(spark, "csv"), scratch_path(spark, "rejects")
    parts = trips.withColumn("total_amount", total).withColumn("part", F.col("trip_id") % 16).drop("trip_id")
    for part in range(16):
        mine = parts.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").option("header", True)
        mine.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(csv)
    name, location = _new_table(spark)
    jobs.dump(spark, csv, name, location=location, rejects_path=report)
    found = spark.read.schema("pickup_datetime string, bad_cells array<string>").json(report)
    day = F.substring("pickup_datetime", 1, 10).alias("date")
    rows = found.select(day, F.array_join("bad_cells", ",").alias("bad_cells"))
    return rows.groupBy("date", "bad_cells").agg(F.count(F.lit(1)).alias("n"))


@register(
    _TRIPS + """select vendor_id, case when weekend then total_amount * 2 else total_amount end as total_amount,
    'taxi-' || date as "index" from t"""
)
def job_process_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days are dumped and processed, then some are dumped anew, and only those processed again."""
    trips = derive_trips(spark, sf_dir).drop("trip_id")
    name, location = _new_table(spark)
    root = scratch_path(spark, "documents")
    weekends = _doubled(_weekends(with_date(trips)).drop("date"))
    for load in (trips, weekends):
        jobs.dump(spark, _as_csv(load), name, location=location)
        jobs.process(spark, root, name, changed=True)
    schema = document_schema(enrich(spark.table(name)).schema, ["date"])
    return read_documents(spark, root, schema).select("vendor_id", "total_amount", "index")


@register(
    _TRIPS + "select 'taxi-' || date as \"index\", count(*) as n from t where weekend group by date"
)
def job_process_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over the changes reads: the first load counts as seen, so only documents of days of the second are made."""
    trips = derive_trips(spark, sf_dir).drop("trip_id")
    name, location = _new_table(spark)
    root = scratch_path(spark, "documents")
    jobs.dump(spark, _as_csv(trips), name, location=location, all_or_none=True)
    marks = ledger.as_seen(ledger.loads(spark, table.location_of(spark, name)))
    ledger.keep_seen(spark, root, table.location_of(spark, name), marks)
    jobs.dump(spark, _as_csv(_weekends(with_date(trips)).drop("date")), name, location=location, all_or_none=True)
    jobs.process(spark, root, name, changed=True)
    schema = document_schema(enrich(spark.table(name)).schema, ["date"])
    return read_documents(spark, root, schema).groupBy("index").agg(F.count(F.lit(1)).alias("n"))
