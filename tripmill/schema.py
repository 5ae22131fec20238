"""The trip schema: 18 nullable columns as they stand in the CSV, and what the jobs add to them."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names, order and types decide how CSV cells are bound.
TRIP = StructType(
    [
        StructField("vendor_id", StringType()),
        StructField("pickup_datetime", TimestampType()),
        StructField("dropoff_datetime", TimestampType()),
        StructField("passenger_count", IntegerType()),
        StructField("trip_distance", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("pickup_latitude", DoubleType()),
        StructField("rate_code", IntegerType()),
        StructField("store_and_fwd_flag", StringType()),
        StructField("dropoff_longitude", DoubleType()),
        StructField("dropoff_latitude", DoubleType()),
        StructField("payment_type", StringType()),
        StructField("fare_amount", DoubleType()),
        StructField("surcharge", DoubleType()),
        StructField("mta_tax", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("tolls_amount", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)

# Where the two jobs meet.
TRIP_TABLE = "default.taxi_trips"
PARTITION_BY = ("date",)
INDEX_TEMPLATE = "taxi-{date}"
INDEX_EXCLUDES = ("date",)

TABLE = StructType([*TRIP, StructField("date", StringType())])

ENRICHED = StructType(
    [
        *TABLE,
        StructField("timestamp", StringType()),
        StructField("pickup_week_day", StringType()),
        StructField("pickup_hour", IntegerType()),
        StructField("duration", DoubleType()),
    ]
)
