"""The two charts over enriched trips; they take the table's rows or the documents alike."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trips_per_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("n"))


def average_duration_by_weekday(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_week_day").agg(F.avg("duration").alias("avg_duration"))
