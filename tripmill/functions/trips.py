"""Columns derived from a trip. Built-in functions only, so each frame stays one codegen projection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output formats.
DAY_FORMAT = "yyyy-MM-dd"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
WEEKDAY_FORMAT = "EEEE"


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, both cut to whole seconds first; negative when end lies before."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60)


def with_date(df: DataFrame) -> DataFrame:
    """Add ``date``, the pickup day in the session zone (null where there is no pickup)."""
    return df.withColumn("date", F.date_format(_instant("pickup_datetime"), DAY_FORMAT))


def enrich(df: DataFrame) -> DataFrame:
    """Add ISO time, weekday, hour and duration; use it as ``df.transform(enrich)``."""
    pickup, dropoff = _instant("pickup_datetime"), _instant("dropoff_datetime")
    return df.withColumns(
        {
            "timestamp": F.date_format(pickup, ISO_FORMAT),
            "pickup_week_day": F.date_format(pickup, WEEKDAY_FORMAT),
            "pickup_hour": F.hour(pickup),
            "duration": minutes_between(pickup, dropoff),
        }
    )


def _instant(name: str) -> Column:
    # Local timestamps become instants of the session zone: minutes over a clock change are real ones.
    return F.col(name).cast("timestamp")
