"""Reading the partitioned table, always through the catalog so that partition values stay text."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmill.functions.names import column, quote_table
from tripmill.schema import PARTITION_BY


def read_table(
    spark: SparkSession,
    name: str,
    *,
    columns: Sequence[str] | str | None = None,
    dates: Iterable[str | None] | str | None = None,
    since: str | None = None,
    until: str | None = None,
    by: str = PARTITION_BY[0],
) -> DataFrame:
    """The table, or some columns and days of it. Days prune partitions, columns narrow the scan.

    ``since`` and ``until`` are inclusive. Among ``dates`` none stands for rows without a day. ``by`` is the partition column that days are looked for in. A single
    day or column may be given as one text. A column is meant by its whole name, dots and all. A name without a
    database is looked up in the current one.
    """
    df = spark.table(quote_table(name))
    day = column(by)
    if dates is not None:
        days = [dates] if isinstance(dates, str) else list(dates)
        named = day.isin([d for d in days if d is not None])
        df = df.where(named | day.isNull() if None in days else named)
    if since is not None:
        df = df.where(day >= since)
    if until is not None:
        df = df.where(day <= until)
    if columns is None:
        return df
    return df.select(*[column(c) for c in ([columns] if isinstance(columns, str) else columns)])
