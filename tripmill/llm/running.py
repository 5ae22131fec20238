"""Running totals within groups over rows sorted by range, so that a group of a third of all rows is many tasks' work."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripmill.llm._common import materialised


def sorted_parts(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """The rows sorted by range and written; ``part`` numbers the ranges upwards. Nulls come first."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialised(parts.withColumn("part", F.spark_partition_id()), label)


def running(parts: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Add, for each name in ``sums``, ``<name>_sofar``: the group's sum up to this row and with it, and ``<name>_all``: that of the group.

    ``parts`` comes from ``sorted_parts`` by the group's columns and then those of ``order``. A part has the rows of a range, so the window
    over one part and group is bounded by the part; a group's totals over the parts before are one row for each part it reaches. Null
    is a group like any other. Rows alike in all columns of ``order`` come one after the other in any order.
    """
    cells = parts.groupBy("part", *group).agg(*[F.sum(value).alias(f"_{name}") for name, value in sums.items()])
    of_group = W.partitionBy(*group)
    earlier = of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(
        F.col("part").alias("_part"),
        *[F.col(g).alias(f"_{g}") for g in group],
        *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums],
        *[F.sum(f"_{name}").over(of_group).alias(f"{name}_all") for name in sums],
    )
    here = W.partitionBy("part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    same = F.col("part") == F.col("_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    within = parts.select("*", *[F.sum(value).over(here).alias(f"_{name}_here") for name, value in sums.items()])
    return within.join(offsets, same).select(
        *parts.columns,
        *[(F.col(f"_{name}_here") + F.col(f"_{name}_before")).alias(f"{name}_sofar") for name in sums],
        *[f"{name}_all" for name in sums],
    )


def along(parts: DataFrame, group: str, facts: DataFrame) -> DataFrame:
    """Join one row of ``facts`` for each group to its rows, part by part, so that no group is one task. Groups without facts go."""
    cells = parts.select("part", group).distinct().join(facts, group)
    return parts.join(cells, ["part", group])
