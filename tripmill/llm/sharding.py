"""Shards of near-equal size by longest-processing-time scheduling, with groups that stay together."""

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripmill.llm._common import materialised, text_of

#: Groups of one size are numbered in so many parts at least, so that no size is one task.
SALTS = 64

#: Rows that one task numbers within its shard, on average.
SLOT_ROWS = 500_000


def spread(loads: list[tuple[int, int]], size: int, count: int) -> list[int]:
    """Give ``count`` items of one size to the least loaded shards, one after the other; how many each got.

    ``loads`` is the heap of (load, shard) and is changed. Items far more than shards go by level: all
    shards are first filled up to the highest level that takes no more than ``count``, and only the rest
    goes item by item. Both give the same, as items of one size are alike.
    """
    got = [0] * len(loads)
    if count > 4 * len(loads):
        low, high = min(loads)[0], max(loads)[0] + size * count
        while low < high:
            level = (low + high + 1) // 2
            if sum(max(0, -(-(level - load) // size)) for load, _ in loads) <= count:
                low = level
            else:
                high = level - 1
        for i, (load, shard) in enumerate(loads):
            got[shard] = max(0, -(-(low - load) // size))
            loads[i] = (load + size * got[shard], shard)
        heapq.heapify(loads)
    for _ in range(count - sum(got)):
        load, shard = loads[0]
        got[shard] += 1
        heapq.heapreplace(loads, (load + size, shard))
    return got


def schedule(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Rows (size, first, end, shard): of the groups of this size, those ranked first..end-1 go to the shard."""
    loads = [(0, shard) for shard in range(shards)]
    rows = []
    for size, count in sorted(sizes, reverse=True):
        first = 0
        for shard, n in enumerate(spread(loads, size, count)):
            if n:
                rows.append((size, first, first + n, shard))
                first += n
    return rows


def shard_groups(groups: DataFrame, shards: int, *, key: str, size: str) -> DataFrame:
    """Each group (one row each: ``key``, ``size`` at least 1) with its ``shard``.

    The heap needs no single group, only how many there are of each size, since groups of one size are
    alike. That histogram is all that reaches the driver. Its length has a proven bound: D different sizes
    sum up to at least D²/2, so D is at most the root of twice all bytes, and in practice about the
    number of different text lengths. Which of the groups of a size go where is decided by their rank, which
    is counted in salted parts, as many as the number of groups asks for.
    """
    spark = groups.sparkSession
    salts = max(SALTS, -(-groups.count() // SLOT_ROWS))
    salted = groups.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    parts = salted.groupBy(size, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    histogram = parts.groupBy(size).agg(F.sum("_n").alias("_n")).toArrow()
    plan = schedule(list(zip(histogram[size].to_pylist(), histogram["_n"].to_pylist(), strict=True)), shards)
    columns = list(zip(*plan, strict=True)) or [[], [], [], []]
    table = pa.table(
        {n: pa.array(c, pa.int64()) for n, c in zip(["_size", "_first", "_end", "shard"], columns, strict=True)}
    )
    before = F.coalesce(
        F.sum("_n").over(W.partitionBy(size).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = parts.select(F.col(size).alias("_osize"), F.col("_salt").alias("_osalt"), before.alias("_before"), "_n")
    place = spark.createDataFrame(table)
    # Ranges of ranks are looked up by part, so groups of one size do not meet in one task.
    met = (F.col("_osize") == F.col("_size")) & (F.col("_first") < F.col("_before") + F.col("_n")) & (F.col("_end") > F.col("_before"))
    spans = offsets.join(place, met).select(
        "_osize", "_osalt", "shard", (F.col("_first") - F.col("_before")).alias("_from"), (F.col("_end") - F.col("_before")).alias("_to")
    )
    ranked = salted.withColumn("_rank", F.row_number().over(W.partitionBy(size, "_salt").orderBy(key)) - 1)
    here = (
        (F.col(size) == F.col("_osize"))
        & (F.col("_salt") == F.col("_osalt"))
        & (F.col("_rank") >= F.col("_from"))
        & (F.col("_rank") < F.col("_to"))
    )
    return ranked.join(spans, here).select(*groups.columns, F.col("shard").cast("int"))


def shard_documents(df: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's shard and its slot there: ``id_col, size, text_crc32, group_key, shard, slot``.

    The law is that of bytes: sizes near equal, as LPT gives them. Equal texts are one group and stay together. A row's size is
    the bytes of its text plus 1. A null text is an empty one, so null and empty texts are one group. A group larger than a
    shard's share makes its shard larger; no group is cut. Slots count from 0 without gaps, by ranges of ids. Rows with a
    null id get slots like any other, and so does each of repeated rows. No rows, no result. Other columns are not looked at.
    """
    text = text_of(text_col)
    size = (F.octet_length(text) + 1).cast("long")
    rows = df.select(
        F.col(id_col).alias("id"),
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group_key"),
    )
    rows = materialised(rows, "shard-rows")
    groups = materialised(
        rows.groupBy("group_key").agg(F.sum("size").alias("group_size"), F.count(F.lit(1)).alias("n")), "shard-groups"
    )
    placed = shard_groups(groups, shards, key="group_key", size="group_size")
    # The rows of a group of a third of all rows are one large partition here, which adaptive execution splits.
    sharded = materialised(rows.join(placed.select("group_key", "shard"), "group_key"), "shard-placed")
    return with_slots(sharded).select(
        F.col("id").alias(id_col), "size", "text_crc32", "group_key", "shard", "slot"
    )


def with_slots(sharded: DataFrame) -> DataFrame:
    """Add ``slot``: the rows of each shard numbered from 0, counted in parts of about ``SLOT_ROWS``."""
    n_parts = max(1, -(-sharded.count() // SLOT_ROWS))
    # As the ids of one shard are spread evenly by their hash, so are its parts.
    parted = sharded.withColumn("_part", F.pmod(F.xxhash64("id", "group_key", "size"), F.lit(n_parts)))
    parts = parted.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.select(
        F.col("shard").alias("_shard"), F.col("_part").alias("_opart"), F.coalesce(before, F.lit(0)).alias("_before")
    )
    number = F.row_number().over(W.partitionBy("shard", "_part").orderBy("id", "group_key"))
    return parted.withColumn("_number", number).join(
        offsets, (F.col("shard") == F.col("_shard")) & (F.col("_part") == F.col("_opart"))
    ).withColumn("slot", (F.col("_number") - 1 + F.col("_before")).cast("long"))
