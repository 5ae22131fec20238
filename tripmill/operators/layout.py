"""How rows are spread over write tasks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.names import quote


# Many, so that two keys, such as two days, seldom share a shuffle partition: where one holds a hot key,
# the other keys in it are cut up too. Not more, because beyond 2000 Spark keeps only average block sizes
# (spark.shuffle.minNumPartitionsToHighlyCompress), and adaptive execution would not see a hot key.
# Partitions left small are merged.
PARTITIONS = 2000

# To so many partitions, by default, a map task writes a stream each and holds no rows (spark.shuffle.sort.bypassMergeThreshold).
# To more it gathers its rows and sorts them, as many as its memory takes.
STREAMED_PARTITIONS = 200

# What a map task that reads a whole file gives to one task that writes, at most: some 256 MB of trips as text.
ROWS_PER_TASK = 2_000_000

_SALT = "_tripmill_salt"


def cluster(df: DataFrame, *columns: str, rows_per_task: int | None = None) -> DataFrame:
    """Bring equal keys together for a partitioned write: few files per key, written in parallel.

    This is Spark's rebalance hint. Small keys share a task and get one file each. A key that outgrows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is cut by adaptive execution into as many
    tasks and files as it needs, so one hot day never ends in one task. The hash is on the key
    columns alone, thus a task that is run again after an executor is lost gives the same rows.
    Spark drops the hint where adaptive execution is off at the time of this call.

    Adaptive execution cuts between what different map tasks gave, so it cannot cut a key that one map task holds, as with one file
    that does not split. With ``rows_per_task`` the key is salted by the row's position in its map task, so many rows at a time:
    such a key goes to as many tasks, and a small one in such a file gets a file for each stretch of it that has some. Positions are those
    in the input's files, so here too a task that runs again gives the same rows.

    A map task that reads a whole file has as many rows as the file. So with ``rows_per_task``, and up to ``STREAMED_PARTITIONS`` input
    files, rows are dealt to as many partitions, which map tasks write without gathering rows: what a task holds is then what a write task
    sorts. Of more files keys would share partitions that are cut up, so there the many partitions stay, and map tasks that outgrow their memory spill.
    """
    keys = [quote(name) for name in columns]
    if rows_per_task is None:
        return df.hint("rebalance", PARTITIONS, *keys)
    # The id counts a task's rows in its lower 33 bits.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    salted = df.withColumn(_SALT, F.floor(position / F.lit(rows_per_task)))
    partitions = STREAMED_PARTITIONS if 0 < len(df.inputFiles()) <= STREAMED_PARTITIONS else PARTITIONS
    return salted.hint("rebalance", partitions, *keys, _SALT).drop(_SALT)
