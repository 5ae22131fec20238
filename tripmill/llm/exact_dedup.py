"""Exact copies, found by refining groups: by length, by a hash of the beginning, by a hash of the whole."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import key_bitmaps, materialised, text_of, with_bit

#: Characters of the beginning that the second step hashes. What is equal is decided by the whole text.
PREFIX_CHARS = 256

#: So many of the largest groups are broadcast to their rows. No other group has more than this part of all rows.
LARGEST = 1000


def normalised(text: Column) -> Column:
    """The text with each run of spaces, tabs and line ends as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def exact_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Rows whose normalised texts are equal form a group; the smallest id stays. Length and a hash of the
    beginning are grouped first. Groups of one need no more. The keys of the others set bits in a
    bitmap of fixed size, and only rows whose bit is set have their whole text hashed. As more groups survive
    than there are bits, more rows are hashed than need be; the result is the same. Ids and hashes are written down, and
    only lengths and hashes are shuffled. ``text_sha256`` is null where no whole hash was needed, unless ``digest_all``.

    A null text is an empty one; empty texts are copies of each other. A null id is larger than any other, so
    its row stays only if all ids of the group are null. Rows that share id and text are one document: they
    stay or go together, and each counts in ``group_size``. Other columns are not looked at.
    """
    text = normalised(text_of(text_col))
    key = df.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        "t",
        F.length("t").alias("length"),
        F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix"),
    )
    several = key.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bitmaps = key_bitmaps(several, ["length", "prefix"])
    whole = F.sha2("t", 256) if digest_all else F.when(F.col("survives"), F.sha2("t", 256))
    hashed = with_bit(key, bitmaps, ["length", "prefix"], "survives").select("id", "prefix", "survives", whole.alias("sha"))
    hashed = materialised(hashed, "hashed")
    groups = (
        hashed.where("survives")
        .groupBy(F.col("sha").alias("group_sha"))
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    groups = materialised(groups, "copies")
    # The rows of the largest groups do not meet at their key: what is known of the group comes to them.
    largest = groups.orderBy(F.desc("group_size"), "group_sha").limit(LARGEST)
    in_largest = hashed.join(F.broadcast(largest), F.col("sha") == F.col("group_sha"))
    others = hashed.join(F.broadcast(largest.select(F.col("group_sha").alias("sha"))), "sha", "left_anti")
    # Rows without a hash get keys of their own, or all of them would meet at the null key.
    own = F.coalesce("sha", F.col("prefix").cast("string"))
    joined = in_largest.unionByName(others.join(groups, own == F.col("group_sha"), "left"))
    alone = F.col("group_sha").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
