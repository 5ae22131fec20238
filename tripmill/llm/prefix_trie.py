"""The trie of conversations by their turns from the first on, with totals of subtrees."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripmill.llm._common import materialised
from tripmill.llm.centroid_rollup import centroid_rollup
from tripmill.llm.running import along, running, sorted_parts

#: A prefix is named by so many sums of 32 bits of its turns' digests, 128 bits together.
_SUMS = [f"sum{k}" for k in range(4)]

#: Conversations that end at a node are written one after the other in pieces of so many ids.
_IDS = 1000

#: A node with more children, or with more than this share of all nodes, is brought to them by broadcast: there are no more of these than
#: nodes for each thousand, and never more than ``_SHARE``.
_CHILDREN, _SHARE = 1000, 100_000


def ordered_turns(df: DataFrame, *, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv_id, place, said, chars, n`` and ``part``: each turn's place in its conversation, from 1, its digest and its length.

    Turns are ordered by number, null first; of one number by their digest. A null role or text is empty. Rows with a null id belong
    to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("said"),
        F.length(text).cast("long").alias("chars"),
    )
    parts = sorted_parts(rows, ["conv_id", "turn", "said"], "trie-turns")
    placed = running(parts, ["conv_id"], ["turn", "said"], {"n": F.lit(1)})
    return materialised(
        placed.select("conv_id", "part", F.col("n_sofar").alias("place"), F.col("n_all").alias("n"), "said", "chars"), "trie-places"
    )


def branched(turns: DataFrame, head: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation anew: the first ``head`` turns (at most ``most``) of conversation ``base``, then its own after its first ``head``.

    Both are made from ``conv_id``. Returns turns ``conv_id, depth, said, chars``, from depth 1 on without gaps, and all conversations. Without the
    base its first turns are missing, and a conversation without turns is one all the same.
    """
    given = turns.groupBy("conv_id").agg(F.max("n").alias("n"))
    conversations = given.select("conv_id", head.alias("head"), base.alias("base"))
    bases = given.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    conversations = conversations.join(bases, "base", "left").withColumn(
        "taken", F.least("head", F.coalesce("base_n", F.lit(0)))
    )
    heads = turns.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), "place", "said", "chars")
    first = conversations.join(heads, "base").where(F.col("place") <= F.col("head"))
    own = along(turns, "conv_id", conversations.select("conv_id", "head", "taken")).where(F.col("place") > F.col("head"))
    depth = F.col("place") - F.col("head") + F.col("taken")
    anew = first.select("conv_id", F.col("place").alias("depth"), "said", "chars").unionByName(
        own.select("conv_id", depth.alias("depth"), "said", "chars")
    )
    return anew, given.select("conv_id")


def _name(depth: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]))


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes each conversation passes: ``conv_id, depth, key, parent, chars, n``, from the root at depth 0 on.

    A node's key is made of the sums of its turns' digests, each taken with its depth. Sums run over parts of a conversation, so that of
    a third of all turns is not one task's work.
    """
    at = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "said"))
    numbers = [F.conv(F.substring("at", 8 * k + 1, 8), 16, 10).cast("long").alias(name) for k, name in enumerate(_SUMS)]
    rows = turns.withColumn("at", at).select("conv_id", "depth", "chars", *numbers)
    parts = sorted_parts(rows, ["conv_id", "depth"], "trie-anew")
    summed = running(parts, ["conv_id"], ["depth"], {"n": F.lit(1)} | {name: F.col(name) for name in _SUMS})
    sofar = [F.col(f"{name}_sofar") for name in _SUMS]
    passed = summed.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        _name(F.col("depth"), sofar).alias("key"),
        _name(F.col("depth") - 1, [s - F.col(name) for s, name in zip(sofar, _SUMS, strict=True)]).alias("parent"),
        "chars",
        F.col("n_all").alias("n"),
    )
    lengths = passed.where(F.col("depth") == 1).select("conv_id", "n")
    root = conversations.join(lengths, "conv_id", "left").select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        _name(F.lit(0), [F.lit(0)] * len(_SUMS)).alias("key"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("chars"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    return materialised(passed.unionByName(root), "trie-prefixes")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest the pieces of each key, which come one after the other."""
    last, digest = None, hashlib.sha256()
    for batch in batches:
        keys, out = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key == last:
                digest.update(b"," + ids.encode())
                continue
            if last is not None:
                keys.append(last)
                out.append(digest.hexdigest())
            last, digest = key, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["key", "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])


def _ends(passed: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of nodes at which conversations end: the digest of their ids, ascending.

    A digest is made of its text from the first byte to the last, so one task reads all ids of a node, in pieces, and holds one
    batch of them. The pieces are made by all tasks.
    """
    parts = sorted_parts(passed.where(F.col("depth") == F.col("n")).select("key", "conv_id"), ["key", "conv_id"], "trie-ends")
    number = F.row_number().over(W.partitionBy("part", "key").orderBy("conv_id")) - 1
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    pieces = (
        parts.withColumn("piece", F.floor(number / _IDS))
        .groupBy("part", "key", "piece")
        .agg(F.array_join(ids, ",").alias("ids"))
        .repartition("key")
        .sortWithinPartitions("key", "part", "piece")
    )
    return pieces.select("key", "ids").mapInArrow(_digests, "key string, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. Parents of very many are broadcast to their children, others are joined."""
    many = max(_CHILDREN, nodes.count() // _SHARE)
    parents = nodes.where(F.col("n_children") > 0).select(
        F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > many).alias("_large")
    )
    large = parents.where("_large").drop("_large").withColumnRenamed("parent_conv_id", "_of_large")
    small = parents.where("not _large").drop("_large")
    # Children of large parents have no other, and need not meet at one key to learn that.
    marked = nodes.join(F.broadcast(large), "parent", "left")
    apart = F.when(F.col("_of_large").isNull(), F.col("parent"))
    spread = F.coalesce(apart, F.concat(F.lit("-"), F.col("key")))
    return (
        marked.withColumn("_at", spread)
        .join(small.withColumnRenamed("parent", "_at"), "_at", "left")
        .withColumn("parent_conv_id", F.coalesce("_of_large", "parent_conv_id"))
        .drop("_at", "_of_large")
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame, **limits: int) -> DataFrame:
    """A row for each prefix of a conversation: ``key, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, depth, said, chars``, ``conversations`` each ``conv_id`` once; see ``ordered_turns`` and ``branched``. The root is the
    empty prefix, and all conversations pass it. ``conv_id`` is the smallest that passes, ``n_leaves`` the childless nodes of the subtree,
    and ``saved_tokens`` the sum over it of ``chars`` for each conversation that passes a node but the first. Totals of subtrees are
    those of a centroid decomposition (``centroid_rollup``, which takes ``limits``). No conversations, no nodes.
    """
    passed = prefixes(turns, conversations)
    nodes = materialised(
        passed.groupBy("key").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            # A node weighs as much as conversations pass it. So the weight of its subtree is what is left of all of these.
            F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
            ((F.count(F.lit(1)) - 1) * F.first("chars")).alias("saved"),
        ),
        "trie-nodes",
    )
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialised(
        nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-children"
    )
    summed = centroid_rollup(
        nodes.select(
            "key", "parent", "depth", "weight",
            F.col("conv_id").alias("line"),
            _name(F.lit(0), [F.lit(0)] * len(_SUMS)).alias("top"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
        ),
        passed.select(F.col("conv_id").alias("line"), "depth", "key", "parent"),
        ["n_leaves", "saved_tokens"],
        **limits,
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        _with_parents(nodes)
        .join(summed, "key")
        .join(_ends(passed), "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", none))
        .drop("weight", "saved")
    )
