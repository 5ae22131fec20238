"""Mixing sources to target weights by weighted fair queueing."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from tripmill.llm._common import materialised, slices, text_bytes, text_of, words
from tripmill.llm.running import running, sorted_parts


@arrow_udf(LongType())
def count_words(text: pa.Array) -> pa.Array:
    """How many runs of other than blanks each text has; none in a null."""
    data, offsets = text_bytes(text)
    counts = np.zeros(len(offsets) - 1, np.int64)
    for first, last in slices(offsets):
        low, high = offsets[first], offsets[last]
        _, _, row = words(data[low:high], offsets[first : last + 1] - low)
        counts[first:last] = np.bincount(row, minlength=last - first)
    return pa.array(counts)


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank``: the sources numbered from 0 by code point, null last, counted by the part in which each begins."""
    begins = F.when(F.col("source").isNull(), F.lit(2**31 - 1)).otherwise(F.col("first_part"))
    sources = sources.withColumn("_begins", begins)
    counts = sources.groupBy("_begins").agg(F.count(F.lit(1)).alias("_n"))
    # A row for each part at most.
    before = F.coalesce(F.sum("_n").over(W.orderBy("_begins").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_begins", before.alias("_before"))
    number = F.row_number().over(W.partitionBy("_begins").orderBy("source")) - 1
    return sources.withColumn("_number", number).join(offsets, "_begins").select(
        "source", "source_size", (F.col("_number") + F.col("_before")).alias("rank")
    )


def _level(weighed: DataFrame, budget: float, repeats: int) -> float:
    """The target of weight 1: what is over the cap of some sources is shared by the others until none is above.

    One row comes back from each round. The level only rises, and with each rise more sources are at their cap.
    """
    level = 0.0
    while True:
        capped = F.col("source_size") * repeats <= F.col("weight") * F.lit(level)
        held, weight = weighed.agg(
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * repeats)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weight:
            return float("inf")
        share = (budget - held) / weight
        if share <= level:
            return level
        level = share


def targets(
    sources: DataFrame, *, weight: Column | None = None, share: float = 1.0, repeats: int = 3
) -> DataFrame:
    """``source, source_size, rank, target``: how many words each source is to give.

    All targets together are ``share`` of all words, by the sources' weights (of ``source`` and ``rank``; 1, 2, 3, 1, ... by rank unless
    told otherwise), none above ``repeats`` times its source's words.
    """
    weight = F.col("rank") % 3 + 1 if weight is None else weight
    weighed = materialised(_ranked(sources).withColumn("weight", weight.cast("double")), "mix-sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = _level(weighed, share * total, repeats)
    most = (F.col("source_size") * repeats).cast("double")
    return weighed.select("source", "source_size", "rank", F.least(most, F.col("weight") * F.lit(level)).alias("target"))


def mix(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Column | None = None,
    share: float = 1.0,
    repeats: int = 3,
    seed: int = 0,
) -> DataFrame:
    """What the mix takes of each document, in its order: ``id_col, size, source, source_size, target, place, copy,
    finish, taken, start``.

    Weighted fair queueing: a source's documents are shuffled by a digest of seed, id and text, and follow one another up to ``repeats``
    times. A copy's virtual finish time is the words of its source up to its end, divided by the source's target, so at time t each source
    has given t times its target. All copies are sorted by that time over all sources, and the mix is cut off when it has its budget, the
    sum of the targets. A copy that is under way at time 1, one of each source at most, enters as its part before and its part after, so
    no long document takes its source far from the target. ``place`` is the document's in its source's queue, ``start`` the copy's in the
    mix, in words.

    There is a row for each copy that enters, with ``taken`` 0 where the mix was over before, and one for copy 0 in any case.
    The order depends on the rows alone. A null text has no words, a null source is a source, the last one. Rows with a null id
    take part, and so does each of repeated rows. No rows, no result. Other columns are not looked at.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text_of(text_col))))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), count_words(text_of(text_col)).alias("size"), digest.alias("at")
    )
    parts = sorted_parts(rows, ["source", "at"], "mix-shuffled")
    sources = parts.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("part").alias("first_part"))
    goal = targets(sources, weight=weight, share=share, repeats=repeats)
    budget = round(goal.agg(F.sum("target")).first()[0] or 0)
    queue = running(parts, ["source"], ["at"], {"size": F.col("size"), "rows": F.lit(1)})
    queued = _with_targets(queue, goal).select(
        "id", "source", "size", "at", "rank", "target",
        F.col("rows_sofar").alias("place"), F.col("size_all").alias("source_size"), (F.col("size_sofar") - F.col("size")).alias("earlier"),
    )
    order = ["finish", "rank", "copy", "place", "end"]
    mixed = running(sorted_parts(_pieces(queued, repeats), order, "mix-queue"), [], order, {"words": F.col("words")})
    start = F.col("words_sofar") - F.col("words")
    taken = F.greatest(F.lit(0).cast("long"), F.least("words", F.lit(budget) - start))
    return mixed.select(
        F.col("id").alias(id_col), "size", "source", "source_size", "target", "place", "copy", "finish", taken.alias("taken"), start.alias("start")
    )


def taken_of_documents(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each row of the documents: ``id_col, size, source, source_size, target, taken``, repeats counted."""
    facts = [F.first(name).alias(name) for name in (id_col, "size", "source_size", "target")]
    return mixed.groupBy("source", "place").agg(*facts, F.sum("taken").alias("taken"))


def _with_targets(queue: DataFrame, goal: DataFrame) -> DataFrame:
    """Join each source's rank and target, part by part."""
    goal = goal.select(F.col("source").alias("_of"), "rank", "target")
    cells = queue.select("part", "source").distinct().join(goal, F.col("source").eqNullSafe(F.col("_of")))
    cells = cells.select(F.col("part").alias("_part"), F.col("source").alias("_source"), "rank", "target")
    return queue.join(cells, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))


def _pieces(queued: DataFrame, repeats: int) -> DataFrame:
    """The copies that begin before time 1, and all first ones: their ``words``, the ``end`` of these in the source's queue, ``finish``.

    The copy of a source that is under way at time 1 comes in two pieces.
    """
    last = F.round("target").cast("long")
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn(
        "begin", F.col("copy") * F.col("source_size") + F.col("earlier")
    )
    before = last - F.col("begin")
    piece = lambda words, end: F.struct(words.alias("words"), end.alias("end"))
    whole = F.array(piece(F.col("size"), F.col("begin") + F.col("size")))
    two = F.array(piece(before, last), piece(F.col("size") - before, F.col("begin") + F.col("size")))
    pieces = (
        copies.where((F.col("copy") == 0) | (before > 0))
        .withColumn("piece", F.explode(F.when((before > 0) & (before < F.col("size")), two).otherwise(whole)))
        .select("*", "piece.words", "piece.end")
    )
    never = F.when(F.col("words") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    finish = F.when(F.col("target") > 0, F.col("end") / F.col("target")).otherwise(never)
    return pieces.withColumn("finish", finish).drop("piece", "begin", "earlier", "at")
