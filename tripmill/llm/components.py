"""Connected components of a graph given by its edges, by large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import materialised

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """From edges ``a, b`` to one row per node that has an edge: ``node, root``, root being the smallest node.

    Each round brings neighbours closer to the smallest node of theirs; rounds grow with the logarithm of the
    longest path. A round is written to the shared folder, so lineage stays short and a lost executor costs a round
    at most. Nodes stay distributed; only a count and a checksum reach the driver. Edges of a node to itself
    are kept as that node alone; edges with a null are dropped, they join nothing.
    """
    now = materialised(
        edges.where("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if seen == before:
            break
        before = seen
        if not seen[0]:
            break
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        both = now.union(now.where("u <> v").select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.join(least, F.col("u") == F.col("k"))
            .where("v >= u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # Small star: the node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        joined = large.join(least, F.col("u") == F.col("k"))
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = materialised(small, "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
