"""Centroid clustering of whole-number vectors, with squared differences read from scalar lookup tables."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import materialised

#: Whole-number components are at most this far from 0: then no squared distance of up to 64 components leaves a long.
LARGEST = 1 << 27

#: Vectors that are compared with all centroids at a time.
ROWS = 4096


def whole_numbers(df: DataFrame, *, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """``id, vector``: of vectors with all their components, each as floor(scale * x). What no long distance can hold is refused."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < F.lit(float("inf"))))
    # Held near the largest one allowed, so that no floor leaves a long before it is refused.
    far = F.lit(2.0 * LARGEST)
    scaled = F.transform(vector_col, lambda x: F.floor(F.least(F.greatest(x.cast("double") * float(scale), -far), far)))
    fits = F.forall("vector", lambda x: F.abs(x) <= LARGEST)
    too_far = F.raise_error(F.concat(F.lit(f"a component is beyond {LARGEST} / {scale}, in the vector "), F.col("id").cast("string")))
    kept = df.where((F.size(vector_col) == dimensions) & finite)
    return kept.select(F.col(id_col).alias("id"), scaled.alias("vector")).withColumn(
        "vector", F.when(fits, F.col("vector")).otherwise(too_far)
    )


def difference_tables(vectors: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each dimension, which of its occurring values each vector has, and the table (value, centroid) of squared differences."""
    for d in range(vectors.shape[1]):
        values, which = np.unique(vectors[:, d], return_inverse=True)
        yield which, (values[:, None] - centroids[None, :, d]) ** 2


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector, the smaller one of equals, and its squared distance."""
    distances = np.zeros((len(vectors), len(centroids)), np.int64)
    for which, table in difference_tables(vectors, centroids):
        distances += table[which]
    cluster = distances.argmin(1)
    return cluster, distances[np.arange(len(vectors)), cluster]


def _blocks(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[slice, np.ndarray]]:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    for first in range(0, len(flat), ROWS):
        yield slice(first, first + ROWS), flat[first : first + ROWS]


def _assign(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, block in _blocks(batch, centroids.shape[1]):
                cluster, distance = nearest(block, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[rows.start : rows.start + len(block)], pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    ["id", "cluster", "distance"],
                )

    return run


def _sums(centroids: np.ndarray):
    """The vectors of a task, added up by cluster: at most one row for each cluster and million of vectors."""

    def rows(count: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dimensions = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for _, block in _blocks(batch, dimensions):
                cluster, _ = nearest(block, centroids)
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                total[found] += np.add.reduceat(block[order], first, axis=0)
                count += np.bincount(cluster, minlength=k)
                if count.sum() > 1_000_000:
                    yield rows(count, total)
                    count[:], total[:] = 0, 0
        if count.any():
            yield rows(count, total)

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the exact floor of the mean of its vectors; an empty one stays."""
    dimensions = centroids.shape[1]
    parts = vectors.select("vector").mapInArrow(_sums(centroids), "cluster int, n bigint, total array<bigint>")
    # Decimals, as longs might not hold the sum of all vectors.
    sums = [F.sum(F.element_at("total", d + 1).cast("decimal(38,0)")).alias(f"s{d}") for d in range(dimensions)]
    moved = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        moved[row["cluster"]] = [int(row[f"s{d}"]) // row["n"] for d in range(dimensions)]
    return moved


def centroid_clusters(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    seed: Column | None = None,
) -> tuple[DataFrame, list[list[int]]]:
    """Rows ``id_col, cluster, distance`` of all vectors, and the final centroids.

    Distances are exact: components are whole numbers, and a round tabulates their squared differences from the centroids for each
    dimension and occurring value, block of vectors by block, so a distance is a sum of gathered table entries. What goes through
    the driver is the centroids, ``k`` times ``dimensions`` numbers; tasks send a sum per cluster. Vectors start as centroids by
    ``seed``, in ascending order (the id's digest unless told otherwise), equal ones by their components.

    Only vectors with exactly ``dimensions`` components take part, none of them null or not finite; null vectors do not. A component
    beyond ``LARGEST / scale`` fails the job by name, since its distances fit in no long. Rows with a null id
    take part, and so does each of repeated rows. Equal distances go to the smaller number. With fewer vectors than ``k``
    there are as many centroids; without any, no rows and no centroids. Other columns are not looked at.
    """
    if dimensions > 64:
        raise ValueError("squared distances of more than 64 components might leave a long")
    seed = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256) if seed is None else seed
    vectors = materialised(
        whole_numbers(df, id_col=id_col, vector_col=vector_col, dimensions=dimensions, scale=scale), "centroid-vectors"
    )
    # At most k rows.
    start = vectors.orderBy(seed, "vector").limit(k).select("vector").collect()
    if not start:
        empty = vectors.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, []
    centroids = np.array([row["vector"] for row in start], np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    id_type = vectors.schema["id"].dataType.simpleString()
    placed = vectors.mapInArrow(_assign(centroids), f"id {id_type}, cluster int, distance bigint")
    return placed.withColumnRenamed("id", id_col), centroids.tolist()


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``. The sums are one row per cluster, as many as there are centroids."""
    spark = placed.sparkSession
    placed = materialised(placed, "centroid-placed")
    # One row for each centroid at most.
    inertia = dict(placed.groupBy("cluster").agg(F.sum("distance")).collect())
    about = [
        (i, inertia[i], sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids)
        if i in inertia
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return placed.join(F.broadcast(spark.createDataFrame(about, schema)), "cluster")
