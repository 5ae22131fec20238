"""The corpus pipeline: toxic texts go, then copies, near copies and texts of benchmarks; what stays is packed.

Each stage takes (spark, docs, sf_dir) and reads all of ``docs``. All but the last return rows of ``documents``, as they came. A row is known by its
id and its text, so rows that share an id, or have none, are judged one by one; of rows alike in both, which are copies, one stays at most after
the second stage. A null id is larger than any other. Null texts are empty. Empty tables give empty tables.
"""

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.decontaminate import contamination
from tripmill.llm.exact_dedup import exact_dedup
from tripmill.llm.near_dedup import near_duplicates
from tripmill.llm.packing import pack
from tripmill.llm.toxicity import fit_toxicity, held_out
from tripmill.session import scratch_path


def _key() -> Column:
    """What a row is known by. Nulls come last, as the smallest one of a group stays."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(text).alias("hash"))


def _only(docs: DataFrame, judge, label: str) -> DataFrame:
    """The rows of ``docs`` that stay when ``judge`` has judged them by their keys; of rows that share a key, one."""
    judged = judge(docs.select(_key().alias("key"), "text"), id_col="key").select("key", "kept")
    path = scratch_path(docs.sparkSession, label)
    judged.groupBy("key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).write.parquet(path)
    keys = docs.sparkSession.read.parquet(path).where("kept").withColumnRenamed("key", "_key")
    several = keys.where("n > 1").drop("kept", "n")
    once = docs.join(keys.where("n = 1"), _key() == F.col("_key"), "left_semi")
    if several.isEmpty():
        return once
    shared = docs.withColumn("_row_key", _key()).join(several, F.col("_row_key") == F.col("_key"), "left_semi")
    return once.unionByName(shared.dropDuplicates(["_row_key"]).drop("_row_key"))


def _with_row(docs: DataFrame) -> DataFrame:
    """Each row as a whole beside its text: what judges rows one by one takes it along in place of an id, without a join."""
    return docs.select(F.struct("*").alias("row"), "text")


def _rows(judged: DataFrame, stays) -> DataFrame:
    return judged.where(stays).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the model, learned from the labels of these documents, calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, usable=~held_out())
    return _rows(model.score(_with_row(docs), id_col="row"), F.col("predicted") == 0)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks, the one with the smallest id."""
    return _only(docs, exact_dedup, "judged-copies")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by similarity, directly or by others, the one with the smallest id."""
    return _only(docs, near_duplicates, "judged-near-copies")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _rows(contamination(_with_row(docs), benchmark, id_col="row"), F.col("n_hit") == 0)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sequences of at most 1024 token ids: one row per piece."""
    return pack(docs).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Trees and token ids have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = SimpleNamespace(run=run, sql=ORACLE_SQL)
