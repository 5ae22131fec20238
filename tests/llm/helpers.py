"""Small frames with the awkward cases that every operator must take."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that depend on the seed alone."""
    out, state = [], seed * 2654435761 % 2**32 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + str(state // 7 % 50))
    return " ".join(out)


LONG = prose(99, 30_000)

ODD = [
    (1, prose(1, 60)),
    (2, prose(2, 60)),
    (3, prose(1, 60)),
    (3, prose(1, 60)),  # a repeated row
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, LONG),
    (9, "Ünï çôdé 漢字 \U0001f600 " + prose(5, 40)),
    (None, prose(6, 50)),
    (None, prose(1, 60)),
    (10, prose(1, 59) + " other"),
]


def odd(spark):
    """The awkward rows, with extra columns whose names operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    for name in ("id", "node", "bits", "size", "shard", "kept", "spans", "features", "score", "key", "n", "token"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    """Rows by id, for frames without repeated ids."""
    return {r.doc_id: r for r in df.collect()}
