"""Reading documents back, from one index or across many."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.files import folders
from tripmill.operators.documents import INDEX


def read_documents(spark: SparkSession, root: str, schema: StructType, pattern: str = "*") -> DataFrame:
    """The documents of all indices whose name fits ``pattern``, where ``*`` stands for any text.

    ``schema`` is that of the documents (see ``document_schema``); nothing is inferred. The pattern
    becomes a filter on the partition column, so other indices are not read. A pattern of ordinary
    characters also narrows the listing of files to the directories that can fit.
    """
    reader = spark.read.schema(schema)
    if pattern == "*":
        return reader.json(root)
    inside = f"{root.rstrip('/')}/{INDEX}={pattern}"
    if re.fullmatch(r"[A-Za-z0-9._*-]+", pattern) and folders(spark, inside):
        df = reader.option("basePath", root).json(inside)
    else:
        df = reader.json(root)
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.where(F.col(INDEX).like(escaped.replace("*", "%")))

