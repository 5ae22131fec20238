"""The document sink: every row goes to the index its own fields name."""

import string
from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.functions.names import by_lower_name, column
from tripmill.operators.layout import cluster as cluster_by
from tripmill.operators.table import WriteResult
from tripmill.session import held_settings

INDEX = "index"

# Microseconds and offset, so documents give back the same instant under every session zone.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
LOCAL_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def template_fields(template: str) -> set[str]:
    """The lower-cased names of the columns a template draws on."""
    return {name.lower() for _, name in _parse(template) if name is not None}


def route(df: DataFrame, template: str, null_index: str | None = None) -> Column:
    """Turn a template such as ``taxi-{date}`` into a column holding each row's index name.

    Any number of ``{field}`` parts may be used; doubled braces stand for themselves. A row with a
    null in one of them, or whose whole name is empty, goes to ``null_index``, or fails the job when none is given.
    """
    have = by_lower_name(df.columns)
    parts: list[Column] = []
    for text, name in _parse(template):
        if text:
            parts.append(F.lit(text))
        if name is None:
            continue
        if name.lower() not in have:
            raise ValueError(f"template {template!r}: the input has no column {name!r}")
        parts.append(column(have[name.lower()]).cast("string"))
    if not parts:
        raise ValueError("the index template is empty")
    otherwise = (
        F.raise_error(F.lit(f"a row has no value for a field of index template {template}"))
        if null_index is None
        else F.lit(null_index)
    )
    return F.coalesce(F.nullif(F.concat(*parts), F.lit("")), otherwise)


def document_schema(schema: StructType, exclude: Sequence[str] | str = ()) -> StructType:
    """The schema of the documents made from rows of ``schema``, with the index they are in.

    A field to be left out that is not there is an error: a mistyped name would store what it is to hide.
    """
    names = [exclude] if isinstance(exclude, str) else list(exclude)
    dropped = {name.lower() for name in names}
    unknown = [name for name in names if name.lower() not in {have.lower() for have in schema.names}]
    if unknown:
        raise ValueError(f"there is no column {', '.join(map(repr, unknown))} to leave out")
    kept = [f for f in schema if f.name.lower() not in dropped]
    return StructType([*kept, StructField(INDEX, StringType())])


def write(
    df: DataFrame,
    root: str,
    template: str,
    *,
    exclude: Sequence[str] | str = (),
    mode: Literal["append", "replace"] = "append",
    null_index: str | None = None,
    cluster: bool = True,
) -> WriteResult:
    """Write rows as JSON documents under ``root``, one directory per index.

    Excluded fields may steer the routing but are not stored. ``append`` adds the documents again on a
    second run; ``replace`` swaps the content of the indices that receive rows. Null fields are left
    out of a document. Nothing becomes visible unless every row could be routed.
    ``cluster=False`` skips the shuffle by index; each task then writes a file for every index it meets.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be append or replace, not {mode!r}")
    spark = df.sparkSession
    target = route(df, template, null_index)
    documents = df.select(*[column(c) for c in document_schema(df.schema, exclude).names[:-1]], target.alias(INDEX))
    by_lower_name(documents.columns)
    written = Observation()
    with held_settings(spark):
        if cluster:
            documents = cluster_by(documents, INDEX)
        (
            documents.observe(written, F.count(F.lit(1)).alias("rows"))
            .write.mode("append" if mode == "append" else "overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", True)
            .option("timestampFormat", TIMESTAMP_FORMAT)
            .option("timestampNTZFormat", LOCAL_TIMESTAMP_FORMAT)
            .partitionBy(INDEX)
            .json(root)
        )
    return WriteResult(root, written.get["rows"])


def _parse(template: str) -> list[tuple[str, str | None]]:
    parts = list(string.Formatter().parse(template))
    if any(spec or conversion for _, _, spec, conversion in parts):
        raise ValueError(f"template {template!r}: a field is a plain column name in braces")
    return [(text, name) for text, name, _, _ in parts]
