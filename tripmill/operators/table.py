"""The partitioned table: create it from a frame, grow its schema, replace the partitions that get rows."""

import json
import logging
import threading
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill import files
from tripmill.functions.names import by_lower_name, column, columns_ddl, quote, quote_table
from tripmill.operators import ledger, staged
from tripmill.operators.align import align, check_types, missing_from
from tripmill.operators.layout import cluster as cluster_by
from tripmill.schema import PARTITION_BY
from tripmill.session import held_settings

log = logging.getLogger(__name__)

# Beside the partitions; names that begin so are not read as data.
_SCHEMA = "_tripmill_schema.json"

# The pass that writes counts the rows of up to so many partitions, with a sketch that is exact so far and holds no more.
_COUNTED = 100_000

_altering = threading.Lock()


@dataclass(frozen=True)
class WriteResult:
    """What a write did.

    ``partitions`` has the rows that each partition received, by its values; it is none for a load of over 100,000 partitions.
    """

    target: str
    rows: int
    created: bool = False
    added_columns: list[str] = field(default_factory=list)
    partitions: dict[tuple[str | None, ...], int] | None = field(default_factory=dict)


def create_ddl(
    name: str, schema: StructType, partition_by: Sequence[str] = PARTITION_BY, location: str | None = None
) -> str:
    """The statement that creates the table: data columns as given, then the partition columns as text."""
    keys = {key.lower() for key in partition_by}
    fields = [f for f in schema if f.name.lower() not in keys]
    fields += [StructField(key, StringType()) for key in partition_by]
    place = "" if location is None else " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return (
        f"CREATE TABLE IF NOT EXISTS {quote_table(name)} ({columns_ddl(fields)}) "
        "USING parquet OPTIONS (compression 'snappy') "
        f"PARTITIONED BY ({', '.join(map(quote, partition_by))}){place}"
    )


def add_columns(spark: SparkSession, name: str, fields: StructType) -> list[str]:
    """Append columns to the table, before its partition columns; rows already there read as null."""
    if fields.names:
        _run(spark, f"ALTER TABLE {quote_table(name)} ADD COLUMNS ({columns_ddl(fields)})")
    return list(fields.names)


def attach(
    spark: SparkSession,
    name: str,
    location: str,
    schema: StructType | None = None,
    partition_by: Sequence[str] = PARTITION_BY,
) -> bool:
    """Enter the table an earlier session wrote at ``location`` into this session's catalog.

    Needed only where the catalog does not outlive a session. False if there is no table. Its columns are
    those of ``schema``, else those the writer keeps in a file at the location, else they are merged from
    the file footers, a Spark job over all files.
    """
    if not files.exists(spark, location):
        return False
    kept = files.read_text(spark, f"{location.rstrip('/')}/{_SCHEMA}") if schema is None else None
    if kept is not None:
        schema = StructType.fromJson(json.loads(kept))
    if schema is None:
        try:
            with held_settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
                schema = spark.read.option("mergeSchema", True).parquet(location).schema
        except AnalysisException as problem:
            if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return False
            raise
    _run(spark, create_ddl(name, schema, partition_by, location))
    _run(spark, f"MSCK REPAIR TABLE {quote_table(name)}")
    staged.reattach(spark, name, location_of(spark, name), partition_by)
    return True


def location_of(spark: SparkSession, name: str) -> str:
    """Where the catalog has the table's files. No column is mistaken for it, whatever its name, and no job runs."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(name)} AS JSON").head()[0]
    return json.loads(described)["location"].rstrip("/")


def keep_schema(spark: SparkSession, name: str) -> None:
    """Keep the table's columns in a file at its location, for ``attach``: what footers alone cannot tell."""
    place, kept = f"{location_of(spark, name)}/{_SCHEMA}", None
    # Again where another load has added columns meanwhile: whoever writes last has seen the table after it.
    while kept != (now := spark.table(quote_table(name)).schema):
        files.write_text(spark, place, json.dumps(now.jsonValue()))
        kept = now


def recover(spark: SparkSession, name: str, partition_by: Sequence[str] = PARTITION_BY, *, force: bool = False) -> bool:
    """Take back a load ``all_or_none`` whose driver was lost while it replaced partitions; whether there was one.

    Loads of this application are taken back by the next write as well. One of another application, which may still be
    running, is taken back only by ``force``.
    """
    return staged.recover(spark, name, location_of(spark, name), partition_by, force=force)


def null_partitions(spark: SparkSession, name: str, columns: set[str]) -> bool:
    """Whether the table has a partition with a null in one of the columns (lower-cased names). No data is read."""
    parts = spark.sql(f"SHOW PARTITIONS {quote_table(name)}")
    each = F.explode(F.split("partition", "/")).alias("part")
    null = F.lower(F.regexp_replace("part", "=.*", "")).isin(list(columns)) & F.col("part").endswith(f"={staged.NULL}")
    return bool(columns) and parts.select(each).where(null).head() is not None


def write(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | str = PARTITION_BY,
    *,
    location: str | None = None,
    cluster: bool = True,
    rows_per_task: int | None = None,
    all_or_none: bool = False,
    preview: int = 0,
) -> WriteResult:
    """Write ``df`` to the table, replacing exactly the partitions that receive rows.

    A missing table is created, or attached if an earlier session left it at ``location``. Columns the
    table lacks are added, also where another load adds some at the same time; columns the frame lacks are null. Rows with a
    null partition value are kept, in the null partition. An empty frame still creates or widens the table, and changes no
    data. The rows are counted by the pass that writes them, in all and by partition.

    ``cluster=False`` skips the shuffle that brings equal partition values together. Use it when the
    input is already in that order; otherwise each task writes a file for every value it meets.
    ``rows_per_task`` cuts up what one map task gives for one partition (see ``layout.cluster``).
    ``location`` is where a new table's files go, if not into the warehouse; one that is known stays
    where it is. ``preview`` shows that many rows first, which costs a job of its own.

    By default partitions are replaced one after the other when the job commits, and a driver that is lost meanwhile leaves some
    old and some new. With ``all_or_none`` rows are written beside the table first, and then the partitions' places are switched
    in the catalog; a failure puts back all of them, a lost driver's load is taken back by the next write or by ``recover``.
    Such partitions lie in folders of their own, so the table is to be read by the catalog or after ``attach``.
    """
    spark = df.sparkSession
    table = quote_table(name)
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    log.info("loading into %s", name)
    _check_keys(df, partition_by)

    known = spark.catalog.tableExists(table)
    if not known and location is not None:
        known = attach(spark, name, location, partition_by=partition_by)
    if not known:
        _run(spark, create_ddl(name, df.schema, partition_by, location))
    _check_partitioning(spark, table, partition_by)
    place = location_of(spark, name)
    staged.recover(spark, name, place, partition_by)
    added = _add_missing(spark, name, df)
    if not known or added:
        keep_schema(spark, name)
    if preview:
        align(df, spark.table(table).schema).show(preview)

    load = _replace_all_or_none if all_or_none else _replace
    while True:
        schema = spark.table(table).schema
        try:
            result = load(align(df, schema), name, place, partition_by, cluster, rows_per_task)
            break
        except AnalysisException:
            # Refused before any row was read: right where another load has added columns since, which are nulls here.
            if spark.table(table).schema == schema:
                raise
    if result.rows:
        log.info("wrote %d rows into %s", result.rows, name)
    else:
        log.warning("no rows for %s, its data is unchanged", name)
    return WriteResult(name, result.rows, not known, added, result.partitions)


def _add_missing(spark: SparkSession, name: str, df: DataFrame) -> list[str]:
    """Add the columns the table lacks, and look again until it has all: other loads may be doing the same."""
    added: list[str] = []
    while True:
        current = spark.table(quote_table(name)).schema
        check_types(df, current)
        missing = missing_from(df, current)
        if not missing.names:
            return list(dict.fromkeys(added))
        try:
            # Loads of one session do not get into each other's way; those of other sessions are met by trying again.
            with _altering:
                added += add_columns(spark, name, missing_from(df, spark.table(quote_table(name)).schema))
        except AnalysisException:
            spark.catalog.refreshTable(quote_table(name))
            if spark.table(quote_table(name)).schema == current:
                raise


def _replace(rows: DataFrame, name, place, partition_by, cluster, rows_per_task) -> WriteResult:
    """Spark's dynamic overwrite."""
    spark = rows.sparkSession
    with held_settings(spark):
        rows, counts = _counted(rows, partition_by, cluster, rows_per_task)
        entry = ledger.begin(spark, place)
        try:
            rows.write.mode("overwrite").insertInto(quote_table(name))
        except AnalysisException:
            files.remove(spark, entry)
            raise
    result = _result(name, counts)
    ledger.finish(spark, entry, result.partitions)
    return result


def _replace_all_or_none(rows: DataFrame, name, place, partition_by, cluster, rows_per_task) -> WriteResult:
    spark = rows.sparkSession
    stage = staged.new_stage(place)
    # What an insert would do: the table's types, which hold the input's values.
    rows = rows.select([column(f.name).cast(f.dataType).alias(f.name) for f in spark.table(quote_table(name)).schema])
    with held_settings(spark):
        rows, counts = _counted(rows, partition_by, cluster, rows_per_task)
        try:
            staged.stage(rows, stage, partition_by)
        except BaseException:
            files.remove(spark, stage)
            raise
    result = _result(name, counts)
    entry = ledger.begin(spark, place)
    try:
        staged.publish(spark, name, place, stage, partition_by)
    except BaseException:
        files.remove(spark, entry)
        raise
    ledger.finish(spark, entry, result.partitions)
    return result


def _counted(rows: DataFrame, partition_by, cluster, rows_per_task) -> tuple[DataFrame, Observation]:
    if cluster:
        # Under the settings as well: without adaptive execution Spark drops the hint when it is given.
        rows = cluster_by(rows, *partition_by, rows_per_task=rows_per_task)
    # Observed above the shuffle, in the stage that writes: counted once, also when map tasks run again.
    counts = Observation()
    # A sketch of bounded size, exact up to as many partitions. Spark stores an empty text as it stores a null.
    keys = F.to_json(F.array(*[F.nullif(column(key).cast("string"), F.lit("")) for key in partition_by]))
    of_each = F.call_function("approx_top_k", keys, F.lit(_COUNTED), F.lit(_COUNTED))
    return rows.observe(counts, F.count(F.lit(1)).alias("rows"), of_each.alias("partitions")), counts


def _result(name: str, counts: Observation) -> WriteResult:
    rows, found = counts.get["rows"], counts.get["partitions"] or []
    partitions = {tuple(json.loads(key)): n for key, n in found}
    whole = len(partitions) < _COUNTED and sum(partitions.values()) == rows
    return WriteResult(name, rows, partitions=partitions if whole else None)


def _check_keys(df: DataFrame, partition_by: Sequence[str]) -> None:
    have = by_lower_name(df.columns)
    absent = [key for key in partition_by if key.lower() not in have]
    if absent:
        raise ValueError(f"input lacks the partition column(s) {', '.join(absent)}")
    if len(have) == len(partition_by):
        raise ValueError("input has no column besides the partition columns")


def _check_partitioning(spark: SparkSession, table: str, partition_by: Sequence[str]) -> None:
    actual = [c.name.lower() for c in spark.catalog.listColumns(table) if c.isPartition]
    if actual != [key.lower() for key in partition_by]:
        raise ValueError(f"{table} is partitioned by {actual}, not by {list(partition_by)}")


def _run(spark: SparkSession, statement: str) -> None:
    log.info("running %s", statement)
    spark.sql(statement)
