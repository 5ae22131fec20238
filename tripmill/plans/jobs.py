"""The two batch jobs."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.functions.names import quote_table
from tripmill.functions.trips import enrich, with_date
from tripmill.operators import documents, ledger, table
from tripmill.operators.layout import ROWS_PER_TASK
from tripmill.operators.table import WriteResult
from tripmill.schema import INDEX_EXCLUDES, INDEX_TEMPLATE, TRIP, TRIP_TABLE
from tripmill.session import held_zone
from tripmill.sources.csv import FAULTY, FILE, WHOLE_FILES, files_of, read_checked_csv, read_csv, read_noted_csv, rejects_of
from tripmill.sources.tables import read_table


@dataclass(frozen=True)
class DumpResult:
    written: WriteResult
    rejects: int | None = None


def dump(
    spark: SparkSession,
    csv_path: str | list[str],
    table_name: str = TRIP_TABLE,
    *,
    schema: StructType = TRIP,
    location: str | None = None,
    rejects_path: str | None = None,
    check_header: bool = False,
    cluster: bool = True,
    rows_per_task: int | None = None,
    all_or_none: bool = False,
    zone: str | None = None,
) -> DumpResult:
    """CSV into the date-partitioned table, replacing the days the input holds.

    With ``rejects_path`` the rows with bad cells are also written there as JSON, as they stood in the
    file, in place of an earlier report. They stay in the table with nulls in place of those cells. The pass that loads the table
    is a plain read that notes which files have bad cells, and only those are read a second time, as text, for the report.
    The table is written first; if the report then fails, the table stays as loaded and the run fails.

    Where the input has files that do not split, what one of them holds for a day is dealt out to tasks by
    ``rows_per_task`` (two million unless told otherwise). ``all_or_none`` replaces all days together; see ``table.write``.

    The session has this zone (UTC by default) while the job runs, and the caller's again after it.
    """
    with held_zone(spark, zone):
        how = {"location": location, "cluster": cluster, "all_or_none": all_or_none}
        if rejects_path is None:
            rows = read_csv(spark, csv_path, schema, check_header=check_header)
            how["rows_per_task"] = rows_per_task or _rows_per_task(rows)
            return DumpResult(table.write(with_date(rows), table_name, **how))
        noted = read_noted_csv(spark, csv_path, schema, check_header=check_header)
        how["rows_per_task"] = rows_per_task or _rows_per_task(noted)
        seen = Observation()
        # Only asked whether it is zero, and for which files: below the shuffle a task that runs again may count twice.
        faulty = F.col(FAULTY)
        observed = noted.observe(seen, F.count_if(faulty).alias("faulty"), files_of(faulty).alias("files")).drop(FAULTY, FILE)
        written = table.write(with_date(observed), table_name, **how)
        # Where there are no rows, Spark may have left out the part of the plan that was observed.
        if not written.rows or not seen.get["faulty"]:
            # What an earlier load left there is not this one's report.
            rejects_of(read_checked_csv(spark, csv_path, schema)).limit(0).write.mode("overwrite").json(rejects_path)
            return DumpResult(written, 0)
        kept = Observation()
        again = read_checked_csv(spark, csv_path, schema, check_header=check_header, files=bytes(seen.get["files"]))
        report = rejects_of(again).observe(kept, F.count(F.lit(1)).alias("rows"))
        report.write.mode("overwrite").json(rejects_path)
        return DumpResult(written, kept.get["rows"])


def _rows_per_task(rows: DataFrame) -> int | None:
    """Set where some file of the input does not split, as its ending tells."""
    return ROWS_PER_TASK if any(path.lower().endswith(WHOLE_FILES) for path in rows.inputFiles()) else None


def process(
    spark: SparkSession,
    root: str,
    table_name: str = TRIP_TABLE,
    *,
    template: str = INDEX_TEMPLATE,
    exclude: Sequence[str] | str = INDEX_EXCLUDES,
    location: str | None = None,
    mode: Literal["append", "replace"] = "append",
    null_index: str | None = None,
    cluster: bool | None = None,
    zone: str | None = None,
    dates: Iterable[str | None] | str | None = None,
    since: str | None = None,
    until: str | None = None,
    changed: bool = False,
) -> WriteResult:
    """The table's trips, enriched, into one document index per day.

    ``dates``, ``since`` and ``until`` choose days, as ``read_table`` takes them; other partitions are not read.
    ``location`` is needed only if this session's catalog does not know the table yet. A task reads parts
    of files, each of one partition, so rows are shuffled by index only if the template draws
    on other columns than those of the partitions; ``cluster`` decides otherwise. Where it draws on nothing else,
    a null partition that would fail the job is refused before it starts.

    With ``changed`` only days that loads have replaced since the last such run for this ``root`` are read, and their indices are
    swapped. The first such run, and one after a load that did not finish, takes all days. The template must draw on the
    partition column and nothing else, so that an index is a day. What was seen is kept at ``root`` at the end, so a run that
    fails is simply done again.

    The session has this zone (UTC by default) while the job runs, and the caller's again after it.
    """
    with held_zone(spark, zone):
        if location is not None and not spark.catalog.tableExists(quote_table(table_name)):
            table.attach(spark, table_name, location)
        if not changed:
            return _process(spark, root, table_name, template, exclude, mode, null_index, cluster, dates, since, until)
        if dates is not None or since is not None or until is not None:
            raise ValueError("choose days, or those that have changed, not both")
        return _process_changed(spark, root, table_name, template, exclude, null_index, cluster)


def _process_changed(spark, root, table_name, template, exclude, null_index, cluster) -> WriteResult:
    keys = [c.name for c in spark.catalog.listColumns(quote_table(table_name)) if c.isPartition]
    if len(keys) != 1 or documents.template_fields(template) != {keys[0].lower()}:
        raise ValueError(f"index template {template} is not one index for each value of the partition column")
    place = table.location_of(spark, table_name)
    # Before the table is read: a load that ends meanwhile is seen by the next run.
    loads = ledger.loads(spark, place)
    days = ledger.changed(loads, ledger.seen(spark, root, place))
    if days is not None and not days:
        return WriteResult(root, 0)
    chosen = None if days is None else [day for (day,) in days]
    result = _process(spark, root, table_name, template, exclude, "replace", null_index, cluster, chosen, None, None)
    ledger.keep_seen(spark, root, place, ledger.as_seen(loads))
    return result


def _process(
    spark, root, table_name, template, exclude, mode, null_index, cluster, dates, since, until
) -> WriteResult:
    name = quote_table(table_name)
    partitioned_by = {c.name.lower() for c in spark.catalog.listColumns(name) if c.isPartition}
    by_partition = documents.template_fields(template) <= partitioned_by
    if cluster is None:
        cluster = not by_partition
    # A null day is among the chosen ones only where none are chosen, or where it is named.
    everything = since is None and until is None and (dates is None or (not isinstance(dates, str) and None in (dates := list(dates))))
    if by_partition and everything and null_index is None and table.null_partitions(spark, name, documents.template_fields(template)):
        raise ValueError(f"{table_name} has rows without a value for index template {template}; name a null_index for them")
    trips = read_table(spark, table_name, dates=dates, since=since, until=until).transform(enrich)
    return documents.write(
        trips, root, template, exclude=exclude, mode=mode, null_index=null_index, cluster=cluster
    )
