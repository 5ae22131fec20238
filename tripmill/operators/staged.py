"""Loads that replace all of their partitions or none: written beside the table, then switched in the catalog."""

import json
import logging
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tripmill import files
from tripmill.functions.names import quote, quote_table

log = logging.getLogger(__name__)

# At the table's location; names that begin so are not read as data.
_STAGED = "_tripmill_staged"
_JOURNAL = "_tripmill_load"
_PLACES = "_tripmill_partitions"

# Fixed value: how a null partition is named.
NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Move:
    """A partition's values, where it was (nowhere, if it is new) and where it is to be."""

    values: list[str | None]
    old: str | None
    new: str


class UnfinishedLoadError(RuntimeError):
    """Another application's load of this table has begun to switch partitions and has not ended."""


def new_stage(location: str) -> str:
    return f"{location.rstrip('/')}/{_STAGED}/{uuid.uuid4().hex}"


def stage(rows: DataFrame, place: str, partition_by: Sequence[str]) -> None:
    """Write the rows, already of the table's columns and types, beside the table: nothing of it can be seen there."""
    rows.write.option("compression", "snappy").partitionBy(*partition_by).parquet(place)


def publish(spark: SparkSession, name: str, location: str, place: str, partition_by: Sequence[str]) -> None:
    """Point the catalog's partitions at what was staged: all of them, or none if that fails.

    The partitions' old and new places are kept in a journal while they are switched, one after the other. A failure puts back those
    that were switched; where the driver itself is lost, ``recover`` does so. The load counts from the moment the
    file with the places of all such partitions is renamed. Then the journal goes, and what was replaced is deleted.
    """
    found = _staged_partitions(spark, place, partition_by)
    if not found:
        files.remove(spark, place)
        return
    moves = [Move(values, _place_of(spark, name, partition_by, values), new) for values, new in found]
    journal = {"application": spark.sparkContext.applicationId, "stage": place, "moves": [asdict(m) for m in moves]}
    files.write_text(spark, f"{location}/{_JOURNAL}", json.dumps(journal))
    try:
        for move in moves:
            _point(spark, name, partition_by, move.values, move.new, known=move.old is not None)
        _keep_places(spark, location, partition_by, moves)
    except BaseException:
        log.warning("the load of %s failed while its partitions were switched, and is taken back", name)
        _take_back(spark, name, location, partition_by, moves, place)
        raise
    files.remove(spark, f"{location}/{_JOURNAL}")
    spark.catalog.refreshTable(quote_table(name))
    for move in moves:
        if move.old is not None and move.old != move.new:
            files.remove(spark, move.old)


def recover(spark: SparkSession, name: str, location: str, partition_by: Sequence[str], *, force: bool = False) -> bool:
    """Take back a load that was lost while it switched partitions; whether there was one.

    One of another application may still be running, so it is taken back only by ``force``, and refused otherwise.
    """
    text = files.read_text(spark, f"{location}/{_JOURNAL}")
    if text is None:
        return False
    journal = json.loads(text)
    if journal["application"] != spark.sparkContext.applicationId and not force:
        raise UnfinishedLoadError(
            f"application {journal['application']} has not finished a load of {name}; if it is gone, recover the table by force"
        )
    moves = [Move(**m) for m in journal["moves"]]
    kept = _kept(spark, location)
    if all(kept.get(_key(m.values)) == _inside(m.new) for m in moves):
        # All was done but to remove the journal.
        files.remove(spark, f"{location}/{_JOURNAL}")
        return True
    _take_back(spark, name, location, partition_by, moves, journal["stage"])
    return True


def reattach(spark: SparkSession, name: str, location: str, partition_by: Sequence[str]) -> None:
    """Point the partitions that lie elsewhere than in their own folder of the table at their places, in a new catalog entry."""
    for key, inside in _kept(spark, location).items():
        values = json.loads(key)
        known = _place_of(spark, name, partition_by, values) is not None
        _point(spark, name, partition_by, values, f"{location}/{inside}", known=known)


def _take_back(spark, name, location, partition_by, moves: Sequence[Move], place: str) -> None:
    for move in moves:
        if move.old is not None:
            _point(spark, name, partition_by, move.values, move.old, known=True)
        else:
            spark.sql(f"ALTER TABLE {quote_table(name)} DROP IF EXISTS PARTITION ({_spec(partition_by, move.values)})")
    files.remove(spark, f"{location}/{_JOURNAL}")
    files.remove(spark, place)
    spark.catalog.refreshTable(quote_table(name))


def _point(spark, name, partition_by, values, place: str, *, known: bool) -> None:
    spec, target = _spec(partition_by, values), place.replace("\\", "\\\\").replace("'", "\\'")
    if known:
        spark.sql(f"ALTER TABLE {quote_table(name)} PARTITION ({spec}) SET LOCATION '{target}'")
    else:
        spark.sql(f"ALTER TABLE {quote_table(name)} ADD PARTITION ({spec}) LOCATION '{target}'")


def _place_of(spark, name, partition_by, values) -> str | None:
    spec = _spec(partition_by, values)
    try:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(name)} PARTITION ({spec}) AS JSON").head()[0]
    except AnalysisException as problem:
        if problem.getCondition() == "PARTITIONS_NOT_FOUND":
            return None
        raise
    return json.loads(described)["location"]


def _spec(partition_by: Sequence[str], values: Sequence[str | None]) -> str:
    def text(value):
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"{quote(key)} = {text(value)}" for key, value in zip(partition_by, values, strict=True))


def _staged_partitions(spark: SparkSession, place: str, partition_by: Sequence[str]) -> list[tuple[list[str | None], str]]:
    found = []
    for path in files.folders(spark, place + "/*" * len(partition_by)):
        parts = path.rsplit("/", len(partition_by))[1:]
        values = [unquote(re.sub(r"^[^=]*=", "", part)) for part in parts]
        found.append(([None if v == NULL else v for v in values], path))
    return found


def _key(values: Sequence[str | None]) -> str:
    return json.dumps(values)


def _inside(path: str) -> str:
    """The path within the table's location, so that the table may move as a whole."""
    return re.sub(r".*/(?=" + _STAGED + "/)", "", path)


def _kept(spark: SparkSession, location: str) -> dict[str, str]:
    return json.loads(files.read_text(spark, f"{location}/{_PLACES}") or "{}")


def _keep_places(spark, location, partition_by, moves: Sequence[Move]) -> None:
    kept = _kept(spark, location) | {_key(m.values): _inside(m.new) for m in moves}
    files.write_text(spark, f"{location}/{_PLACES}", json.dumps(kept))
