"""What loads have replaced in a table, kept beside its data, and which of them a reader has seen."""

import json
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from tripmill import files

# At the table's location, and at the root of what is made from it; names that begin so are not read as data.
_LEDGER = "_tripmill_loads"
_SEEN = "_tripmill_seen"

#: Partition values, in the order of the partition columns.
Key = tuple[str | None, ...]


def begin(spark: SparkSession, location: str) -> str:
    """Note that a load has begun. Until it is told what it replaced, it may have been anything."""
    entry = f"{location}/{_LEDGER}/{time.time_ns():020d}-{uuid.uuid4().hex}.json"
    files.write_text(spark, entry, json.dumps({"partitions": None}))
    return entry


def finish(spark: SparkSession, entry: str, rows: dict[Key, int] | None) -> None:
    """Note what the load replaced, and how many rows each partition has from it. Of a load without rows nothing is left.

    A load of too many partitions to name may go on to have replaced anything.
    """
    if rows is None:
        return
    if rows:
        files.write_text(spark, entry, json.dumps({"partitions": [[list(key), n] for key, n in sorted(rows.items(), key=str)]}))
    else:
        files.remove(spark, entry)


def loads(spark: SparkSession, location: str) -> dict[str, dict[Key, int] | None]:
    """Each load's partitions and rows, by its name, in the order in which they began; none for a load that has not finished."""
    found = {}
    for name in files.names(spark, f"{location}/{_LEDGER}"):
        # A file that is being written under its new name is none yet.
        if name.startswith(("_", ".")):
            continue
        text = files.read_text(spark, f"{location}/{_LEDGER}/{name}")
        if text is not None:
            parts = json.loads(text)["partitions"]
            found[name] = None if parts is None else {tuple(key): n for key, n in parts}
    return found


def changed(given: dict[str, dict[Key, int] | None], seen: Iterable[str] | None) -> set[Key] | None:
    """The partitions that loads have replaced since; none (that is, any) where one cannot tell.

    ``seen`` has what ``as_seen`` made of earlier loads, or is none for a reader that comes for the first time.
    """
    if seen is None:
        return None
    seen = set(seen)
    new = [parts for name, parts in given.items() if _mark(name, parts) not in seen]
    return None if any(parts is None for parts in new) else {key for parts in new for key in parts}


def as_seen(given: dict[str, dict[Key, int] | None]) -> list[str]:
    return [_mark(name, parts) for name, parts in given.items()]


def _mark(name: str, parts: dict | None) -> str:
    # A load that finishes after it was seen unfinished is seen again.
    return f"{name}:unfinished" if parts is None else name


def seen(spark: SparkSession, root: str, location: str) -> list[str] | None:
    """The loads of the table at ``location`` that are in what lies at ``root``; none if it was never made from the ledger."""
    return json.loads(files.read_text(spark, f"{root.rstrip('/')}/{_SEEN}") or "{}").get(location)


def keep_seen(spark: SparkSession, root: str, location: str, marks: Sequence[str]) -> None:
    path = f"{root.rstrip('/')}/{_SEEN}"
    kept = json.loads(files.read_text(spark, path) or "{}")
    files.write_text(spark, path, json.dumps(kept | {location: list(marks)}))
