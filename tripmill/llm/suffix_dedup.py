"""Repeated passages across a corpus: bytes of strings that also start earlier, removed."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.llm._common import (
    _INVERSE,
    _MULTIPLIER,
    materialised,
    mixed,
    powers,
    slices,
    tasks_for,
    text_bytes,
    text_of,
)
from tripmill.llm.burrows_wheeler import equal_prefix_classes

#: Bytes of the anchors. A repeated string must be longer.
GRAM = 32

#: Bytes of text whose anchors are sorted together before anything is sent, and on average in a part of the contexts.
BATCH_BYTES = 8 << 20
PART_BYTES = 8 << 20

#: Ranges that one batch, or what was merged of several, is dealt out to: more parts are reached in several rounds, so
#: the rows sent in a round follow the number of batches and not its square.
FAN_OUT = 128

#: Bytes of contexts transformed together, and contexts of one anchor beyond which windows are compared one by one.
SHARD_BYTES = 1 << 19
HOT_CONTEXTS = 4_000

#: Bytes whose hashes are in memory at a time, some hundred bytes for each.
_SLICE_BYTES = 1 << 20

#: A longer text is cut into pieces of so many window starts, which overlap by a window.
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)

def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64((1 << 64) - 1))
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).reshape(-1)
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def contexts_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of ``length`` bytes: row, start, number of windows, anchor hash and context hash.

    The anchor of a window is the least of its grams by hash, the first of equal ones. It depends on the window's bytes alone, so equal
    windows have equal anchors, at the same place in them. Windows in a row that have the same anchor make one context, from the first byte of
    the first to the last byte of the last.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n + 1, _MULTIPLIER)[:n], out=sums[1:])
    inverse = powers(n + 1, _INVERSE)
    gram = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    key = gram & ~_PLACE
    key |= np.arange(len(gram), dtype=np.uint64)
    least = (_sliding_least(key, length - GRAM + 1) & _PLACE).astype(np.int64)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: n - length + 1]
    inside = np.arange(n - length + 1) + length <= offsets[1:][row_of]
    # A context begins where the anchor, the row or what is inside changes.
    change = np.ones(len(least) + 1, bool)
    change[1:-1] = (least[1:] != least[:-1]) | (row_of[1:] != row_of[:-1]) | (inside[1:] != inside[:-1])
    at = np.flatnonzero(change)
    begin, count = at[:-1], np.diff(at)
    kept = inside[begin]
    begin, count = begin[kept], count[kept]
    row = row_of[begin]
    end = begin + count + length - 1
    whole = (sums[end] - sums[begin]) * inverse[begin]
    place = (least[begin] - begin).astype(np.uint64)
    context = mixed(whole ^ mixed(place * np.uint64(256) + count.astype(np.uint64)))
    return row, begin - offsets[row], count, gram[least[begin]], context


def _pieces(offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Byte ranges of pieces, and of each its row and where in it it begins. Most rows are one piece."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-(size - length + 1) // _PIECE))
    row = np.repeat(np.arange(len(size)), count)
    base = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * _PIECE
    begin = offsets[row] + base
    return begin, np.minimum(begin + _PIECE + length - 1, offsets[row + 1]), row, base


def _firsts(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows sorted by context, anchor, document and start; which are the first of their context, and which come after the first."""
    anchor, context, doc, start, _ = rows
    order = np.lexsort((start, doc, anchor, context))
    rows = [x[order] for x in rows]
    anchor, context, doc, start, _ = rows
    first = np.ones(len(anchor), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.zeros(0, np.int64)
    # A repeated row stands at the same place as the first and is not after it.
    later = (doc != doc[head]) | (start != start[head])
    return rows, first, later


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted, and those of one document that overlap or touch made one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    same = doc[1:] == doc[:-1]
    # The furthest end so far, within the document: documents are kept apart by more than any text is long.
    apart = np.append(0, np.cumsum(~same)) << 40
    furthest = np.maximum.accumulate(end + apart)
    new = np.append(True, start[1:] + apart[1:] > furthest[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(new)) - 1
    return doc[new], start[new], furthest[last] - apart[last]


def _rounds(parts: int) -> list[int]:
    """Over how many ranges of contexts each round deals; the last round reaches the parts."""
    ranges = [FAN_OUT]
    while ranges[-1] < parts:
        ranges.append(ranges[-1] * FAN_OUT)
    return [*ranges[:-1], parts]


#: What is sent to a range: contexts, one of each kind, and merged spans that are known to be repeats already.
_SENT = [(name, "<u8") for name in ("anchor", "context")] + [("doc", "<i8"), ("start", "<u4"), ("count", "u1")]
_KNOWN = [("later_doc", "<i8"), ("later_start", "<u4"), ("later_end", "<u4")]


def _split(length: int, given: list[np.ndarray], known: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Contexts sorted, one of each kind, and the known repeats together with those among the contexts."""
    rows, first, later = _firsts(given)
    doc, start, count = (x[later] for x in rows[2:])
    repeats = [doc, start, start + count + (length - 1)]
    return [x[first] for x in rows], list(_merged(*[np.concatenate(c) for c in zip(known, repeats, strict=True)]))


def _dealt(rows: list[np.ndarray], known: list[np.ndarray], ranges: int) -> pa.RecordBatch:
    """Rows for the ranges that get any. By context: one anchor's contexts go to all ranges, however many there are; known repeats go evenly to the same ranges."""
    if len(rows[3]) and rows[3].max() + 1000 >= 1 << 32:
        raise ValueError("a text of over 4 GB")
    part = ((rows[1] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    parts, at = np.unique(part, return_index=True)
    at = np.append(at, len(part))
    shares = [np.array_split(x, max(len(parts), 1)) for x in known]
    columns: list[list] = [[] for _ in _SENT + _KNOWN]
    for p, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
        sent = [*[x[lo:hi] for x in rows], *[share[p] for share in shares]]
        for column, x, (_, kind) in zip(columns, sent, _SENT + _KNOWN, strict=True):
            column.append(x.astype(kind).tobytes())
    # Any number will do that spreads batches evenly and is the same when a task is run again.
    batch = rows[1][:1].view(np.int64).repeat(len(parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(parts.astype(np.int64)), pa.array(batch), *[pa.array(c, pa.binary()) for c in columns]],
        ["part", "batch", *[name for name, _ in _SENT + _KNOWN]],
    )


def _received(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    def read(name: str, kind: str) -> np.ndarray:
        x = np.concatenate([np.frombuffer(raw, kind) for raw in table[name].to_pylist()])
        return x if kind.endswith("8") else x.astype(np.int64)

    return [read(*field) for field in _SENT], [read(*field) for field in _KNOWN]


def _finder(length: int, ranges: int):
    """Texts to rows for the ranges of contexts. What a batch knows to repeat itself is not asked about again."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def full() -> pa.RecordBatch:
            rows, known = _split(length, [np.concatenate(c) for c in zip(*held, strict=True)], [np.zeros(0, np.int64)] * 3)
            held.clear()
            return _dealt(rows, known, ranges)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = text_bytes(batch.column(1))
            begin, end, row, base = _pieces(offsets, length)
            bounds = np.concatenate([[0], np.cumsum(end - begin)])
            for lo, hi in slices(bounds, _SLICE_BYTES):
                part = np.concatenate([data[b:e] for b, e in zip(begin[lo:hi].tolist(), end[lo:hi].tolist(), strict=True)])
                own, start, count, anchor, context = contexts_of(part, bounds[lo : hi + 1] - bounds[lo], length)
                held.append([anchor, context, ids[row[lo:hi]][own], start + base[lo:hi][own], count])
                size += len(part)
                if size >= BATCH_BYTES:
                    yield full()
                    size = 0
        if held:
            yield full()

    return found


def _merger(length: int, ranges: int):
    """What several batches sent to one range, merged and dealt out to the finer ranges of the next round."""

    def merged(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_dealt(*_split(length, *_received(table)), ranges)])

    return merged


def _judge(length: int):
    """All contexts of a part: repeats of equal contexts, and one of each kind."""

    def judged(table: pa.Table) -> pa.Table:
        (anchor, _, doc, start, count), (old_doc, old_start, old_end) = _split(length, *_received(table))
        n_old, n_kinds = len(old_doc), len(anchor)
        return pa.table(
            {
                "kind": np.repeat([False, True], [n_old, n_kinds]),
                "anchor": np.concatenate([np.zeros(n_old, np.int64), anchor.view(np.int64)]),
                "id": np.concatenate([old_doc, doc]),
                "start": np.concatenate([old_start, start]),
                "end": np.concatenate([old_end, start + count + (length - 1)]),
            }
        )

    return judged


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the contexts asked for, to the contexts' bytes."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        asks = batch.column(2)
        of = asks.flatten()
        row = np.repeat(np.arange(batch.num_rows), asks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        start = of.field("start").to_numpy(zero_copy_only=False)
        end = of.field("end").to_numpy(zero_copy_only=False)
        begin, stop = offsets[row] + start, np.minimum(offsets[row] + end, offsets[row + 1])
        raw = [data[b:e].tobytes() for b, e in zip(begin.tolist(), stop.tolist(), strict=True)]
        ids = batch.column(0).take(pa.array(row))
        yield pa.RecordBatch.from_arrays(
            [of.field("anchor"), of.field("hot"), ids, pa.array(start, pa.int64()), pa.array(raw, pa.binary())],
            ["anchor", "hot", "id", "start", "bytes"],
        )


def _transformer(length: int):
    """Contexts of a shard to spans of windows that also start earlier."""

    def spans(table: pa.Table) -> pa.Table:
        raw = table["bytes"].to_pylist()
        doc, start = table["id"].to_numpy(), table["start"].to_numpy()
        size = np.array([len(r) + 1 for r in raw], np.int64)
        last = np.cumsum(size) - 1
        sequence = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8).astype(np.int64) + 1
        sequence[last] = 0
        order, group = equal_prefix_classes(sequence, length)
        # Of suffixes that share a class, the one that starts earliest in the corpus stays.
        several = np.bincount(group)[group] > 1
        order, group = order[several], group[several]
        context = np.searchsorted(last, order)
        place = start[context] + order - (last[context] - size[context] + 1)
        by = np.lexsort((place, doc[context], group))
        group, context, place = group[by], context[by], place[by]
        head = np.ones(len(group), bool)
        head[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else np.zeros(0, np.int64)
        later = (doc[context] != doc[context[first]]) | (place != place[first])
        context, place = context[later], place[later]
        by = np.lexsort((place, context))
        context, place = context[by], place[by]
        begins = np.ones(len(place), bool)
        begins[1:] = (context[1:] != context[:-1]) | (place[1:] != place[:-1] + 1)
        ends = np.append(begins[1:], True) if len(place) else begins
        return pa.table(
            {
                "id": doc[context[begins]],
                "start": place[begins],
                "end": place[ends] + length,
            }
        )

    return spans


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their spans, in any order and overlapping, to merged spans and the bytes that are left."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for lo, hi in slices(offsets, _SLICE_BYTES):
            part = batch.slice(lo, hi - lo)
            yield _without_spans(part, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _without_spans(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    size = np.diff(offsets)
    lists = batch.column(2)
    count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    of = lists.flatten()
    row = np.repeat(np.arange(batch.num_rows), count)
    start = np.minimum(of.field("start").to_numpy(zero_copy_only=False), size[row]) + offsets[row]
    end = np.minimum(of.field("end").to_numpy(zero_copy_only=False), size[row]) + offsets[row]
    cover = np.zeros(len(data) + 1, np.int32)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.append(False, gone[:-1]) & ~edge[:-1] if len(data) else gone
    after = np.append(gone[1:], False) & ~edge[1:] if len(data) else gone
    first, last = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    of_row = np.searchsorted(offsets, first, "right") - 1
    merged = pa.StructArray.from_arrays(
        [pa.array(first - offsets[of_row]), pa.array(last + 1 - offsets[of_row])], ["start", "end"]
    )
    kept = np.concatenate([[0], np.cumsum(~gone)])[offsets]
    left = data[~gone]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(size, pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(of_row, np.arange(batch.num_rows + 1)), pa.int32()), merged),
            pa.array([left[a:b].tobytes() for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)], pa.binary()),
        ],
        ["id", "n_bytes", "spans", "kept"],
    )


def _windows_one_by_one(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows by grouping a hash of each window: for anchors of very many different contexts."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("at")
    window = contexts.select("id", "start", "bytes", at).select(
        "id",
        (F.col("start") + F.col("at")).alias("start"),
        F.sha2(F.substring(F.col("bytes"), F.col("at") + 1, F.lit(length)), 256).alias("window"),
    )
    first = window.groupBy("window").agg(F.min(F.struct("id", "start")).alias("first")).withColumnRenamed("window", "w")
    again = window.join(first, F.col("window") == F.col("w")).where(F.struct("id", "start") != F.col("first"))
    return again.select("id", "start", (F.col("start") + length).alias("end"))


def _placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``id, text, place`` with a whole number for their order, and the bytes of all texts.

    The id is the place, unless ids are null or different texts share one. Then pairs of id and hash are sorted, and numbered as Spark
    numbers the rows of sorted partitions.
    """
    hashed = rows.withColumn("_hash", F.xxhash64("text"))
    per_id = hashed.groupBy("id").agg(
        F.sum(F.octet_length("text").cast("long")).alias("bytes"),
        (F.min("_hash") != F.max("_hash")).alias("differ"),
    )
    total, unclear = per_id.agg(F.sum("bytes"), F.count_if(F.col("differ") | F.col("id").isNull())).head()
    if not unclear:
        return rows.withColumn("place", F.col("id").cast("long")), total or 0
    keys = hashed.select("id", "_hash").distinct().orderBy(F.asc_nulls_last("id"), "_hash")
    places = materialised(keys.withColumn("place", F.monotonically_increasing_id()), "places").toDF("_i", "_h", "place")
    same = F.col("id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))
    return hashed.join(places, same).select("id", "text", "place"), total or 0


def repeated_passages(
    df: DataFrame, *, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col, n_bytes, spans, kept``.

    Removed is each byte that a string of ``length`` bytes covers which also starts earlier: in a document of smaller id, or in the same one before.
    All strings count as they stand in the input; none crosses documents. ``spans`` are the removed byte ranges, merged where they touch, and ``kept`` the
    bytes that are left, as a binary, since a cut can part a character.

    1. Each window gets an anchor, the least of its grams, so that equal windows meet without all windows being sent: contexts, one in some forty bytes.
    2. Parts of the space of contexts sort them. Equal ones are repeats but for the first; a batch sends each kind once, so no part
       grows with a passage that all documents share, nor with an anchor that stands in many different contexts. A batch is dealt out to ``FAN_OUT``
       ranges; where there are more parts, ranges of several batches are merged and dealt out again.
       Kinds are then counted by anchor, partial counts first. An anchor with one kind of context is settled.
    3. Of anchors with several kinds, one context of each kind is read and goes into a Burrows-Wheeler transform with others. Breadth-first backward
       extension gives common prefixes by increasing value and stops at ``length``; suffixes that are not parted by then
       share a window. An anchor of over ``HOT_CONTEXTS`` kinds is settled window by window in place of one transform.

    Ids are whole numbers. A null id is larger than all others. Rows that share an id and a text are one document: neither repeats the other. If they share
    an id but not the text, they are documents in the order of their texts' hashes. A null text is empty. Texts shorter than ``length`` stay whole. Other columns are not looked at.
    """
    if length <= GRAM or length - GRAM > 200:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 200}")
    rows, total = _placed(df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")))
    texts = rows.select(F.col("place").alias("id"), "text")
    parts = max(1, -(-total // PART_BYTES))
    sent = "part bigint, batch bigint, " + ", ".join(f"{name} binary" for name, _ in _SENT + _KNOWN)
    first, *finer = rounds = _rounds(parts)
    dealt = texts.mapInArrow(_finder(length, first), sent)
    for coarse, ranges in zip(rounds, finer, strict=False):
        # As many groups as parts in all, so each merges as much as a part holds.
        group = F.pmod(F.xxhash64("batch"), F.lit(-(-parts // coarse))).alias("group")
        dealt = dealt.groupBy("part", group).applyInArrow(_merger(length, ranges), sent)
    judged = materialised(
        dealt.groupBy("part").applyInArrow(_judge(length), "kind boolean, anchor bigint, id bigint, start bigint, end bigint"),
        "contexts",
    )
    kinds = judged.where("kind").drop("kind")
    several = materialised(
        kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > HOT_CONTEXTS).alias("hot")),
        "anchors",
    )
    asks = materialised(kinds.join(several, "anchor"), "asks")
    wanted = asks.agg(F.sum(F.col("end") - F.col("start"))).head()[0] or 0
    spans = judged.where("not kind").select("id", "start", "end")
    if wanted:
        per_text = asks.groupBy("id").agg(F.collect_list(F.struct("anchor", "hot", "start", "end")).alias("asks"))
        contexts = materialised(
            texts.join(per_text.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"))
            .select("id", "text", "asks")
            .mapInArrow(_reader, "anchor bigint, hot boolean, id bigint, start bigint, bytes binary"),
            "context-bytes",
        )
        shards = max(1, -(-wanted // SHARD_BYTES))
        transformed = (
            contexts.where("not hot")
            .drop("hot")
            .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
            # With a number, adaptive execution does not merge them: a shard's time is far more than its bytes tell.
            .repartition(min(shards, 4 * tasks_for(df.sparkSession)), "shard")
            .groupBy("shard")
            .applyInArrow(_transformer(length), "id bigint, start bigint, end bigint")
        )
        one_by_one = _windows_one_by_one(contexts.where("hot"), length)
        spans = spans.union(transformed).union(one_by_one.select("id", "start", "end"))
    per_text = spans.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = rows.join(per_text.withColumnRenamed("id", "_id"), F.col("place") == F.col("_id"), "left")
    schema = StructType([rows.schema["id"], *StructType.fromDDL("n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")])
    return joined.select("id", "text", "found").mapInArrow(_remover, schema).withColumnRenamed("id", id_col)
