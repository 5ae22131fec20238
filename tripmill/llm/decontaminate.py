"""Benchmark decontamination: an FM-index per training shard, searched for the windows of benchmark items."""

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.llm._common import byte_class, kept, lower_ascii, materialised, slices, span_hashes, text_bytes, text_of, words
from tripmill.llm.fm_index import FMIndex

#: Bytes of benchmark text that are sent to all tasks at once. A larger benchmark is taken in blocks of this size.
BLOCK_BYTES = 8 << 20

#: Words are letters and digits of ASCII, and all other characters beyond it.
_BETWEEN = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
MEMBER = byte_class(besides=_BETWEEN)

_RESULT = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"

def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks; no more than one block and one fetched partition are on the driver."""
    block, size = [], 0
    for item, text in benchmark.select(F.col(id_col).cast("string"), text_of(text_col)).toLocalIterator():
        block.append((item, text))
        size += len(text.encode())
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _phrases(block: list[tuple[str, str]], window: int) -> tuple:
    """Of a block: sorted hashes of its words, different windows as word numbers, and the items of each window."""
    names = sorted({item for item, _ in block if item is not None})
    number = {item: i for i, item in enumerate(names)}
    block = [(item, text) for item, text in block if item is not None]
    data, offsets = text_bytes(pa.array([text for _, text in block], pa.string()))
    data = lower_ascii(data)
    start, end, row = words(data, offsets, MEMBER)
    vocabulary, word = np.unique(span_hashes(data, start, end), return_inverse=True)
    at = np.searchsorted(row, np.arange(len(block) + 1))
    found: dict[tuple, set[int]] = {}
    for i, (item, _) in enumerate(block):
        own = (word[at[i] : at[i + 1]] + 1).tolist()
        width = min(window, len(own))
        for k in range(len(own) - width + 1 if width else 0):
            found.setdefault(tuple(own[k : k + width]), set()).add(number[item])
    lengths = np.array([len(p) for p in found], np.int64)
    phrases = np.zeros((len(found), window), np.int64)
    for k, phrase in enumerate(found):
        phrases[k, : len(phrase)] = phrase
    of = [sorted(s) for s in found.values()]
    item_at = np.concatenate([[0], np.cumsum([len(s) for s in of])]).astype(np.int64)
    items = np.array([x for s in of for x in s], np.int64)
    return names, vocabulary, phrases, lengths, item_at, items


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes, each member's group and its place there."""
    group = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
    return group, place


def _finder(block: list[tuple[str, str]], window: int):
    token = uuid.uuid4().hex

    def build() -> tuple:
        return _phrases(block, window)

    def shard(data: np.ndarray, offsets: np.ndarray) -> tuple:
        """Of the rows of one shard: words, hit words, spans (row, start, end), pairs (row, item)."""
        names, vocabulary, phrases, lengths, item_at, items = kept(token, build)
        n_rows = len(offsets) - 1
        n_words = np.zeros(n_rows, np.int64)
        parts = []
        for lo, hi in slices(offsets):
            low = lower_ascii(data[offsets[lo] : offsets[hi]])
            start, end, row = words(low, offsets[lo : hi + 1] - offsets[lo], MEMBER)
            n_words[lo:hi] = np.bincount(row, minlength=hi - lo)
            if not len(start) or not len(phrases):
                continue
            hashed = span_hashes(low, start, end)
            at = np.minimum(np.searchsorted(vocabulary, hashed), len(vocabulary) - 1)
            symbol = np.where(vocabulary[at] == hashed, at + 1, 0)
            # Only runs of benchmark words as long as the shortest window can hold one; others need no index.
            edge = np.ones(len(symbol) + 1, bool)
            edge[1:-1] = (row[1:] != row[:-1]) | ((symbol[1:] > 0) != (symbol[:-1] > 0))
            begin = np.flatnonzero(edge)
            length = np.diff(begin)
            run = (symbol[begin[:-1]] > 0) & (length >= lengths.min())
            group, place = _spread(length[run])
            index = begin[:-1][run][group] + place
            last = np.flatnonzero(np.append(group[1:] != group[:-1], True)) if len(group) else np.zeros(0, np.int64)
            parts.append(
                [
                    np.insert(x, last + 1, 0)
                    for x in (symbol[index], row[index] + lo, start[index] + offsets[lo], end[index] + offsets[lo])
                ]
            )
        empty = np.zeros(0, np.int64)
        text, row, start, end = (np.concatenate([empty, *p]) for p in zip(*parts, strict=True)) if parts else [empty] * 4
        if not len(text):
            return n_words, np.zeros(n_rows, np.int64), (empty, empty, empty), (empty, empty)
        index = FMIndex(text, len(vocabulary))
        low, high = index.search(phrases, lengths)
        phrase, place = _spread(high - low)
        at = index.locate(low[phrase] + place)
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + lengths[phrase], -1)
        hit = np.cumsum(cover)[:-1] > 0
        n_hit = np.bincount(row[hit], minlength=n_rows)
        # An end stands between runs, so hit words that touch here are neighbours in one text.
        first = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        final = np.flatnonzero(hit & ~np.append(hit[1:], False))
        n_items = len(names)
        seen, _ = _spread((item_at[1:] - item_at[:-1])[phrase])
        _, which = _spread((item_at[1:] - item_at[:-1])[phrase])
        pairs = np.unique(row[at[seen]] * n_items + items[item_at[phrase[seen]] + which])
        return n_words, n_hit, (row[first], start[first], end[final]), (pairs // n_items, pairs % n_items)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(kept(token, build)[0], pa.string())
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            n_words, n_hit, (row, start, end), (doc, item) = shard(data, offsets)
            rows = np.arange(batch.num_rows + 1)
            spans = pa.StructArray.from_arrays(
                [pa.array(start - offsets[row]), pa.array(end - offsets[row])], ["start", "end"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words),
                    pa.array(n_hit),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(row, rows), pa.int32()), spans),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, rows), pa.int32()), names.take(pa.array(item))),
                ],
                ["id", "n_words", "n_hit", "spans", "items"],
            )

    return found


_MERGE = """
aggregate(array_sort(all_spans), cast(array() as array<struct<start:bigint,end:bigint>>), (done, s) ->
    if(size(done) > 0 and done[size(done) - 1].end >= s.start,
       concat(slice(done, 1, size(done) - 1), array(named_struct('start', done[size(done) - 1].start,
              'end', greatest(done[size(done) - 1].end, s.end)))),
       concat(done, array(s))))
"""


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit, items, spans``.

    A-Z count as a-z; words are runs of letters and digits of ASCII and of all other characters beyond it. A window is
    ``window`` words of an item in a row; an item of fewer words is one window, one of none has none. ``n_hit`` counts the words
    inside any occurrence of a window, ``items`` are the ids (as text, sorted) of the items with an occurring window, ``spans`` the
    byte ranges to remove, merged where occurrences overlap or follow each other.

    Documents stay where they are: nothing is shuffled. A task takes the rows of an Arrow batch as a shard and indexes what can hold a
    window: runs of words that all are benchmark words. All windows are searched at once. The benchmark goes to the tasks in
    blocks of ``BLOCK_BYTES`` of text; with more than one, each block passes over the documents once, and a row's results are then brought
    together by a number that the row was given, so that ids do not matter.

    A null text has no words. An item without id is not looked for; of items that share an id, any counts. Null and repeated document ids
    are rows like any other. Without items nothing is hit. Other columns are not looked at.
    """
    texts = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = StructType([texts.schema["id"], *StructType.fromDDL(_RESULT)])
    blocks = list(_blocks(benchmark, item_col, item_text_col)) or [[]]
    if len(blocks) == 1:
        result = texts.mapInArrow(_finder(blocks[0], window), schema)
    else:
        result = _together(texts, blocks, window, schema)
    return result.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def _together(texts: DataFrame, blocks: list, window: int, schema: StructType) -> DataFrame:
    """Results of several blocks: spans and items merged, hit words counted again inside the merged spans."""
    texts = materialised(texts.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    by_row = StructType([StructField("id", LongType()), *StructType.fromDDL(_RESULT)])
    passes = [texts.select("row", "text").mapInArrow(_finder(b, window), by_row) for b in blocks]
    merged = (
        reduce(DataFrame.unionByName, passes)
        .groupBy(F.col("id").alias("row"))
        .agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("all_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .withColumn("spans", F.expr(_MERGE))
        .drop("all_spans")
    )
    out = texts.join(merged, "row").drop("row")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            counts = []
            for text, spans in zip(table["text"].to_pylist(), table["spans"].to_pylist(), strict=True):
                data = lower_ascii(np.frombuffer(text.encode(), np.uint8))
                start, _, _ = words(data, np.array([0, len(data)]), MEMBER)
                counts.append(sum(int(((start >= s["start"]) & (start < s["end"])).sum()) for s in spans))
            out = table.append_column("n_hit", pa.array(counts, pa.int64()))
            yield from out.select(["id", "n_words", "n_hit", "spans", "items"]).combine_chunks().to_batches()

    return out.mapInArrow(counted, schema)
