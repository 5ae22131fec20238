"""Packing token ids into sequences of fixed capacity by Karmarkar-Karp multiway differencing."""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import slices, text_bytes, text_of
from tripmill.llm.tokens import encoder

#: Pieces that are distributed over windows together, and the most tokens of one of them.
POOL_PIECES = 256
PIECE_TOKENS = 256

_TEXT_BYTES = 2 << 20


def differenced(sizes: list[int], ways: int) -> tuple[np.ndarray, list[list[int]]]:
    """Karmarkar-Karp: sums of ``ways`` parts, ascending, and the members of each.

    Each size begins as a partition of its own, all other parts empty. The two partitions of the largest difference are merged, the
    largest part of one with the smallest of the other, until one is left.
    """
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[-1] = size
        parts: list = [None] * ways
        parts[-1] = i
        heap.append((-size, i, sums, parts))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, other, others = heap[0]
        sums = sums + other[::-1]
        order = sums.argsort(kind="stable")
        # A part is nothing, a member, or a pair of parts.
        joined = [a if b is None else b if a is None else (a, b) for a, b in zip(parts, reversed(others), strict=True)]
        parts = [joined[k] for k in order.tolist()]
        sums = sums[order]
        count += 1
        heapq.heapreplace(heap, (int(sums[0] - sums[-1]), count, sums, parts))
    _, _, sums, parts = heap[0]
    return sums, [_members(part) for part in parts]


def _members(part) -> list[int]:
    found, rest = [], [part]
    while rest:
        part = rest.pop()
        if isinstance(part, tuple):
            rest += part
        elif part is not None:
            found.append(part)
    return sorted(found)


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Members of near-equal windows, none over ``capacity``: one window more whenever it is exceeded."""
    if not sizes:
        return []
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        sums, parts = differenced(sizes, ways)
        if sums[-1] <= capacity:
            return [p for p in parts if p]
        ways += 1


def pack(
    df: DataFrame,
    *,
    capacity: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    json_path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its token ids and then ``end_id``. What fills whole sequences is cut off from its beginning; the rest is cut into
    pieces of at most ``PIECE_TOKENS``, and the rests of the documents a task reads are distributed over windows, ``POOL_PIECES`` at a time. ``ids`` has the piece's ids
    as little-endian unsigned 32-bit numbers, ``start`` the document's ids before it. Every sequence holds at most ``capacity`` ids, without gaps from offset 0.

    Nothing is shuffled, and a task keeps one pool and one slice of texts in memory. A sequence belongs to one task, whose number is the upper part of
    ``sequence_id``; a task that runs again over the same rows gives the same. Without texts (null or empty) a document is ``end_id`` alone. Null and repeated ids are documents like any other. No rows, no sequences.
    Other columns are not looked at. ``json_path`` is a vocabulary of ``tokenizers``, ``ranks_path`` the same one as merge ranks (None: not used).
    """
    if json_path is None:
        json_path = public_tokenizers.path("byte_bpe_50k.json")
        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    texts = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, pattern).encode
        first = TaskContext.get().partitionId() << 32
        made = 0
        out: list[tuple] = []
        pool: list[tuple] = []
        id_type = None

        def flush() -> None:
            nonlocal made
            for members in windows([p[2] for p in pool], capacity):
                at = 0
                for k in members:
                    out.append((*pool[k], first + made, at))
                    at += pool[k][2]
                made += 1
            pool.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 7
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            id_type = batch.column(0).type
            _, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets, _TEXT_BYTES):
                ids, at = encode(batch.column(1).slice(lo, hi - lo))
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                ids = np.insert(ids, at[1:], np.uint32(end_id)).astype("<u4").tobytes()
                at = (at + np.arange(len(at))).tolist()
                for name, begin, end in zip(names, at[:-1], at[1:], strict=True):
                    total = end - begin
                    whole = total // capacity * capacity
                    for start in range(0, whole, capacity):
                        piece = ids[4 * (begin + start) : 4 * (begin + start + capacity)]
                        out.append((name, start, capacity, piece, total, first + made, 0))
                        made += 1
                    for start in range(whole, total, PIECE_TOKENS):
                        size = min(PIECE_TOKENS, total - start)
                        pool.append((name, start, size, ids[4 * (begin + start) : 4 * (begin + start + size)], total))
                    if len(pool) >= POOL_PIECES:
                        flush()
                yield rows()
        flush()
        if out:
            yield rows()

    schema = (
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    return texts.mapInArrow(packed, schema).withColumnRenamed("id", id_col)
