"""Helpers the operators share: texts, scratch tables, and bytes of Arrow columns as numpy arrays."""

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import scratch_path

# How many bytes of text a task turns into arrays at a time. One longer text is taken alone.
SLICE_BYTES = 1 << 20

# A worker stays for many tasks and shares its host with the JVM, so what a large batch took is given back: not to
# Arrow's own pools, and in glibc not to the heap, where large blocks go once some of their size were freed.
pa.set_memory_pool(pa.system_memory_pool())
_mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
if _mallopt is not None:
    _M_MMAP_THRESHOLD = -3
    _mallopt(_M_MMAP_THRESHOLD, 1 << 20)

_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_kept: dict = {}


def give_back() -> None:
    """Let the host have the memory that was freed: the worker stays, and shares the host with the JVM."""
    if _malloc_trim is not None:
        _malloc_trim(0)


def kept(key, build):
    """What a worker keeps from task to task, one thing at a time: what the operator before kept goes when the next one begins."""
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = build()
    return _kept[key]


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_bucket(id_name: str, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_name).cast("string"), F.lit(""))) % buckets


def materialised(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A filter of keys has this many bitmaps of 32,768 bits, 4 KB each: 2 MB to broadcast, however many keys there are.
BITMAPS = 512
_BITS = 32768


def _bit(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITMAPS * _BITS))


def key_bitmaps(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps with a bit set for each of the keys, of fixed size: ``bitmap, bits``."""
    return (
        df.select(_bit(keys).alias("bit"))
        .select((F.col("bit") / _BITS).cast("int").alias("bitmap"), (F.col("bit") % _BITS).alias("at"))
        .groupBy("bitmap")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )


def with_bit(df: DataFrame, bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add whether the row's key has its bit set. True for all keys the bitmaps were made of, and, as they fill up, for others."""
    # Position p is bit p % 8 of byte p / 8.
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("_bit") % _BITS / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.coalesce(F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    return (
        df.withColumn("_bit", _bit(keys))
        .withColumn("bitmap", (F.col("_bit") / _BITS).cast("int"))
        .join(F.broadcast(bitmaps), "bitmap", "left")
        .withColumn(name, is_set)
        .drop("bitmap", "bits", "_bit")
    )


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and the offsets of its rows. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes together, or one row each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def byte_class(*, besides: str) -> np.ndarray:
    """A table over all bytes: true but for the ASCII characters named. Bytes of other characters are true."""
    table = np.ones(256, bool)
    table[list(besides.encode("ascii"))] = False
    return table


#: What parts words, a space or one of \t \n \v \f \r.
BLANKS = " \t\n\v\f\r"
NOT_BLANK = byte_class(besides=BLANKS)


def words(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NOT_BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of member bytes, and the row it is in. No run crosses rows."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = member[data]
    first_of_row = np.zeros(n + 1, bool)
    first_of_row[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first_of_row[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first_of_row[1:n]
    start = np.flatnonzero(starts)
    row = np.searchsorted(offsets, start, "right") - 1
    return start, np.flatnonzero(ends) + 1, row


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base² ... modulo 2⁶⁴, at least ``n`` of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), np.uint64(base))
        have[0] = 1
        np.cumprod(have, out=have)
        if n > SLICE_BYTES + 1:
            return have  # not kept: one very long text must not hold memory for good
        _powers[base] = have
    return have


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes, equal hash."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n + 1, _MULTIPLIER)[:n], out=sums[1:])
    value = (sums[end] - sums[start]) * powers(n + 1, _INVERSE)[start]
    return mixed(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(word: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``n`` words in a row of one text, and the index of their first word."""
    count = len(word) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:count] == row[n - 1 :])
    value = np.zeros(len(first), np.uint64)
    for k in range(n):
        value = value * np.uint64(_MULTIPLIER) + word[first + k]
    return mixed(value), first
