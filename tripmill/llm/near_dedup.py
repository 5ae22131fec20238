"""N-gram Jaccard self-join: MinHash bands propose, full n-gram sets decide."""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import (
    _MULTIPLIER,
    gram_hashes,
    key_bitmaps,
    lower_ascii,
    materialised,
    mixed,
    slices,
    span_hashes,
    text_bytes,
    text_of,
    with_bit,
    words,
)
from tripmill.llm.components import components

#: Texts compared with each other in one task, and the bytes of text they have.
TILE_ROWS = 512
TILE_BYTES = 16 << 20

_COLUMNS = 4096


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """How many bands of ``rows`` values find a pair of that similarity with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)) if similarity < 1 else 1


def _grams(data: np.ndarray, offsets: np.ndarray, n: int):
    """Hashes of n-grams and their rows, in order of rows; word hashes and where each row's begin.

    A text of fewer than ``n`` words, but not none, has one gram: all of them.
    """
    low = lower_ascii(data)
    start, end, row = words(low, offsets)
    word = span_hashes(low, start, end)
    gram, first = gram_hashes(word, row, n)
    at = np.searchsorted(row, np.arange(len(offsets)))
    gram_row = row[first]
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < n))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = at[short] + k < at[short + 1]
            more[has] = more[has] * np.uint64(_MULTIPLIER) + word[at[short[has]] + k]
        gram = np.concatenate([gram, mixed(more ^ np.diff(at)[short].astype(np.uint64))])
        gram_row = np.concatenate([gram_row, short])
        order = np.argsort(gram_row, kind="stable")
        gram, gram_row = gram[order], gram_row[order]
    return gram, gram_row, word, at


def _signer(n: int, bands: int, rows: int):
    """A function over Arrow batches (id, text, hash): the digest of each text's words and its band hashes."""
    random = np.random.default_rng(20_240_229)
    factor = random.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32) | np.uint32(1)
    shift = random.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32)
    salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                part = offsets[lo : hi + 1] - offsets[lo]
                gram, row, word, at = _grams(data[offsets[lo] : offsets[hi]], part, n)
                digest = [
                    hashlib.md5(word[a:b].tobytes()).digest() if b > a else None
                    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
                ]
                full, first = np.unique(row, return_index=True)
                value = (gram >> np.uint64(32)).astype(np.uint32)
                out = np.zeros((hi - lo, bands), np.uint64)
                if len(full):
                    for band in range(bands):
                        key = np.full(len(full), salt[band])
                        for k in range(band * rows, band * rows + rows):
                            least = np.minimum.reduceat(value * factor[k] ^ shift[k], first)
                            key = key * np.uint64(_MULTIPLIER) + least
                        out[full, band] = mixed(key)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(out.reshape(-1).view(np.int64)), bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        pa.array(digest, pa.binary()),
                        lists.cast(pa.list_(pa.int64())),
                    ],
                    ["id", "hash", "node", "bands"],
                )

    return signed


def _verifier(n: int, similarity: float):
    """A function over the texts of a tile: for each its links there, and the smallest node it is linked to."""

    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, i_block, j_block = (k.as_py() for k in key)
        table = table.combine_chunks()
        node, copies = table["node"].to_pylist(), table["copies"].to_numpy()
        block = table["block"].to_numpy()
        sets, seen, kept = [], set(), []
        data, offsets = text_bytes(table["text"])
        for i in range(len(node)):
            one = data[offsets[i] : offsets[i + 1]]
            gram, _, word, _ = _grams(one, np.array([0, len(one)]), n)
            # A text that shares its id and hash with another is told by its digest.
            if hashlib.md5(word.tobytes()).digest() == node[i] and node[i] not in seen:
                seen.add(node[i])
                kept.append(i)
                sets.append(np.unique(gram))
        size = np.array([len(s) for s in sets], np.int64)
        m = len(sets)
        shared = np.zeros((m, m), np.float32)
        if m > 1:
            _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            common = count > 1
            number = np.cumsum(common) - 1
            owner = np.repeat(np.arange(m), size)
            use = common[column]
            owner, column = owner[use], number[column[use]]
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            total = int(common.sum())
            for first in range(0, total, _COLUMNS):
                lo, hi = np.searchsorted(column, [first, first + _COLUMNS])
                present = np.zeros((m, min(_COLUMNS, total - first)), np.float32)
                present[owner[lo:hi], column[lo:hi] - first] = 1
                shared += present @ present.T
        union = size[:, None] + size[None, :] - shared
        near = shared >= similarity * union
        np.fill_diagonal(near, False)
        # The key tells a tile of two blocks, not the rows: one of the blocks may have none.
        if i_block != j_block:
            mine = block[kept]
            near &= mine[:, None] != mine[None, :]
        linked = near.astype(np.int64) @ copies[kept] if m else np.zeros(0, np.int64)
        # The smallest node of each one's component here.
        rank = np.argsort(np.argsort(np.array([node[i] for i in kept], object))) if m else np.zeros(0, np.int64)
        label = rank.copy()
        while m:
            least = np.where(near, label[None, :], m).min(axis=1)
            new = np.minimum(label, least)
            new = np.minimum(new, new[np.argsort(rank)[new]])
            if (new == label).all():
                break
            label = new
        by_rank = sorted(node[i] for i in kept)
        return pa.table(
            {
                "node": pa.array([node[i] for i in kept], pa.binary()),
                "links": pa.array(linked, pa.int64()),
                "peer": pa.array([by_rank[k] for k in label], pa.binary()),
            }
        )

    return links


def near_duplicates(
    df: DataFrame,
    *,
    n: int = 5,
    similarity: float = 0.8,
    recall: float = 0.9999,
    band_rows: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``id_col, class_id, n_links, kept``.

    Two texts are linked if the Jaccard similarity of their sets of ``n`` words in a row (A-Z lower-cased, parted at
    blanks) is at least ``similarity``. ``class_id`` is the smallest id that links lead to, ``n_links`` the number of
    other rows linked directly, copies among them, and ``kept`` says that the row's id is the class's.

    1. Texts of the same words are copies: one of them stands for all, with their number. No pair of copies is made.
    2. As many bands of ``band_rows`` MinHash values as find a pair of just that similarity with probability ``recall``.
       The shuffle is on band hashes, one row for each text and band; the texts of a bucket are tied to its smallest.
    3. Texts tied together are compared on their full sets, all with all, in tiles of bounded size, so no link is
       lost where buckets overlap. A tile gives one row a text: its links, and the smallest text it reaches. No pairs leave it.
       Work on texts that are tied together, but differ, grows with the square of their number, as the count of links asks for all.

    A text of fewer than ``n`` words has one gram, all its words. A text without words (or null) is linked to none, and a class of its own.
    A null id is larger than any other. Rows that share an id and a text are copies. Other columns are not looked at.
    """
    bands = bands_for(similarity, recall, band_rows)
    texts = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).withColumn("hash", F.xxhash64("text"))
    kind = texts.schema["id"].dataType.simpleString()
    signed = materialised(
        texts.mapInArrow(_signer(n, bands, band_rows), f"id {kind}, hash bigint, node binary, bands array<bigint>"), "signatures"
    )
    # The copy that stands for all, by its id, the smallest, and its text's hash: an id, or the null, may have many other texts.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash"))
    classes = materialised(
        signed.where("node is not null")
        .groupBy("node")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"))
        .select("node", F.col("first.id").alias("rep"), F.col("first.hash").alias("rep_hash"), "copies", "bands"),
        "classes",
    )
    banded = classes.select("node", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band").agg(F.min("node").alias("peer"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    # Bitmaps of fixed size keep most rows that meet nothing out of the second shuffle on bands, and out of that of texts.
    shared = with_bit(banded, key_bitmaps(buckets, ["band"]), ["band"], "shared").where("shared").drop("shared")
    ties = shared.join(buckets, "band").where("node <> peer").select(F.col("node").alias("a"), F.col("peer").alias("b"))
    tied = components(ties).join(classes.drop("bands"), "node")
    tied = materialised(tied, "tied")
    wanted = with_bit(texts, key_bitmaps(tied, ["rep", "rep_hash"]), ["id", "hash"], "wanted").where("wanted").drop("wanted")
    wanted = wanted.groupBy("id", "hash").agg(F.any_value("text").alias("text"))
    own = F.col("id").eqNullSafe(F.col("rep")) & (F.col("hash") == F.col("rep_hash"))
    found = wanted.join(tied, own).drop("hash", "rep_hash").withColumn("bytes", F.octet_length("text"))
    group = tied.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    # Bytes are at most those of the longest text times the members: blocks are made small enough for both.
    found = materialised(found.drop("id"), "candidates")
    weight = found.groupBy("root").agg(F.sum("bytes").alias("weight"))
    group = group.join(weight, "root").select(
        F.col("root").alias("r"),
        F.when((F.col("members") <= TILE_ROWS) & (F.col("weight") <= TILE_BYTES), F.lit(1))
        .otherwise(
            F.greatest(F.ceil(F.col("members") * 2 / TILE_ROWS), F.ceil(F.col("weight") * 2 / TILE_BYTES))
        )
        .cast("int")
        .alias("blocks"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = (
        found.join(group, F.col("root") == F.col("r"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("root", "node", "copies", "text", "block", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
    )
    checked = materialised(
        tiles.groupBy("root", "i", "j").applyInArrow(
            _verifier(n, similarity), "node binary, links bigint, peer binary"
        ),
        "links",
    )
    linked = checked.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(checked.where("node <> peer").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    named = grouped.join(classes.select("node", "rep"), "node")
    smallest = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = named.join(smallest, "root").select(F.col("node").alias("_n"), "class_id")
    per_class = (
        classes.drop("bands")
        .join(linked.withColumnRenamed("node", "_l"), F.col("node") == F.col("_l"), "left")
        .join(named, F.col("node") == F.col("_n"), "left")
        .select(
            F.col("node").alias("_c"),
            F.when(F.col("_n").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    result = signed.select("id", "node").join(per_class, F.col("node") == F.col("_c"), "left")
    class_id = F.when(F.col("_c").isNull(), F.col("id")).otherwise(F.col("class_id"))
    return result.select(
        F.col("id").alias(id_col),
        class_id.alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("id").eqNullSafe(class_id).alias("kept"),
    )
