"""Language-model scores by deleted interpolation of n-gram estimates, with counts from the whole corpus.

No table of counts is sent anywhere whole. Texts are put into batches, and a batch asks for the counts of its different n-grams: one row goes to
each range of the n-gram space, where the rows of many batches are merged, and one row comes back. Where there are more parts than a batch has
ranges, merged rows are dealt out again to finer ranges, and the answers come back the same way; so rows grow in proportion to the corpus.
"""

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import (
    _MULTIPLIER,
    crc_bucket,
    lower_ascii,
    materialised,
    mixed,
    slices,
    span_hashes,
    text_of,
    words,
)

#: Bytes of text in a batch, and at most, on average, in what a part of the n-gram space is asked for.
BATCH_BYTES = 4 << 20
PART_BYTES = 8 << 20

#: A batch deals its n-grams out to at most 2^10 ranges at a time.
FAN_OUT_BITS = 10

#: N-grams of several tokens are told apart by their part and this many bits of their hash: with the n-grams of 8 MB of text in
#: a part, one in a million shares its count with another. Single tokens are told apart by 64 bits.
TAIL_BITS = 40

#: Hashes of what is no word: the end of a text, which counts as a token, and what stands before its first word.
_END = np.uint64(0x5DEECE66D1CE4E5B)
_BEGIN = np.uint64(0x2545F4914F6CDD1D)

#: What a part adds to the totals: types and tokens, of all that is trained on and without the deleted part.
_TOTALS = ["types", "types_kept", "tokens", "tokens_kept"]

ORDER = 3
EM_ROUNDS = 15
EM_CLOSE = 1e-4
_LEAST = 1e-6
_BUCKETS = 65


def _batcher():
    """Rows (id, text, kind) into batches: the ids, and the texts compressed. Batches of one kind; 0 held out, 1 trained on, 2 deleted part."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def full(kind: int) -> pa.RecordBatch:
            ids, texts = zip(*waiting.pop(kind), strict=True)
            lengths = pa.array([[len(t) for t in texts]], pa.list_(pa.int64()))
            raw = b"".join(texts)
            packed = zstandard.ZstdCompressor(level=1).compress(raw)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([kind], pa.int32()),
                    pa.array([list(ids)], pa.list_(id_type)),
                    lengths,
                    pa.array([packed], pa.binary()),
                ],
                ["batch", "kind", "ids", "lengths", "texts"],
            )

        held: dict[int, int] = {}
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            # One by one: an Arrow batch may be many times as large as one of these.
            for row_id, text, kind in zip(*batch.columns, strict=True):
                row_id, text, kind = row_id.as_py(), text.as_py().encode(), kind.as_py()
                waiting.setdefault(kind, []).append((row_id, text))
                held[kind] = held.get(kind, 0) + len(text)
                if held[kind] >= BATCH_BYTES:
                    held[kind] = 0
                    yield full(kind)
        for kind in list(waiting):
            yield full(kind)

    return batches_of


def _tokens(texts: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of what stands in the texts: for each its begin, its tokens and its end; which are begins, and the text of each."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    parts, rows = [], []
    for lo, hi in slices(offsets):
        low = lower_ascii(raw[offsets[lo] : offsets[hi]])
        start, end, row = words(low, offsets[lo : hi + 1] - offsets[lo])
        texts_here = np.arange(hi - lo)
        after = np.searchsorted(row, texts_here, "right")
        before = np.searchsorted(row, texts_here, "left")
        # At one place, the end of a text without words comes after its begin.
        at = np.stack([before, after], axis=1).ravel()
        marks = np.tile([_BEGIN, _END], hi - lo)
        parts.append(np.insert(span_hashes(low, start, end), at, marks))
        rows.append(np.insert(row, at, np.repeat(texts_here, 2)) + lo)
    token = np.concatenate([np.zeros(0, np.uint64), *parts])
    row = np.concatenate([np.zeros(0, np.int64), *rows])
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return token, first, row


def _grams(token: np.ndarray, first: np.ndarray, order: int, bits: int) -> list[np.ndarray]:
    """Hashes of the one, two, ... tokens that end at each place; before a text's begin there are begins."""
    grams = [token]
    for _ in range(order - 1):
        before = np.append(grams[-1][:1], grams[-1][:-1])
        before[first] = grams[-1][first]
        grams.append(mixed(before * np.uint64(_MULTIPLIER) + token))
    return [g >> np.uint64(64 - bits) if k else g for k, g in enumerate(grams)]


def _rounds(parts: int) -> list[int]:
    """Into how many ranges each round deals, as powers of two; the last round reaches the parts."""
    bits = max(1, (parts - 1).bit_length())
    return [*range(FAN_OUT_BITS, bits, FAN_OUT_BITS), bits]


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold the largest: their number, then all lowest bytes, all second ones ..."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    eight = np.zeros((planes.shape[1], 8), np.uint8)
    eight[:, : raw[0]] = planes.T
    return eight.reshape(-1).view("<u8")


def _asked_fields(order: int) -> list[str]:
    return [f"{name}{k}" for k in range(1, order + 1) for name in ("key", "trained", "deleted")]


def _answer_fields(order: int) -> list[str]:
    return [f"{name}{k}" for k in range(1, order + 1) for name in ("trained", "deleted")]


class _Space:
    """The n-gram space: how many orders, how many bits a hash has, and the ranges of one round."""

    def __init__(self, order: int, bits: int, tail_bits: int):
        self.order, self.bits = order, bits
        self.hash_bits = min(64, bits + tail_bits)

    def edges(self, k: int, bits: int) -> np.ndarray:
        return np.arange(1 << bits, dtype=np.uint64) << np.uint64((64 if k == 0 else self.hash_bits) - bits)

    def deal(self, grams: list[tuple], child: str, kind: int, group: int, bits: int) -> pa.RecordBatch:
        """Rows for the ranges that get any of a child's n-grams, given by order as (sorted hashes, counts, deleted counts)."""
        edges = [self.edges(k, bits) for k in range(self.order)]
        cuts = [np.append(np.searchsorted(g[0], e), len(g[0])) for g, e in zip(grams, edges, strict=True)]
        ranges = np.flatnonzero(np.any([np.diff(c) > 0 for c in cuts], axis=0))
        columns: list[list] = [[] for _ in range(3 * self.order)]
        for r in ranges.tolist():
            for k, ((keys, trained, deleted), cut) in enumerate(zip(grams, cuts, strict=True)):
                lo, hi = cut[r], cut[r + 1]
                columns[3 * k].append(_packed(np.diff(keys[lo:hi], prepend=edges[k][r])))
                columns[3 * k + 1].append(b"" if trained is None else _packed(trained[lo:hi]))
                columns[3 * k + 2].append(b"" if deleted is None else _packed(deleted[lo:hi]))
        n = len(ranges)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"{r:x}/{group:x}" for r in ranges.tolist()], pa.string()),
                pa.array(ranges, pa.int64()),
                pa.array([group] * n, pa.int64()),
                pa.array([child] * n, pa.string()),
                pa.array([kind] * n, pa.int32()),
                *[pa.array(c, pa.binary()) for c in columns],
            ],
            ["node", "range", "group", "child", "kind", *_asked_fields(self.order)],
        )

    def received(self, table: pa.Table, k: int, bits: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """What a node was asked for in one order: different hashes; for each row, where its own are; counts and deleted counts."""
        base = self.edges(k, bits)[table["range"][0].as_py()]
        keys = [np.cumsum(_unpacked(raw), dtype=np.uint64) + base for raw in table[f"key{k + 1}"].to_pylist()]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.split(at, np.cumsum([len(x) for x in keys])[:-1])
        counts = []
        for name in ("trained", "deleted"):
            total = np.zeros(len(different), np.int64)
            for raw, places in zip(table[f"{name}{k + 1}"].to_pylist(), own, strict=True):
                if raw:
                    total[places] += _unpacked(raw).astype(np.int64)
            counts.append(total)
        return different, own, *counts


def _ask(space: _Space, bits: int, groups: int):
    """Batches to rows for the ranges: the different n-grams of each order, and how often each is trained on."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, kind, lengths, texts in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                token, first, _ = _tokens(texts, np.array(lengths, np.int64))
                grams = []
                for g in _grams(token, first, space.order, space.hash_bits):
                    keys, counts = np.unique(g, return_counts=True)
                    grams.append((keys, counts if kind else None, counts if kind == 2 else None))
                yield space.deal(grams, name, kind, zlib.crc32(name.encode()) % groups, bits)

    return asked


def _merge(space: _Space, bits: int, finer: int, last: bool):
    """What several batches asked of one range, merged and asked of the finer ranges of the next round."""

    def merged(table: pa.Table) -> pa.Table:
        grams = []
        for k in range(space.order):
            different, _, trained, deleted = space.received(table, k, bits)
            grams.append((different, trained, deleted))
        group = 0 if last else table["group"][0].as_py() >> FAN_OUT_BITS
        # Whose answer must tell the deleted counts too is of kind 2.
        return pa.Table.from_batches([space.deal(grams, table["node"][0].as_py(), 2, group, finer)])

    return merged


def _answers(table: pa.Table, order: int, own: list, counts: list) -> dict:
    """For each row of a node, the counts of the n-grams it asked for, in its order."""
    kind = table["kind"].to_pylist()
    out = {"child": table["child"], "range": table["range"], "kind": table["kind"]}
    for k in range(order):
        trained, deleted = counts[k]
        out[f"trained{k + 1}"] = pa.array([_packed(trained[at]) for at in own[k]], pa.binary())
        out[f"deleted{k + 1}"] = pa.array(
            [_packed(deleted[at]) if of == 2 else b"" for at, of in zip(own[k], kind, strict=True)], pa.binary()
        )
    return out


def _answer(space: _Space):
    """All rows of a part: counts summed and given back. The first row also has what the part adds to the totals."""

    def answered(table: pa.Table) -> pa.Table:
        own, counts = [], []
        totals = []
        for k in range(space.order):
            different, places, trained, deleted = space.received(table, k, space.bits)
            own.append(places)
            counts.append((trained, deleted))
            if k == 0:
                word = different != _BEGIN
                kept = trained - deleted
                totals = [(trained > 0) & word, (kept > 0) & word, trained * word, kept * word]
        rest = [0] * (table.num_rows - 1)
        added = {c: pa.array([int(x.sum()), *rest], pa.int64()) for c, x in zip(_TOTALS, totals, strict=True)}
        return pa.table(_answers(table, space.order, own, counts) | added)

    return answered


def _told(answers: pa.Table, k: int, name: str) -> np.ndarray:
    """The counts that came back to one who asked, in the order of the hashes."""
    raw = answers[f"{name}{k + 1}"].to_pylist()
    return np.concatenate([np.zeros(0, np.int64), *[_unpacked(x).astype(np.int64) for x in raw]])


def _pass_on(space: _Space, bits: int):
    """What finer ranges answered a node, given back to those who asked the node."""

    def passed(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("range")
        own, counts = [], []
        for k in range(space.order):
            own.append(space.received(table, k, bits)[1])
            counts.append((_told(answers, k, "trained"), _told(answers, k, "deleted")))
        return pa.table(_answers(table, space.order, own, counts))

    return passed


def _counted(space: _Space, batch: pa.Table, answers: pa.Table, names: list[str]) -> tuple:
    """The text of each token of a batch, and by name and order the counts of the n-gram that ends there and of its context."""
    answers = answers.sort_by("range")
    token, first, row = _tokens(batch["texts"][0].as_py(), np.array(batch["lengths"][0].as_py(), np.int64))
    place = np.flatnonzero(~first)
    counts: dict[str, list] = {name: [] for name in names}
    contexts: dict[str, list] = {name: [] for name in names}
    for k, g in enumerate(_grams(token, first, space.order, space.hash_bits)):
        _, at = np.unique(g, return_inverse=True)
        for name in names:
            told = _told(answers, k, name)[at]
            counts[name].append(told[place])
            contexts[name].append(told[place - 1])
    return row[place], counts, contexts


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Contexts of 0, 1, 2-3, 4-7 ... occurrences are buckets 0, 1, 2, 3 ..."""
    return np.frexp(context.astype(np.float64))[1].astype(np.int32)


def _evidence_fields(order: int) -> list[str]:
    return ["count1", *[f"{name}{k}" for k in range(2, order + 1) for name in ("context", "count")]]


def _evidence(space: _Space):
    """Of a batch of the deleted part: how often each combination of counts occurs, the part's own occurrences taken off."""

    def found(key, batch: pa.Table, answers: pa.Table) -> pa.Table:
        _, counts, contexts = _counted(space, batch, answers, ["trained", "deleted"])
        kept = [a - b for a, b in zip(counts["trained"], counts["deleted"], strict=True)]
        before = [a - b for a, b in zip(contexts["trained"], contexts["deleted"], strict=True)]
        columns = [kept[0], *[x for k in range(1, space.order) for x in (before[k - 1], kept[k])]]
        order = np.lexsort(columns)
        columns = [x[order] for x in columns]
        new = np.ones(len(order), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
        n = np.diff(np.append(np.flatnonzero(new), len(order)))
        names = _evidence_fields(space.order)
        return pa.table({**{c: x[new] for c, x in zip(names, columns, strict=True)}, "n": pa.array(n, pa.int64())})

    return found


def interpolation_weights(evidence: DataFrame, tokens: int, types: int, order: int = ORDER) -> dict[tuple[int, int], float]:
    """By order and bucket of the context's count: the weight of that order's estimate against all lower ones, by expectation-maximisation.

    ``evidence`` has rows (count1, context2, count2, context3, count3 ..., n): counts of the n-grams that end in a held-out token and of their
    contexts, and how many stand so. It stays distributed; each round brings two numbers for each order and bucket, of at most 65, to the driver.
    """
    contexts = {k: F.col(f"context{k}") for k in range(2, order + 1)}
    # As many buckets as the bits of a count; single tokens have one context, the empty one.
    bucket = {k: F.when(c > 0, F.length(F.bin(c))).otherwise(F.lit(0)) for k, c in contexts.items()}
    share = {k: F.when(c > 0, F.col(f"count{k}") / c).otherwise(F.lit(0.0)) for k, c in contexts.items()}
    bucket[1], share[1] = F.lit(1), F.col("count1") / F.lit(max(tokens, 1))
    given = evidence.select("n", *[bucket[k].alias(f"b{k}") for k in bucket], *[share[k].alias(f"e{k}") for k in share])
    orders = range(1, order + 1)
    weights: dict[tuple[int, int], float] = {}
    for _ in range(EM_ROUNDS):
        w, p = {}, {0: F.lit(1.0 / (types + 1))}
        for k in orders:
            # Without a context there is no estimate of this order.
            table = [0.0] + [weights.get((k, b), 0.5) for b in range(1, _BUCKETS)]
            w[k] = F.array(*map(F.lit, table))[F.col(f"b{k}")]
            p[k] = w[k] * F.col(f"e{k}") + (1 - w[k]) * p[k - 1]
        with_p = given.select("*", *[(w[k] * F.col(f"e{k}") / p[k]).alias(f"t{k}") for k in orders])
        reached = F.col("n").cast("double")
        sums = []
        for k in reversed(orders):
            sums += [F.sum(reached * F.col(f"t{k}")).alias(f"taken{k}"), F.sum(reached).alias(f"reached{k}")]
            reached = reached * (1 - F.col(f"t{k}"))
        # First by the buckets of all orders together, of which few occur, then by order.
        together = with_p.groupBy(*[f"b{k}" for k in orders]).agg(*sums)
        each = F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("k"), F.col(f"b{k}").alias("b"), F.col(f"taken{k}").alias("taken"), F.col(f"reached{k}").alias("reached"))
                    for k in orders
                ]
            )
        )
        rows = together.select(each.alias("x")).groupBy("x.k", "x.b").agg(F.sum("x.taken").alias("taken"), F.sum("x.reached").alias("reached"))
        new = {
            # A little of each stays, so that no probability is zero.
            (r.k, r.b): min(max(r.taken / r.reached, _LEAST), 1 - _LEAST) if r.b and r.reached else 0.0
            for r in rows.collect()
        }
        moved = max((abs(x - weights.get(at, 0.5)) for at, x in new.items() if at[1]), default=0.0)
        weights = new
        if moved < EM_CLOSE:
            break
    return weights


def weight_table(weights: dict[tuple[int, int], float], order: int = ORDER) -> np.ndarray:
    """Weights for all orders (from 1) and buckets; a bucket that was not seen has that of the nearest below, else of the nearest above."""
    table = np.zeros((order + 1, _BUCKETS))
    for k in range(1, order + 1):
        seen = sorted(b for of, b in weights if of == k and b)
        for b in range(1, _BUCKETS):
            below = [s for s in seen if s <= b]
            table[k, b] = weights[k, below[-1] if below else seen[0]] if seen else 0.5
    return table


def _scorer(space: _Space, weights: np.ndarray, tokens: int, types: int):
    below = tokens + 0.1 * (types + 1)

    def scored(key, batch: pa.Table, answers: pa.Table) -> pa.Table:
        row, counts, contexts = _counted(space, batch, answers, ["trained"])
        token = counts["trained"][0]
        p = np.full(len(row), 1.0 / (types + 1))
        for k in range(1, space.order + 1):
            context = contexts["trained"][k - 2] if k > 1 else np.full(len(row), tokens)
            w = weights[k][bucket_of(context) if k > 1 else np.minimum(context, 1)]
            p = w * counts["trained"][k - 1] / np.maximum(context, 1) + (1 - w) * p
        ids = batch["ids"].combine_chunks().flatten()
        n = len(ids)
        return pa.table(
            {
                "id": ids,
                "n_tokens": pa.array(np.bincount(row, minlength=n), pa.int64()),
                "n_known": pa.array(np.bincount(row[token > 0], minlength=n), pa.int64()),
                "base_score": pa.array(np.bincount(row, np.log10((token + 0.1) / below), n), pa.float64()),
                "score": pa.array(np.bincount(row, np.log10(p), n), pa.float64()),
            }
        )

    return scored


def _counts_of(batches: DataFrame, space: _Space, parts: int) -> tuple[DataFrame, list[int]]:
    """What each batch asked for, answered: rows (child, range, kind, counts by order); and the totals."""
    rounds = _rounds(parts)
    asked_schema = "node string, range bigint, `group` bigint, child string, kind int, " + ", ".join(
        f"{c} binary" for c in _asked_fields(space.order)
    )
    answer_schema = "child string, range bigint, kind int, " + ", ".join(f"{c} binary" for c in _answer_fields(space.order))
    groups = -(-(1 << rounds[-1]) >> rounds[0]) if len(rounds) > 1 else 1
    asked = [batches.select("batch", "kind", "lengths", "texts").mapInArrow(_ask(space, rounds[0], groups), asked_schema)]
    for k, (bits, finer) in enumerate(zip(rounds[:-1], rounds[1:], strict=True)):
        # Read twice: merged on the way there, and asked again for its order on the way back.
        asked[-1] = materialised(asked[-1], f"asked-{k}")
        merge = _merge(space, bits, finer, finer == rounds[-1])
        asked.append(asked[-1].groupBy("node").applyInArrow(merge, asked_schema))
    totals_schema = ", ".join(f"{c} bigint" for c in _TOTALS)
    told = materialised(asked[-1].groupBy("node").applyInArrow(_answer(space), f"{answer_schema}, {totals_schema}"), "answers")
    totals = [x or 0 for x in told.agg(*[F.sum(c) for c in _TOTALS]).head()]
    told = told.drop(*_TOTALS)
    for k in reversed(range(len(rounds) - 1)):
        back = asked[k].groupBy("node").cogroup(told.groupBy("child")).applyInArrow(_pass_on(space, rounds[k]), answer_schema)
        told = materialised(back, f"answers-{k}")
    return told, totals


def lm_scores(
    df: DataFrame,
    *,
    order: int = ORDER,
    trained: Column | None = None,
    deleted: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col, n_tokens, n_known, train_tokens, base_score, score``.

    A-Z count as a-z; tokens are what blanks part, and one end a text. The model is of ``order`` tokens: the maximum-likelihood estimate of a token after the
    ``order - 1`` before it is mixed with that after one fewer, and so on to the token alone and the uniform estimate over all types and an unknown one;
    each weight depends on how often the context occurs, by powers of two. Counts come from all rows for which ``trained`` holds (default: crc32 of the id,
    modulo 10, is not 0). The weights come from the ``deleted`` part of those (default: that remainder is 1): estimates without that part's own counts, weights
    by expectation-maximisation on its tokens. ``score`` is the log10 probability of the text, ``base_score`` that of additively smoothed single tokens,
    ``n_known`` the tokens with a count.

    Equal ranges of the hash space stand for the n-grams; a batch of texts asks each range once, so a very frequent word is one entry
    a batch, and no part grows with it. Parts and batches are of bounded size, and there are as many as the corpus needs.

    A null text is empty: it has one token, the end. Null and repeated ids are documents like any other; each repeated row counts. With nothing to train on every
    token has the uniform probability, 1. Other columns are not looked at.
    """
    if order < 1:
        raise ValueError("the order is at least 1")
    trained = crc_bucket(id_col, 10) != 0 if trained is None else trained
    deleted = crc_bucket(id_col, 10) == 1 if deleted is None else deleted
    kind = F.when(~F.coalesce(trained, F.lit(False)), 0).when(F.coalesce(deleted, F.lit(False)), 2).otherwise(1)
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), kind.cast("int").alias("kind"))
    id_type = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    space = _Space(order, _rounds(parts)[-1], TAIL_BITS)
    batches = materialised(
        rows.mapInArrow(
            _batcher(), f"batch string, kind int, ids array<{id_type}>, lengths array<bigint>, texts binary"
        ),
        "batches",
    )
    answers, (types, types_kept, tokens, tokens_kept) = _counts_of(batches, space, parts)
    evidence = (
        batches.where("kind = 2")
        .groupBy("batch")
        .cogroup(answers.where("kind = 2").groupBy("child"))
        .applyInArrow(_evidence(space), ", ".join(f"{c} bigint" for c in [*_evidence_fields(order), "n"]))
    )
    learned = interpolation_weights(materialised(evidence, "evidence"), tokens_kept, types_kept, order)
    weights = weight_table(learned, order)
    scores = batches.groupBy("batch").cogroup(answers.groupBy("child")).applyInArrow(
        _scorer(space, weights, tokens, types),
        f"id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scores.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
