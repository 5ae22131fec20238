import math
import re
import types
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, SCHEMA, empty, odd, prose
from tripmill.llm import lm_scoring
from tripmill.llm.lm_scoring import bucket_of, interpolation_weights, lm_scores, weight_table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\0end"]


def fold_of(i, n=10):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def brute(rows, order):
    """Counts, weights and scores with dictionaries, by the definitions."""
    texts = [(i, tokens(t)) for i, t in rows]

    def places(ws):
        """Each token with the ones before it."""
        padded = ["\0begin"] * (order - 1) + ws
        return [tuple(padded[k : k + order]) for k in range(len(ws))]

    def counts(kept):
        grams, contexts = Counter(), Counter()
        for i, ws in texts:
            if kept(fold_of(i)):
                for place in places(ws):
                    for k in range(order):
                        grams[place[k:]] += 1
                        contexts[place[k:-1], k] += 1
        return grams, contexts

    def estimates(grams, contexts, place):
        """By order, the lowest first: how often the context occurs, and the token's share there."""
        out = []
        for k in reversed(range(order)):
            c = contexts[place[k:-1], k]
            out.append((c, grams[place[k:]] / c if c else 0.0))
        return out

    def chain(weights, table, v):
        p = [1 / (v + 1)]
        for w, (_, share) in zip(weights, table, strict=True):
            p.append(w * share + (1 - w) * p[-1])
        return p

    def bucket(k, c):
        return c.bit_length() if k else min(c, 1)

    def kinds(grams):
        return sum(len(g) == 1 for g in grams)

    kept = counts(lambda f: f > 1)
    v = kinds(kept[0])
    rows_em = [estimates(*kept, place) for i, ws in texts if fold_of(i) == 1 for place in places(ws)]
    weights = {}
    for _ in range(lm_scoring.EM_ROUNDS):
        taken, reached = Counter(), Counter()
        for table in rows_em:
            ws = [weights.get((k + 1, bucket(k, c) if k else 1), 0.5) if c or not k else 0.0 for k, (c, _) in enumerate(table)]
            p = chain(ws, table, v)
            mass = 1.0
            for k in reversed(range(order)):
                at = (k + 1, bucket(k, table[k][0]) if k else 1)
                here = mass * ws[k] * table[k][1] / p[k + 1]
                taken[at] += here
                reached[at] += mass
                mass -= here
        new = {
            at: min(max(taken[at] / reached[at], 1e-6), 1 - 1e-6) if at[1] and reached[at] else 0.0 for at in reached
        }
        moved = max((abs(x - weights.get(at, 0.5)) for at, x in new.items() if at[1]), default=0.0)
        weights = new
        if moved < lm_scoring.EM_CLOSE:
            break
    table = weight_table(weights, order)
    full = counts(lambda f: f > 0)
    v, n = kinds(full[0]), full[1][(), order - 1]
    out = []
    for i, ws in texts:
        base = sum(math.log10((full[0][w,] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        score = 0.0
        for place in places(ws):
            shares = estimates(*full, place)
            score += math.log10(chain([table[k + 1, bucket(k, c)] for k, (c, _) in enumerate(shares)], shares, v)[-1])
        out.append((i, len(ws), sum((w,) in full[0] for w in ws), n, base, score))
    return sorted(out, key=str)


def compare(df, rows, order=3):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    want = sorted(brute(rows, order), key=str)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:] == pytest.approx(w[4:], rel=1e-6)


def some():
    return [(i, prose(i % 37, 20 + i % 50).replace("alpha", "Alpha")) for i in range(150)] + ODD


@pytest.mark.parametrize("size", [16 << 20, 4_000])
def test_against_dictionaries(spark, monkeypatch, size):
    """Also with many parts."""
    monkeypatch.setattr(lm_scoring, "PART_BYTES", size)
    compare(lm_scores(spark.createDataFrame(some(), SCHEMA).repartition(4)), some())


@pytest.mark.parametrize("order", [1, 2, 4])
def test_orders(spark, order):
    compare(lm_scores(spark.createDataFrame(some(), SCHEMA).repartition(2), order=order), some(), order)
    with pytest.raises(ValueError):
        lm_scores(empty(spark), order=0)


def test_parts_reached_in_several_rounds(spark, monkeypatch):
    """Three rounds of four ranges each, with batches small enough that nodes merge several."""
    size = sum(len((t or "").encode()) for _, t in some())
    monkeypatch.setattr(lm_scoring, "FAN_OUT_BITS", 2)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", size // 40)
    monkeypatch.setattr(lm_scoring, "_batcher", small_batches(2_000))
    assert len(lm_scoring._rounds(40)) == 3
    compare(lm_scores(spark.createDataFrame(some(), SCHEMA).repartition(4)), some())


def small_batches(size):
    """Rows sent to workers do not see a changed constant, so the function that they get has it in its own globals."""
    own = dict(vars(lm_scoring), BATCH_BYTES=size)
    return types.FunctionType(lm_scoring._batcher.__code__, own)


def test_rows_sent_do_not_grow_with_batches_times_parts():
    """Rows of a batch, and rows that meet at a node, stay below a bound however many parts there are."""
    for parts in (1, 2, 100, 1024, 1025, 10**6, 20 * 10**6):
        rounds = lm_scoring._rounds(parts)
        assert 1 << rounds[-1] >= parts and all(b - a <= lm_scoring.FAN_OUT_BITS for a, b in zip([0, *rounds], rounds))
        assert len(rounds) <= 3


def test_packing_of_numbers():
    for values in ([], [0], [1, 255], [256, 3], [0, 2**63 + 5, 7], list(range(70_000))):
        values = np.array(values, np.uint64)
        assert lm_scoring._unpacked(lm_scoring._packed(values)).tolist() == values.tolist()


def test_awkward_rows(spark):
    compare(lm_scores(odd(spark)), ODD)
    assert lm_scores(empty(spark)).collect() == []


def test_nothing_to_train_on(spark):
    got = lm_scores(spark.createDataFrame([(1, "a b")], SCHEMA), trained=F.lit(False)).head()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.score) == (3, 0, 0, 0.0)


def test_weights_of_buckets_not_seen():
    for seen in ({(2, 3): 0.7}, {(1, 1): 0.9, (2, 5): 0.2, (3, 1): 0.4, (3, 9): 0.8}, {}):
        table = weight_table(seen)
        assert (table[1:, 1:] > 0).all() and (table < 1).all() and (table[:, 0] == 0).all()
    assert table.shape == (4, 65)
    assert weight_table({(3, 1): 0.4, (3, 9): 0.8})[3, [1, 8, 9, 64]].tolist() == [0.4, 0.4, 0.8, 0.8]


def test_weights_follow_the_evidence(spark):
    rows = [(1, 4, 4, 90), (1, 4, 0, 10), (5, 0, 0, 50), (0, 0, 0, 50)]
    df = spark.createDataFrame(rows, "count1 bigint, context2 bigint, count2 bigint, n bigint")
    weights = interpolation_weights(df, 100, 50, order=2)
    assert weights[2, 3] > 0.8 and weights[2, 0] == 0 and 0 < weights[1, 1] < 1
    assert bucket_of(np.array([0, 1, 2, 3, 4, 7, 8])).tolist() == [0, 1, 2, 2, 3, 3, 4]


def test_copies_of_trained_texts_are_likelier_by_triples(spark):
    """A held-out text whose copy is trained on stands out from one of the same words in another order."""
    held = [i for i in range(400) if fold_of(i) == 0][:2]
    copied = prose(7, 300)
    shuffled = " ".join(sorted(copied.split(), key=lambda w: zlib.crc32(w.encode())))
    # Texts occur three times each, so the deleted part tells what a triple seen before is worth.
    rows = [(i, prose(i % 133, 100)) for i in range(400) if fold_of(i) != 0]
    rows[0] = (rows[0][0], copied)
    df = spark.createDataFrame([*rows, (held[0], copied), (held[1], shuffled)], SCHEMA)
    got = {r.doc_id: r for r in lm_scores(df).where(F.col("doc_id").isin(held)).collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)
    assert got[held[0]].score > got[held[1]].score + 100
