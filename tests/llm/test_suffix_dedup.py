import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ODD, SCHEMA, empty, odd, prose
from tripmill.llm import suffix_dedup
from tripmill.llm.burrows_wheeler import equal_prefix_classes
from tripmill.llm.suffix_dedup import repeated_passages

LAST = (1 << 63) - 1


def brute(rows, length=100, hashes=None):
    """Each row's id, bytes, removed spans and bytes kept, by looking at every string."""
    first, places = {}, []
    for i, text in rows:
        data = (text or "").encode()
        i = (LAST if i is None else i, hashes[text or ""] if hashes else 0)
        for k in range(len(data) - length + 1):
            w = data[k : k + length]
            first[w] = min(first.get(w, (i, k)), (i, k))
        places.append((i, data))
    out = []
    for (given, _), (i, data) in zip(rows, places, strict=True):
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] != (i, k):
                gone[k : k + length] = b"\1" * length
        spans, k = [], 0
        while k < len(data):
            if gone[k]:
                e = k
                while e < len(data) and gone[e]:
                    e += 1
                spans.append((k, e))
                k = e
            else:
                k += 1
        out.append((given, len(data), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


def test_awkward_rows(spark):
    rows = ODD + [(2, "another text under an id, with what another has: " + ODD[0][1])]
    more = spark.createDataFrame(rows[-1:], SCHEMA)
    hashes = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) as h").collect()}
    got = repeated_passages(odd(spark).select("doc_id", "text").union(more))
    assert result(got) == brute(rows, hashes=hashes)
    assert result(repeated_passages(odd(spark))) == brute(ODD, hashes=hashes)


def repeats(seed):
    random.seed(seed)
    pool = [prose(k, 30) for k in range(6)] + ["ab" * 120, "x" * 300, "naïve café " * 20]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(random.randint(0, 5)):
            p = random.choice(pool)
            a = random.randint(0, len(p) // 2)
            parts.append(p[a : a + random.randint(20, len(p))])
            parts.append(prose(random.randint(100, 10_000), random.randint(0, 12)))
        rows.append((i, random.choice(["", " "]).join(parts)))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_repeats(spark, seed):
    rows = repeats(seed)
    assert result(repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_small_pieces_parts_and_hot_anchors(spark, monkeypatch):
    """The ways for very long texts, many parts and anchors of very many contexts give the same."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5_000)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 2)
    rows = repeats(7)
    assert result(repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_parts_reached_in_rounds(spark, monkeypatch):
    """With more parts than a batch is dealt out to, ranges are merged and dealt out again; no batch sends more rows."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3_000)
    monkeypatch.setattr(suffix_dedup, "_SLICE_BYTES", 1_000)
    monkeypatch.setattr(suffix_dedup, "FAN_OUT", 3)
    rows = repeats(11)
    parts = -(-sum(len(t.encode()) for _, t in rows) // 500)
    assert len(suffix_dedup._rounds(parts)) >= 3
    assert result(repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["id", "text"])
    assert all(sent.num_rows <= 3 for sent in suffix_dedup._finder(100, 3)(iter([batch])))


def test_rounds():
    assert suffix_dedup._rounds(1) == [1] and suffix_dedup._rounds(128) == [128]
    assert suffix_dedup._rounds(129) == [128, 129] and suffix_dedup._rounds(100_000) == [128, 16_384, 100_000]


def test_contexts_of_one_anchor_go_to_many_parts():
    """A line that stands between differing texts has a different context in each: no part gets them all."""
    texts = [prose(k, 20) + "\n" + "a line of seventy bytes or so that many different documents do share\n" + prose(5_000 + k, 20) for k in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["id", "text"])
    [sent] = suffix_dedup._finder(100, 16)(iter([batch]))
    per_part = [Counter(np.frombuffer(raw, "<u8").tolist()) for raw in sent["anchor"].to_pylist()]
    [(anchor, n)] = sum(per_part, Counter()).most_common(1)
    assert n >= 100 and max(c[anchor] for c in per_part) < n / 4


def test_a_line_between_differing_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5_000)
    line = "\na line of seventy bytes or so that many different documents do share\n"
    rows = [(k, prose(k // 2, 12) + line + prose(5_000 + k // 3, 12)) for k in range(60)]
    for hot in (10, 4_000):
        monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
        assert result(repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_merged_spans():
    random.seed(1)
    for _ in range(50):
        spans = [(d, a, a + random.randint(1, 9)) for d in (-5, 0, 7) for a in random.sample(range(60), random.randint(0, 12))]
        random.shuffle(spans)
        want = []
        for d, a, e in sorted(spans):
            if want and want[-1][0] == d and a <= want[-1][2]:
                want[-1] = (d, want[-1][1], max(e, want[-1][2]))
            else:
                want.append((d, a, e))
        columns = np.array(spans, np.int64).reshape(-1, 3).T
        assert list(zip(*[x.tolist() for x in suffix_dedup._merged(*columns)], strict=True)) == want


def test_pieces_of_long_texts():
    offsets = np.array([0, 10, 10, 400])
    begin, end, row, base = suffix_dedup._pieces(offsets, 100)
    assert (row == [0, 1, 2]).all() and (base == 0).all() and (end - begin == [10, 0, 390]).all()
    n = suffix_dedup._PIECE + 1000
    begin, end, row, base = suffix_dedup._pieces(np.array([0, n]), 100)
    assert base.tolist() == [0, suffix_dedup._PIECE] and end.tolist() == [suffix_dedup._PIECE + 99, n]


@pytest.mark.parametrize("length", [2, 3, 5])
def test_classes_share_their_prefixes(length):
    random.seed(length)
    for _ in range(30):
        texts = ["".join(random.choice("ab") for _ in range(random.randint(0, 12))) for _ in range(6)]
        joined = "$".join(texts) + "$"
        sequence = np.array([0 if c == "$" else ord(c) for c in joined])
        order, group = equal_prefix_classes(sequence, length)
        assert sorted(order.tolist()) == list(range(len(joined)))
        seen = {}
        for at, g in zip(order.tolist(), group.tolist(), strict=True):
            s = joined[at : at + length]
            whole = len(s) == length and "$" not in s
            seen.setdefault(g, set()).add(s if whole else at)
        assert all(len(v) == 1 for v in seen.values())
        strings = [next(iter(v)) for v in seen.values()]
        assert len(set(strings)) == len(strings)


def test_empty_table(spark):
    assert repeated_passages(empty(spark)).collect() == []
