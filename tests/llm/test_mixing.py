import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import empty, odd, prose
from tripmill.llm.mixing import mix, taken_of_documents

SCHEMA = "doc_id long, text string, source string"


def shared(sizes, weights, budget, repeats):
    """Targets: the excess of sources above their caps goes to the others by weight until none is above."""
    target, open_ = {}, dict(weights)
    while open_:
        left, weight = budget - sum(target.values()), sum(open_.values())
        above = [s for s in open_ if left * open_[s] / weight >= repeats * sizes[s]]
        if not above:
            return target | {s: left * w / weight for s, w in open_.items()}
        for s in above:
            target[s] = float(repeats * sizes[s])
            del open_[s]
    return target


def brute(rows, repeats=3, share=1.0, weight=lambda rank, source: rank % 3 + 1):
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    docs = [
        (s, md5(f"0:{'' if i is None else i}:{md5(t or '')}"), i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows
    ]
    sources = sorted({s for s, *_ in docs}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(n for t, _, _, n in docs if t == s) for s in sources}
    target = shared(sizes, {s: weight(k, s) for k, s in enumerate(sources)}, share * sum(sizes.values()), repeats)
    queue = []
    for rank, s in enumerate(sources):
        mine = sorted((d for d in docs if d[0] == s), key=lambda d: d[1])
        end = 0
        last = math.floor(target[s] + 0.5)
        for copy in range(repeats):
            for place, (_, _, i, n) in enumerate(mine):
                begin, end = end, end + n
                ends = [last, end] if begin < last < end else [end]
                for e in ends:
                    queue.append(((e / target[s] if target[s] else math.inf * (n > 0) if n else 0), rank, copy, place, e, e - begin, s, i, n))
                    begin = e
    budget = round(sum(target.values()))
    taken = defaultdict(int)
    for _, _, _, place, _, words, s, i, n in sorted(queue, key=lambda q: q[:5]):
        taken[s, place, i, n] += min(words, budget)
        budget -= min(words, budget)
    return sorted((str(i), n, sizes[s], round(target[s], 6), t) for (s, _, i, n), t in taken.items()), target


def outcome(df, **how):
    got = taken_of_documents(mix(df, **how)).collect()
    return sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in got)


def some_rows():
    sizes = {"a": 40, "b": 3, "Z": 12, "é": 25, None: 9, "hot": 150, "\U0001f600": 2, "￮": 4}
    rows, k = [], 0
    for source, n in sizes.items():
        for j in range(n):
            rows.append((k, prose(k, 1 + (k * 7 + j) % 40), source))
            k += 1
    return [*rows, (k, prose(5, 900), "b"), (k + 1, None, "a"), (k + 2, " \x0b\n", "empty"), (k + 3, "a b", "a")]


@pytest.mark.parametrize("how", [{}, {"repeats": 2, "share": 0.4}, {"share": 2.5}, {"share": 4.0}], ids=str)
def test_against_brute_force(spark, how):
    df = spark.createDataFrame(some_rows(), SCHEMA).repartition(7)
    want, target = brute(some_rows(), **how)
    assert outcome(df, **how) == want
    of = {i: (s, t) for i, t, s in some_rows()}
    taken = defaultdict(int)
    for i, size, _, _, n in want:
        assert n <= how.get("repeats", 3) * size
        taken[of[int(i)][0]] += n
    assert all(abs(taken[s] - t) <= len(target) for s, t in target.items())
    assert sum(taken.values()) == round(sum(target.values()))


def test_weights_of_ones_own(spark):
    df = spark.createDataFrame(some_rows(), SCHEMA)
    weight = F.when(F.col("source") == "hot", 5.5).when(F.col("source") == "a", 0.0).otherwise(1.0)
    want, target = brute(some_rows(), weight=lambda rank, s: {"hot": 5.5, "a": 0.0}.get(s, 1.0))
    assert outcome(df, weight=weight) == want and target["a"] == 0


def test_the_mix_is_in_order_without_gaps_and_the_same_again(spark):
    df = spark.createDataFrame(some_rows(), SCHEMA)
    rows = sorted(mix(df).collect(), key=lambda r: (r.start, r.finish))
    assert [r.finish for r in rows] == sorted(r.finish for r in rows)
    at = 0
    for r in rows:
        if r.taken:
            assert r.start == at
            at += r.taken
    other = mix(df.repartition(11)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, other))


def test_awkward_rows(spark):
    rows = [(r.doc_id, r.text, "x" if k % 3 else None) for k, r in enumerate(odd(spark).collect())]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "size", "at", "part", "rank", "target", "place", "copy", "words", "finish", "taken", "end"):
        df = df.withColumn(name, F.lit("clash"))
    assert outcome(df) == brute(rows)[0]


def test_nothing_to_mix(spark):
    none = empty(spark).withColumn("source", F.lit("a"))
    assert taken_of_documents(mix(none)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, " ", None)], SCHEMA)
    assert outcome(blank) == [("1", 0, 0, 0.0, 0), ("2", 0, 0, 0.0, 0), ("None", 0, 0, 0.0, 0)]
