import heapq
import random
from collections import defaultdict

from tests.llm.helpers import ODD, SCHEMA, empty, odd
from tripmill.llm import sharding
from tripmill.llm.sharding import schedule, shard_documents, spread


def one_by_one(loads, size, count):
    got = [0] * len(loads)
    for _ in range(count):
        load, shard = heapq.heappop(loads)
        got[shard] += 1
        heapq.heappush(loads, (load + size, shard))
    return got


def test_filling_by_level_is_the_same_as_item_by_item():
    random.seed(3)
    for _ in range(200):
        loads = [(random.randint(0, 50), s) for s in range(random.randint(1, 9))]
        heapq.heapify(loads)
        other = list(loads)
        size, count = random.randint(1, 20), random.randint(0, 200)
        assert spread(loads, size, count) == one_by_one(other, size, count)
        assert sorted(loads) == sorted(other)


def test_schedule_is_lpt():
    random.seed(4)
    sizes = [random.randint(1, 40) for _ in range(300)]
    heap = [(0, s) for s in range(5)]
    for size in sorted(sizes, reverse=True):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
    rows = schedule([(s, sizes.count(s)) for s in set(sizes)], 5)
    loads = defaultdict(int)
    for size, first, end, shard in rows:
        loads[shard] += size * (end - first)
    assert sorted(loads.values()) == sorted(load for load, _ in heap)


def test_awkward_rows(spark):
    got = shard_documents(odd(spark), 4).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    text = defaultdict(set)
    slots = defaultdict(list)
    for r in got:
        text[r.group_key].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in text.values())
    assert len(text) == len({t or "" for _, t in ODD})
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.size for r in got if r.doc_id in (4, 5)} == {1}


def test_many_small_groups_are_near_equal(spark):
    rows = [(i, "x" * (i * 37 % 211) + str(i)) for i in range(3000)]
    loads = defaultdict(int)
    for r in shard_documents(spark.createDataFrame(rows, SCHEMA), 16).collect():
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) - min(loads.values()) <= 8


def test_as_many_parts_as_groups_ask_for(spark, monkeypatch):
    """All groups of one size, and some of others, in few and in many parts: each group in one shard, loads near equal, all rows there."""
    monkeypatch.setattr(sharding, "SALTS", 2)
    rows = [(i, f"{i:05d}") for i in range(900)] + [(900 + i, f"{i:09d}") for i in range(100)] + [(5, "00005")]
    for slot_rows in (7, 400, 5_000):
        monkeypatch.setattr(sharding, "SLOT_ROWS", slot_rows)
        got = shard_documents(spark.createDataFrame(rows, SCHEMA), 7).collect()
        assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
        shards, loads, slots = defaultdict(set), defaultdict(int), defaultdict(list)
        for r in got:
            shards[r.group_key].add(r.shard)
            loads[r.shard] += r.size
            slots[r.shard].append(r.slot)
        assert all(len(s) == 1 for s in shards.values())
        assert len(loads) == 7 and max(loads.values()) - min(loads.values()) <= 10
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(spark):
    assert shard_documents(empty(spark), 4).collect() == []
