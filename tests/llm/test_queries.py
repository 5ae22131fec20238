"""The registered queries of the operators, against SQL where there is some, and by their contracts where not."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry_points
from tests.llm.helpers import empty, odd
from tests.llm.test_lm_scoring import brute as lm_brute
from tests.llm.test_suffix_dedup import brute as passages_brute
from tests.test_queries import SF_DIR, TYPES
from tripmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "conversations", "embeddings"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def rows_of(duck, sql):
    return duck.sql(sql).fetchall()


def test_all_are_registered():
    assert [n.split("_")[0] for n in QUERIES if n.startswith("op")].__len__() == 13
    assert {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert QUERIES.keys() | {"pipeline"} <= entry_points.queries().keys()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_against_sql(spark, duck, name):
    got = QUERIES[name].run(spark, SF_DIR)
    want = duck.sql(QUERIES[name].sql)
    assert sorted((c, TYPES[t]) for c, t in got.dtypes) == sorted(
        (c, str(t)) for c, t in zip(want.columns, want.types, strict=True)
    )
    assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall())


def test_op1(spark, duck):
    got = QUERIES["op1_sharding"].run(spark, SF_DIR).collect()
    texts = {i: t or "" for i, t in rows_of(duck, "select doc_id, text from documents")}
    shards, slots = defaultdict(set), defaultdict(list)
    for r in got:
        text = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        shards[text].add(r.shard)
        slots[r.shard].append((r.slot, r.size))
    assert len(got) == len(texts) and all(len(s) == 1 for s in shards.values()) and set(slots) == set(range(16))
    assert all(sorted(k for k, _ in s) == list(range(len(s))) for s in slots.values())
    loads = [sum(n for _, n in s) for s in slots.values()]
    assert max(loads) - min(loads) <= max(r.size for r in got)


def test_op4(spark, duck):
    rows = rows_of(duck, "select doc_id, text from documents")
    want = {i: (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in passages_brute(rows)}
    got = QUERIES["op4_suffix_array_dedup"].run(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_op8(spark, duck):
    want = lm_brute(rows_of(duck, "select doc_id, text from documents"))
    got = sorted(QUERIES["op8_lm_scoring"].run(spark, SF_DIR).collect(), key=lambda r: str(tuple(r)))
    by_id = {r.doc_id: r for r in got}
    assert len(by_id) == len(want)
    for i, n, known, train, base, score in want:
        r = by_id[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert (r.base_score, r.score) == pytest.approx((base, score), rel=1e-6)


def test_the_model_is_better_than_its_base_on_held_out_texts(spark):
    got = [r for r in QUERIES["op8_lm_scoring"].run(spark, SF_DIR).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_op3_op5_op7_have_a_row_for_all(spark, duck):
    n_docs = rows_of(duck, "select count(*) from documents")[0][0]
    n_pages = rows_of(duck, "select count(*) from pages")[0][0]
    assert QUERIES["op3_toxicity"].run(spark, SF_DIR).select("doc_id").distinct().count() == n_docs
    assert QUERIES["op7_url_filters"].run(spark, SF_DIR).count() == n_pages
    pieces = QUERIES["op5_packing"].run(spark, SF_DIR).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(pieces) == n_docs and all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)


def test_frames_of_the_helpers(spark):
    assert odd(spark).count() == 13 and empty(spark).count() == 0
