"""Each stage against brute force on its own input."""

from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.helpers import SCHEMA, odd, prose
from tests.llm.test_decontaminate import brute as contamination_brute
from tests.llm.test_exact_dedup import expected as copies
from tests.llm.test_near_dedup import brute as links

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(session):
    """The input of each stage and, at the end, the result."""
    docs = session.read.parquet(f"{SF_DIR}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(session, frames[-1], SF_DIR).cache())
    return frames


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing",
    ]


def test_columns_and_rows_are_those_of_documents(stages):
    given = {r.doc_id: tuple(r) for r in stages[0].collect()}
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
        assert all(given[r.doc_id] == tuple(r) for r in df.collect())
        assert df.select("doc_id").distinct().count() == df.count()


def test_toxicity(session, stages):
    labels = {r.doc_id: r.toxic for r in session.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert kept <= {r.doc_id for r in stages[0].collect()}


def test_toxic_documents_go(session):
    """On more documents: with eleven toxic labels, as above, no word can be told from chance."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (session.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(session, docs, folder).select("doc_id").collect()}
    toxic = {bool(t): {r.doc_id for r in labels.where(labels.toxic == t).collect()} for t in (0, 1)}
    assert len(toxic[True] - kept) >= 0.55 * len(toxic[True])
    assert len(toxic[False] - kept) <= 0.01 * len(toxic[False])


def test_exact_dedup(stages):
    assert sorted(i for i, _ in pairs(stages[2])) == sorted(i for i, _, _, kept, _ in copies(pairs(stages[1])) if kept)


def test_near_copies(stages):
    assert sorted(i for i, _ in pairs(stages[3])) == sorted(i for i, c, _ in links(pairs(stages[2])) if i == c)


def test_decontamination(session, stages):
    items = [(r.item_id, r.text) for r in session.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    judged = contamination_brute(pairs(stages[3]), items)
    assert sorted(i for i, _ in pairs(stages[4])) == sorted(i for i, _, hit, _, _ in judged if not hit)
    assert any(hit for _, _, hit, _, _ in judged)


def test_packing(stages):
    length = defaultdict(int)
    for r in stages[5].collect():
        length[r.doc_id] += r["length"]
    assert set(length) == {i for i, _ in pairs(stages[4])}


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows(spark, k):
    docs = odd(spark)
    got = corpus_pipeline.STAGES[k][1](spark, docs, SF_DIR)
    assert got.count() > 0
    if k < 4:
        assert got.columns == docs.columns
    nothing = corpus_pipeline.STAGES[k][1](spark, docs.limit(0), SF_DIR)
    assert nothing.collect() == []


def test_exact_copies_go_even_where_ids_are_shared(spark):
    rows = [(1, prose(1, 50)), (2, prose(1, 50)), (3, prose(3, 50))]
    got = corpus_pipeline.drop_copies(spark, spark.createDataFrame(rows, SCHEMA), SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies])
def test_no_copy_stays_where_ids_are_missing_or_shared(spark, stage):
    t, u, v = (prose(k, 50) for k in (1, 2, 3))
    rows = [(1, t), (None, t), (None, u), (None, u), (None, v), (7, t), (7, v), (8, u), (9, prose(4, 50)), (9, prose(4, 50)), (9, t)]
    got = stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), SF_DIR)
    assert sorted(map(str, pairs(got))) == sorted(map(str, [(1, t), (8, u), (7, v), (9, prose(4, 50))]))
