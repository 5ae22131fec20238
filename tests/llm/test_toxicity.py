import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, empty, odd, prose
from tripmill.llm.toxicity import FEATURES, Lexicon, features, fit_toxicity, held_out, terms

LABELS = "doc_id bigint, toxic int"
BAD = ["blurgh", "snarfo", "vexit"]


def corpus(n=600):
    random.seed(6)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, random.randint(8, 60)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(random.randint(1, 3)):
                word = random.choice(BAD)
                if word == "vexit":
                    word += random.choice(["un", "ol", "as", "em", "ir", "a"]) + str(i)
                words.insert(random.randint(0, len(words)), word)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(session):
    rows, labels = corpus()
    docs = session.createDataFrame(rows, SCHEMA)
    return docs, fit_toxicity(docs, session.createDataFrame(labels, LABELS), usable=~held_out())


def test_held_out_accuracy(spark, fitted):
    docs, model = fitted
    scored = model.score(docs).select("doc_id", held_out().alias("h"), "score", "predicted").collect()
    wrong = [r for r in scored if r.predicted != (r.doc_id % 4 == 0)]
    assert len(scored) == 600 and 90 < sum(r.h for r in scored) < 150
    assert len([r for r in wrong if r.h]) <= 0.05 * sum(r.h for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_scores_order_and_are_near_probabilities(spark, fitted):
    docs, model = fitted
    scored = {r.doc_id: r.score for r in model.score(docs).collect()}
    toxic = [s for i, s in scored.items() if i % 4 == 0]
    clean = [s for i, s in scored.items() if i % 4]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.1
    assert model.calibrated == sorted(model.calibrated)


def test_a_long_text_is_read_to_its_end(spark, fitted):
    _, model = fitted
    long = prose(77, 2000)
    rows = [(1, long), (2, long + " blurgh snarfo blurgh " * 60)]
    got = {r.doc_id: r.score for r in model.score(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2] > got[1]


def test_awkward_rows(spark, fitted):
    _, model = fitted
    got = model.score(odd(spark).drop("score")).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    assert model.score(empty(spark)).collect() == []


def test_learning_from_little(spark):
    docs = odd(spark)
    for labels, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, None), (None, 1)], 0.0)):
        model = fit_toxicity(docs, spark.createDataFrame(labels, LABELS))
        assert {r.score for r in model.score(docs).collect()} == {score}


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, LABELS)
    other = known.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [
        {r.doc_id: r.score for r in fit_toxicity(docs, k, usable=~held_out()).score(docs).collect()} for k in (known, other)
    ]
    assert scores[0] == scores[1]


def test_features():
    lexicon = Lexicon({"idiot": 0.9, "vexi*": 0.8})
    found = dict(zip(FEATURES, features("You IDIOT! 1d1ot vexilla", lexicon), strict=True))
    assert found["word_hits"] == 1 and found["stem_hits"] == 1 and found["disguised_hits"] == 1
    assert found["hits_near_second_person"] == 2 and found["second_person_density"] > 0
    assert found["capital_rate"] > 0 and found["exclamation_rate"] > 0
    assert len(features("", lexicon)) == len(FEATURES)
    assert "idiot" in terms("i.d.i.o.t") and "loser" in terms("loooser") and "stupid" in terms("($tupid)")
    assert terms("") == set()
