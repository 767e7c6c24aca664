import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from astrolode.llm import toxicity

SF = "/root/testdata/sf0.1"


def auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]).all()
    test = rows[rows["held_out"]]
    score, label, said = (test[c].to_numpy() for c in ("score", "toxic", "predicted"))
    assert auc(score, label) > 0.97
    assert (label[said == 1] == 1).mean() > 0.95 and (said[label == 1] == 1).mean() > 0.85
    assert ((score >= 0.3) == (said == 1)).all()


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.learn(docs, labels)
    b = toxicity.learn(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), turned)
    assert a == b


def test_a_feature_counts_by_the_logarithm_of_its_words():
    assert [toxicity._times(n) for n in (1, 2, 3, 4, 7, 8)] == [1, 2, 2, 3, 3, 4]
    one, same = toxicity.features("Idiot"), toxicity.features("idiot, (IDIOT) idiot!")
    assert len(one) == len(set(one)) == 4  # the word and its beginnings of 3, 4 and 5 letters
    assert (one == same).all()
    assert len(toxicity.features("ab")) == 2 and not len(toxicity.features(" .,; "))
    stem = toxicity._slots("idi")
    many = toxicity.features("idiot idiom idiolect")
    assert max(np.bincount(many)) == 2 and set(stem) & set(many[np.bincount(many)[many] == 2])


def test_scores_are_the_sums_of_the_features(odd_rows):
    rng = np.random.default_rng(3)
    texts = [t or "" for _, t in odd_rows] + ["Idiot idiot. idiom!"]
    slots = np.unique(np.concatenate([toxicity.features(t) for t in texts]))[::2]
    weights = dict(zip(slots.tolist(), rng.normal(size=len(slots)).tolist(), strict=True))
    model = toxicity.Model(weights, -1.0)
    want = [-1 + sum(weights.get(s, 0.0) for s in toxicity.features(t).tolist()) for t in texts]
    got = model.scores(texts, {})
    assert np.allclose(got, 0.5 + 0.5 * np.tanh(0.5 * np.array(want)))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame(
        [(r[0], int("idiot" in (r[1] or ""))) for r in odd_rows if r[0] is not None][:60]
        + [(None, 1), (4, None), (4, 0), (4, 0), (999_999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (-5, -2, 1, 4)}
    assert len(empty) == 1
    kept = toxicity.clean_documents(odd_docs, model)
    assert kept.schema == odd_docs.schema
    assert kept.count() == sum(r["predicted"] == 0 for r in rows)
    assert toxicity.score(no_docs, model).collect() == []
    untaught = toxicity.learn(no_docs, labels.limit(0))
    assert not untaught.weights and toxicity.score(odd_docs, untaught).count() == len(odd_rows)


def test_risk_of_clean_text_stays_non_negative():
    rng = np.random.default_rng(0)
    toxic = [np.array([1, int(rng.integers(10, 500))], np.int32) for _ in range(40)]
    clean = [np.array(sorted({2, int(rng.integers(10, 500))}), np.int32) for _ in range(360)]
    weights, bias = toxicity.train(toxic, clean + toxic, 0.1, toxicity.Fit(epochs=40))
    odds = [np.exp(bias + weights[[slot]].sum()) for slot in (1, 2)]
    assert odds[0] > 0.3 / 0.7 and odds[1] < 0.1


@pytest.mark.parametrize("toxic,unlabelled", [([], []), ([], [[1]]), ([[1]], [])])
def test_nothing_to_learn_from(toxic, unlabelled):
    rows = [[np.array(r, np.int32) for r in part] for part in (toxic, unlabelled)]
    weights, bias = toxicity.train(*rows, 0.1)
    assert not weights.any() and bias < 0


def test_repeated_rows_count_once(spark, docs_of, monkeypatch):
    rows = [(i, "you idiot trash" if i % 4 == 0 else f"the river and stone {i}") for i in range(80)]
    hot = [next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2 and i % 4 == k) for k in (0, 1)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    taught = []
    real = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda a, b, *rest: taught.append((len(a), len(b))) or real(a, b, *rest))
    once = toxicity.learn(docs_of(rows), labels)
    again = toxicity.learn(docs_of(rows + [r for r in rows if r[0] in hot] * 300).repartition(5), labels)
    assert taught[0] == taught[1] and once == again and once.weights
    toxicity.learn(docs_of(rows + [(hot[0], f"text {k}") for k in range(300)]).repartition(5), labels)
    assert taught[2] == taught[0]
