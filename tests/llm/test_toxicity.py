"""The chain's exactness, accuracy on held-out labels, and odd rows."""

import itertools
import random

import numpy as np
import pytest

from storyloom.llm import toxicity
from storyloom.llm.toxicity import Crf, fit, held_out, keep_clean, marginals, score


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(2)
    lengths = [1, 5, 2, 7, 3, 1, 4]
    e = rng.normal(0, 3, sum(lengths))
    m = Crf(np.zeros(4), trans=rng.normal(0, 1, (2, 2)), start=rng.normal(0, 1, 2))
    fresh = np.zeros(len(e), bool)
    fresh[np.cumsum([0, *lengths[:-1]])] = True
    got = marginals(m, e, fresh)[0]
    at = 0
    for n in lengths:
        own, total, hot = e[at:at + n], 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(m.start[y[0]] + sum(own[i] for i in range(n) if y[i])
                       + sum(m.trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            hot += w * np.array(y)
        assert got[at:at + n] == pytest.approx(hot / total, abs=1e-9)
        at += n


def test_long_texts_do_not_overflow():
    n = 50_000
    e = np.where(np.arange(n) % 1000 == 0, 40.0, -25.0)
    p = marginals(Crf(np.zeros(4)), e, np.arange(n) == 0)[0]
    assert np.isfinite(p).all() and (p[::1000] > 0.99).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = score(docs, fit(docs, labels)).join(labels, "doc_id").where(held_out("doc_id")).collect()
    y = np.array([r["toxic"] for r in got])
    hit = np.array([r["score"] >= 0.5 for r in got])
    assert 0 < y.sum() and hit[y == 1].mean() >= 0.9 and hit[y == 0].mean() <= 0.02


def labelled(spark):
    r = random.Random(1)
    vocab = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(vocab) for _ in range(r.randint(5, 40))]
        if i % 4 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vileterm,", "Nastyword", "vileterm"]))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None, "x"), (901, "", "x"), (902, " \n", "x"), (903, "é nastyword! ok", "x"), (903, "é nastyword! ok", "x"),
             (None, "vileterm vileterm", "x"), (904, "word1 " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels + [(0, 0), (5, None), (None, 1)], "doc_id long, toxic int")


def test_spans_scores_and_odd_rows(spark):
    docs, labels = labelled(spark)
    m = fit(docs, labels)
    got = {}
    for r in score(docs.repartition(3), m).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all((got[i][0]["score"] >= 0.5) == (i % 4 == 0) for i in range(400))
    assert [len(got[i]) for i in (900, 903, None)] == [1, 2, 1]
    assert all(got[i][0]["score"] < 0.5 and got[i][0]["spans"] == [] for i in (900, 901, 902, 904))
    (span,) = got[903][0]["spans"]
    assert (span["start"], span["end"]) == (2, 12) and span["p"] >= 0.5
    kept = keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(400) if i % 4} | {900, 901, 902, 904}


def test_without_labels_or_rows(spark):
    docs, labels = labelled(spark)
    assert fit(docs, labels.where("toxic = 0")) is None
    assert {r["score"] for r in score(docs, None).collect()} == {0.0}
    assert keep_clean(docs, labels.limit(0)).count() == docs.count()
    assert score(docs.limit(0), fit(docs, labels)).collect() == []


def test_held_out_labels_and_side_columns_are_not_used(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("toxic", toxicity.F.when(held_out("doc_id"), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    a, b = fit(docs, labels), fit(docs.drop("score"), flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.doc, b.doc)


def test_stretches_of_tokens_give_the_same_fit(spark, monkeypatch):
    docs, labels = labelled(spark)
    whole = fit(docs, labels)
    monkeypatch.setattr(toxicity, "FIT_TOKENS", 100)
    cut = fit(docs, labels)
    a, b = ({r["doc_id"]: r["score"] for r in score(docs, m).collect()} for m in (whole, cut))
    assert all((a[i] >= 0.5) == (b[i] >= 0.5) for i in a)


def test_long_labelled_texts_are_fitted_and_scored(spark):
    r = random.Random(3)
    vocab = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = [r.choice(vocab) for _ in range(4000)]
        if i % 3 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), "vileterm")
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    got = {x["doc_id"]: x["score"] >= 0.5 for x in score(docs, fit(docs, labels)).collect()}
    assert got == {i: i % 3 == 0 for i in range(60)}


def test_one_labelled_id_with_many_texts_is_bounded(spark, monkeypatch):
    docs = spark.range(5000).selectExpr("7L doc_id", "concat('w', id, ' vileterm') text")
    docs = docs.unionByName(spark.range(50).selectExpr("id + 8 doc_id", "concat('w', id, ' fine') text"))
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(8, 58)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "_train", lambda texts, toxic: seen.append(len(texts)))
    if not spark.range(1).select(held_out("id")).first()[0]:
        fit(docs, labels, sample_docs=20)
    assert all(n <= 80 for n in seen)


def test_without_telling_terms_there_is_still_a_model(spark):
    docs = spark.createDataFrame([(i, "" if i % 2 else f"one{i} two{i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(40)], "doc_id long, toxic int")
    m = fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in score(docs, m).collect()}
    assert m is not None and min(got[i] for i in range(0, 40, 2)) > max(got[i] for i in range(1, 40, 2))
    empty = fit(docs.withColumn("text", toxicity.F.lit(None).cast("string")), labels)
    assert {0 < r["score"] < 1 for r in score(docs, empty).collect()} == {True}
