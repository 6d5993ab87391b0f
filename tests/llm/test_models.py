"""The classifiers: what they learn, held-out accuracy, and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import quality_gam, toxicity_cnn
from lamina.llm.common import fold
from lamina.llm.training import labelled_keys


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.zeros((4000, len(quality_gam.FEATURES)))
    x[:, 0], x[:, 1], x[:, 2] = rng.random((3, 4000))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    assert (1, 0) in model.pairs
    x[:, 0], x[:, 1] = rng.random((2, 4000))
    want = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    assert ((model.score(x) > 0.5) == want).mean() > 0.9
    # A score is the sum of one entry of each table.
    at = model.bins(x)
    total = model.start + sum(t[p] for t, p in zip(model.tables, at)) + sum(t[at[i], at[j]] for (i, j), t in zip(model.pairs, model.pair_tables))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("label", [np.zeros(0), np.ones(5), np.zeros(5)])
def test_constant_scores(label):
    rows = np.zeros((len(label), len(quality_gam.FEATURES)))
    share = (label.sum() + 1) / (len(label) + 2)
    assert np.allclose(quality_gam.fit(rows, label).score(np.zeros((3, len(quality_gam.FEATURES)))), share)
    model = toxicity_cnn.fit([np.zeros(2, np.int64)] * len(label), label)
    assert np.allclose(model.score([np.zeros(0, np.int64)]), share)


@pytest.mark.parametrize("text", ["", " ", "\n\n", "a", "é" * 100, "| | |", "x " * 50_000])
def test_features_are_finite(text):
    found = quality_gam.features(text)
    assert len(found) == len(quality_gam.FEATURES) and np.isfinite(found).all()


def toxic_rows(count, seed):
    rng = random.Random(seed)
    words = [a + b for a in ("ka", "lo", "mi", "ter", "su") for b in ("na", "re", "vo", "shi", "pla", "dor")]
    rows = []
    for i in range(count):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["nasty", "vilegoon" + rng.choice(["en", "ix", "ova", "um"])]))
        rows.append((i, " ".join(text), int(bad), rng.choice(["en", "de", None])))
    return rows


def test_cnn_learns_words_and_word_starts():
    train, test = toxic_rows(1500, 1), toxic_rows(400, 2)
    model = toxicity_cnn.fit([toxicity_cnn.word_buckets(r[1]) for r in train], np.array([r[2] for r in train], float))
    score = model.score([toxicity_cnn.word_buckets(r[1]) for r in test])
    label = np.array([r[2] for r in test])
    assert ((score >= 0.3) == label).mean() > 0.97
    # Unseen words add nothing, however many they are; a bad word counts anywhere in a long text.
    many = " ".join(f"qq{i}zz" for i in range(40_000))
    clean, bad = model.score([toxicity_cnn.word_buckets(many), toxicity_cnn.word_buckets(many + " nasty vilegoonish " + many)])
    assert clean < 0.3 <= bad
    assert model.score([toxicity_cnn.word_buckets("")])[0] < 0.3


def test_calibration():
    score = np.array([0.9, 0.8, 0.7, 0.2, 0.1, 0.6, 0.5, 0.4])
    label = np.array([1, 1, 0, 0, 0, 1, 1, 0.0])
    found = toxicity_cnn.calibrate(np.tile(score, 20), np.tile(label, 20), (["a"] * 5 + ["b"] * 3) * 20)
    assert found["a"] == pytest.approx(0.75) and found["b"] == pytest.approx(0.45)
    assert toxicity_cnn.calibrate(score, np.zeros(8), ["a"] * 8) == {None: 0.5}


def test_labelled_keys_are_bounded(spark):
    rows = [(i, i % 2) for i in range(3000)] + [(7, 1)] * 3000 + [(None, 1), (5001, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = labelled_keys(labels, "quality", F.col("doc_id") % 10 == 0, 500).collect()
    assert 350 < len(got) < 650 and len({r.doc_id for r in got}) == len(got)
    assert all(r.doc_id is not None and r.doc_id % 10 for r in got)
    assert labelled_keys(labels.limit(0), "quality", F.lit(False), 500).count() == 0


def test_scores_on_spark(spark):
    rows = toxic_rows(500, 3)
    docs = spark.createDataFrame([(i, t, lang, 0.5) for i, t, _, lang in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y, y) for i, _, y, _ in rows], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, None, None, 0.0), (7, "", "en", 0.0), (7, "", "en", 0.0), (8, "x " * 9000, "zz", 0.0)], docs.schema)
    everything = docs.union(odd)
    detector = toxicity_cnn.train(everything, labels, fold(4, 2))
    out = toxicity_cnn.score_toxicity(everything, detector)
    assert out.columns == ["doc_id", "score", "predicted", "flagged"] and out.count() == 504
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.collect())
    truth = {i: y for i, _, y, _ in rows}
    held = {r.doc_id for r in docs.where(fold(4, 2)).collect()}
    right = [r.predicted == truth[r.doc_id] for r in out.collect() if r.doc_id in held and r.doc_id not in (7, 8)]
    assert np.mean(right) > 0.9
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("toxic", F.when(fold(4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity_cnn.train(everything, flipped, fold(4, 2))
    assert np.allclose(again.model.out, detector.model.out)
    model = quality_gam.train(everything, labels, fold(5, 0))
    scored = quality_gam.score_quality(everything, model)
    assert scored.columns == ["doc_id", "score", "predicted"] and scored.count() == 504
    empty = quality_gam.train(docs.limit(0), labels, fold(5, 0))
    assert {r.score for r in quality_gam.score_quality(docs, empty).collect()} == {0.5}
    assert quality_gam.score_quality(docs.limit(0), model).count() == 0
    assert toxicity_cnn.score_toxicity(docs.limit(0), detector).count() == 0


def test_cnn_learns_from_all_labelled_rows(spark):
    """Also from texts of more than 4,000 words, in any number of packs; partitions change nothing."""
    rows = [(i, t, "en" if i % 2 else "de", y) for i, t, y, _ in toxic_rows(600, 5)]
    rng = random.Random(9)
    for i in range(1000, 1060):
        many = " ".join(f"f{rng.randrange(3000)}" for _ in range(4500))
        rows.append((i, many + (" grimwort grimwort " if i % 2 else " ") + many, "en", i % 2))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    packs = toxicity_cnn._packs(docs, labelled_keys(labels, "toxic", F.lit(False), None), "text", 200)
    seen, ones, count = toxicity_cnn._counted(packs)
    texts = [toxicity_cnn.word_buckets(r[1]) for r in rows]
    assert packs.count() > 1 and count == len(rows) and ones == sum(r[3] for r in rows)
    assert (seen == toxicity_cnn.bucket_counts(texts, np.array([r[3] for r in rows]))).all()
    detector = toxicity_cnn.train(docs, labels, F.lit(False), rows=200)
    clean, bad = detector.model.score([toxicity_cnn.word_buckets(t) for t in ("kana lore", "kana grimwort grimwort lore")])
    assert bad > clean and set(detector.thresholds) == {None, "de", "en"}
    again = toxicity_cnn.train(docs.repartition(7), labels.repartition(3), F.lit(False), rows=200)
    assert np.array_equal(again.model.tables, detector.model.tables) and again.thresholds == detector.thresholds
