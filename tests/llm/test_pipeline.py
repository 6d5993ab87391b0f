"""The stages over the small table: what each decides takes effect, and what it must not touch stays."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import quality_gam, sentencepiece_codec
from lamina.llm.common import fold
from tests.llm.test_mixing import reshared
from tests.llm.test_pii import plain_spans
from tests.llm.test_simhash import plain_kept

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first and after every stage."""
    out = str(tmp_path_factory.mktemp("stages"))
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs[-1], FOLDER).write.parquet(f"{out}/{name}")
        docs.append(spark.read.parquet(f"{out}/{name}"))
    return docs


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns


def test_quality_rejects_what_the_model_scores_low(spark, stages):
    before, after = stages[0], stages[1]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_gam.train(before, labels, fold(5, 0))
    rows = before.orderBy("doc_id").collect()
    import numpy as np

    score = model.score(np.array([quality_gam.features(r.text) for r in rows]))
    want = {r.doc_id for r, s in zip(rows, score) if s >= 0.3}
    assert {r.doc_id for r in after.collect()} == want
    truth = labels.join(after.select("doc_id", F.lit(1).alias("kept")), "doc_id", "left").collect()
    assert all(r.kept for r in truth if r.quality == 1)


def test_one_of_each_group_stays(stages):
    """By the similarity of all pairs of five-word shingle sets of the quality stage's texts."""
    rows = sorted(stages[1].collect(), key=lambda r: r.doc_id)
    want = set(plain_kept([(r.doc_id, r.text) for r in rows]))
    assert {r.doc_id for r in stages[2].collect()} == want
    texts = Counter(r.text for r in stages[2].collect())
    assert max(texts.values()) == 1


def test_personal_data_is_gone_and_the_rest_stays(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert not plain_spans(row.text)
        assert row.n_chars == len(row.text)
        if not plain_spans(before[i].text):
            assert row.text == before[i].text


def test_mix_meets_its_targets(stages):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in stages[3].collect():
        sizes[r.source] += len(r.text.split())
        largest[r.source] = max(largest[r.source], len(r.text.split()))
    for r in stages[4].collect():
        taken[r.source] += len(r.text.split())
    for source, target in reshared(dict(sizes)).items():
        assert abs(taken[source] - target) <= 2 * largest[source]
    assert max(Counter(r.doc_id for r in stages[4].collect()).values()) <= 3


def test_encoding_turns_back(spark, stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    back = sentencepiece_codec.decode_documents(stages[5], corpus_pipeline.PIECES).collect()
    assert len(back) == stages[4].count() and all(texts[r.doc_id] == r.decoded for r in back)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r.doc_id, tuple(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, FOLDER)) == key(stages[5])


def test_odd_rows_pass_every_stage(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word " * 9000, None, None, 45000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema).withColumn("fp", F.lit("x"))
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, FOLDER)
            path = f"{tmp_path}/{len(some)}-{i}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
