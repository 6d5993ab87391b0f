"""The registered queries' own columns against plain Python, over the small tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lamina.llm import queries
from tests.llm.test_mixing import reshared
from tests.llm.test_simhash import plain_components, plain_print

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows_of(spark, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, FOLDER).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    got = rows_of(spark, "op1_sentencepiece")
    assert got.keys() == texts.keys()
    for i, r in got.items():
        ids = library.encode(texts[i].text, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids))
        assert r.covered_bytes == len(texts[i].text.encode())


def test_op4(spark, texts):
    library = Tokenizer.from_file(queries.BYTE_PAIRS)
    got = rows_of(spark, "op4_token_counts")
    assert got.keys() == texts.keys()
    for i, r in got.items():
        n = len(library.encode(texts[i].text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[i].text.encode()), n, n > 1024)


@pytest.mark.parametrize("name, label, base, out", [("op3_quality", "quality", 5, 0), ("op6_toxicity", "toxic", 4, 2)])
def test_classifiers(spark, texts, name, label, base, out):
    got = rows_of(spark, name)
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % base == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    right = [got[r.doc_id].predicted == r[label] for r in labels]
    assert np.mean(right) > 0.85


def test_op8(spark, texts):
    got = rows_of(spark, "op8_mixing")
    sizes, taken, largest = {}, {}, {}
    for i, r in got.items():
        n = len(texts[i].text.split())
        assert r["size"] == n and 0 <= r.taken <= 3 * n
        source = texts[i].source
        sizes[source] = sizes.get(source, 0) + n
        taken[source] = taken.get(source, 0) + r.taken
        largest[source] = max(largest.get(source, 0), n)
    want = reshared(sizes)
    for i, r in got.items():
        source = texts[i].source
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_op9(spark):
    table = sorted(spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    x = np.array([r.embedding for r in table], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    got = rows_of(spark, "op9_embeddings")
    assert [got[r.vec_id].n_links for r in table] == links.sum(axis=1).tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_op10(spark, texts):
    got = rows_of(spark, "op10_simhash")
    ids = sorted(texts)
    prints = [plain_print(texts[i].text) for i in ids]
    roots = plain_components(prints, 3)
    for place, i in enumerate(ids):
        assert got[i].fingerprint == f"{prints[place]:016x}"
        assert got[i].component_id == ids[roots[place]]
