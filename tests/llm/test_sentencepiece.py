"""The codec against the library, and its offsets against a plain normaliser."""

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import sentencepiece_codec as sc
from lamina.llm.queries import PIECES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
CODEC = sc.Codec(PIECES)
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n x \t y ", "▁ literal ▁▁ marks", "é😀 ẞ 한국어 \x00 end", "x" * 5000]


def same(text):
    found = CODEC.encode([text])[0]
    ids = LIBRARY.encode(text, add_eos=True)
    assert found.ids.tolist() == ids
    assert CODEC.decode([ids])[0] == LIBRARY.decode(ids)
    raw = text.encode()
    assert found.begins[:1].tolist() in ([0], [len(raw)])
    assert found.ends[-1] == len(raw)
    assert (found.begins[1:] == found.ends[:-1]).all() and (found.ends >= found.begins).all()
    for one, begin, end in zip(ids, found.begins, found.ends):
        if not (LIBRARY.is_control(one) or LIBRARY.is_byte(one)):
            piece = LIBRARY.id_to_piece(one).encode()
            source = raw[begin:end].replace(b" ", sc.SPACE_MARK)
            assert piece in (source, sc.SPACE_MARK + source)


@pytest.mark.parametrize("text", TEXTS)
def test_fixed_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\tabcdeéß▁😀한.,019 "), max_size=60))
def test_any_text(text):
    same(text)


def test_no_vocabulary_piece_crosses_a_space():
    assert CODEC.by_word


def test_whole_texts_give_the_same_as_words():
    plain = sc.Codec(PIECES)
    plain.by_word = False
    rng = random.Random(5)
    for _ in range(50):
        text = "".join(rng.choice("ab e\n.  ñ") for _ in range(rng.randrange(300)))
        one, other = CODEC.encode([text])[0], plain.encode([text])[0]
        assert (one.ids == other.ids).all() and (one.begins == other.begins).all()
        # The sparse record agrees with the full one.
        aligned = CODEC.normalizer.align(text)
        cuts = np.arange(len(aligned.data) + 1)
        assert (CODEC.normalizer.project(text, cuts) == aligned.source).all()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("trim", [True, False])
def test_compiled_map_as_the_library(rule, trim):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=trim, escape_whitespaces=True
    )
    spec = sc.read_spec(library.serialized_model_proto())
    assert spec.trim_spaces == trim and bool(spec.charsmap) == (rule != "identity")
    mine = sc.Normalizer(spec)
    samples = ["", "  ", "ＡＢ ﬁ  x", "①② Ｋ ½ ㍿", "  lead and tail  ", "é Å", "　a b\tc\n", "İSTANBUL ẞ", "ｶﾞ 한국 ​"]
    for text in samples:
        aligned = mine.align(text)
        norm, offsets = library.normalize(text, with_offsets=True)
        assert aligned.data.decode() == norm, text
        # Library offsets are in characters of both texts.
        place, starts = 0, []
        for char in norm:
            starts.append(place)
            place += len(char.encode())
        raw = text.encode()
        found = [len(raw[: aligned.source[i]].decode()) for i in [*starts, place]]
        assert found == list(offsets), text


def test_documents(spark):
    rows = [(1, "Hi there", "x"), (2, None, "y"), (2, "", "z"), (None, "Hi there", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sc.encode_documents(docs, PIECES, decoded=True)
    assert out.columns == ["doc_id", "ids", "begins", "ends", "decoded"]
    got = sorted(((r.doc_id or 0), r.ids, r.decoded) for r in out.collect())
    hi = LIBRARY.encode("Hi there", add_eos=True)
    assert got == [(0, hi, "Hi there"), (1, hi, "Hi there"), (2, [2], ""), (2, [2], "")]
    back = sc.decode_documents(out.drop("decoded"), PIECES)
    assert sorted(r.decoded for r in back.collect()) == ["", "", "Hi there", "Hi there"]
    assert sc.encode_documents(docs.limit(0), PIECES).count() == 0
