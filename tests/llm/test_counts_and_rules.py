"""Token counts against the library; rules and license join against plain Python."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lamina.llm import common, license_join, quality_rules, token_counts
from lamina.llm.queries import BYTE_PAIRS

LIBRARY = Tokenizer.from_file(BYTE_PAIRS)
COUNTER = token_counts.PieceCounter(BYTE_PAIRS, batch_bytes=64)


def size(text):
    return len(LIBRARY.encode(text, add_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\xa0 \x1c\x85a'stdon12é한😀<|>.-"), max_size=50))
def test_counts_of_any_text(text):
    assert COUNTER.count([text]) == [size(text)]


def test_special_strings_and_long_texts():
    texts = ["", "a<|endoftext|>b", " <|endoftext|> ", "word " * 3000, "x" * 3000, "  \n\n  ", "don't 'll"]
    assert COUNTER.count(texts) == [size(t) for t in texts]


def test_count_tokens(spark):
    rows = [(1, "Hello there", 5), (1, "Hello there", 5), (None, None, 6), (3, "", 7), (4, "é" * 2000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    out = token_counts.count_tokens(docs, BYTE_PAIRS, slice_bytes=100)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens"]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in out.collect())
    assert got == sorted((i or 0, len((t or "").encode()), size(t or "")) for i, t, _ in rows)
    assert token_counts.count_tokens(docs.limit(0), BYTE_PAIRS).count() == 0


def test_batches_by_bytes():
    for sizes in ([], [0], [5, 5, 5], [100], [1, 100, 1], [0, 0, 0]):
        cut = list(common.batches_by_bytes(sizes, 10))
        assert [i for a, b in cut for i in range(a, b)] == list(range(len(sizes)))
        assert all(sum(sizes[a:b]) <= 10 or b - a == 1 for a, b in cut)


def plain_measures(text):
    text = text or ""
    for c in "\t\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    lines = [line for line in text.split("\n") if line.strip(" ")]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
    }


def test_rules(spark):
    rng = random.Random(6)
    texts = [None, "", " \n \t", "one", "a b", "a b c", "a a a a a", "x y z x y z", "é\x85b\xa0c # $\n# $\n\n# $", "w " * 400]
    texts += ["".join(rng.choice("ab c\n#|") for _ in range(rng.randrange(120))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id int, text string, n_words int, kept string")
    out = quality_rules.apply_rules(docs)
    for r in out.collect():
        want = plain_measures(texts[r.doc_id])
        assert {k: r[k] for k in want} == want, texts[r.doc_id]
        short = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r.base_failed == short and not (short and r.kept)
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def test_rules_stay_one_projection(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = quality_rules.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


LINES = [
    "Released under the MIT License.", "under the mit, license", "CC BY-NC cc by nc", "Apache License, Version 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction", "Licensed under CC BY-SA 4.0", "the license of the mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "nothing here", "É under THE Mit licensE", "",
]


def plain_scan(text):
    split = lambda s: [w for w in "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in s).lower().split(" ") if w]
    words = split(text or "")
    places, base = [], set()
    for phrase, label in license_join.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    more, best = set(), 0.0
    for line in (text or "").split("\n"):
        have = set(split(line))
        for label, template in license_join.TEMPLATES:
            want = set(template.split())
            share = len(want & have) / len(want)
            if share >= license_join.CONTAINMENT - 1e-12:
                more.add(label)
                best = max(best, share)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(base | more), 1.0 if places else best


def test_license_scan(spark):
    rng = random.Random(9)
    texts = [None, "", *LINES] + ["\n".join(rng.choices(LINES, k=rng.randrange(1, 5))) for _ in range(60)]
    texts += [" ".join(rng.choices(LINES, k=3)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, LINES[0], "y")], "doc_id int, text string, label string")
    for r in license_join.scan(docs).collect():
        text = LINES[0] if r.doc_id is None else texts[r.doc_id]
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
        want = plain_scan(text)
        assert got[:6] == want[:6] and got[6] == pytest.approx(want[6]), text
    assert license_join.scan(docs.limit(0)).count() == 0
