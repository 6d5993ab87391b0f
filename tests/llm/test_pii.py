"""Spans against Python's regular expressions, disclosure against plain counting."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest

from lamina.llm import pii_disclosure as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m.group())
    ]


def random_text(rng):
    parts = [
        "a.b@c.d", "x@y", "@", "é1.2.3.4", "10.0.0.255", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000.001.2.3", "4111 1111 1111 1111",
        "4111-1111-1111-1111", "41111111111111112222", "1 - 2", "+1 (555) 010-0199", "+4.", "+12 3", "ab@c.d_e@f.g", "b.c@d.e@f.g",
        "word", "😀", "Zoë", "\n", "5", "--", "(", "12 34 56 78 90 12 34 5", "+1 4111111111111111 ", "%@-.-", "9" * 30,
    ]
    return "".join(rng.choice(parts) + rng.choice(["", " ", ", ", "-"]) for _ in range(rng.randrange(14)))


def listing(df):
    return df.select("doc_id", pii.listed("spans").alias("base"), pii.listed(df["spans"], df["added"]).alias("all"))


def test_spans(spark):
    rng = random.Random(8)
    texts = [None, "", "7" * 4000, "a" * 5000 + "@", "1." * 3000, "+" + "( " * 3000, "a@b.c " * 300]
    texts += [random_text(rng) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = pii.detect(docs)
    for row in listing(found).collect():
        assert row.base == ",".join(plain_spans(texts[row.doc_id])), texts[row.doc_id]
    kinds = [pii.count_of(i).alias(k) for i, k in enumerate(PLAIN)]
    for row in found.select("doc_id", *kinds).collect():
        want = plain_spans(texts[row.doc_id])
        assert all(row[k] == sum(s.startswith(k) for s in want) for k in PLAIN)


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choice(["the", "of", "cat", "dog", "sun"]) for _ in range(30))))
    for i in range(60, 66):
        rows.append((i, f"the Zorblat case of kim@corp.example and the cat {i} dog"))
    rows.append((66, "the Zorblat case alone"))
    rows += [(67, "big Quorvex ann@y.example Quorvex ann@y.example and ann@y.example Quorvex")]
    rows += [(70, "ring bob@x.example once"), (70, "ring bob@x.example once"), (None, "mail bob@x.example"), (71, None)]
    return rows


def plain_added(texts):
    """start, end and removed of every term to change, by plain counting of all pairs."""
    n, of_term, of_entity, both, held = len(texts), Counter(), Counter(), Counter(), []
    for text in texts:
        text = text or ""
        spans = [(k, m) for k, p in PLAIN.items() for m in re.finditer(p, text) if holds(k, m.group())]
        entities = {k + ":" + (m.group().lower() if k == "email" else m.group() if k == "ip" else re.sub("[^0-9]", "", m.group())) for k, m in spans}
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]{2,}", text)]
        of_term.update({w for w, _, _ in words})
        of_entity.update(entities)
        free = [w for w in words if spans and not any(m.start() < w[2] and w[1] < m.end() for _, m in spans)]
        both.update((e, t) for e in entities for t in {w for w, _, _ in free})
        held.append((entities, free))

    def share(e, t):
        given = math.log(both[e, t] * n / (of_entity[e] * (of_term[t] + pii.PRIOR)))
        return round(given / math.log(n / of_entity[e]), 9) if of_entity[e] < n else 0.0

    out = []
    for entities, free in held:
        best = [(max(share(e, t) for e in entities), s, z) for t, s, z in free]
        out.append([(s, z, x >= pii.REMOVE) for x, s, z in best if x >= pii.GENERALISE])
    return out


def test_added_terms(spark):
    rng = random.Random(5)
    texts = [text for _, text in corpus()]
    texts += [random_text(rng) + " ".join(rng.choices(["Zoë", "kim", "sun", "Qu1", "the"], k=3)) for _ in range(200)]
    texts += [f"ann{i}@z.example met Veldt{i // 4} and Orm{i // 9} in the sun" for i in range(40)]
    texts += [f"Keldar writes to team@q.example on day {i}" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_added(texts)
    assert sum(map(len, want)) > 50 and any(x[2] for w in want for x in w) and any(not x[2] for w in want for x in w)
    for r in pii.detect(docs).collect():
        assert [tuple(x) for x in r.added] == want[r.doc_id], texts[r.doc_id]


def test_sanitise(spark):
    rows = [(*r, i, "k", "d") for i, r in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int, _k string, cuts string")
    out = {r.spans: r.text for r in pii.sanitise(docs).collect()}
    assert pii.sanitise(docs).columns == docs.columns and len(out) == len(rows)
    for i in range(60):
        assert out[i] == rows[i][1]
    assert out[66] == "the Zorblat case alone" and out[71] is None
    assert "kim@" not in out[61] and "Zorblat" not in out[61] and "[EMAIL]" in out[61] and "dog" in out[61]
    assert "bob@" not in (out[68] + out[69] + out[70])
    assert out[67] == "[TERM] [TERM] [EMAIL] [TERM] [EMAIL] and [EMAIL] [TERM]"
    assert pii.sanitise(docs.limit(0)).count() == 0
    overlap = spark.createDataFrame([(1, "x +4222222222222 y 4111111111111111 z")], "doc_id long, text string")
    assert pii.sanitise(overlap).first().text == "x [PHONE] y [CARD] z"


def test_many_matches_of_one_text(spark):
    rng = random.Random(3)
    words = ["sun", "the", "cat"]
    texts = [" ".join(f"{rng.choice(words)} a{i}@b{i}.example" for i in range(k)) for k in (255, 256, 257, 512, 8000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, "the cat")], "doc_id long, text string")
    begin = time.monotonic()
    for row in listing(pii.detect(docs)).where("doc_id < 9").collect():
        assert row.base == ",".join(plain_spans(texts[row.doc_id]))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    for i, text in enumerate(texts):
        assert clean[i] == re.sub(r"\S+@\S+", "[EMAIL]", text)
    assert time.monotonic() - begin < 60


def test_rows_repeat(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    assert listing(pii.detect(docs)).count() == docs.count()
    none = pii.detect(docs.limit(0))
    assert none.count() == 0
    blank = listing(pii.detect(docs.where("text is null"))).first()
    assert blank.base == "" and hashlib.sha256(b"").hexdigest().startswith("e3b0")
