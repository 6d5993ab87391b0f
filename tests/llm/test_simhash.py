"""Fingerprints, covering masks, links and components against brute force."""

import itertools
import os
import random
import time

import numpy as np
import pytest
import xxhash

from lamina.llm import simhash_cover as sh
from lamina.llm.components import connected_components
from lamina.session import cut_lineage


def plain_print(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    root = list(range(len(prints)))
    for _ in prints:
        for i, j in itertools.combinations(range(len(prints)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[i] = root[j] = min(root[i], root[j])
    return root


TEXTS = [None, "", " \n\t", "One", "ONE two", "É é a b", "a b c a b c a b c", "x\x85y\xa0z\x1cw u v", "long " * 50 + "end"]


def test_fingerprints(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id int, text string, fp int")
    got = {r.doc_id: r.fp for r in sh.fingerprints(docs).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] & (1 << 64) - 1 == plain_print(text), text


@pytest.mark.parametrize("radius", [1, 3, 6])
@pytest.mark.parametrize("bits", [64, 33, 12])
def test_any_few_bits_are_outside_of_a_mask(radius, bits):
    rng = random.Random(bits)
    places = rng.sample(range(64), bits)
    masks = sh.covering_masks(places, radius)
    assert len(masks) == 2 ** (radius + 1) - 2 and all(masks)
    if bits == 64:
        assert {m.bit_count() for m in masks} == {32}
    tried = list(itertools.combinations(places, radius)) if radius < 3 else []
    tried = tried or [rng.sample(places, radius) for _ in range(3000)]
    for some in tried:
        flipped = sum(1 << b for b in some)
        assert any(not m & flipped for m in masks)


def near_prints(count, seed, spread):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(5)]
    out = {0}
    while len(out) < count:
        one = rng.choice(centers)
        for _ in range(rng.randrange(spread)):
            one ^= 1 << rng.randrange(64)
        out.add(one)
    return sorted(out)


@pytest.mark.parametrize("widest", [2048, 12])
@pytest.mark.parametrize("radius", [3, 5])
def test_links_connect_what_brute_force_does(spark, widest, radius):
    """With narrow buckets the finer tables are used again and again."""
    prints = near_prints(120, 4, 8)
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = sh.links(spark.createDataFrame(rows, "fp long"), radius, widest).collect()
    place = {row[0]: i for i, row in enumerate(rows)}
    for r in found:
        assert (prints[place[r.a]] ^ prints[place[r.b]]).bit_count() <= radius
    root = list(range(len(prints)))
    for _ in prints:
        for r in found:
            i, j = place[r.a], place[r.b]
            root[i] = root[j] = min(root[i], root[j])
    assert root == plain_components(prints, radius)


def test_forest_has_no_pair_too_many():
    rng = np.random.default_rng(2)
    prints = np.unique(rng.integers(0, 1 << 12, 900, dtype=np.uint64))
    a, b = sh.forest(prints, 3, block=64)
    assert len(a) < len(prints)
    assert (np.bitwise_count(a ^ b) <= 3).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (20, 3), (30, 31), (31, 32), (32, 33), (33, 34)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 8: 8, 9: 8, 30: 30, 31: 30, 32: 30, 33: 30, 34: 30}
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert connected_components(none, "a", "b").count() == 0


def test_finished_steps_leave_no_shuffle_files(spark):
    """Of the rounds of components no shuffle files stay; else they add up until the driver collects its garbage."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    held = lambda: set(env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    before = held()
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    found = connected_components(links, "a", "b")
    for _ in range(50):
        left = [f for f in held() - before if "shuffle_" in f]
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert {r.root for r in found.collect()} == {0}


def copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 150))]
        rows.append((i, " ".join(words)))
        if i % 6 == 0:
            words[10] = "changed"
            rows.append((100 + i, " ".join(words)))
            rows.append((200 + i, " ".join(words).upper()))
    return rows + [(500, None), (501, ""), (None, rows[0][1]), (3, rows[3][1])]


def test_near_duplicates(spark):
    rows = copies()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, root int")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fp & (1 << 64) - 1, r.component_id) for r in sh.near_duplicates(docs).collect()))
    prints = [plain_print(t) for _, t in rows]
    roots = plain_components(prints, 3)
    least = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            least[root] = min(least.get(root, i), i)
    want = sorted((i is None, i or 0, p, least[r]) for (i, _), p, r in zip(rows, prints, roots))
    assert got == want


def test_one_stays_of_each_group(spark):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sh.representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [*range(60), 500]
    assert sh.representatives(docs.limit(0)).count() == 0
    unnamed = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "p q r s")], "doc_id long, text string")
    assert sorted(r.text for r in sh.representatives(unnamed).collect()) == ["a b c d", "p q r s"]


def plain_kept(rows, least=0.8):
    """Smallest id of each component of texts whose five-word shingles have a Jaccard similarity of ``least``."""
    def shingles(text):
        words = (text or "").encode().lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        one, other = sets[i], sets[j]
        if one == other or 5 * len(one & other) >= 5 * least * len(one | other) - 1e-9 and one and other:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    kept = {}
    for place, (i, _) in enumerate(rows):
        kept.setdefault(find(place), []).append(i)
    return sorted(min(ids) for ids in kept.values())


def test_only_similar_texts_are_dropped(spark):
    """Order and repetition of words count, and so do chains whose links are all similar."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    turned = words[::-1]
    rows = [(1, " ".join(words)), (2, " ".join(turned)), (3, " ".join(words * 9)), (4, " ".join(words[:30] * 9 + words[30:]))]
    chain = [f"c{i}" for i in range(200)]
    for k in range(8):
        chain[20 * k + 5] = f"x{k}"
        rows.append((10 + k, " ".join(chain)))
    line = "one very common line that stands in many texts of this table"
    for i in range(40):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 40))]
        rows.append((100 + i, line + " " + " ".join(own)))
        rows.append((200 + i, line + " " + " ".join([*own[:-1], "z"])))
    rows += [(300, None), (301, " "), (302, "a b"), (303, "A  b"), (304, "b a")]
    got = sorted(r.doc_id for r in sh.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_kept(rows)
    assert {1, 2, 10}.issubset(got) and not {11, 17, 303} & set(got)


def test_sketches_never_refuse_a_similar_pair():
    """What two sketches leave possible is at least what the sets share, also of unequal widths and when all bits are set."""
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 100, 3000, 60_000):
        for m in (1, 90, 4000, 50_000):
            pool = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
            one, other = np.unique(pool[:n]), np.unique(np.concatenate([pool[: n // 2], pool[n:]]))
            bound = sh.most_shared(sh.sketch(one), len(one), sh.sketch(other), len(other))
            assert len(np.intersect1d(one, other)) <= bound <= min(len(one), len(other))
    one = np.arange(400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert sh.most_shared(sh.sketch(one), 400, sh.sketch(one[:200]), 200) == 200
    assert sh.most_shared(sh.sketch(one[:200]), 200, sh.sketch(one[200:]), 200) < 100


def test_one_passage_around_which_texts_differ(spark):
    """Texts that share most of their shingles but too few to be linked, beside some that are."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(100)]
    rows = []
    for i in range(90):
        own = [f"o{i}x{j}" for j in range(rng.choice((2, 6, 9, 12, 20)))]
        cut = rng.randrange(100)
        rows.append((i, " ".join(passage[:cut] + own + passage[cut:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as near_id", "2 as fp", "'k' as set_key", "3 as _key", "4 as _id", "5 as _k")
    kept = sh.representatives(docs)
    assert kept.columns == docs.columns and {r.near_id for r in kept.collect()} == {1}
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(rows)


def test_many_changed_copies_of_one_text(spark, monkeypatch):
    """Of a group of copies with more or fewer changed words, the pairs that are listed are about those that are similar."""
    rng = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        for place in rng.sample(range(150), rng.randrange(2, 15)):
            words[place] = f"n{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    listed = []

    def watched(df):
        out = cut_lineage(df)
        if "promise" in df.columns:
            listed.append(out.count())
        return out

    monkeypatch.setattr(sh, "cut_lineage", watched)
    got = sorted(r.doc_id for r in sh.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == plain_kept(rows) and 10 < len(got) < 290
    sets = [sh.shingle_set(t) for _, t in rows]
    shared = ((len(np.intersect1d(a, b)), len(a) + len(b)) for a, b in itertools.combinations(sets, 2))
    assert listed[0] <= sum(k >= 0.75 * (both - k) for k, both in shared)


def test_few_links_take_few_tasks(spark):
    """The rounds over a few links do not take as many tasks as the shuffles of large tables."""
    context = spark.sparkContext
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    context.setJobGroup("few-links", "components")
    try:
        found = connected_components(links, "a", "b")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.root for r in found.collect()} == {0}
    status = context.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("few-links")]
    stages = {s for job in jobs if job for s in job.stageIds}
    tasks = sum(info.numTasks for info in map(status.getStageInfo, stages) if info)
    assert 0 < tasks < 4000, tasks


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_given_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in sh.representatives(docs).collect()) == plain_kept(rows)
