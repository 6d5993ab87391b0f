import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.operators import evaluate, trees
from lamina.session import fresh_path
from tests.conftest import rows


def labelled(spark, tp, fn, fp, tn):
    pairs = [(1, 1)] * tp + [(1, 0)] * fn + [(0, 1)] * fp + [(0, 0)] * tn
    return spark.createDataFrame(pairs, "y int, p int")


def test_published_metrics(spark):
    m = evaluate.evaluate(labelled(spark, 32, 46, 22, 56), "y", "p").first()
    got = [round(m[n], 4) for n in evaluate.METRICS]
    assert got == [0.5641, 0.5926, 0.4103, 0.4848]
    assert m["tp"] + m["tn"] + m["fp"] + m["fn"] == 156


def test_undefined_metrics_are_zero(spark):
    m = evaluate.evaluate(labelled(spark, 0, 0, 0, 5), "y", "p").first()
    assert (m["acuracia"], m["precisao"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)
    empty = evaluate.evaluate(labelled(spark, 1, 0, 0, 0).limit(0), "y", "p").first()
    assert empty["acuracia"] == 0.0


def test_tie_takes_second_model(spark):
    m = spark.createDataFrame([("modelo1_gini", 0.5), ("modelo2_entropy", 0.5)], "model string, f1 double")
    assert evaluate.best_model(m).first()["best_model"] == "modelo2_entropy"
    m = spark.createDataFrame([("modelo1_gini", 0.6), ("modelo2_entropy", 0.5)], "model string, f1 double")
    assert evaluate.best_model(m).first()["best_model"] == "modelo1_gini"


def test_verdicts(spark):
    one = spark.createDataFrame([(0.5, 0.5, 0.5)], "a double, b double, c double")
    two = spark.createDataFrame([(0.502, 0.5005, 0.4995)], "a double, b double, c double")
    got = {r["metric"]: r["improved"] for r in evaluate.layer_verdict(one, two, ("a", "b", "c")).collect()}
    assert got == {"a": "SIM", "b": "=", "c": "NAO"}


def test_label_is_strict(spark):
    df = spark.createDataFrame([(1.0, "train"), (2.0, "train"), (3.0, "test"), (None, "test")], "total_loss_usd double, split string")
    limit = evaluate.label_threshold(df)
    assert limit == 2.0 and evaluate.label_threshold(df, scope="train") == 1.5
    got = [r["label"] for r in evaluate.with_label(df, limit).collect()]
    assert got == [0, 0, 1, 0]


def test_prediction_tables(spark):
    df = spark.createDataFrame([(7, 1, 1, 0, 9.876), (3, 0, 1, 0, 1.0)], "k int, y int, a int, b int, total_loss_usd double")
    one = evaluate.prediction_table(df, "k", "y", "a", 5.0)
    assert rows(one) == [(0, "Baixo", "Alto", "NAO", 1.0, 5.0), (1, "Alto", "Alto", "SIM", 9.88, 5.0)]
    both = evaluate.side_by_side(df, "k", "y", "a", "b")
    assert rows(both)[0] == (0, "Baixo", "Alto", "Baixo", "NAO", "SIM", 1.0)
    other = evaluate.prediction_table(df, "k", "y", "b", 5.0)
    assert rows(evaluate.join_predictions(one, other)) == rows(both)
    assert rows(evaluate.side_by_side(df, "k", "y", "a", "b", words=False))[1][4:6] == (1, 0)


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(6000).select(
        "id", F.rand(1).alias("x1"), F.rand(2).alias("x2"), F.lit(1.0).alias("x3")
    )
    df = df.withColumn("label", (F.col("x1") > 0.4).cast("int")).withColumn(
        "split", F.when(F.col("id") < 4800, "train").otherwise("test")
    )
    (tree,) = trees.fit_trees(df.filter("split = 'train'"), ["x1", "x2", "x3"], [trees.GINI])
    return df, tree


def test_planted_signal(spark, planted):
    df, tree = planted
    scored = trees.predict(df, tree, tree.spec.name)
    metrics = evaluate.evaluate_models(scored, "label", {tree.spec.name: tree.spec.name}, ["split"])
    assert all(r["acuracia"] > 0.98 for r in metrics.collect())
    importance = trees.impurity_importance(spark, tree)
    assert importance.first()["feature"] == "x1"
    assert abs(sum(r["importance"] for r in importance.collect()) - 1) < 1e-9
    gap = evaluate.overfit_gap(metrics)
    assert abs(gap.first()["acuracia_gap"]) < 0.02
    summary = trees.model_summary(scored, tree, gap, importance).first()
    assert (summary["n_treino"], summary["n_teste"], summary["max_depth"]) == (4800, 1200, 5)


def plain_prediction(tree, x):
    at = 0
    while tree.nodes[at].feature is not None:
        node = tree.nodes[at]
        at = node.left if x[node.feature] <= node.threshold else node.right
    return tree.nodes[at].prediction


@pytest.mark.parametrize("bucket_rows", [50_000, 100, 3])
def test_permutation_importance(planted, bucket_rows):
    """Scoring only the rows whose path asks for a feature gives what scoring all rows again gives."""
    df, tree = planted
    test = df.filter("split = 'test'")
    got = {r["feature"]: r["importance"] for r in trees.permutation_importance(test, tree, "id", bucket_rows=bucket_rows).collect()}
    data = [(r.id, (r.x1, r.x2, r.x3), r.label) for r in test.collect()]
    buckets = {}
    for key, x, y in data:
        digest = hashlib.md5(f"{key}:42".encode()).hexdigest()
        buckets.setdefault(int(digest[:8], 16) % -(-len(data) // bucket_rows), []).append((digest, key, x, y))
    for f, name in enumerate(("x1", "x2", "x3")):
        lost = 0
        for members in buckets.values():
            members.sort()
            for i, (_, _, x, y) in enumerate(members):
                for r in range(1, 6):
                    mixed = list(x)
                    mixed[f] = members[(i + r) % len(members)][2][f]
                    lost += (plain_prediction(tree, x) == y) - (plain_prediction(tree, mixed) == y)
        assert abs(got[name] - lost / (5 * len(data))) < 1e-12


def test_permutation_of_few_rows(planted):
    df, tree = planted
    for rows_ in ("id = 1", "id = -1"):
        table = trees.permutation_importance(df.filter(rows_), tree, "id")
        assert {r["importance"] for r in table.collect()} == {0.0}


def test_nodes_rules_and_storage(spark, planted):
    df, tree = planted
    nodes = trees.tree_nodes(spark, tree).collect()
    assert len(nodes) == len(tree.nodes)
    root = next(n for n in nodes if n["node"] == 0)
    assert root["feature"] == "x1" and abs(root["threshold"] - 0.4) < 0.05
    assert sum(n["rows"] for n in nodes if n["feature"] is None) == 4800
    loaded = trees.load_model(spark, trees.save_model(spark, tree, fresh_path(spark, "model")))
    assert loaded == tree
    leaves = {}
    for r in trees.leaf_rules(spark, tree).collect():
        leaves.setdefault(r["leaf"], []).append(r)
    place = {"x1": 0, "x2": 1, "x3": 2}
    for row in trees.predict(df.limit(200), tree).collect():
        x = (row.x1, row.x2, row.x3)
        fits = [
            rules[0]["prediction"]
            for rules in leaves.values()
            if all((r["above"] is None or x[place[r["feature"]]] > r["above"]) and (r["up_to"] is None or x[place[r["feature"]]] <= r["up_to"]) for r in rules)
        ]
        assert fits == [row.prediction] == [plain_prediction(tree, x)]


def plain_tree(rows_, spec, depth=0):
    """(depth, zeros, ones, feature, code, gain) of a walk from the root, every cut of every node tried."""
    def impurity(zeros, ones):
        shares = [n / (zeros + ones) for n in (zeros, ones) if n]
        return 1 - sum(p * p for p in shares) if spec.impurity == "gini" else -sum(p * math.log2(p) for p in shares)

    ones = sum(y for _, y in rows_)
    zeros, best = len(rows_) - ones, None
    for f in range(len(rows_[0][0]) if zeros and ones and depth < spec.depth else 0):
        for code in sorted({x[f] for x, _ in rows_})[:-1]:
            left = [y for x, y in rows_ if x[f] <= code]
            a, n = sum(left), len(left)
            gain = impurity(zeros, ones) - n / len(rows_) * impurity(n - a, a)
            gain -= (len(rows_) - n) / len(rows_) * impurity(zeros - n + a, ones - a)
            if gain > 1e-12 and (best is None or (-round(gain, 12), f, code) < best[:3]):
                best = (-round(gain, 12), f, code, gain)
    if best is None:
        return [(depth, zeros, ones, None, None, None)]
    _, f, code, gain = best
    sides = [[r for r in rows_ if (r[0][f] <= code) == side] for side in (True, False)]
    return [(depth, zeros, ones, f, code, round(gain, 9)), *plain_tree(sides[0], spec, depth + 1), *plain_tree(sides[1], spec, depth + 1)]


def test_trees_against_every_cut_tried(spark):
    rng = random.Random(1)
    data = [([rng.randrange(6), rng.randrange(9), 3, rng.randrange(2)], 0) for _ in range(400)]
    data = [(x, int((x[0] > 2) ^ (x[1] in (1, 2, 7)) if rng.random() < 0.85 else rng.randrange(2))) for x, _ in data]
    df = spark.createDataFrame([(*map(float, x), y) for x, y in data], "a double, b double, c double, d double, label int")
    edges = {n: tuple(float(v) for v in range(9)) for n in "abcd"}
    for spec, tree in zip((trees.GINI, trees.ENTROPY), trees.fit_trees(df.repartition(5), list("abcd"), (trees.GINI, trees.ENTROPY), edges=edges)):
        got = [(n.depth, n.zeros, n.ones, n.feature, n.code, n.gain and round(n.gain, 9)) for n in tree.nodes]
        assert got == plain_tree(data, spec)
        assert len(got) > 20
        found = [r.prediction for r in trees.predict(df, tree).collect()]
        assert found == [plain_prediction(tree, x) for x, _ in data]


def test_trees_do_not_depend_on_partitions(spark):
    """More rows than any sample would hold; bounds are exact ranks of all of them."""
    df = spark.range(30_000).select(
        "id", *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_003)).cast("double").alias(f"x{k}") for k in range(4)]
    )
    noise = F.pmod(F.xxhash64("id", F.lit("noise")), F.lit(10)) < 3
    df = df.withColumn("label", ((F.col("x1") > 40_000) & (F.col("x2") > 30_000) | noise).cast("int"))
    names = ["x0", "x1", "x2", "x3"]
    plain = {n: sorted(r[0] for r in df.select(n).collect()) for n in names}
    want = {n: tuple(sorted({v[30_000 * k // 32] for k in range(1, 32)})) for n, v in plain.items()}
    assert trees.bin_edges(df.repartition(3), names, gathered=100, buckets=64) == want
    dumps = []
    for part in (df.coalesce(1), df.repartition(7, "x3")):
        (tree,) = trees.fit_trees(part, names, [trees.ENTROPY])
        dumps.append(tree.nodes)
    assert dumps[0] == dumps[1] and len(dumps[0]) > 20
    assert {n.threshold for n in dumps[0] if n.feature == 1} <= set(want["x1"])


def test_codes(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (1.0,), (1.5,), (9.0,)], "a double")
    got = [list(r[0]) for r in df.select(trees.codes(df, {"a": (0.0, 1.0, 2.0)})).collect()]
    assert got == [[0], [0], [0], [1], [2], [3]]
    assert trees.bin_edges(df.limit(0), ["a"]) == {"a": ()}
    assert [list(r[0]) for r in df.limit(2).select(trees.codes(df, {"a": ()})).collect()] == [[0], [0]]


def test_trees_without_cuts(spark):
    """No rows, one class, no features, constant features: a single leaf."""
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, label int")
    for part, names in ((df.limit(0), ["a"]), (df, ["a"]), (df, []), (df.selectExpr("1.0D as a", "label"), ["a"])):
        (tree,) = trees.fit_trees(part, names, [trees.GINI])
        assert len(tree.nodes) == 1
        assert {r.prediction for r in trees.predict(df, tree).collect()} == {int(tree.nodes[0].ones > 0)}
        assert trees.impurity_importance(spark, tree).filter("importance <> 0").count() == 0


def test_features_of_few_values_are_counted_not_searched(spark, monkeypatch):
    """Bounds of a column of few values come from one count of them, equal to those of the search."""
    df = spark.range(5000, numPartitions=3).select(
        F.col("id").cast("double").alias("wide"), (F.col("id") % 7 - 3).cast("double").alias("few"), (F.col("id") % 90 == 0).alias("flag")
    )
    names = ["wide", "few", "flag"]
    want = {}
    for n in names:
        held = sorted(float(r[0]) for r in df.select(n).collect())
        want[n] = tuple(sorted({held[5000 * k // 32] for k in range(1, 32)}))
    searched = []
    search = trees.select_ranks
    monkeypatch.setattr(trees, "select_ranks", lambda rows_, ranks, *a, **k: searched.extend(ranks) or search(rows_, ranks, *a, **k))
    assert trees.bin_edges(df, names) == want
    assert searched == ["wide"]


def test_rows_are_not_multiplied_by_features(planted):
    """Neither counting nor permuting writes a row for each feature of a row."""
    df, tree = planted
    coded = df.select(trees.codes(df, {"x1": (0.5,), "x2": (0.2, 0.4)}).alias("codes"), "label")
    counts = trees._counted(coded, (2, 3), [(0, trees.walk_of([trees.Node(0, 0, 0)], "code"), np.array([0]))])
    held = [(r.x1 > 0.5, (r.x2 > 0.2) + (r.x2 > 0.4), r.label) for r in df.collect()]
    want = {(f, c): [sum(h[f] == c and h[2] == y for h in held) for y in (0, 1)] for f in (0, 1) for c in range(3)}
    assert {(r.f, r.code): [r.zeros, r.ones] for r in counts.collect()} == {k: v for k, v in want.items() if any(v)}
    for plan in (counts, trees.permutation_importance(df, tree, "id")):
        assert "Generate" not in plan._jdf.queryExecution().optimizedPlan().toString()
